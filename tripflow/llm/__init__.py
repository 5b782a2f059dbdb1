"""Operators for preparing training text at scale, and the queries that apply them.

Nothing else in the library imports this package. Each module is one operator;
``queries`` registers one query per operator, with SQL where SQL can express it.
"""

import sys

from pyspark import cloudpickle

# Send the helpers of this package to tasks as code: executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
