"""What a write observes on its way."""

from __future__ import annotations

from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(seen: Observation, **nothing: Any) -> dict[str, Any]:
    """The observed values; ``nothing`` where there were no rows.

    Adaptive execution replaces a plan by an empty one when a shuffle turns out to
    be empty, and the observation goes with it.
    """
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return nothing
