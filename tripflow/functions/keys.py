"""Key rewriting."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def remapped(key: Column, mapping: Mapping[int, int]) -> Column:
    """Replace ``key`` where ``mapping`` lists it; all replacements at once.

    Unlisted values and NULL stay. Each branch tests the original value, so a
    mapping of a to b and b to a swaps the two.
    """
    if not mapping:
        return key
    branches = None
    for old, new in mapping.items():
        hit, value = key == F.lit(old), F.lit(new)
        branches = F.when(hit, value) if branches is None else branches.when(hit, value)
    return branches.otherwise(key)
