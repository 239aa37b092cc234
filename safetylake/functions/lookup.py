"""Value mappings as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, mapping: dict[str, object]) -> Column:
    """The mapped value of a key; NULL for a key that is not listed."""
    (first, value), *rest = mapping.items()
    start = F.when(key == first, F.lit(value))
    return reduce(lambda chain, kv: chain.when(key == kv[0], F.lit(kv[1])), rest, start)
