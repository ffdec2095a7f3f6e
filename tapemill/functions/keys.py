"""Conditions on key columns and their order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def any_missing(cols: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in cols])


def numbers_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Keys with text last. Spark compares sort rows by an 8-byte prefix of the first column, which
    decides almost every comparison for a time or a number, but none for a handful of exchanges."""
    kinds = dict(df.dtypes)
    return sorted(keys, key=lambda k: kinds[k] == "string")
