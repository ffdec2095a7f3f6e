"""Keyed upsert as a DataFrame expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.functions.keys import all_present, any_missing, numbers_first
from tapemill.operators.dedup import WHOLE_KEY, one_per_key

AMBIGUOUS = "upsert: several source rows match one target row"


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(all_present(keys))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace target rows whose key occurs in `source`, keep the others, add all source rows.

    Rows with a NULL in the key match nothing. A target row matched by several source rows
    raises when the plan runs, and only then: unmatched repeats are simply inserted. The source
    is counted per key before the join, so a repeated key cannot multiply rows.

    Sides marked by `one_per_merge_key` are not shuffled again for the join.
    """
    on, columns = numbers_first(target, keys), [c for c in target.columns if c != WHOLE_KEY]
    matches = _whole_keys(source, keys).groupBy(*on).agg(F.count("*").alias("_matches"))
    untouched = (
        F.when(F.col("_matches").isNull(), True)
        .when(F.col("_matches") == 1, False)
        .otherwise(F.raise_error(AMBIGUOUS).cast("boolean"))
    )
    keyed = _whole_keys(target, keys).join(matches, on, "left").where(untouched)
    # Target rows without a whole key match nothing; in the join they would all meet in one task.
    rest = target.where(~F.col(WHOLE_KEY) if WHOLE_KEY in target.columns else any_missing(keys))
    return keyed.select(*columns).unionByName(rest.select(*columns)).unionByName(source.select(*columns))


def _whole_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.where(WHOLE_KEY) if WHOLE_KEY in df.columns else drop_null_keys(df, keys)


def latest_of(rows: DataFrame, keys: Sequence[str], stamp: str = "_ingest_ts") -> DataFrame:
    """The latest delivery of each key, ties by the other columns; rows with a NULL in the key all stay.

    Reducing parts first and then their union gives the same, so deliveries may come in any batches. Where rows
    without a whole key are repeated they stay repeated.
    """
    others = [c for c in rows.columns if c not in keys and c != stamp]
    return one_per_key(rows, keys, [F.col(stamp).desc(), *others])
