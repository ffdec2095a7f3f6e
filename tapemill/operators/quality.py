"""Data-quality checks: a list of rules in, one result frame out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapemill.functions.keys import any_missing
from tapemill.specs import EVENT_TYPES, SIDES

SUCCESS, FAILURE = "Success", "Failure"
RESULT_COLUMNS = ("suite", "rule", "metric", "min_ratio", "status")


@dataclass(frozen=True)
class Rule:
    """Share of rows meeting `predicate`, or, with `unique_on`, share of rows alone under their key."""

    name: str
    min_ratio: float = 1.0
    predicate: str | None = None
    unique_on: tuple[str, ...] = ()


def complete(col: str) -> Rule:
    return Rule(f"complete({col})", predicate=f"{col} IS NOT NULL")


def contained_in(col: str, values: Sequence[str]) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"contained_in({col})", predicate=f"{col} IS NULL OR {col} IN ({listed})")


def non_negative(col: str) -> Rule:
    return Rule(f"non_negative({col})", predicate=f"coalesce({col}, 0) >= 0")


def satisfies(predicate: str, min_ratio: float = 1.0) -> Rule:
    """A NULL predicate counts as not met."""
    return Rule(f"satisfies({predicate})", min_ratio, predicate=predicate)


def unique(cols: Sequence[str], min_ratio: float = 1.0) -> Rule:
    return Rule(f"unique({', '.join(cols)})", min_ratio, unique_on=tuple(cols))


_TICK_KEY = ("exchange", "symbol", "exchange_ts", "sequence_num")

# The rules of each suite and the shares they ask for.
SUITES: dict[str, tuple[Rule, ...]] = {
    "silver_trades_quality": (
        *(complete(c) for c in _TICK_KEY),
        contained_in("side", SIDES),
        non_negative("size"),
        non_negative("price"),
        unique(_TICK_KEY, 0.9999),
    ),
    "silver_quotes_quality": (
        *(complete(c) for c in (*_TICK_KEY, "bid", "ask")),
        *(non_negative(c) for c in ("bid", "ask", "bid_size", "ask_size")),
        satisfies("ask > bid", 0.99),
        unique(_TICK_KEY, 0.9999),
    ),
    "silver_events_quality": (
        *(complete(c) for c in ("event_id", "symbol", "event_type", "event_date")),
        contained_in("event_type", EVENT_TYPES),
        complete("event_start"),
        satisfies("event_end > event_start"),
        unique(("event_id", "event_date")),
    ),
}


def _status(metric: Column, min_ratio: float | Column) -> Column:
    return F.when(F.coalesce(metric >= min_ratio, F.lit(False)), SUCCESS).otherwise(FAILURE)


def _result(suite: str, rule: Rule, met: Column, total: Column) -> Column:
    ratio = F.try_divide(met.cast("double"), total.cast("double"))
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(rule.name).alias("rule"),
        ratio.alias("metric"),
        F.lit(rule.min_ratio).alias("min_ratio"),
        _status(ratio, rule.min_ratio).alias("status"),
    )


def run_checks(df: DataFrame, suite: str, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row per rule: suite, rule, metric, min_ratio, status.

    The first uniqueness rule is a count per key, combined on the map side, so a hot key costs one partial row
    per task; all row rules are counted along with it, in the same pass over the input. Further uniqueness
    rules take a pass each. An empty input gives NULL metrics, hence failures.
    """
    rules = SUITES[suite] if rules is None else rules
    row_rules = [r for r in rules if not r.unique_on]
    unique_rules = [r for r in rules if r.unique_on]
    count = F.count("*").alias("total")
    met = [F.count_if(F.expr(r.predicate)).alias(f"met_{i}") for i, r in enumerate(row_rules)]
    if unique_rules:
        per_key = df.groupBy(*unique_rules[0].unique_on).agg(count, *met)
        names = ["total", *(f"met_{i}" for i in range(len(row_rules)))]
        counted = per_key.agg(F.count_if(F.col("total") == 1).alias("alone"), *[F.sum(n).alias(n) for n in names])
    else:
        counted = df.agg(count, *met)
    results = [_result(suite, r, F.col(f"met_{i}"), F.col("total")) for i, r in enumerate(row_rules)]
    results += [_result(suite, r, F.col("alone"), F.col("total")) for r in unique_rules[:1]]
    out = counted.select(F.explode(F.array(*results)).alias("r")).select("r.*")
    for rule in unique_rules[1:]:
        per_key = df.groupBy(*rule.unique_on).agg(count)
        alone = per_key.agg(F.count_if(F.col("total") == 1).alias("alone"), F.sum("total").alias("total"))
        out = out.unionByName(alone.select(_result(suite, rule, F.col("alone"), F.col("total")).alias("r")).select("r.*"))
    return out


def missing_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count, and how many rows have a NULL in any of `cols`."""
    return df.agg(F.count("*").alias("n_rows"), F.count_if(any_missing(cols)).alias("n_missing"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column of `cols`: column_name, n_null, status."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in cols])
    return counted.select(F.explode(rows).alias("r")).select(
        "r.column_name", "r.n_null", F.when(F.col("r.n_null") == 0, SUCCESS).otherwise(FAILURE).alias("status")
    )


def row_count_gate(df: DataFrame, day: Column, days: DataFrame, gate: str, min_rows: int) -> DataFrame:
    """One row per expected day of `days(day)`: gate, day, n_rows, min_rows, status.

    `days` is the list of run dates, so a day without rows still shows, with a count of zero.
    """
    counts = df.groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    n_rows = F.coalesce("n", F.lit(0))
    return days.join(counts, "day", "left").select(
        F.lit(gate).alias("gate"),
        "day",
        n_rows.alias("n_rows"),
        F.lit(min_rows).cast("long").alias("min_rows"),
        F.when(n_rows >= min_rows, SUCCESS).otherwise(FAILURE).alias("status"),
    )
