"""From a drop to a bronze table in one read of the drop, with counts of what became of its lines."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tapemill.functions.keys import any_missing
from tapemill.sources.checked import Delivery
from tapemill.storage.publish import write_audit_publish
from tapemill.storage.table import Pointer, Table

log = logging.getLogger(__name__)

EXCLUDED_RULES = "spark.sql.adaptive.optimizer.excludedRules"
EMPTY_RELATIONS = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


@dataclass(frozen=True)
class Loaded:
    """Lines read, rejected as unreadable, without a required key, repeating another's key, and loaded."""

    read: int
    rejected: int
    nameless: int
    repeated: int
    loaded: int
    pointer: Pointer | None


NOTHING = Loaded(0, 0, 0, 0, 0, None)


@contextmanager
def _counting(spark: SparkSession) -> Iterator[None]:
    """Keep adaptive execution from cutting a plan that turns out empty, and its counts along with it."""
    before = spark.conf.get(EXCLUDED_RULES, None)
    spark.conf.set(EXCLUDED_RULES, ",".join(filter(None, (before, EMPTY_RELATIONS))))
    try:
        yield
    finally:
        spark.conf.unset(EXCLUDED_RULES) if before is None else spark.conf.set(EXCLUDED_RULES, before)


def load(
    table: Table,
    delivery: Delivery,
    lineage: Callable[[DataFrame], DataFrame],
    reduce: Callable[[DataFrame], DataFrame],
    run_id: str,
    required: tuple[str, ...] = (),
    rejects: str | None = None,
) -> Loaded:
    """Upsert the accepted lines that have all `required` columns, reduced to one per key.

    The counts are taken while the rows are written, so the drop is read once; only if lines were rejected and
    `rejects` names a folder is it read again for them. `lineage` sees the accepted columns and the file. Tasks
    that are repeated after a lost executor may be counted twice.
    """
    if delivery.empty:
        log.info("%s run %s: nothing has arrived", table.spec.name, run_id)
        return NOTHING
    lines, kept = Observation(), Observation()
    nameless = any_missing(required) if required else F.lit(False)
    rows = delivery.rows.observe(
        lines,
        F.count("*").alias("read"),
        F.count_if(delivery.is_rejected).alias("rejected"),
        F.count_if(~delivery.is_rejected & nameless).alias("nameless"),
    )
    accepted = lineage(rows.where(~delivery.is_rejected & ~nameless)).select(*table.spec.columns)
    source = reduce(accepted).observe(kept, F.count("*").alias("loaded"))
    with _counting(table.spark):
        pointer = write_audit_publish(table, source, run_id)
    seen, loaded = lines.get, kept.get["loaded"]
    repeated = seen["read"] - seen["rejected"] - seen["nameless"] - loaded
    result = Loaded(seen["read"], seen["rejected"], seen["nameless"], repeated, loaded, pointer)
    log.info("%s run %s: %s", table.spec.name, run_id, result)
    if result.rejected and rejects:
        delivery.rejected().write.mode("overwrite").parquet(f"{rejects}/run={run_id}")
    return result
