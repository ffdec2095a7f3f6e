"""Write, audit, publish: rows go into new folders, one aggregate audits them, one rename makes them the table.

A lost executor only repeats tasks of a Spark write. A lost driver leaves a folder that nothing refers to. One
writer per table at a time: publishing checks that the table is still the version it started from.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.operators import quality
from tapemill.operators.upsert import drop_null_keys, upsert
from tapemill.session import MIB
from tapemill.storage.table import Pointer, Table, Values, partition_values

log = logging.getLogger(__name__)

# Parquet bytes, for each core, that are merged at once. Their shuffles take about ten times as much disk, which so
# follows the cluster and not the table.
SLICE_BYTES = 32 * MIB

Merge = Callable[[DataFrame, DataFrame, tuple[str, ...]], DataFrame]


class QualityError(RuntimeError):
    """A check failed; the published version is unchanged."""


class ConflictError(RuntimeError):
    """Another writer published in between."""


@dataclass(frozen=True)
class Staged:
    """A version under audit, the partitions it rewrites and the version it was made from."""

    pointer: Pointer
    written: dict[str, str]
    parent: str | None


def _shared_keys(table: Table, source: DataFrame, partitions: dict[str, str], how: str) -> DataFrame:
    """Join of the partitions' rows ("t") and `source` ("s") on the key, where it lies in another partition of either.

    The source's least and greatest key values go along as filters, which Parquet's statistics answer for
    most row groups.
    """
    keys, by = table.spec.keys, table.spec.partition_by
    ends = drop_null_keys(source, keys).agg(*[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    rows = table.with_partition_columns(table.read_partitions(partitions if ends[0] is not None else {}))
    for key in keys if ends[0] is not None else ():
        rows = rows.where(F.col(key).between(ends[f"min_{key}"], ends[f"max_{key}"]))
    columns = list(dict.fromkeys([*keys, *by]))
    rows, source = rows.select(*columns).alias("t"), table.with_partition_columns(source).select(*columns).alias("s")
    same_key = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    moved = reduce(or_, [~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by])
    return rows.join(source, [*same_key, moved], how)


def _partitions_holding(table: Table, source: DataFrame, partitions: dict[str, str]) -> set[str]:
    """Partitions with a row whose key occurs in `source` under another partition, by one semi join on the key."""
    return _named(partitions, table.values_in(_shared_keys(table, source, partitions, "left_semi")))


def _moves(table: Table, source: DataFrame, partitions: dict[str, str]) -> list[tuple[Values, Values, Values]]:
    """For each of the partitions that `_partitions_holding` found: its values, and the least and the greatest values
    under which the source has its keys."""
    by = table.spec.partition_by
    text = {side: F.struct(*[F.coalesce(F.col(f"{side}.{c}").cast("string"), F.lit("")).alias(c) for c in by]) for side in "ts"}
    found = _shared_keys(table, source, partitions, "inner").groupBy(text["t"].alias("t")).agg(F.min(text["s"]), F.max(text["s"]))
    return [tuple(tuple(value or None for value in values) for values in row) for row in found.collect()]


def _slices(weights: dict[Values, int], moves: list[tuple[Values, Values, Values]], most: int) -> list[set[Values]]:
    """Partitions that are merged at once, in sets of about the weight `most`.

    Every partition between which a key moves is in one set, so that all rows of a key meet; a set outweighs `most`
    only for that or for a single partition.
    """
    order = sorted(weights, key=lambda values: [value or "" for value in values])
    place = {values: n for n, values in enumerate(order)}
    parent = list(range(len(order)))

    def root(n: int) -> int:
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    for held, least, greatest in moves:
        for n in range(place[least], place[greatest] + 1):
            parent[root(n)] = root(place[held])
    together: dict[int, list[Values]] = {}
    for values in order:
        together.setdefault(root(place[values]), []).append(values)
    slices, weight = [set()], 0
    for group in together.values():
        more = sum(weights[values] for values in group)
        if slices[-1] and weight + more > most:
            slices.append(set())
            weight = 0
        slices[-1].update(group)
        weight += more
    return slices


def _named(partitions: dict[str, str], values: set[Values]) -> set[str]:
    return {p for p in partitions if tuple(partition_values(p).values()) in values}


def stage(
    table: Table,
    source: DataFrame,
    run_id: str,
    check_source: Callable[[DataFrame], None] | None = None,
    merge: Merge = upsert,
) -> Staged:
    """Merge `source` into the partitions it meets, as a new version that no reader sees.

    The source is written once and read back from then on, so its plan runs once. For an empty table it is written as
    the new version; otherwise as it comes, since sorted partition folders would only be read and written again. Large
    merges go slice by slice of the partitions, so that only one slice is shuffled at a time; `merge` sees all rows of
    each key that the table has in one slice.
    """
    current = table.pointer()
    base = current.partitions if current else {}
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    met: set[str] = set()
    try:
        if base:
            rows = table.write_rows(source, f"{version}-in")
        else:
            written = table.write_version(source, f"{version}-in")
            rows = table.read_partitions(written)
        if check_source:
            check_source(rows)
        if base:
            counts = table.rows_by_values(rows)
            met, held = _named(base, set(counts)), set()
            if counts and not table.spec.partition_follows_key:
                held = _partitions_holding(table, rows, base)
            met, written = met | held, {}
            weights = _weights(table, f"{version}-in", counts, {p: base[p] for p in met})
            most = SLICE_BYTES * table.spark.sparkContext.defaultParallelism
            parts = [set(weights)] if weights else []
            if sum(weights.values()) > most:
                moves = _moves(table, rows, {p: base[p] for p in held}) if held else []
                parts = _slices(weights, moves, most)
            for part in parts:
                some = rows if len(parts) == 1 else table.rows_in(rows, part)
                old = {p: base[p] for p in _named(base, part)}
                merged = merge(table.read_partitions(old), some, table.spec.keys) if old else some
                written = table.write_version(merged, version)
            table.files.delete(table.version_path(f"{version}-in"))
    except Exception:
        _discard(table, version)
        raise
    untouched = {p: v for p, v in base.items() if p not in met}
    return Staged(Pointer(version, {**untouched, **written}), written, current.version if current else None)


def _weights(table: Table, source: str, counts: dict[Values, int], met: dict[str, str]) -> dict[Values, int]:
    """Parquet bytes that a merge reads for each partition, those of the source by its rows."""
    weights = {tuple(partition_values(p).values()): table.files.bytes_in(path) for p, path in zip(met, table.paths(met))}
    if counts:
        per_row = table.files.bytes_in(table.version_path(source)) / sum(counts.values())
        for values, n in counts.items():
            weights[values] = weights.get(values, 0) + round(n * per_row)
    return weights


def _discard(table: Table, version: str) -> None:
    for folder in (version, f"{version}-in"):
        table.files.delete(table.version_path(folder))


def failed_checks(rows: DataFrame, suite: str | None, not_null: tuple[str, ...] = ()) -> list[str]:
    """Failed rules of the suite and of the table's NOT NULL columns, checked together."""
    rules = list(quality.SUITES[suite]) if suite else []
    rules += [rule for rule in map(quality.complete, not_null) if rule not in rules]
    if not rules:
        return []
    results = quality.run_checks(rows, suite or "not_null", rules).collect()
    for r in results:
        log.info("%s %s metric=%s min=%s %s", r.suite, r.rule, r.metric, r.min_ratio, r.status)
    return [r.rule for r in results if r.status != quality.SUCCESS]


def publish(table: Table, staged: Staged) -> None:
    current = table.pointer()
    if (current.version if current else None) != staged.parent:
        raise ConflictError(f"{table.spec.name}: the table is no longer {staged.parent}")
    table.set_pointer(staged.pointer)


def write_audit_publish(
    table: Table,
    source: DataFrame,
    run_id: str,
    suite: str | None = None,
    check_source: Callable[[DataFrame], None] | None = None,
    merge: Merge = upsert,
) -> Pointer | None:
    """Stage, audit, publish; None if there was nothing to write. A failed audit leaves the table as it was."""
    staged = stage(table, source, run_id, check_source, merge)
    if not staged.written:
        _discard(table, staged.pointer.version)
        return None
    try:
        failed = failed_checks(table.read_partitions(staged.written), suite, table.spec.not_null)
        if failed:
            raise QualityError(f"{table.spec.name} run {run_id}: {', '.join(failed)}")
        publish(table, staged)
    except Exception:
        _discard(table, staged.pointer.version)
        raise
    return staged.pointer
