"""From raw documents to shards: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tapemill.llm import decontamination, mixing, sharding, simhash, toxicity
from tapemill.llm.common import drop_stored, noting_stored, stored, table
from tapemill.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Folders of the tables that each stage stored in its last call, by the stage's function name.
_left_by: dict[str, list[str]] = {}


def _after(before: str) -> Callable[[Stage], Stage]:
    """A stage that first deletes what the stage before it stored to make its result.

    Stages hand on written Parquet, so those tables are of no more use, and only one stage's lie on the disk at
    a time. If the unwritten result itself is handed on instead, it still reads them and they stay.
    """

    def wrap(stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            left = _left_by.get(before)
            if left and not any(folder in file for file in docs.inputFiles() for folder in left):
                drop_stored(spark, _left_by.pop(before))
            with noting_stored() as folders:
                result = stage(spark, docs, sf_dir)
            _left_by.setdefault(stage.__name__, []).extend(folders)
            return result

        return run_stage

    return wrap


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


@_after("drop_toxic")
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each(docs)


@_after("drop_near_copies")
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat benchmark passages go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


@_after("drop_contaminated")
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that the domains' tokens meet their target shares; all stay."""
    return mixing.remixed(docs, table(spark, sf_dir, "labels"))


@_after("mix")
def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents are written to one folder per shard; returns the manifest of what was written."""
    return sharding.write_shards(docs, scratch_dir(spark, "shards"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing", mix),
    ("sharding", shard),
]

# A trained model decides the first stage; tests/llm/test_pipeline.py checks the run against a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next one reads it."""
    docs, written = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noting_stored() as folders:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_stored(spark, written)
        written = folders
    return STAGES[-1][1](spark, docs, sf_dir)
