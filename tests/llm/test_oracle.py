"""SQL of document queries against the queries, and the guard that leaves them out."""

import __spark_entry__ as entry
from compare import connect, differences

from tapemill.llm import queries


def test_registered_with_the_pipeline():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_exact_dedup_matches_sql(spark):
    path = "/root/testdata/sf0.001"
    con = connect(path)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    rows, diff = differences(queries.QUERIES["op5_exact_dedup"](spark, path), con, queries.ORACLES["op5_exact_dedup"])
    assert rows > 0 and not diff
