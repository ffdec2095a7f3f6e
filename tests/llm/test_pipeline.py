"""The pipeline's rows against what brute force says each stage should keep."""

import pyarrow.parquet as pq
from llm_cases import documents  # noqa: F401  a fixture
from llm_cases import BENCHMARK, LABELS, MESSY, PROSE
from test_queries import SF, slow_contamination, slow_fingerprint

import corpus_pipeline
from tapemill.llm import queries


def test_run_keeps_what_it_should(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    judged = queries.QUERIES["op10_toxicity"](spark, SF).collect()
    clean = sorted(r["doc_id"] for r in judged if r["predicted"] == 0)
    prints = {i: slow_fingerprint(texts[i]) for i in clean}
    group = {i: i for i in clean}
    changed = True
    while changed:
        changed = False
        for a in clean:
            low = min(group[b] for b in clean if (prints[a] ^ prints[b]).bit_count() <= 2)
            changed, group[a] = changed or low != group[a], low
    kept = {i for i in clean if group[i] == i and not slow_contamination(texts[i], items)[4]}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == kept and len(kept) < len(clean) < len(texts)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_run_on_empty_and_messy_tables(spark, documents, tmp_path):
    labels = [(i, 1, 0) for i in range(1, 9)] + [(9, 0, 1), (None, 1, None)]
    for name, rows in (("empty", []), ("messy", MESSY)):
        for table, frame in (
            ("documents", documents(*rows)),
            ("labels", spark.createDataFrame(labels if rows else [], LABELS)),
            ("benchmark", spark.createDataFrame([(1, None), (2, "never seen words")] if rows else [], BENCHMARK)),
        ):
            frame.write.parquet(str(tmp_path / name / f"{table}.parquet"))
        got = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert bool(got) == bool(rows)
        # Of the equal texts at most one stays, and every row that stays is one of the table's.
        assert len({r["doc_id"] for r in got if r["size"] == len(PROSE) + 1}) <= 1
        assert {r["doc_id"] for r in got} <= {i for i, _ in rows}
