"""MERGE semantics of the upsert and of the source reduction."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tapemill.operators.dedup import keep_first, one_per_merge_key
from tapemill.operators.upsert import AMBIGUOUS, drop_null_keys, upsert

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("v", T.LongType())])
KEYS = ["k", "n"]


def row(k, n, v):
    return {"k": k, "n": n, "v": v}


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_match_replaces_the_whole_row_and_others_stay(frame):
    target = frame(SCHEMA, row("a", 1, 10), row("b", 1, 20))
    source = frame(SCHEMA, row("a", 1, None), row("c", 1, 30))
    assert bag(upsert(target, source, KEYS)) == [("a", 1, None), ("b", 1, 20), ("c", 1, 30)]


def test_null_keys_never_match_and_pile_up(frame):
    once = upsert(frame(SCHEMA), frame(SCHEMA, row(None, 1, 1)), KEYS)
    assert bag(upsert(once, frame(SCHEMA, row(None, 1, 1)), KEYS)) == [(None, 1, 1), (None, 1, 1)]


def test_two_source_rows_on_one_target_row_raise(frame):
    repeated = frame(SCHEMA, row("a", 1, 1), row("a", 1, 2))
    with pytest.raises(Exception, match=AMBIGUOUS):
        upsert(frame(SCHEMA, row("a", 1, 0)), repeated, KEYS).collect()


def test_unmatched_repeats_are_all_inserted(frame):
    repeated = frame(SCHEMA, row("a", 1, 1), row("a", 1, 2))
    assert bag(upsert(frame(SCHEMA, row("b", 1, 0)), repeated, KEYS)) == [("a", 1, 1), ("a", 1, 2), ("b", 1, 0)]


def test_reduction_keeps_one_per_key_but_every_null_key(frame):
    rows = frame(SCHEMA, row("a", 1, 2), row("a", 1, 1), row(None, 1, 7), row(None, 1, 7))
    assert bag(one_per_merge_key(rows, KEYS, ["v"])) == [("a", 1, 1), (None, 1, 7), (None, 1, 7)]


def test_null_key_guard(frame):
    assert bag(drop_null_keys(frame(SCHEMA, row("a", None, 1), row("a", 1, 2)), KEYS)) == [("a", 1, 2)]


ROWS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 5)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=ROWS, source=ROWS)
def test_upsert_is_idempotent_and_follows_a_dictionary(frame, target, source):
    old = {r[:2]: r for r in target}
    new = {r[:2]: r for r in source}
    t = frame(SCHEMA, *(row(*r) for r in old.values()))
    s = frame(SCHEMA, *(row(*r) for r in new.values()))
    once = upsert(t, s, KEYS)
    assert bag(once) == sorted((old | new).values(), key=repr)
    assert bag(upsert(once, s, KEYS)) == bag(once)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_keep_first_leaves_the_least_row_of_each_key(frame, rows):
    out = bag(keep_first(frame(SCHEMA, *(row(*r) for r in rows)), KEYS, ["v"]))
    assert out == sorted((min(r for r in rows if r[:2] == k) for k in {r[:2] for r in rows}), key=repr)


def test_hot_keys_are_cut_before_the_shuffle(spark, frame):
    plan = keep_first(frame(SCHEMA, row("a", 1, 1)), KEYS, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_a_key_holding_a_third_of_all_rows(spark):
    rows = spark.range(60_000).selectExpr("IF(id % 3 = 0, 'hot', 'k' || id) AS k", "1L AS n", "id AS v")
    kept = keep_first(rows, KEYS, ["v"])
    assert kept.count() == 40_001
    source = spark.createDataFrame([("hot", 1, -1)], SCHEMA)
    assert upsert(rows, source, KEYS).count() == 40_001


def test_rows_without_a_key_never_reach_the_join(spark):
    """However many they are, they are kept as they come and matched by nothing."""
    target = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 1), (2, 2)], "k long, v long")
    source = spark.createDataFrame([(1, 10), (None, 99)], "k long, v long")
    out = sorted((r["k"] or 0, r["v"]) for r in upsert(target, source, ["k"]).collect())
    assert out == sorted([(0, i) for i in range(50)] + [(1, 10), (2, 2), (0, 99)])


def test_marked_sides_are_shuffled_once_each(spark):
    def side(name, *null_rows):
        rows = spark.range(50).selectExpr("id % 20 AS n", "concat('k', id % 4) AS k", f"concat('{name}', id) AS v")
        return rows.unionByName(spark.createDataFrame(list(null_rows), "n long, k string, v string"))

    nulls = [(None, "a", "x"), (None, "a", "x"), (1, None, "y")]
    target, source, keys = side("t", *nulls), side("s", *nulls).where("n IS NULL OR n < 12"), ["k", "n"]
    plain = upsert(*(one_per_merge_key(rows, keys, ["v"]) for rows in (target, source)), keys)
    marked = upsert(*(one_per_merge_key(rows, keys, ["v"], marked=True) for rows in (target, source)), keys)
    # Target, source and source again for its keys, which adaptive execution reuses; none above the reduced rows.
    first, second = (df._jdf.queryExecution().executedPlan().toString() for df in (marked, plain))
    assert first.count("Exchange hashpartitioning") == 3 < second.count("Exchange hashpartitioning")
    assert marked.columns == plain.columns
    assert sorted(map(repr, marked.collect())) == sorted(map(repr, plain.collect()))
