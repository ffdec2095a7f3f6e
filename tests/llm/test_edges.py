"""Rows that are NULL, empty, long, tied or repeated, empty tables, and columns with clashing names."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tapemill.llm import decontamination, exact_dedup, mixing, sharding, simhash, toxicity
from tapemill.llm.common import components
from llm_cases import documents  # noqa: F401  a fixture
from llm_cases import BENCHMARK, DOCUMENTS, LABELS, MESSY, PROSE, WORDS


def as_rows(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, None, None), (None, 1, 1), (6, 1, 1), (9, 1, 0), (3, 0, 0)], LABELS)


def test_exact_dedup(documents):
    docs = documents(*MESSY)
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(MESSY)
    sizes = Counter(t or "" for _, t in MESSY)
    assert sum(r["kept"] for r in got) == len(sizes)
    twice = [r for r in got if r["doc_id"] == 2]
    assert [r["keep_id"] for r in twice] == [2, 2] and sum(r["kept"] for r in twice) == 1
    assert {r["group_size"] for r in twice} == {5}
    kept = exact_dedup.unique_documents(docs)
    assert kept.columns == docs.columns and kept.count() == len(sizes)
    assert as_rows(kept) - as_rows(docs) == Counter()


def test_simhash(documents):
    docs = documents(*MESSY)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_groups(docs).collect()]
    assert len(got) == len(MESSY)
    assert {c for i, f, c in got if f == "0" * 16} == {3}
    assert {c for i, f, c in got if i in (1, 2, 7, -5)} == {-5}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({f for _, f, _ in got})
    assert simhash.one_of_each(documents((2, PROSE), (2, PROSE))).count() == 1
    assert simhash.one_of_each(documents((None, PROSE), (None, PROSE))).count() == 1


def test_covering_masks_cover():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        rng = np.random.default_rng(1)
        for _ in range(300):
            difference = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
            assert any((m & ((1 << 64) - 1)) & difference == 0 for m in masks)


@pytest.mark.parametrize("direct", [1, 3, 64])
def test_links_of_large_and_small_buckets(spark, monkeypatch, direct):
    """However large a bucket may be before midpoints are used, components are those of brute force."""
    monkeypatch.setattr(simhash, "DIRECT", direct)
    rng = np.random.default_rng(3)
    prints = {int(p) for p in rng.integers(0, 2**62, 30)}
    prints |= {p ^ (1 << int(i)) ^ (1 << int(j)) for p in list(prints) for i, j in rng.integers(0, 62, (4, 2))}
    links = simhash.near_links(spark.createDataFrame([(p,) for p in prints], "print long"))
    got = defaultdict_of(components(links))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                parent[root(a)] = root(b)
    groups = Counter(root(p) for p in prints)
    assert sorted(map(len, got.values())) == sorted(n for n in groups.values() if n > 1)


def defaultdict_of(members):
    groups = {}
    for r in members.collect():
        groups.setdefault(r["root"], set()).add(r["node"])
    return groups


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(60)]
    groups = defaultdict_of(components(spark.createDataFrame(chain + star + [(5, 5)], "a long, b long")))
    assert sorted(map(len, groups.values())) == [61, 61]


def test_decontamination(spark, documents):
    benchmark = spark.createDataFrame(
        [(1, PROSE), (2, PROSE.title() + "!"), (3, None), (4, ""), (None, "x"), (5, "☃ text"), (5, "y")], BENCHMARK
    )
    got = decontamination.contamination_report(documents(*MESSY), benchmark)
    rows = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in got.collect()}
    assert got.count() == len(MESSY)
    assert {(2, 18, 18, 2, True), (7, 18, 18, 2, True), (8, 1, 1, 0, True), (8, 1, 1, 1, True), (3, 0, 0, 0, False)} <= rows
    assert (9, 3, 2, 1, True) in rows and (6, 30_000, 0, 0, False) in rows
    kept = decontamination.decontaminated(documents(*MESSY), benchmark)
    assert kept.columns == documents((1, "a")).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([3, None, None, 4, 5, 6])


def test_decontamination_in_blocks(spark, documents, monkeypatch):
    benchmark = spark.createDataFrame([(i, " ".join((WORDS[i:] + WORDS[:i])[:13])) for i in range(18)], BENCHMARK)
    docs = documents((1, PROSE), (2, " ".join(WORDS[3:] + WORDS[:3])), (3, "other words"))
    whole = as_rows(decontamination.contamination_report(docs, benchmark))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 120)
    assert as_rows(decontamination.contamination_report(docs, benchmark)) == whole


def test_proximity_is_wider_than_phrases(spark, documents):
    benchmark = spark.createDataFrame([(1, " ".join(WORDS[:13]))], BENCHMARK)
    loose = WORDS[:5] + ["extra"] + WORDS[5:13]
    docs = documents((1, " ".join(loose)), (2, " ".join(WORDS[:13])), (3, "amber birch cedar delta alone"))
    windows = decontamination.item_windows(benchmark)
    index = decontamination.Index(docs, windows, ["doc_id"])
    assert index.phrases().count() == 1
    found = index.proximity(2).join(index.documents, "mark").select("row.doc_id").distinct().collect()
    assert {r["doc_id"] for r in found} == {1, 2}


def slow_proximity(text, window, slack):
    words = text.split()
    near = lambda s, k: window[k] in words[max(0, s + k - slack) : max(0, s + k + slack + 1)]
    return any(all(near(s, k) for k in range(len(window))) for s in range(-slack, len(words) + slack))


@pytest.mark.parametrize("slack", [1, 2, 4])
def test_proximity_is_that_of_brute_force(spark, documents, slack):
    window = WORDS[:13]
    texts = [PROSE, " ".join([window[0], window[6], window[12]]), " ".join(reversed(window))]
    texts += [" ".join(window[:k] + ["extra"] * n + window[k:]) for k in range(14) for n in (1, 2, 4, 5, 9)]
    texts += [" ".join(window[:k] + ["x"] + window[k + 1 :]) for k in range(13)]
    # Terms at both ends are the rarest in one corpus, those in the middle in another.
    for common in (window[2:11], window[:5] + window[8:], window[:12]):
        docs = documents(*enumerate([*texts, *[" ".join(["y"] * 40 + common + ["z"] * 40)] * 5]))
        index = decontamination.Index(docs, decontamination.item_windows(spark.createDataFrame([(1, " ".join(window))], BENCHMARK)), ["doc_id"], slack)
        found = {r["doc_id"] for r in index.proximity(slack).join(index.documents, "mark").select("row.doc_id").distinct().collect()}
        assert found == {i for i, t in enumerate(texts) if slow_proximity(t, window, slack)}
    with pytest.raises(ValueError):
        index.proximity(slack + 1)


def test_sharding(documents):
    docs = documents(*MESSY)
    got = sharding.sharded(docs)
    assert got.count() == len(MESSY) and got.columns.count("shard") == 1
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["doc_id"], set()).add((r["shard"], r["grown_shard"]))
    assert all(len(s) == 1 for s in by_id.values())
    assert {r["size"] for r in got.where("doc_id = 3").collect()} == {1}


def test_only_changed_subtrees_take_rows(spark):
    keys = spark.range(4000)
    heavier = {**sharding.EIGHT, "west": {"w1": {4: 1.0, 5: 3.0}, "w2": {6: 1.0, 7: 1.0}}}
    moved = keys.select(
        sharding.shard_of(keys["id"], sharding.EIGHT).alias("a"), sharding.shard_of(keys["id"], heavier).alias("b")
    ).where("a <> b").groupBy("a", "b").count().collect()
    # Rows only leave the east for the west, or move within the west towards the rack and shard that grew.
    assert moved and all((r["a"] < 4 <= r["b"]) or r["b"] in (4, 5) for r in moved)
    assert all(r["b"] == 5 for r in moved if r["a"] == 4)
    counts = {r["s"]: r["count"] for r in keys.select(sharding.shard_of(keys["id"], sharding.EIGHT).alias("s")).groupBy("s").count().collect()}
    assert min(counts.values()) > 400 and max(counts.values()) < 600


def test_classifiers_on_messy_and_on_no_rows(spark, documents, labels):
    docs, nothing = documents(*MESSY), documents()
    scored = toxicity.scores(docs, labels).collect()
    assert len(scored) == len(MESSY) and all(0 <= r["score"] <= 1 for r in scored)
    assert len({r["score"] for r in scored if r["doc_id"] in (3, 4, 5)}) == 1
    assert toxicity.scores(nothing, labels).count() == 0
    empty = spark.createDataFrame([], LABELS)
    assert toxicity.without_toxic(docs, empty).count() == len(MESSY)
    for some in (labels, empty):
        mixed = mixing.mixture(docs, some).collect()
        assert len(mixed) == len(MESSY) and all(r["rate"] >= 0 for r in mixed)
        again = mixing.remixed(docs, some)
        assert again.columns == docs.columns and as_rows(docs) - as_rows(again) == Counter()
    assert mixing.mixture(nothing, labels).count() == 0


def outcome(rows):
    """Shares of tokens by domain (clean, poor) with the fitted rates and with the whole copies, and the least rate."""
    rows = rows.toPandas()
    p, tokens = np.stack(rows["posteriors"]), rows["tokens"].to_numpy()
    by_rate, by_copies = ((p * (tokens * rows[c].to_numpy())[:, None]).sum(axis=0) for c in ("rate", "copies"))
    return by_rate / by_rate.sum(), by_copies / by_copies.sum(), rows["rate"].min()


@pytest.mark.parametrize("poor", [0.05, 0.14, 0.4, 0.7])
def test_rates_of_at_least_one_meet_the_targets(spark, poor):
    rng = np.random.default_rng(7)
    share = np.where(rng.random(4000) < poor, 0.93, 0.04) + rng.uniform(-0.02, 0.02, 4000)
    data = [(int(t), [1 - float(s), float(s)]) for t, s in zip(rng.integers(5, 900, 4000), share)]
    rows = spark.createDataFrame(data, "tokens long, posteriors array<double>")
    targets = [mixing.MIX_TARGETS[n] for n in sorted(mixing.MIX_TARGETS)]
    got, _, least = outcome(rows.withColumn("rate", mixing.fit_rates(rows, targets, 1.0)).withColumn("copies", mixing.F.col("rate")))
    assert least >= 1 and np.abs(got - np.array(targets) / sum(targets)).max() < 1e-4


def test_targets_out_of_reach_are_reported(spark, caplog):
    rows = spark.createDataFrame([(10, [0.5, 0.5])] * 4, "tokens long, posteriors array<double>")
    rate = mixing.fit_rates(rows, [0.9, 0.1], 1.0)
    assert "not met" in caplog.text and rows.select(rate.alias("r")).agg({"r": "max"}).first()[0] < 6


@pytest.mark.parametrize("hot", [1, 5])
def test_shares_that_the_mixing_stage_gives(spark, hot):
    """Also if a source of poor text is five times as large."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    poor = docs.join(labels.where("quality = 0"), "doc_id", "left_semi")
    for k in range(1, hot):
        docs = docs.union(poor.withColumn("doc_id", poor["doc_id"] + k * 10**9))
    rows = mixing.rated(docs, labels, ["doc_id"], targets=mixing.MIX_TARGETS, least=1.0)
    wanted = np.array([mixing.MIX_TARGETS[n] for n in sorted(mixing.MIX_TARGETS)])
    wanted /= wanted.sum()
    by_rate, by_copies, least = outcome(rows)
    assert least >= 1 and np.abs(by_rate - wanted).max() < 1e-4 and np.abs(by_copies - wanted).max() < 0.01


def test_misspellings_share_subwords():
    clean = ["the river runs past green hills and quiet farms", "we walked along the shore at noon"] * 20
    toxic = ["you are a worthless moron and everyone knows", "what a pathetic idiot this person is"] * 20
    scorer = toxicity.train(clean + toxic, [0] * 40 + [1] * 40).scorer()
    assert min(scorer[b"patheticc"], scorer[b"idiiot"]) > max(scorer[b"shoore"], scorer[b"hillss"], scorer[b"unmet"]) + 1


def test_empty_tables(spark, documents):
    nothing = documents()
    benchmark = spark.createDataFrame([], BENCHMARK)
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert simhash.near_groups(nothing).count() == 0
    assert simhash.one_of_each(nothing).schema == nothing.schema
    assert sharding.sharded(nothing).count() == 0
    assert decontamination.contamination_report(nothing, benchmark).count() == 0
    assert decontamination.decontaminated(documents((1, PROSE)), benchmark).count() == 1
    assert DOCUMENTS == nothing.schema


def test_written_shards_hold_every_text_at_its_slot(spark, documents, tmp_path):
    docs = documents(*MESSY, *((100 + i, f"text {i} of many") for i in range(300))).repartition(5)
    manifest = sharding.write_shards(docs, str(tmp_path / "shards"))
    assert manifest.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    got = [tuple(r) for r in manifest.collect()]
    other = [tuple(r) for r in sharding.shard_manifest(docs).collect()]
    # All but the order of slots is that of the manifest of unwritten documents.
    assert sorted(map(str, ((*r[:5], r[6]) for r in got))) == sorted(map(str, ((*r[:5], r[6]) for r in other)))
    slots = defaultdict(list)
    for r in got:
        slots[r[4]].append(r[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8
    written = spark.read.parquet(str(tmp_path / "shards"))
    kept = [c for c in docs.columns if c not in ("shard", "size")]
    assert Counter(map(str, written.select(kept).collect())) == Counter(map(str, docs.select(kept).collect()))
    for folder in (tmp_path / "shards").glob("shard=*"):
        place = {r[5]: r[0] for r in got if r[4] == int(folder.name[6:])}
        files = [pq.read_table(f)["doc_id"].to_pylist() for f in sorted(folder.glob("*.parquet"))]
        assert [place[i] for i in range(len(place))] == [d for ids in files for d in ids]
    assert sharding.write_shards(documents(), str(tmp_path / "none")).count() == 0


def test_slots_are_gapless_over_many_buckets(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_SLOT_BUCKET", 7)
    slots = defaultdict(list)
    for r in sharding.shard_manifest(documents(*MESSY, *((i, "t") for i in range(200)))).collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == len(MESSY) + 200
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
