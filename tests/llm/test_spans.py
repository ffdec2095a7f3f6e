"""Personal data, licenses, repeated passages and line quality against brute force and planted cases."""

import random
from collections import Counter
from zlib import crc32

import pyarrow.parquet as pq
import pytest
import regex

from tapemill.llm import licenses, pii, quality, queries, suffix_dedup
from llm_cases import documents  # noqa: F401  a fixture
from llm_cases import LABELS, MESSY, PROSE

SF = "/root/testdata/sf0.001"


def slow_base(text):
    found = [("email", m.start(), m.end()) for m in regex.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in regex.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in regex.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    for m in regex.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def test_base_patterns_on_random_texts():
    rng = random.Random(5)
    pieces = ["a", "b@", "@", ".", "c.d", "1", "12", "255.", "300.1.2.3", "1.2.3.4", "+", "+1 ", "(5", ")", " ", "-", "4111 1111 1111 1111", "%", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == slow_base(text), text


def test_personal_data_in_whole_texts(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op4_pii"](spark, "/root/testdata/sf0.01").collect()}
    seen = Counter()
    for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist():
        wanted = slow_base(r["text"])
        row = got[r["doc_id"]]
        assert row["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e in wanted) and row["n_added"] == 0
        counts = Counter(k for k, _, _ in wanted)
        assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == tuple(counts[k] for k in pii.KINDS)
        seen += counts
    assert len(seen) == 4


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("write to jane.doe [at] mail [dot] example [dot] com today", "email", "jane.doe [at] mail [dot] example [dot] com"),
        ("jane at example dot org, thanks", "email", "jane at example dot org"),
        ("mail јаne@exаmple.com now", "email", "јаne@exаmple.com"),
        ("card ４１１１ 1111 1111 1111!", "card", "４１１１ 1111 1111 1111"),
        ("call +1 five five five one two three four five six seven", "phone", "+1 five five five one two three four five six seven"),
        ("host 10(dot)0(dot)0(dot)7 up", "ip", "10(dot)0(dot)0(dot)7"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, source):
    base, spans = pii.all_spans(text)
    assert (kind, text.index(source), text.index(source) + len(source)) in spans and set(base) <= set(spans)


@pytest.mark.parametrize(
    "text, kind, source",
    [
        *[(f"ask jane at example dot {top} today", "email", f"jane at example dot {top}") for top in ("tech", "app", "dev", "biz", "online", "de")],
        ("ask jane at mail.example dot com today", "email", "jane at mail.example dot com"),
        ("ask jane at mail dot example dot co dot uk dot thanks", "email", "jane at mail dot example dot co dot uk"),
        ("ask john dot q dot smith at example dot com", "email", "john dot q dot smith at example dot com"),
        ("ask john dot smith@example.com now", "email", "john dot smith@example.com"),
        ("ask jane at example [dot] org now", "email", "jane at example [dot] org"),
        ("ask jane@example dot info now", "email", "jane@example dot info"),
        ("host 10 dot 0 dot 0 dot 7 up", "ip", "10 dot 0 dot 0 dot 7"),
        ("host one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("five one-nine-two.one-six-eight.zero.one two three four", "ip", "one-nine-two.one-six-eight.zero.one two three"),
        ("host 1 9 2[dot]1 6 8[dot]0[dot]1 up", "ip", "1 9 2[dot]1 6 8[dot]0[dot]1"),
        ("10 dot 0 dot 0 dot 17 five five five one two three four", "ip", "10 dot 0 dot 0 dot 17"),
    ],
)
def test_spoken_signs(text, kind, source):
    base, spans = pii.all_spans(text)
    assert (kind, text.index(source), text.index(source) + len(source)) in spans and set(base) <= set(spans)


def test_spoken_words_that_make_no_pattern():
    for text in ("we work at example.com", "300 dot 1 dot 2 dot 3", "one dot two dot three", "at noon dot matrix.", "table 1 2.5.6"):
        assert pii.all_spans(text) == ([], []), text


def test_spoken_runs_take_linear_time():
    for text in ("one " * 60_000, "one dot " * 60_000, "a dot " * 60_000, "a at b dot " * 60_000, "1.1 dot " * 60_000, "a at b dot com " * 30_000):
        pii.all_spans(text)


LOOKALIKES = str.maketrans({"a": "а", "c": "с", "e": "е", "o": "о", "p": "р", "j": "ј"} | {c: chr(ord(c) + 0xFEE0) for c in "0123456789+@.() -" if c != " "})


@pytest.mark.parametrize(
    "kind, plain", [("email", "jane.poe@example.com"), ("ip", "192.168.1.10"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567")]
)
def test_a_lone_homoglyph_at_each_place(kind, plain):
    places = [k for k, c in enumerate(plain) if c.translate(LOOKALIKES) != c]
    assert len(places) > 8
    for k in places:
        source = plain[:k] + plain[k].translate(LOOKALIKES) + plain[k + 1 :]
        base, spans = pii.all_spans(f"x {source} y")
        assert (kind, 2, 2 + len(source)) in spans and set(base) <= set(spans), source


def test_masking_leaves_no_rest_of_overlapping_spans(documents):
    docs = documents((1, "to jаne@example.com, jane@example.cоm"), (2, "at 192.168.1.1０ up"), (3, "+4111 1111 1111 1111"))
    masked = {r["doc_id"]: r["text"] for r in pii.masked(docs).collect()}
    assert masked[1] == "to [email], [email]"
    assert masked[2] == "at [ip] up" and masked[3] == "+[card]"
    assert pii.merged([("card", 3, 9), ("phone", 0, 5), ("ip", 9, 12)]) == [("card", 0, 9), ("ip", 9, 12)]


def test_plain_words_are_no_disguise():
    for text in ("we met at noon dot matrix", "one two three", "look at me", "Привет мир", "at dot at dot"):
        assert pii.all_spans(text) == ([], [])


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "+1" + "(" * 300_000, "one " * 60_000, "a@" * 100_000, "1." * 150_000):
        pii.all_spans(text)


def test_personal_data_of_messy_rows(documents):
    got = pii.personal_data(documents(*MESSY)).collect()
    assert len(got) == len(MESSY) and all(r["spans"] == "" for r in got)
    masked = pii.masked(documents((1, "to a@b.co and c [at] d [dot] org"), (2, None))).orderBy("doc_id").collect()
    assert [r["text"] for r in masked] == ["to [email] and [email]", None]
    assert pii.personal_data(documents()).count() == 0


def slow_passages(texts, size):
    """Starts of all runs of so many words that occur twice, by document."""
    words = {k: t.split() for k, t in texts}
    seen = Counter(tuple(w[i : i + size]) for w in words.values() for i in range(len(w) - size + 1))
    return {k: [i for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1] for k, w in words.items()}


def test_repeated_passages(spark):
    rng = random.Random(2)
    new = lambda n: [f"w{rng.randint(0, 5000)}" for _ in range(n)]
    shared = [new(rng.choice([50, 51, 60, 120])) for _ in range(12)]
    texts = []
    for k in range(120):
        body = new(rng.randint(0, 90))
        if k % 2:
            body += rng.choice(shared)
        if k % 7 == 0:
            part = rng.choice(shared)
            body += part[rng.randint(0, 30) :]
        texts.append((k, " ".join(body + new(rng.randint(0, 40)))))
    texts += [(500, texts[3][1]), (501, "again and again " * 60), (502, " ".join(new(300)))]
    marked = assert_exact_passages(suffix_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string")), texts)
    assert sum(map(len, marked.values())) > 3000
    assert not marked[502]


def assert_exact_passages(got, texts):
    """Passages are the longest runs of the words that brute force covers; returns these words by document."""
    rows = {k: [] for k, _ in texts}
    for r in got.collect():
        assert r["n_words"] == r["end_word"] - r["start_word"] >= 50
        rows[r["doc_id"]].append((r["start_word"], r["end_word"]))
    covered = {k: {p for i in starts for p in range(i, i + 50)} for k, starts in slow_passages(texts, 50).items()}
    for k, words in covered.items():
        starts = sorted(p for p in words if p - 1 not in words)
        ends = sorted(p + 1 for p in words if p + 1 not in words)
        assert sorted(rows[k]) == list(zip(starts, ends))
    return covered


def test_repeated_passages_of_whole_tables(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        texts = [(r["doc_id"], r["text"] or "") for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
        assert any(assert_exact_passages(queries.QUERIES["op8_repeated_passages"](spark, sf), texts).values())


def test_a_passage_of_exactly_fifty_words_at_any_place(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [(k, " ".join([*(f"a{k}x{i}" for i in range(k)), passage, *(f"b{k}x{i}" for i in range(40 - k))])) for k in range(41)]
    got = suffix_dedup.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in got.collect()} == {(k, k, k + 50) for k in range(41)}


def test_repeated_passages_of_messy_rows(documents):
    got = suffix_dedup.repeated_passages(documents(*MESSY)).collect()
    assert {r["doc_id"] for r in got} == {6}
    long = " ".join(f"v{i}" for i in range(80))
    twice = suffix_dedup.repeated_passages(documents((1, long), (1, long), (None, long), (2, None))).collect()
    assert Counter(r["doc_id"] for r in twice) == {1: 2, None: 1}
    assert suffix_dedup.repeated_passages(documents()).count() == 0


def test_license_notices(documents):
    header = licenses.TEMPLATES["gpl-header"]
    changed = header.replace("of the GNU", "of this GNU")
    docs = documents(
        (11, "some text. Released under the MIT License."), (12, f"{PROSE} {header} {PROSE}"), (13, f"{PROSE}\n{changed}"),
        (14, " ".join(header.split()[:20])), (15, "released under another license"), (16, "// SPDX-License-Identifier: MIT"),
        (17, f"{PROSE} SPDX-License-Identifier: Apache-2.0 {PROSE}"), (18, "spdx license"),
        (19, f"{licenses.TEMPLATES['zlib']} {PROSE} {licenses.TEMPLATES['zlib']}"), (19, licenses.TEMPLATES["zlib"]),
        (20, header.replace("either version 3", "either version 2")), *MESSY,
    )
    rows = licenses.license_notices(docs).collect()
    assert Counter((r["doc_id"], r["license"]) for r in rows) == {
        (11, "mit-short"): 1, (12, "gpl-header"): 1, (13, "gpl-header"): 1, (16, "spdx:MIT"): 1, (17, "spdx:Apache-2.0"): 1, (19, "zlib"): 3,
        (20, "gpl-2.0-header"): 1,
    }
    got = {(r["doc_id"], r["license"]): r for r in rows}
    assert got[12, "gpl-header"]["containment"] == 1.0 and got[13, "gpl-header"]["containment"] < 1.0
    assert got[12, "gpl-header"]["start_word"] == 18
    assert licenses.license_notices(documents()).count() == 0


def test_every_notice_is_found_whole_and_alone():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    inside = {"apache-2.0-header": {"apache-2.0-short"}, "isc": {"0bsd"}}
    for name, template in licenses.TEMPLATES.items():
        n = len(licenses.words_of(template))
        found = scanner.scan(f"{PROSE} {template} {PROSE}")
        assert (name, len(PROSE.split()), len(PROSE.split()) + n, 1.0) in found, name
        assert {m[0] for m in found} - inside.get(name, set()) == {name}
        # The words in another order are no notice.
        assert n < 8 or name not in {m[0] for m in scanner.scan(" ".join(sorted(template.split())))}


def test_worn_notices_are_retrieved():
    # Every copy lacks a word somewhere; all that still hold four fifths of the shingles must be found.
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name in ("mit", "isc", "mpl-2.0-header", "lgpl-2.1-header", "unlicense", "bsd"):
        words = licenses.TEMPLATES[name].split()
        for k in range(len(words)):
            worn = words[:k] + words[k + 1 :]
            whole, left = (_runs([w.decode() for w in licenses.words_of(" ".join(ws))], 5) for ws in (words, worn))
            # Words between hyphens and slashes fall apart, so more than one may be gone.
            assert len(whole & left) < 0.8 * len(whole) or name in {m[0] for m in scanner.scan(f"{PROSE} {' '.join(worn)} {PROSE}")}


def _runs(words, width):
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def test_licenses_in_whole_texts(spark):
    rows = queries.QUERIES["op6_licenses"](spark, "/root/testdata/sf0.01").collect()
    got = {(r["doc_id"], r["license"]) for r in rows}
    texts = {r["doc_id"]: licenses.words_of(r["text"]) for r in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()}
    whole, near = set(), set()
    for name, template in licenses.TEMPLATES.items():
        words = licenses.words_of(template)
        width = min(licenses.SHINGLE, len(words))
        own = _runs(words, width)
        reach = len(own) + len(own) // 4 + width - 1
        for doc_id, text in texts.items():
            if len(own & _runs(text, width)) >= 0.8 * len(own):
                if any(len(own & _runs(text[i : i + reach], width)) >= 0.8 * len(own) for i in range(len(text))):
                    near.add((doc_id, name))
                if b" ".join(words) in b" ".join(text):
                    whole.add((doc_id, name))
    assert whole and whole <= got <= near
    for r in rows:
        words = licenses.words_of(licenses.TEMPLATES[r["license"]])
        width = min(licenses.SHINGLE, len(words))
        held = _runs(words, width) & _runs(texts[r["doc_id"]][r["start_word"] : r["end_word"]], width)
        assert len(held) >= r["containment"] * len(_runs(words, width)) - 1e-9


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = queries.QUERIES["op7_quality"](spark, sf).collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [p for p, y in held if y], [p for p, y in held if not y]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.2


def test_quality_of_messy_and_of_no_rows(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, None, None), (None, 1, 1), (6, 0, 1)], LABELS)
    for some in (labels, spark.createDataFrame([], LABELS)):
        got = quality.scores(documents(*MESSY), some).collect()
        assert len(got) == len(MESSY) and all(0 <= r["score"] <= 1 for r in got)
    assert quality.scores(documents(), labels).count() == 0


def test_marginals_are_those_of_brute_force():
    from itertools import product

    import numpy as np

    odds, stay = np.array([1.5, -0.3, 0.2, -2.0]), 0.7
    weight = {y: np.exp(sum(o for o, v in zip(odds, y) if v) + stay * sum(a == b for a, b in zip(y, y[1:]))) for y in product((0, 1), repeat=4)}
    wanted = [sum(w for y, w in weight.items() if y[k]) / sum(weight.values()) for k in range(4)]
    assert quality._marginals(odds, stay) == pytest.approx(wanted)
