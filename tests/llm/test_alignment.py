"""Token alignment against cuts found by comparing all ends."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
from llm_cases import DOCUMENTS, MESSY, documents  # noqa: F401
from tokenizers import Tokenizer

from tapemill.llm import alignment, queries

SF = "/root/testdata/sf0.001"
FIRST, SECOND = f"{alignment.VOCABULARIES}/{alignment.BYTE_VOCABULARY}", f"{alignment.VOCABULARIES}/{alignment.PIECE_VOCABULARY}"


class Slow:
    def __init__(self):
        self.first = Tokenizer.from_file(FIRST)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
        self.bytes_of = alignment.byte_encoder(FIRST).tokens

    def groups(self, text):
        """Lists of ids per group, or None."""
        if not text:
            return None
        a = self.first.encode(" " + text, add_special_tokens=False).ids
        b = self.second.encode(text)
        pieces = [self.second.id_to_piece(i) for i in b]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)
        ]
        a_bytes = [self.bytes_of[i] for i in a]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        ends = [list(np.cumsum([len(t) for t in tokens])) for tokens in (a_bytes, b_bytes)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        out, i, j = [], 0, 0
        for cut in cuts:
            to_i, to_j = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            out.append((a[i:to_i], b[j:to_j]))
            i, j = to_i, to_j
        return out


def slow_rows(texts):
    slow = Slow()
    found = [slow.groups(t) for t in texts]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in found]
    counts = Counter(pair for own in links for pair in own)
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for groups, own in zip(found, links):
        groups = groups or []
        listed = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append(
            (
                sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
                sum(n for p, n in own.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in own.items()),
                hashlib.sha256(listed.encode()).hexdigest() if groups else "",
            )
        )
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_against_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op11_alignment"](spark, SF).collect()}
    assert got == dict(zip(docs["doc_id"], slow_rows(docs["text"])))


ODD = ["<s> <unk> </s> <|endoftext|>", "▁x", "日本語 テスト 😀👍🏽", "a  b   c\n\n\td", " ", "don't  'll", "ﬁ ½ Ａ"]


@pytest.mark.parametrize("pairs", [0, alignment.BROADCAST_PAIRS])
def test_messy_documents(spark, documents, monkeypatch, pairs):  # noqa: F811
    """NULL, empty, repeated, very long and odd texts; the same by merge join."""
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", pairs)
    given = [*MESSY, *((100 + k, t) for k, t in enumerate(ODD))]
    rows = alignment.token_alignment(documents(*given)).collect()
    got = Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows)
    assert got == Counter((i, *row) for (i, _), row in zip(given, slow_rows([t for _, t in given])))
    assert all(r[7] == "" for r in rows if r["doc_id"] in (3, 101))


def test_no_documents(spark):
    assert alignment.token_alignment(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_very_long_gaps():
    aligner = alignment.Aligner(alignment.byte_encoder(FIRST), alignment.piece_encoder(SECOND))
    row = aligner.align(["a" + " " * 300_000 + "b"])[0]
    assert row[0] > 200_000 and row[3] >= row[0]


def test_cuts_are_all_shared_ends():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 40, 3000):
        for share in (0.05, 0.5, 0.95):
            last = 4 * size
            a, b = (np.unique(np.append(rng.choice(last, max(1, int(share * last)), replace=False), last)) for _ in range(2))
            cut_a, cut_b = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
            assert a[cut_a].tolist() == sorted(set(a.tolist()) & set(b.tolist())) == b[cut_b].tolist()


def test_one_long_group_is_counted_by_distinct_ids(monkeypatch):
    a, b = np.array([5, 5, 6, 7]), np.array([1, 2, 1])
    whole = alignment.Aligner._links(a, b, np.array([2, 3]), np.array([1, 2]), np.array([3, 1]), np.array([2, 1]), np.array([0, 0]))
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 2)
    parts = alignment.Aligner._links(a, b, np.array([2, 3]), np.array([1, 2]), np.array([3, 1]), np.array([2, 1]), np.array([0, 0]))
    assert [x.tolist() for x in whole] == [x.tolist() for x in parts]
    assert whole[1].tolist() == [2, 2, 1, 1, 1]


def test_tokens_stay_arrays():
    """No Python object per token; a text that its tokens do not spell is None and leaves its neighbours alone."""
    texts = [" plain words", " a▁x", " 日本語 😀", " <s> end"]
    for encoder in (alignment.byte_encoder(FIRST), alignment.piece_encoder(SECOND)):
        found = encoder.ids(texts)
        assert all(isinstance(ids, np.ndarray) for ids in found if ids is not None)
        assert all(encoder.spelled(ids).decode() == text for ids, text in zip(found, texts) if ids is not None)
        assert found[0] is not None and found[2] is not None and encoder.ids([]) == []
    assert alignment.piece_encoder(SECOND).ids(texts)[1] is None


def test_links_of_mixed_groups():
    """Groups of one token of each and longer ones, in several texts and in chunks."""
    rng = np.random.default_rng(5)
    in_a, in_b = rng.choice([1, 1, 1, 2, 3], (2, 200))
    a, b = rng.integers(0, 9, in_a.sum()), rng.integers(0, 9, in_b.sum())
    text = np.sort(rng.integers(0, 4, 200))
    cut_a, cut_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
    want = Counter(
        (int(t), int(x), int(y))
        for t, ca, cb, na, nb in zip(text, cut_a, cut_b, in_a, in_b)
        for x in a[ca + 1 - na : ca + 1]
        for y in b[cb + 1 - nb : cb + 1]
    )
    pair, times, owner = alignment.Aligner._links(a, b, cut_a, cut_b, in_a, in_b, text)
    first, second = pair >> alignment.ID_BITS, pair & ((1 << alignment.ID_BITS) - 1)
    assert dict(zip(zip(owner.tolist(), first.tolist(), second.tolist()), times.tolist())) == want
