"""Alignment of two tokenizers' tokens, divided and conquered at shared cuts.

Both token sequences of a text cover the same bytes. An interval of tokens that holds a place where tokens of both
end is cut there, at the one nearest its middle, found by bisection, and both halves go on in the same way; an
interval without such a place is a group. The recursion goes level by level over all texts of an Arrow batch, so
that each level is a few numpy calls. Pairs of ids that share a group are counted over the corpus in Spark.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import bound_batches, stored
from tapemill.operators.joins import sized

# Where the vocabulary files lie on every machine.
VOCABULARIES = "/opt/tokenizers"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
# The pre-tokenizer's pattern of the byte-level vocabulary, a fixed value.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The faster of two encoders of that vocabulary fails on white space of about 100,000 characters; the other takes it.
LONG_GAP = re.compile(r"\s{10000}")
# A pair of ids is one number: the first tokenizer's id above this many bits of the second's.
ID_BITS = 20
# Group pairs of one Arrow batch are listed in chunks of about this many.
CHUNK_LINKS = 1 << 21
# Characters aligned at a time; a longer text is taken whole.
CHUNK_CHARS = 1 << 20
# The counts of pairs that several texts share are broadcast up to this many (16 bytes each), else merge-joined.
BROADCAST_PAIRS = 2_000_000

RESULT = (
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
)


@dataclass
class Encoder:
    """One tokenizer; `tokens[id]` are a token's bytes."""

    encode: Callable[[list[str]], list[np.ndarray]]
    tokens: list[bytes]

    def __post_init__(self):
        self.sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._starts = np.cumsum(self.sizes) - self.sizes

    def spelled(self, ids: np.ndarray) -> bytes:
        """The tokens' bytes, joined."""
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        return self._bytes[np.repeat(self._starts[ids] - before, sizes) + np.arange(sizes.sum())].tobytes()

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Token ids of each text; None where their bytes are not those of the text."""
        if not texts:
            return []
        found = self.encode(texts)
        flat = np.concatenate(found)
        joined = self.spelled(flat)
        stops = np.append(0, np.cumsum(self.sizes[flat]))[np.cumsum([len(ids) for ids in found])].tolist()
        return [
            ids if joined[start:stop] == text.encode() else None
            for text, ids, start, stop in zip(texts, found, [0, *stops], stops)
        ]


def _byte_level() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(c): b for c, b in [*((b, b) for b in printable), *((256 + i, b) for i, b in enumerate(others))]}


@lru_cache(maxsize=4)
def byte_encoder(path: str) -> Encoder:
    """The vocabulary file's own merges, run as ranks, which is the same where ids follow the merges' order."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary, level = content["model"]["vocab"], _byte_level()
    merges = [m if isinstance(m, str) else " ".join(m) for m in content["model"]["merges"]]
    if any(vocabulary[m.replace(" ", "")] != 256 + i for i, m in enumerate(merges)):
        raise ValueError(f"{path}: ids do not follow the order of merges")
    ranks = {bytes(level[c] for c in entry): i for entry, i in vocabulary.items()}
    special = {t["id"]: t["content"].encode() for t in content["added_tokens"]}
    tokens = [b""] * (max([*ranks.values(), *special]) + 1)
    for token, i in [*ranks.items(), *((t, i) for i, t in special.items())]:
        tokens[i] = token
    # No special tokens: their strings are plain text.
    own = tiktoken.Encoding("own", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})
    slower = Tokenizer.from_file(path)
    slower.encode_special_tokens = True

    def encode(texts: list[str]) -> list[np.ndarray]:
        return [
            np.array(slower.encode(t, add_special_tokens=False).ids if LONG_GAP.search(t) else own.encode_ordinary(t), np.int64)
            for t in texts
        ]

    return Encoder(encode, tokens)


@lru_cache(maxsize=4)
def piece_encoder(path: str) -> Encoder:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
    ]
    # The model adds the leading space itself.
    return Encoder(lambda texts: model.encode([t[1:] for t in texts], num_threads=1, return_type="numpy"), tokens)


def shared_cuts(a: np.ndarray, b: np.ndarray, a_from: np.ndarray, a_to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the ends `a` and `b` (both ascending) where tokens of both end, within intervals of `a`.

    Each interval [a_from, a_to) covers the same bytes in both, so its last end is shared; it is returned too.
    """
    low, high = a_from.astype(np.int64), a_to.astype(np.int64) - 1
    found = [high]
    # The token of `b` that ends at a byte: one look instead of a search.
    ending = np.full(b[-1] + 1, -1)
    ending[b] = np.arange(len(b))
    tried = np.full(len(low), -1)
    while len(low):
        # Inner ends are at low..high-1; ends up to `tried` away from the middle are no cuts.
        middle = (low + high - 1) >> 1
        reach = 2 * tried + 2
        left_from, left_to = np.maximum(middle - reach, low), middle - tried - 1
        right_from, right_to = np.maximum(middle + tried + 1, middle + 1), np.minimum(middle + reach, high - 1)
        sizes = np.stack([left_to - left_from + 1, right_to - right_from + 1], axis=1).clip(0)
        starts = np.stack([left_from, right_from], axis=1).ravel()
        flat = sizes.ravel()
        owner = np.repeat(np.arange(len(low)).repeat(2), flat)
        at = np.arange(flat.sum()) - np.repeat(np.cumsum(flat) - flat, flat) + np.repeat(starts, flat)
        hit = ending[a[at]] >= 0
        owner, at = owner[hit], at[hit]
        # The nearest to the middle cuts the interval; owners are in order.
        if not (owner[1:] > owner[:-1]).all():
            order = np.lexsort((np.abs(at - middle[owner]), owner))
            owner, at = owner[order], at[order]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            owner, at = owner[first], at[first]
        found.append(at)
        open_ = np.ones(len(low), bool)
        open_[owner] = False
        # Intervals without a cut so far go on wider, unless all of them was tried.
        open_ &= (middle - reach > low) | (middle + reach < high - 1)
        low, high, tried = (
            np.concatenate((low[open_], low[owner], at + 1)),
            np.concatenate((high[open_], at, high[owner])),
            np.concatenate((reach[open_], np.full(2 * len(at), -1))),
        )
        inner = high > low
        low, high, tried = low[inner], high[inner], tried[inner]
    cuts = np.sort(np.concatenate(found))
    return cuts, ending[a[cuts]]


class Aligner:
    """Aligns batches of texts of two encoders."""

    def __init__(self, first: Encoder, second: Encoder):
        self.first, self.second = first, second
        # Ids in decimal with what follows them: a comma within a side of a group, else the side's end. Each has eight
        # bytes, zeros at the end, which ids of ID_BITS fit.
        texts = [
            f"{i}{end}" for encoder, ends in ((first, ",|"), (second, ",;")) for end in ends for i in range(len(encoder.tokens))
        ]
        self.texts = np.array(texts, "S8").view(np.uint64)

    def align(self, texts: list[str | None]) -> list[tuple]:
        """RESULT of each text; NULL, empty and texts that one of the two cannot cover have no tokens."""
        chosen = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in chosen]
        firsts, seconds = self.first.ids(spaced), self.second.ids(spaced)
        kept = [n for n in range(len(chosen)) if firsts[n] is not None and seconds[n] is not None]
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        out = [nothing] * len(texts)
        if kept:
            for n, row in zip(kept, self._aligned([firsts[n] for n in kept], [seconds[n] for n in kept])):
                out[chosen[n]] = row
        return out

    def _aligned(self, firsts: list[np.ndarray], seconds: list[np.ndarray]) -> Iterator[tuple]:
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (firsts, seconds))
        a, b = (np.concatenate(ids).astype(np.int64) for ids in (firsts, seconds))
        a_stop, b_stop = np.cumsum(n_a), np.cumsum(n_b)
        # Texts lie one after the other: equal bytes keep the ends of both in step.
        cut_a, cut_b = shared_cuts(
            np.cumsum(self.first.sizes[a]), np.cumsum(self.second.sizes[b]), a_stop - n_a, a_stop
        )
        in_a, in_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        pieces = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[cut_a], last_b[cut_b] = 1, 1
        pieces[np.arange(len(a)) + np.repeat(np.cumsum(in_b) - in_b, in_a)] = a + last_a * len(self.first.tokens)
        pieces[np.arange(len(b)) + np.repeat(np.cumsum(in_a), in_b)] = (
            b + last_b * len(self.second.tokens) + 2 * len(self.first.tokens)
        )
        listed = self.texts[pieces]
        # Every text ends with a group.
        n_groups = np.diff(np.searchsorted(cut_a, a_stop), prepend=0)
        text_of_group = np.repeat(np.arange(len(n_a)), n_groups)
        n_links = np.bincount(text_of_group, in_a * in_b, len(n_a)).astype(np.int64)
        keys, times, owners = self._links(a, b, cut_a, cut_b, in_a, in_b, text_of_group)
        stops = np.searchsorted(owners, np.arange(len(n_a)), side="right")
        for k in range(len(n_a)):
            start = a_stop[k] - n_a[k] + b_stop[k] - n_b[k]
            groups = listed[start : a_stop[k] + b_stop[k]].tobytes().translate(None, b"\0")
            digest = hashlib.sha256(groups[:-1]).hexdigest()
            own = slice(stops[k - 1] if k else 0, stops[k])
            yield int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), digest, keys[own], times[own]

    @staticmethod
    def _links(a, b, cut_a, cut_b, in_a, in_b, text_of_group):
        """Distinct (text, id pair) with the number of links, in order of text and pair."""
        found = []
        size = in_a * in_b
        start_a, start_b = cut_a + 1 - in_a, cut_b + 1 - in_b
        done = 0
        stops = np.cumsum(size)
        while done < len(size):
            to = max(done + 1, int(np.searchsorted(stops, (stops[done - 1] if done else 0) + CHUNK_LINKS, side="right")))
            if size[done] > CHUNK_LINKS:
                # One very long group: distinct ids of each side, with their numbers.
                ua, ca = np.unique(a[start_a[done] : cut_a[done] + 1], return_counts=True)
                ub, cb = np.unique(b[start_b[done] : cut_b[done] + 1], return_counts=True)
                pair, times = ((ua << ID_BITS)[:, None] | ub).ravel(), (ca[:, None] * cb).ravel()
                owner = np.full(len(pair), text_of_group[done])
                found.append(_summed(_key(owner, pair), times))
                to = done + 1
            else:
                # Most groups are one token of each; the others' pairs are listed.
                groups = np.arange(done, to)
                one = size[done:to] == 1
                single, groups = groups[one], groups[~one]
                group = np.repeat(groups, size[groups])
                nth = np.arange(len(group)) - np.repeat(np.cumsum(size[groups]) - size[groups], size[groups])
                pair = (a[start_a[group] + nth // in_b[group]] << ID_BITS) | b[start_b[group] + nth % in_b[group]]
                alone = (a[cut_a[single]] << ID_BITS) | b[cut_b[single]]
                key = np.concatenate((_key(text_of_group[single], alone), _key(text_of_group[group], pair)))
                found.append(_summed(key, None))
            done = to
        return _merged(found)


def _key(owner, pair):
    # Owners are few, ids are short: both fit one number for the sort.
    return (owner << (2 * ID_BITS)) | pair


def _summed(key, times):
    """Pair, number of links and owner of each distinct key; without `times` each stands for one link."""
    if times is None:
        key = np.sort(key)
    else:
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    if times is None:
        sums = np.diff(first, append=len(key))
    else:
        sums = np.add.reduceat(times, first) if len(first) else times[:0]
    key = key[first]
    return key & ((1 << 2 * ID_BITS) - 1), sums, key >> (2 * ID_BITS)


def _merged(found):
    if len(found) == 1:
        return found[0]
    pair, times, owner = (np.concatenate(parts) for parts in zip(*found))
    return _summed(_key(owner, pair), times)


def aligned(docs: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id and RESULT of every document, stored: its groups' digest and its id pairs with their numbers of links."""
    bound_batches(docs.sparkSession)
    first, second = f"{vocabularies}/{BYTE_VOCABULARY}", f"{vocabularies}/{PIECE_VOCABULARY}"

    @F.pandas_udf(RESULT)
    def align(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(byte_encoder(first), piece_encoder(second))
        names = [field.split()[0] for field in RESULT.split(", ")]
        for batch in batches:
            texts = batch.tolist()
            # Few texts at a time: each character takes about a hundred bytes here.
            chunk = np.cumsum([len(t or "") for t in texts]) // CHUNK_CHARS
            starts = np.flatnonzero(np.diff(chunk, prepend=-1)).tolist()
            rows = [row for a, b in zip(starts, [*starts[1:], len(texts)]) for row in aligner.align(texts[a:b])]
            yield pd.DataFrame(rows, columns=names)

    rows = docs.select("doc_id", align(docs["text"].cast("string")).alias("r"))
    return stored(
        rows.select("doc_id", F.monotonically_increasing_id().alias("mark"), "r.*"), "aligned"
    )


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, n: in how many documents each id pair is linked; combined before the shuffle, so common pairs are no hot keys."""
    return rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def token_alignment(docs: DataFrame, vocabularies: str = VOCABULARIES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document.

    A pair's count is the number of documents (rows, repeated ones too) that hold it linked. NULL and empty texts and
    those whose tokens do not spell them have no tokens: zeros and an empty digest. Only counts of pairs that
    several documents share are looked up; a pair that is not among them has a count of one.
    """
    rows = aligned(docs, vocabularies)
    counts = stored(pair_counts(rows), "pair-counts")
    first = F.shiftright("pair", ID_BITS)
    # At most one row per id of the vocabulary.
    best = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    shared = counts.where("n > 1")
    links = rows.select("mark", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "mark", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times")
    )
    looked = (
        links.join(sized(shared, shared.count() <= BROADCAST_PAIRS), "pair", "left")
        .withColumns({"n": F.coalesce("n", F.lit(1)), "a": first})
        .join(F.broadcast(best), "a")
    )
    sums = looked.groupBy("mark").agg(
        F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "mark", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
