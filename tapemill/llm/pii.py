"""Personal data, also in disguise, with offsets into the source text.

Base patterns are found in the text as it is. Then small transducers rewrite it: homoglyphs to ASCII, spelled
digits to digits, bracketed or spoken at and dot to their signs. They keep, for every character written, the
source characters it stands for, so what is found in the rewritten text maps back to source spans. Only finds
that contain a rewritten character are added; what is found without rewriting stays as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import bound_batches
from tapemill.llm.top_level import TOP_LEVEL

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive repeats and looking behind leave the matches as they are and keep the time linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters and digits of other scripts that look like ASCII ones.
HOMOGLYPHS = dict(
    zip(
        "АВЕКМНОРСТУХаеорсухіјѕԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο",
        "ABEKMHOPCTYXaeopcyxijsdhqw" "ABEZHIKMNOPTYXo",
    )
)
HOMOGLYPHS |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}  # full-width forms
HOMOGLYPHS |= {chr(0x0660 + k): str(k) for k in range(10)} | {chr(0x06F0 + k): str(k) for k in range(10)}
# Spelled digits.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
# A run of spelled digits, digits among them, of at least so many tokens is a number.
LEAST_SPELLED = 7

_LOOKALIKE = re.compile("[" + re.escape("".join(HOMOGLYPHS)) + "]")
_DIGIT_WORD = rf"(?:{'|'.join(SPELLED)})"
_DIGIT_RUN = re.compile(rf"(?i)(?<![A-Za-z])(?=\+?(?:[0-9][ -]){{0,3}}{_DIGIT_WORD}\b)\+?(?:{_DIGIT_WORD}|[0-9]+)(?:[ -](?:{_DIGIT_WORD}|[0-9]+))++(?![A-Za-z])")
_TOKEN = re.compile(rf"(?i){_DIGIT_WORD}|[0-9]+|[ +-]")
_BRACKETED = re.compile(r"(?i) ?[\[({<] ?(at|dot|@|\.) ?[\])}>] ?")
# A dotted quad whose dots may be spoken and whose parts may be spelled; words are joined within a part only.
_DIGIT = rf"(?:{_DIGIT_WORD}(?![A-Za-z])|[0-9](?![0-9]))"
_PART = rf"(?:{_DIGIT}(?:[ -]{_DIGIT})*+|[0-9]++)"
_QUAD = re.compile(rf"(?i)(?<![A-Za-z0-9]){_PART}(?:(?: dot |\.){_PART})*+")
_QUAD_DOT = re.compile(rf"(?i)(?: dot |\.)(?={_DIGIT_WORD}|[0-9])")
_PART_OR_DOT = re.compile(rf"(?i) dot |\.|{_DIGIT_WORD}|[0-9]+")
# Words are only taken for signs of an address where its domain ends in a top-level domain.
_AT = re.compile(r"(?i)(?<=[A-Za-z0-9._%+-]) at (?=[A-Za-z0-9-])|@(?=[A-Za-z0-9-])")
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_DOT = re.compile(r"(?i) dot (?=[A-Za-z0-9-])|\.(?=[A-Za-z0-9-])")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans (kind, start, end) of the base patterns, by kind as listed, then start."""
    found: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append(("email", start, done))
        else:
            done = at + 1
        at = text.find("@", done)
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def _rewrite(text: str, starts: list[int], ends: list[int], edits: list[tuple[int, int, str]]):
    """Apply edits (start, end, new) in order; every new character stands for the whole source of its edit."""
    out, s, e, at = [], [], [], 0
    for start, end, new in edits:
        out += [text[at:start], new]
        s += starts[at:start] + [starts[start]] * len(new)
        e += ends[at:start] + [ends[end - 1]] * len(new)
        at = end
    return "".join(out) + text[at:], s + starts[at:], e + ends[at:]


def _quads(plain: str, rewritten: Callable[[int], bool]) -> list[tuple[int, int, str]]:
    """Edits that make dotted quads of runs of digits, spelled digits, dots and spoken dots."""
    if sum(1 for _ in islice(_QUAD_DOT.finditer(plain), 3)) < 3:
        return []
    edits: list[tuple[int, int, str]] = []
    for m in _QUAD.finditer(plain):
        parts, dots = [[]], []
        for t in _PART_OR_DOT.finditer(plain, m.start(), m.end()):
            if t[0] == "." or t[0].lower() == " dot ":
                dots.append((t.start(), t.end(), "."))
                parts.append([])
            else:
                parts[-1].append((t.start(), t.end(), SPELLED.get(t[0].lower(), t[0])))
        number = lambda part: int("".join(d for _, _, d in part)[-9:])
        k = 0
        while k + 4 <= len(parts):
            first, *inner, last = parts[k : k + 4]
            # Digits before and after a quad do not belong to it.
            while number(first) > 255 and len(first) > 1:
                first = first[1:]
            while number(last) > 255 and len(last) > 1:
                last = last[:-1]
            quad = [first, *inner, last]
            signs = dots[k : k + 3]
            words = any(e - s > len(d) for part in quad for s, e, d in part)
            if not (words or any(e - s > 1 or rewritten(s) for s, e, _ in signs)) or any(number(part) > 255 for part in quad):
                k += 1
                continue
            for part in quad:
                edits += [edit for edit in part if plain[edit[0] : edit[1]] != edit[2]]
                edits += [(a[1], b[0], "") for a, b in zip(part, part[1:])]
            edits += [sign for sign in signs if plain[sign[0] : sign[1]] != "."]
            k += 4
    return sorted(edits)


def _addresses(plain: str, rewritten: Callable[[int], bool]) -> list[tuple[int, int, str]]:
    """Edits that make addresses of labels with spoken at and dot. Spoken at needs a dot in disguise in the domain."""
    edits: dict[int, tuple[int, int, str]] = {}
    for m in _AT.finditer(plain):
        at, dots, end = m.end(), [], 0
        label = _LABEL.match(plain, at)
        while label:
            top = label[0].lower()
            name = top if top.startswith("xn--") else top.split("-")[0]
            if dots and (name in TOP_LEVEL or name.startswith("xn--") or len(name) == 2 and name.isalpha()):
                end = len(dots)
            dot = _DOT.match(plain, label.end())
            if dot:
                dots.append((dot.start(), dot.end(), "."))
            label = _LABEL.match(plain, dot.end()) if dot else None
        domain = [d for d in dots[:end] if d[1] - d[0] > 1]
        if m[0] != "@" and not domain and not any(rewritten(d[0]) for d in dots[:end]):
            continue
        if m[0] == "@" and not dots:
            continue
        local, start = [], m.start()
        while True:
            token = start
            while start and plain[start - 1] in _LOCAL:
                start -= 1
            if not any(c.isalnum() for c in plain[start:token]):
                break
            local.append((start, token))
            if plain[max(0, start - 5) : start].lower() != " dot ":
                break
            start -= 5
        if not local:
            continue
        between = [(b[1], a[0], ".") for a, b in zip(local, local[1:])]
        sign = [] if m[0] == "@" else [(m.start(), m.end(), "@")]
        # Without a top-level domain behind a spoken dot, the part before it has to be a domain.
        if m[0] == "@" and not end and plain[dots[0][0]] != ".":
            continue
        edits |= {edit[0]: edit for edit in [*between, *sign, *domain]}
    return sorted(edits.values())


def normalise(text: str) -> tuple[str, list[int], list[int]] | None:
    """The rewritten text with source start and end of each of its characters; None if nothing changes."""
    plain = "".join(HOMOGLYPHS.get(c, c) for c in text) if _LOOKALIKE.search(text) else text
    state = None

    def step(edits: list[tuple[int, int, str]]) -> None:
        nonlocal state, plain
        if edits:
            starts, ends = state or (list(range(len(plain))), list(range(1, len(plain) + 1)))
            plain, starts, ends = _rewrite(plain, starts, ends, edits)
            state = starts, ends

    def rewritten(k: int) -> bool:
        return state is not None and state[1][k] - state[0][k] > 1

    sign = lambda m: "@" if "at" in m[0].lower() or "@" in m[0] else "."
    step([(m.start(), m.end(), sign(m)) for m in _BRACKETED.finditer(plain)])
    step(_quads(plain, rewritten))
    # Spelled digits next to an IP are no part of it.
    ips = [(s, e) for kind, s, e in base_spans(plain) if kind == "ip"] if _DIGIT_RUN.search(plain) else []
    runs = []
    for start, end in zip([0, *[e for _, e in ips]], [*[s for s, _ in ips], len(plain)]):
        for m in _DIGIT_RUN.finditer(plain, start, end):
            tokens = [t for t in _TOKEN.finditer(plain, m.start(), m.end())]
            kinds = [t for t in tokens if t[0] not in (" ", "-", "+")]
            if sum(len(t[0]) if t[0].isdigit() else 1 for t in kinds) >= LEAST_SPELLED:
                for t in tokens:
                    if t[0].lower() in SPELLED:
                        runs.append((t.start(), t.end(), SPELLED[t[0].lower()]))
                    elif t[0] in (" ", "-"):
                        runs.append((t.start(), t.end(), ""))
    step(runs)
    step(_addresses(plain, rewritten))
    if state is None:
        return None if plain == text else (plain, list(range(len(text))), list(range(1, len(text) + 1)))
    return plain, *state


def all_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those found in disguise; both by kind as listed, then start.

    NULL is the empty text. A find in disguise may overlap base spans, which often are the undisguised part of it.
    """
    text = text or ""
    base = base_spans(text)
    changed = normalise(text)
    if changed is None:
        return base, base
    plain, starts, ends = changed
    added = []
    for kind, start, end in base_spans(plain):
        source = starts[start], ends[end - 1]
        if text[source[0] : source[1]] != plain[start:end]:
            added.append((kind, *source))
    return base, sorted(set(base + added), key=lambda s: (KINDS.index(s[0]), s[1:]))


def merged(spans: list[Span]) -> list[Span]:
    """Spans without overlaps, by start; overlapping ones become one of the kind of the longest."""
    out: list[tuple[int, Span]] = []
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if out and start < out[-1][1][2]:
            longest, (kind0, start0, end0) = out.pop()
            kind = kind if end - start > longest else kind0
            out.append((max(longest, end - start), (kind, start0, max(end, end0))))
        else:
            out.append((end - start, (kind, start, end)))
    return [span for _, span in out]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_SCHEMA = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans (base and added, by source code points), n_added."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf(_SCHEMA)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                base, spans = all_spans(text)
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*counts, digest, _joined(spans), len(spans) - len(base)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _SCHEMA.split(", ")])

    return docs.select("doc_id", find(docs["text"].cast("string")).alias("f")).select("doc_id", "f.*")


def masked(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets, overlapping ones by one; other columns as they came."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def mask(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            out = []
            for text in batch:
                for kind, s, e in reversed(merged(all_spans(text)[1])):
                    text = f"{text[:s]}[{kind}]{text[e:]}"
                out.append(text)
            yield pd.Series(out, dtype=object)

    return docs.withColumn("text", mask(docs["text"].cast("string")))
