"""License notices found by MinHash bands over overlapping windows of words, verified by containment.

Templates are cut into 5-word shingles (shorter ones are one shingle) and signed by MinHash. Windows overlap and are
a quarter longer than the template; one whose signature agrees with a template's in a band retrieves it, and the exact
share of the template's shingles in the window decides. A window that holds four fifths of a template has a Jaccard
similarity of 0.55 or more to it; 16 bands of one row miss such a pair with probability 0.45 ** 16, or 3 in a million.
As a band is the least value of one shingle, only windows around a template's band values need a signature at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapemill.llm.common import WORD_BYTES, bound_batches

SHINGLE = 5
BANDS = 16
CONTAINMENT = 0.8
# Words a task remembers before it starts over.
MEMORY = 400_000

# Notices of public licenses, and the names that SPDX gives to licenses.
NOTICES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "apache-2.0-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "mit-short": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "lgpl-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-disclaimer": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-3-clause-endorsement": "may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "epl-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib": "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "bsl-1.0-short": "Distributed under the Boost Software License, Version 1.0.",
}
SPDX = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 "
    "CC-BY-NC-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only "
    "GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 OFL-1.1 "
    "Unlicense WTFPL Zlib"
).split()
TEMPLATES = NOTICES | {f"spdx:{name}": f"SPDX-License-Identifier: {name}" for name in SPDX}

_rng = np.random.default_rng(11)
_MULTIPLY = _rng.integers(1, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64)
_PLACE = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for every run of `width` words, given the words' hashes."""
    n = max(0, len(hashes) - width + 1)
    sums = np.full(n, width, np.uint64)
    for k in range(width):
        sums += hashes[k : k + n] * _PLACE[k]
    sums ^= sums >> np.uint64(29)
    return sums * np.uint64(0xBF58476D1CE4E5B9)


def signed(values: np.ndarray, band: int) -> np.ndarray:
    """A shingle's value in a band; the least one of a set is the set's signature there."""
    mixed = values * _MULTIPLY[band] + _ADD[band]
    return mixed ^ (mixed >> np.uint64(32))


class Scanner:
    """Templates with their bands; scans one text at a time."""

    def __init__(self, templates: dict[str, str]):
        self.words = _Words()
        # By shingle width: the sets of the templates' shingles, and by shingle the bands in which it signs a template.
        self.sets: dict[int, dict[str, np.ndarray]] = {}
        self.bands: dict[int, dict[int, list[tuple[str, int]]]] = {}
        for name, template in templates.items():
            hashes = self.hashes(template)
            if not len(hashes):
                continue
            width = min(SHINGLE, len(hashes))
            own = np.unique(shingles(hashes, width))
            self.sets.setdefault(width, {})[name] = own
            bands = self.bands.setdefault(width, {})
            for band in range(BANDS):
                bands.setdefault(int(own[signed(own, band).argmin()]), []).append((name, band))
        self.keys = {width: np.array(sorted(bands), np.uint64) for width, bands in self.bands.items()}

    def hashes(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        return np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))

    def retrieved(self, values: np.ndarray, width: int) -> set[tuple[str, int, int]]:
        """(template, start, end) of the windows of a text's shingles that agree with a template in a band."""
        keys = self.keys[width]
        near = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
        found: set[tuple[str, int, int]] = set()
        for at in np.flatnonzero(keys[near] == values).tolist():
            for name, band in self.bands[width][int(values[at])]:
                size = len(self.sets[width][name])
                reach, stride = size + size // 4, max(1, size // 8)
                least = signed(values[at : at + 1], band)[0]
                for start in range(max(0, -(-(at - reach + 1) // stride) * stride), at + 1, stride):
                    window = (name, start, start + reach)
                    if window not in found and signed(values[start : start + reach], band).min() == least:
                        found.add(window)
        return found

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(template, first word, end word, containment), one for each run of matching windows.

        A match of less than a whole template gives way to one of another template that overlaps it and holds more
        shingles: notices of one family differ in few words.
        """
        hashes = self.hashes(text)
        merged: list[tuple[str, int, int, float]] = []
        for width, sets in self.sets.items():
            values = shingles(hashes, width)
            found = []
            for name, start, end in self.retrieved(values, width) if len(values) else ():
                own = values[start:end]
                held = np.isin(own, sets[name])
                share = len(np.unique(own[held])) / len(sets[name])
                if share >= CONTAINMENT:
                    at = np.flatnonzero(held) + start
                    found.append((name, int(at[0]), int(at[-1]) + width, share))
            last = len(merged)
            for name, s, e, share in sorted(found):
                if len(merged) > last and merged[-1][0] == name and s < merged[-1][2]:
                    _, s0, e0, share0 = merged.pop()
                    s, e, share = s0, max(e, e0), max(share, share0)
                merged.append((name, s, e, share))
        sizes = {name: len(own) for sets in self.sets.values() for name, own in sets.items()}
        return _best(merged, sizes)


def _best(matches: list[tuple[str, int, int, float]], sizes: dict[str, int]) -> list[tuple[str, int, int, float]]:
    """Matches by start, without those short of a whole template that overlap one with more shingles."""
    matches = sorted(matches, key=lambda m: (m[1], m[2], m[0]))
    held = [share * sizes[name] for name, _, _, share in matches]
    lost: set[int] = set()
    # Matches that reach beyond the current one's start: one of a template at most.
    reaching: list[int] = []
    for k, (_, start, _, _) in enumerate(matches):
        reaching = [j for j in reaching if matches[j][2] > start]
        for j in reaching:
            less, more = (j, k) if held[j] < held[k] else (k, j)
            if held[less] < held[more] and matches[less][3] < 1.0:
                lost.add(less)
        reaching.append(k)
    return [m for k, m in enumerate(matches) if k not in lost]


def license_notices(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per notice: doc_id, license, start_word, end_word, containment.

    NULL and empty texts have none; repeated rows and notices are found each time, an empty table has none.
    """
    bound_batches(docs.sparkSession)
    chosen = dict(TEMPLATES if templates is None else templates)

    @F.pandas_udf("array<struct<license: string, start_word: int, end_word: int, containment: double>>")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(chosen)
        names = ("license", "start_word", "end_word", "containment")
        for batch in texts:
            yield pd.Series([[dict(zip(names, m)) for m in scanner.scan(t)] for t in batch], dtype=object)

    found = docs.select("doc_id", scan(docs["text"].cast("string")).alias("found"))
    return found.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
