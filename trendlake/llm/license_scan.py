"""License texts in documents: MinHash retrieves templates by windows, shingle containment verifies them.

Texts are read as runs of letters and digits, without case. A template of m words is looked for in windows of
``span(m)`` words, each starting ``span(m) / 4`` after the last, so that any m words lie whole within one.
A window that holds ``least`` of a template's five-word shingles has a known least Jaccard similarity to it;
``band_settings`` picks bands that catch such a window with the wanted probability. Retrieved pairs are
verified by the exact share of the template's shingles in the window.

The templates given here are notices, headers and short whole texts of common licenses; the long texts (GPL, Apache, Mozilla) are
known by their headers only. Others are a parameter.

Result: a row per document and template that is found, with the highest share, the first word of the first window that
has it and how many windows were verified.

Defined cases: null, empty and too short texts hold nothing. A template needs five words at least. Repeated rows are
scanned each. An empty table gives an empty result. Extra columns aren't read. Texts are read whole, in slices of rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trendlake.llm.common import slices, small_batches

SHINGLE = 5
TOKEN = re.compile(r"[^\W_]+")
#: Notices in general use.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-3.0-line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0-line": "Licensed under the Mozilla Public License, Version 2.0.",
    "bsd-line": "Released under the BSD License.",
    "isc-line": "Released under the ISC License.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nd-4.0-line": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-4.0-long-line": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "gpl-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."
    ),
    "lgpl-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "agpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "bsd-name-clause": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "bsd-conditions": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "boost-1.0-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software"
    ),
    "unlicense-grant": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}


def span(words: int) -> int:
    """Window length for a template: a power of two, a quarter of which still leaves room for the template."""
    return 1 << math.ceil(math.log2(max(8, words * 4 / 3)))


def band_settings(jaccard: float, wanted: float = 0.999, hashes: int = 64) -> tuple[int, int]:
    """Bands and rows a band: the most selective ones that catch the similarity with the wanted probability."""
    best = None
    for rows in range(1, 9):
        hit = jaccard**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - wanted) / math.log(1 - hit))
        if best is None or bands * rows <= hashes:
            best = (bands, rows)
    return best


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def word_hash(word: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word, 0)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of each run of five word hashes."""
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - SHINGLE + 1 + i]
    return mixed(out)


MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def permuted(shingle: np.ndarray, number: int) -> np.ndarray:
    return (shingle ^ np.uint64(number * 0x632BE59BD9B4E019 % (1 << 64))) * np.uint64((2 * number + 1) * 0x9E3779B97F4A7C15 % (1 << 64))


class Templates:
    """Shingles and band keys of the templates that share a window length."""

    def __init__(self, texts: dict[str, str], least: float):
        self.least = least
        self.spans: dict[int, dict[str, frozenset[int]]] = defaultdict(dict)
        for name, text in texts.items():
            words = tokens(text)
            if len(words) < SHINGLE:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            found = shingles(np.array([word_hash(w) for w in words], np.uint64))
            self.spans[span(len(words))][name] = frozenset(found.tolist())
        self.bands: dict[int, tuple[int, int]] = {}
        self.keys: dict[int, list[dict[int, list[str]]]] = {}
        for length, group in self.spans.items():
            held = min(math.ceil(least * len(s)) for s in group.values())
            whole = max(len(s) for s in group.values())
            # The window has span - 4 shingles, ``held`` of them the template's.
            self.bands[length] = bands, rows = band_settings(held / (length - SHINGLE + 1 + whole - held))
            self.keys[length] = [defaultdict(list) for _ in range(bands)]
            for name, found in group.items():
                own = np.array(sorted(found), np.uint64)
                for band in range(bands):
                    self.keys[length][band][band_key([permuted(own, band * rows + r).min() for r in range(rows)])].append(name)


def band_key(minima) -> int:
    key = np.uint64(0)
    with np.errstate(over="ignore"):
        for m in minima:
            key = key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(m)
    return int(key)


def scan(texts: list[str | None], templates: Templates) -> list[tuple[int, str, float, int, int]]:
    """(row, template, share, first word, windows) of what is found in a list of texts."""
    words = [tokens(t) for t in texts]
    known: dict[str, int] = {}
    for w in set().union(*words) if words else ():
        known[w] = word_hash(w)
    hashed = [shingles(np.fromiter(map(known.__getitem__, w), np.uint64, len(w))) for w in words]
    found: dict[tuple[int, str], list] = {}
    for length, group in templates.spans.items():
        step = length // 4
        size = length - SHINGLE + 1
        # Each text starts at a multiple of the step, followed by enough room that no window reaches the next.
        room = [-(-(len(h) + length) // step) * step if len(h) else 0 for h in hashed]
        starts = np.cumsum([0, *room])
        flat = np.full(int(starts[-1]), MOST, np.uint64)
        for h, at in zip(hashed, starts, strict=False):
            flat[at : at + len(h)] = h
        if not len(flat):
            continue
        bands, rows = templates.bands[length]
        candidates: set[tuple[int, str]] = set()
        real = flat != MOST
        for band in range(bands):
            key = None
            for r in range(rows):
                value = np.where(real, permuted(flat, band * rows + r), MOST)
                # Windows overlap by whole steps, but the last one's shingles end four words early.
                whole = value.reshape(-1, step).min(1)
                blocks = size // step
                low = np.full(len(whole), MOST, np.uint64)
                for b in range(blocks):
                    low[: len(whole) - b] = np.minimum(low[: len(whole) - b], whole[b:])
                left = size - blocks * step
                if left:
                    tail = value.reshape(-1, step)[:, :left].min(1)
                    low[: len(whole) - blocks] = np.minimum(low[: len(whole) - blocks], tail[blocks:])
                key = low if key is None else key * np.uint64(0x9E3779B97F4A7C15) + low
            wanted = templates.keys[length][band]
            for w in np.flatnonzero(np.isin(key, np.array(list(wanted), np.uint64))).tolist():
                candidates.update((w, name) for name in wanted[int(key[w])])
        for w, name in sorted(candidates):
            at = w * step
            row = int(np.searchsorted(starts, at, "right")) - 1
            begin = at - int(starts[row])
            inside = set(hashed[row][begin : begin + size].tolist())
            share = len(inside & group[name]) / len(group[name])
            if share >= templates.least:
                best = found.setdefault((row, name), [0.0, 0, 0])
                best[2] += 1
                if share > best[0]:
                    best[:2] = [share, begin]
    return [(row, name, share, begin, count) for (row, name), (share, begin, count) in sorted(found.items())]


def license_matches(docs: DataFrame, texts: dict[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """doc_id, template, containment, first_word, windows."""
    templates = Templates(texts, least)
    small_batches(docs.sparkSession)
    source = docs.select("doc_id", "text")
    schema = source.drop("text").schema
    for name, kind in (("template", "string"), ("containment", "double"), ("first_word", "long"), ("windows", "long")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1):
                found = scan(batch.column(1).to_pylist(), templates)
                row, name, share, begin, count = zip(*found, strict=True) if found else ([], [], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(name, pa.string()),
                        pa.array(share, pa.float64()),
                        pa.array(begin, pa.int64()),
                        pa.array(count, pa.int64()),
                    ],
                    names=["doc_id", "template", "containment", "first_word", "windows"],
                )

    return source.mapInArrow(run, schema)
