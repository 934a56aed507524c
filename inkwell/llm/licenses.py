"""License scans: MinHash bands retrieve templates, shingle containment verifies them.

A text's shingles (five words in a row, lower case; a shorter template has one of all its
words) are cut into blocks of S, S a power of two and at least the template's number n of
shingles. Two blocks in a row are a window, so any passage of a template's length lies
in one of the overlapping windows whole. A window that holds the wanted share of a
template has a Jaccard similarity to it of at least ``share * n / (2S + (1 - share) * n)``.
Each band is one minimum hash; the number of bands is such that a window of that
similarity meets the template in a band with probability ``RECALL``. Templates met are
verified by the exact share of their shingles in the window.

Defined results: null and empty texts, and texts of fewer words than the shortest template,
hold no license. Of several windows the one with the largest share counts, then the first.
Repeated rows give repeated results, templates without words are never found, and tables
without rows give no rows. Columns other than key and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkwell.llm import textnum
from inkwell.llm.shipping import map_batches

SHINGLE, SHARE, RECALL = 5, 0.8, 0.999

# Passages of public licenses and the usual notices.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}


def _band(shingles: np.ndarray, band: int) -> np.ndarray:
    """The hash of a band, 32 bits."""
    low = (shingles ^ (shingles >> np.uint64(29))).astype(np.uint32)
    return (low ^ (low >> np.uint32(16))) * np.uint32(2 * (band * 0x3C6EF372 % (1 << 31)) + 1) + (
        (shingles >> np.uint64(32)).astype(np.uint32) * np.uint32(2 * (band * 0x1B873593 % (1 << 31)) + 1)
    )


def _length(text: str) -> int:
    """The number of words of a text."""
    return len(textnum.word_runs(textnum.flatten([text.lower()])[0])[0])


def _short(templates: Templates, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> dict[tuple[int, int], tuple[float, int, int]]:
    """First place of each short template in each text: (text, template) to (-1, first word, last word).

    A set of one shingle is its own minimum in every band, so a text meets the template where it holds that shingle.
    """
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    for length, known in templates.short.items():
        hashed = textnum.mix(textnum.shingle_hashes(words, length), length)
        at = np.flatnonzero(np.isin(hashed, np.fromiter(known, np.uint64, len(known))))
        texts = np.searchsorted(high, at, side="right")
        for a, t in zip(at.tolist(), texts.tolist()):
            if low[t] <= a and a + length <= high[t]:
                for k in known[int(hashed[a])]:
                    found.setdefault((t, k), (-1.0, a, a + length - 1))
    return found


class Templates:
    """Templates by the size of their blocks."""

    def __init__(self, texts: dict[str, str], share: float = SHARE):
        self.names = sorted(texts)
        found, ends = textnum.shingle_sets([texts[n] for n in self.names], SHINGLE)
        self.sets = [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        self.share = share
        self.classes: dict[int, list[int]] = {}
        self.bands: dict[int, int] = {}
        # Templates of fewer words than a shingle, by their number of words: one shingle of that length each.
        self.short: dict[int, dict[int, list[int]]] = {}
        for k, shingles in enumerate(self.sets):
            length = _length(texts[self.names[k]])
            if 0 < length < SHINGLE:
                self.short.setdefault(length, {}).setdefault(int(shingles[0]), []).append(k)
            elif n := len(shingles):
                size = max(4, 1 << (n - 1).bit_length())
                least = math.ceil(share * n - 1e-9) / (2 * size + n - math.ceil(share * n - 1e-9))
                self.classes.setdefault(size, []).append(k)
                self.bands[size] = max(self.bands.get(size, 0), math.ceil(math.log(1 - RECALL) / math.log(1 - least)))
        self.least = {(s, b): {int(_band(self.sets[k], b).min()): [] for k in ks} for s, ks in self.classes.items() for b in range(self.bands[s])}
        for (size, b), known in self.least.items():
            for k in self.classes[size]:
                known[int(_band(self.sets[k], b).min())].append(k)


def matches(templates: Templates, texts: list[str]) -> list[tuple[int, str, float, int, int]]:
    """(text, license, share, start, end) of each license found in each text; places are characters."""
    lowered = [t.lower() for t in texts]
    codes, starts, ends = textnum.flatten(lowered)
    ws, we = textnum.word_runs(codes)
    words = textnum.run_hashes(codes, ws, we)
    low, high = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    first = textnum.shingle_hashes(words, SHINGLE)
    counts = np.maximum(high - low - SHINGLE + 1, 0)
    offset = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    word = low[owner] + np.arange(int(counts.sum())) - offset[owner]
    shingles = first[word]
    best = _short(templates, words, low, high)
    sizes = sorted(templates.classes) if len(shingles) else []
    blocks = {}
    for size in sizes:
        within = np.arange(len(shingles)) - offset[owner]
        blocks[size] = np.flatnonzero(within % size == 0)
    met: set[tuple[int, int, int]] = set()
    for band in range(max(templates.bands.values(), default=0) if sizes else 0):
        hashed, finest, at_finest = _band(shingles, band), None, None
        for size in sizes:
            if band >= templates.bands[size]:
                continue
            heads = blocks[size]
            if finest is None:
                least = np.minimum.reduceat(hashed, heads)
            else:
                least = np.minimum.reduceat(finest, np.searchsorted(at_finest, heads))
            finest, at_finest = least, heads
            known = templates.least[size, band]
            # A window starts at each block; a block that holds the minimum is in the window
            # that it starts and in the one before it.
            for at in np.flatnonzero(np.isin(least, np.fromiter(known, np.uint32, len(known)))):
                for k in known[int(least[at])]:
                    met.add((size, int(at), k))
                    if at and owner[heads[at - 1]] == owner[heads[at]]:
                        met.add((size, int(at) - 1, k))
    for size, at, k in sorted(met):
        heads = blocks[size]
        begin, text = int(heads[at]), int(owner[heads[at]])
        end = min(begin + 2 * size, int(offset[text] + counts[text]))
        place = np.flatnonzero(np.isin(shingles[begin:end], templates.sets[k]))
        share = len(np.unique(shingles[begin:end][place])) / len(templates.sets[k])
        if share >= templates.share - 1e-9:
            new = (-share, int(word[begin + place[0]]), int(word[begin + place[-1]]) + SHINGLE - 1)
            if (text, k) not in best or new < best[text, k]:
                best[text, k] = new
    out = []
    for (t, k), (share, a, b) in sorted(best.items()):
        start, end = int(ws[a] - starts[t]), int(we[b] - starts[t])
        if len(lowered[t]) != len(texts[t]):  # lower case of another length: places in the original text
            lengths = np.cumsum([0, *(len(c.lower()) for c in texts[t])])
            start, end = int(np.searchsorted(lengths, start, "right") - 1), int(np.searchsorted(lengths, end, "left"))
        out.append((t, templates.names[k], -share, start, end))
    return out


def scan(documents: DataFrame, texts: dict[str, str] = TEMPLATES, key: str = "doc_id", share: float = SHARE) -> DataFrame:
    """key, license, share, start and end of each license found in each document."""
    templates = Templates(texts, share)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (first + t, *rest)
                for first, held in textnum.slices(batch.column("text").to_pylist())
                for t, *rest in matches(templates, held)
            ]
            if found:
                rows, *rest = map(list, zip(*found))
                types = (pa.string(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(pa.array(rows)), *[pa.array(x, t) for x, t in zip(rest, types)]],
                    [key, "license", "share", "start", "end"],
                )

    schema = f"`{key}` {kind}, license string, share double, start bigint, `end` bigint"
    return map_batches(documents.select(key, "text"), run, schema)
