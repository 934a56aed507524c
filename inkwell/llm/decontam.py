"""Benchmark decontamination by CGK embeddings, bit-sampling and exact edit distances.

Symbols are words (lower case). A window of a document matches a benchmark item if at
most ``share`` of the item's words must be inserted, deleted or replaced to get it.

1. At most k edits leave at least ``n - 1 - 2k`` of an item's n - 1 neighbouring word pairs
   as they are. Where so many pairs of one item lie within its size, a window of the item's
   size is cut at the place the pair has in the item. This exact count takes out nearly
   all text and no match.
2. The CGK walk reads each window and each item: a step writes the current word and moves
   on if a random bit of (step, word) is set. Few edits become few different steps.
3. Bit-sampling LSH: a table hashes one or two sampled steps of a walk. A window is a
   candidate of an item that it meets in any table. Walks and tables are repeated until planted
   deletions, insertions and replacements of the largest distance are all found (``level``): the
   longer an item, the sooner its walks part and the more repeats it gets. Items of more than ``MEASURED`` words,
   or of a size for which no setting of ``LEVELS`` finds all, go to step 4 with all their windows.
4. Candidates are verified by the exact edit distance of the item to the best part of
   the text around the window, which may be longer or shorter than the item. Windows of one item that
   begin close together are verified as one stretch of text.

Defined results: null and empty texts match nothing; an item without words matches
nothing; an item of one word matches that word. Of equally near windows of a document the first counts.
Repeated document rows give repeated result rows, equal items each give a row. Tables
without rows give no rows. Columns other than the key and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import textnum
from inkwell.llm.shipping import map_batches
from inkwell.session import keep

SHARE = 0.2
#: Benchmark texts go to every task in portions of at most this many bytes, with keys of two or three
#: times as many, and as many passes are made over the documents as there are portions.
PORTION_BYTES = 16 << 20
#: Walks, tables of each walk and sampled steps of each table, the weakest setting first.
LEVELS = ((2, 8, 2), (4, 12, 2), (4, 16, 1), (8, 32, 1), (16, 64, 1))
#: The largest item whose recall is measured, and the planted matches of each kind of edit: if
#: none of 300 is lost, recall is over 0.99 with 95 % confidence.
MEASURED, TRIALS = 640, 300
_FILTER_BITS = 22
#: Cells of the lines of edit distances that are held at once.
_CELLS = 250_000


class Items:
    """A portion of the benchmark, ready to be looked up."""

    def __init__(self, ids: list[int], texts: list[str], share: float):
        if not 0 <= share <= 0.3:
            raise ValueError("the share of edits is 0 to 0.3")
        codes, starts, ends = textnum.flatten([t.lower() for t in texts])
        ws, we = textnum.word_runs(codes)
        words = textnum.run_hashes(codes, ws, we)
        low, high = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
        kept = np.flatnonzero(high > low)
        self.ids = [ids[i] for i in kept]
        self.sizes = (high - low)[kept]
        self.edits = (share * self.sizes + 1e-9).astype(np.int64)
        self.largest = int(self.sizes.max(initial=0))
        # All items' words, one item after the other, so that a long one does not widen the others.
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = words[np.repeat(low[kept] - self.starts, self.sizes) + np.arange(int(self.sizes.sum()))]
        # Every neighbouring pair of words: where it is in which item.
        item = np.repeat(np.arange(len(kept)), self.sizes - 1)
        ends = np.cumsum(self.sizes - 1)
        place = np.arange(len(item)) - np.repeat(ends - self.sizes + 1, self.sizes - 1)
        at = self.starts[item] + place
        pairs = textnum.mix(textnum.mix(self.words[at]) + self.words[at + 1]) if len(at) else np.zeros(0, np.uint64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, first, self.met = np.unique(pairs[order], return_index=True, return_counts=True)
        self.first, self.item, self.place = first, item[order], place[order]
        self.marks = np.zeros(1 << _FILTER_BITS, bool)
        self.marks[self.pairs >> np.uint64(64 - _FILTER_BITS)] = True
        self.needed = self.sizes - 1 - 2 * self.edits
        # Items of one word, by that word.
        ones = np.flatnonzero(self.sizes == 1)
        self.ones = ones[np.argsort(self.words[self.starts[ones]], kind="stable")]
        self.single = self.words[self.starts[self.ones]]
        # Keys of all items of a size, and which of them an item has.
        self.levels = {int(n): level(int(n), share) for n in np.unique(self.sizes)}
        self.place_in_size, self.keys = np.zeros(len(kept), np.int64), {}
        for n, setting in self.levels.items():
            same = np.flatnonzero(self.sizes == n)
            self.place_in_size[same] = np.arange(len(same))
            if setting is not None:
                self.keys[n] = _sketches(self.rows, same, n, setting, True)

    def meet(self, cut, chosen: np.ndarray) -> np.ndarray:
        """Which windows meet the chosen item in a table; ``cut`` gives the words of windows."""
        met, sizes = np.ones(len(chosen), bool), self.sizes[chosen]
        for n in np.unique(sizes):
            setting = self.levels[int(n)]
            if setting is not None:
                at = np.flatnonzero(sizes == n)
                for part in np.array_split(at, 1 + len(at) * int(n) // _CELLS):
                    keys = sketch(cut(part), setting, False)
                    met[part] = (keys == self.keys[int(n)][:, self.place_in_size[chosen[part]]]).any(0)
        return met

    def rows(self, chosen: np.ndarray) -> np.ndarray:
        """A row of words for each chosen item, 0 beyond its size."""
        return _cut(self.words, self.starts[chosen], self.sizes[chosen], (self.starts + self.sizes)[chosen])


def sketch(windows: np.ndarray, setting: tuple[int, int, int], known: bool) -> np.ndarray:
    """Keys of each window (a row of its size; 0 is past its end) in each table.

    A table with a step past the end has a key that no window shares with a known item.
    """
    count, n = windows.shape
    walks, tables, sampled = setting
    steps = (np.random.default_rng(5).random((walks, tables, sampled)) * (1.6 * n)).astype(np.int64)
    taken: dict[int, list[tuple[int, int]]] = {}
    for walk, table, i in np.ndindex(steps.shape):
        taken.setdefault(int(steps[walk, table, i]), []).append((walk, table))
    last = max(taken) + 1
    salts = textnum.mix(np.arange(last * walks, dtype=np.uint64)).reshape(last, walks, 1) | np.uint64(1)
    symbols = np.concatenate([windows, np.zeros((count, 1), np.uint64)], axis=1).ravel()
    rows, at = np.arange(count)[None, :] * (n + 1), np.zeros((walks, count), np.int64)
    keys, past = np.full((walks, tables, count), n, np.uint64), np.zeros((walks, tables, count), bool)
    for j in range(last):
        now = symbols[rows + at]
        for walk, table in taken.get(j, ()):
            keys[walk, table] = textnum.mix(keys[walk, table] + now[walk])
            past[walk, table] |= now[walk] == 0
        at += ((now * salts[j]) >> np.uint64(63)).astype(np.int64)
    keys[past] = int(known)
    return keys.reshape(walks * tables, count)


def _sketches(rows, chosen: np.ndarray, size: int, setting: tuple[int, int, int], known: bool) -> np.ndarray:
    """``sketch`` of many rows, some at a time."""
    parts = np.array_split(chosen, 1 + len(chosen) * size // _CELLS)
    return np.concatenate([sketch(rows(part), setting, known) for part in parts if len(part)], axis=1)


def planted(size: int, edits: int, trials: int) -> dict[str, np.ndarray]:
    """For each kind of edit: windows of an item 1, 2 .. size with so many edits, other words around.

    The window is the one that the pair count surely gives: its first pair that is left whole
    stands at its own place.
    """
    rng, kinds = np.random.default_rng(size), {}
    other = np.uint64(1 << 40)
    for kind in ("delete", "insert", "replace"):
        for spread in ("even", "random"):
            rows = np.empty((trials, size), np.uint64)
            for row in range(trials):
                if spread == "even":
                    places = ((np.arange(edits) + rng.random()) * size / max(1, edits)).astype(np.int64)
                else:
                    places = rng.choice(size, edits, replace=False)
                words = np.arange(1, size + 1, dtype=np.uint64)
                if kind == "replace":
                    words[places] = other
                elif kind == "delete":
                    words = np.delete(words, places)
                else:
                    words = np.insert(words, places, other)
                whole = np.flatnonzero((words[1:] == words[:-1] + np.uint64(1)) & (words[1:] < other))
                first = int(whole[0]) if len(whole) else 0
                begin = first - (int(words[first]) - 1) if len(whole) else 0
                around = np.full(size, other + np.uint64(1))
                text = np.concatenate([around, words, around])
                rows[row] = text[size + begin : 2 * size + begin]
            kinds[f"{kind} {spread}"] = rows
    return kinds


def recall(size: int, share: float, setting: tuple[int, int, int], trials: int = TRIALS) -> dict[str, float]:
    """The part of planted matches at the largest distance that meet their item, by kind of edit."""
    # Numbers as words have alike bits; hashes do not.
    item = sketch(textnum.mix(np.arange(1, size + 1, dtype=np.uint64))[None, :], setting, True)
    kinds = planted(size, int(share * size + 1e-9), trials)
    return {k: float((sketch(textnum.mix(rows), setting, False) == item).any(0).mean()) for k, rows in kinds.items()}


@lru_cache(maxsize=None)
def _measured(size: int, share: float) -> tuple[int, int, int] | None:
    return next((s for s in LEVELS if min(recall(size, share, s).values()) == 1.0), None)


def level(size: int, share: float) -> tuple[int, int, int] | None:
    """The weakest setting that loses none of the planted matches, None if none does.

    Sizes are measured by classes, at the largest size of a class: steps of 5 words, then of a quarter.
    """
    top = 5
    while top < size:
        top += max(5, top // 20 * 5)
    return _measured(top, share) if size <= MEASURED else None


def edit_distances(items: np.ndarray, sizes: np.ndarray, texts: np.ndarray, free: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each row: fewest edits from the item to a part of the text, and where that part ends.

    The part may start anywhere (``free``) or at the start of the text. One dynamic
    program runs over all rows at once; 0 pads items and texts.
    """
    count, m = texts.shape
    steps = np.arange(m + 1, dtype=np.int32)
    line = np.zeros((count, m + 1), np.int32) if free else np.tile(steps, (count, 1))
    done = np.empty_like(line)
    done[sizes == 0] = line[sizes == 0]
    for i in range(items.shape[1]):
        new = np.empty_like(line)
        new[:, 0] = i + 1
        np.minimum(line[:, :-1] + (texts != items[:, i : i + 1]), line[:, 1:] + 1, out=new[:, 1:])
        # Insertions run along the line: the smallest earlier value plus the way from it.
        line = np.minimum.accumulate(new - steps, axis=1) + steps
        done[sizes == i + 1] = line[sizes == i + 1]
    done[:, 1:][texts == 0] = items.shape[1] + m + 1
    ends = done.argmin(1)
    return done[np.arange(count), ends], ends


def _windows(items: Items, words: np.ndarray, owners: np.ndarray, lows: np.ndarray, highs: np.ndarray):
    """First word and item of each window that may match, by the number of known pairs."""
    pairs = textnum.mix(textnum.mix(words[:-1]) + words[1:])
    maybe = np.flatnonzero(items.marks[pairs >> np.uint64(64 - _FILTER_BITS)])
    known = np.minimum(np.searchsorted(items.pairs, pairs[maybe]), max(0, len(items.pairs) - 1))
    sure = (items.pairs[known] == pairs[maybe]) & (owners[maybe] == owners[maybe + 1]) if len(items.pairs) else np.zeros(len(maybe), bool)
    places, known = maybe[sure], known[sure]
    # Of any item's pairs, as many as the easiest item needs must lie within the largest size.
    if len(places):
        enough = np.searchsorted(places, places + items.largest) - np.arange(len(places)) >= items.needed[items.sizes > 1].min()
        reach = np.zeros(len(words) + items.largest + 1, np.int32)
        np.add.at(reach, places[enough], 1)
        np.add.at(reach, places[enough] + items.largest, -1)
        dense = np.cumsum(reach)[places] > 0
        places, known = places[dense], known[dense]
    # Now the pairs of each item by themselves.
    met = items.met[known]
    entry = np.repeat(items.first[known], met) + np.arange(int(met.sum())) - np.repeat(np.cumsum(met) - met, met)
    at, item, within = np.repeat(places, met), items.item[entry], items.place[entry]
    wide = len(words) + items.largest + 1
    order = np.argsort(item * wide + at, kind="stable")
    at, item, within = at[order], item[order], within[order]
    own = item * wide + at
    first = np.searchsorted(own, own)
    # A pair that its item has twice is counted twice here, which lets only more through.
    count = np.searchsorted(own, own + items.sizes[item] - 1) - first
    good = count >= items.needed[item]
    at, item, within = at[good], item[good], within[good]
    start = np.maximum(at - within, lows[owners[at]])
    # Items of one word have no pairs.
    alone = np.flatnonzero(np.isin(words, items.single)) if len(items.single) else np.zeros(0, np.int64)
    low = np.searchsorted(items.single, words[alone])
    met = np.searchsorted(items.single, words[alone], side="right") - low
    entry = np.repeat(low, met) + np.arange(int(met.sum())) - np.repeat(np.cumsum(met) - met, met)
    both = np.unique(np.stack([np.append(start, np.repeat(alone, met)), np.append(item, items.ones[entry])], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _cut(words: np.ndarray, first: np.ndarray, sizes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A row of words for each window, 0 beyond its size or its document."""
    place = first[:, None] + np.arange(int(sizes.max()))
    found = words[np.minimum(place, len(words) - 1)]
    found[place >= np.minimum(first + sizes, stops)[:, None]] = 0
    return found


def _turned(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each row's first words, as many as its size, from the last to the first; then 0."""
    places = sizes[:, None] - 1 - np.arange(rows.shape[1])
    return np.where(places >= 0, np.take_along_axis(rows, np.maximum(places, 0), 1), 0)


def _batches(rows: np.ndarray, widths: np.ndarray) -> Iterator[np.ndarray]:
    """The rows, those of like width together, in batches of about ``_CELLS`` cells."""
    order = np.argsort(-widths, kind="stable")
    rows, widths, at = rows[order], widths[order], 0
    while at < len(rows):
        held = max(1, _CELLS // max(1, int(widths[at])))
        yield rows[at : at + held]
        at += held


def matches(items: Items, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of each text and item that match.

    Start and end are characters of the text.
    """
    lowered = [t.lower() for t in texts]
    codes, starts, ends = textnum.flatten(lowered)
    ws, we = textnum.word_runs(codes)
    if not items.ids or not len(ws):
        return []
    words = textnum.run_hashes(codes, ws, we)
    lows, highs = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    owners = np.repeat(np.arange(len(texts)), highs - lows)
    f, k = _windows(items, words, owners, lows, highs)
    # Only windows that meet their item in a table of the LSH go on to the edit distance.
    met = items.meet(lambda at: _cut(words, f[at], items.sizes[k[at]], highs[owners[f[at]]]), k)
    f, k = f[met], k[met]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    # Copies without an edit need no dynamic program, and nothing is nearer than they are.
    owner, size = owners[f], items.sizes[k]
    whole = np.flatnonzero(f + size <= highs[owner])
    for w in _batches(whole, size[whole]):
        same = w[(_cut(words, f[w], size[w], highs[owner[w]]) == items.rows(k[w])).all(1)]
        for i in same.tolist():
            key, new = (int(owner[i]), int(k[i])), (0, int(f[i]), int(f[i] + size[i]))
            best[key] = min(best.get(key, new), new)
    done = [t * len(items.ids) + i for t, i in best]
    left = ~np.isin(owner * len(items.ids) + k, done)
    # Windows of an item that begin in the same stretch of its size are one piece of text.
    f, k, owner, stretch = f[left], k[left], owner[left], (f // size)[left]
    order = np.lexsort((f, stretch, k, owner))
    f, k, owner, stretch = f[order], k[order], owner[order], stretch[order]
    new = np.ones(len(f), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (k[1:] != k[:-1]) | (stretch[1:] != stretch[:-1])
    heads = np.flatnonzero(new)
    f, last, k, owner = f[heads], f[np.flatnonzero(np.append(new[1:], True))] if len(f) else f, k[heads], owner[heads]
    size, slack, stop = items.sizes[k], items.edits[k], highs[owner]
    begin = np.maximum(f - slack, lows[owner])
    reach = np.minimum(last + size + 2 * slack, stop) - begin
    for w in _batches(np.arange(len(f)), reach):
        found = _cut(words, begin[w], reach[w], stop[w])
        apart, end = edit_distances(items.rows(k[w]), size[w], found, free=True)
        near = np.flatnonzero((apart <= slack[w]) & (end > 0))
        if not len(near):
            continue
        w, apart, end = w[near], apart[near], end[near]
        # Backwards from the end for the start, which is at most the edits before the item's size.
        back = np.minimum(end, size[w] + slack[w])
        text = _turned(_cut(words, begin[w] + end - back, back, stop[w]), back)
        _, length = edit_distances(_turned(items.rows(k[w]), size[w]), size[w], text, free=False)
        for a, b, d, x, y in zip(owner[w].tolist(), k[w].tolist(), apart.tolist(), (begin[w] + end - length).tolist(), (begin[w] + end).tolist()):
            key, new = (a, b), (d, x, y)
            if y > x and (key not in best or new < best[key]):
                best[key] = new
    out = []
    for (t, k), (d, a, b) in sorted(best.items()):
        start, end = int(ws[a] - starts[t]), int(we[b - 1] - starts[t])
        if len(lowered[t]) != len(texts[t]):  # lower case of another length: places in the original text
            lengths = np.cumsum([0, *(len(c.lower()) for c in texts[t])])
            start, end = int(np.searchsorted(lengths, start, "right") - 1), int(np.searchsorted(lengths, end, "left"))
        out.append((t, items.ids[k], start, end, d))
    return out


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    share: float = SHARE,
    portion: int = PORTION_BYTES,
) -> DataFrame:
    """key, item_id, start, end, edits: the nearest window of each document and item that match."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    portions = max(1, -(-int(total) // (portion // 2)))
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id bigint, start bigint, `end` bigint, edits int"
    out = None
    for p in range(portions):
        part = benchmark.select(F.col(item).alias("item"), "text").where("text is not null and item is not null")
        if portions > 1:
            part = part.where(F.pmod(F.xxhash64("item"), F.lit(portions)) == p)
        rows = sorted(part.collect())
        items = Items([int(r["item"]) for r in rows], [r["text"] for r in rows], share)

        def run(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [
                    (first + t, *rest)
                    for first, held in textnum.slices(batch.column("text").to_pylist())
                    for t, *rest in matches(items, held)
                ]
                if found:
                    rows, *rest = map(list, zip(*found))
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(key).take(pa.array(rows)), *[pa.array(x, t) for x, t in zip(rest, types)]],
                        [key, "item_id", "start", "end", "edits"],
                    )

        found = map_batches(documents.select(key, "text"), run, schema)
        if portions > 1:
            # Written before the next portion is read, so that the driver holds one at a time.
            found = keep(found, "matches")
        out = found if out is None else out.unionByName(found)
    return out
