"""Periodic runs of words: seeds of repeated k-grams, extended along their diagonal.

A run of period q is a stretch of words in which words q apart are identical, whose smallest
period is q, with ``max(SHORTEST, TIMES * q)`` words or more, that no neighbouring word extends.

Two equal k-grams q words apart are a seed on the diagonal of lag q. Lags fall in classes, and
each class has a k that is at least its largest lag and at most the overlap a run guarantees:
a run of period q has at least 3 q equal pairs at lag q (5 and 6 for lags 1 and 2). So each run
holds a seed of its class, and as k >= q the second k-gram is the next occurrence of the first:
only neighbouring occurrences are paired, never all. A nearer occurrence would give the run
a smaller period, so a run found this way has no smaller one.

k is 4, 8, 16, ... A k-gram is named by the pair of its halves' names, numbered by sorting: equal
names are equal words, without hashing. Names are made for longer k-grams only as long as
one occurs twice in a document. They give the extension of a seed as well, by halving steps.
For each lag a table holds how far extensions have come; a seed before that point lies in a
known stretch and is skipped.

Documents are handled in groups of ``GROUP_WORDS`` words, one document never being cut; memory
is that of some integers a word for each k.

Defined results: a null text counts as empty; a text without a word has no runs and collapses to
the empty text. Words are what lies between ASCII white space, compared byte by byte.
Repeated rows and texts give the same result each; a null key changes nothing. Other columns
are returned as they are, those named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkwell.llm.shipping import append_columns

#: Fewest words of a run, and how often its period must fit.
SHORTEST, TIMES = 6, 4
#: Words that are handled together.
GROUP_WORDS = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lag_class(k: int) -> tuple[int, int]:
    """Smallest and largest lag that k-grams are indexed for."""
    return {4: (1, 2), 8: (3, 8)}.get(k, (k // 2 + 1, k))


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Equal numbers from 0 for equal keys."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


class Group:
    """Words of some documents in a row, and the names of their k-grams."""

    def __init__(self, documents: list[list[bytes]]):
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        self.ends = np.cumsum(sizes)
        self.first = self.ends - sizes
        numbers: dict[bytes, int] = {}
        flat = np.fromiter(
            (numbers.setdefault(w, len(numbers)) for words in documents for w in words), np.int64, int(sizes.sum())
        )
        document = np.repeat(np.arange(len(sizes)), sizes)
        self.start, self.end = self.first[document], self.ends[document]
        # Names hold the document, so that equal names lie in one document.
        self.names = {1: _numbered(document * max(len(numbers), 1) + flat)}
        # Up to 4-grams always, for the steps of an extension.
        for k in (2, 4):
            self._double(k)

    def _double(self, k: int) -> None:
        """Names of k-grams from those of their halves; -1 where the document ends earlier."""
        half, size = self.names[k // 2], len(self.start)
        name = np.full(size, -1, np.int64)
        at = np.flatnonzero(np.arange(size) + k <= self.end)
        name[at] = _numbered(half[at] * (size + 1) + half[at + k // 2])
        self.names[k] = name

    def seeds(self, k: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """Place and lag of neighbouring equal k-grams of the class, and whether any are equal."""
        name = self.names[k]
        order = np.argsort(name, kind="stable")
        order = order[np.searchsorted(name[order], 0) :]
        same = np.flatnonzero(name[order[1:]] == name[order[:-1]])
        place, lag = order[same], order[same + 1] - order[same]
        low, high = lag_class(k)
        own = np.flatnonzero((lag >= low) & (lag <= high))
        own = own[np.argsort(place[own])]
        return place[own], lag[own], len(same) > 0

    def _equal(self, k: int, a: int, b: int) -> bool:
        """Whether the k-grams at a < b are equal, both inside their document."""
        name = self.names[k]
        return b < len(name) and a >= self.start[b] and name[a] >= 0 and name[a] == name[b]

    def extended(self, place: int, lag: int, longest: int) -> tuple[int, int]:
        """The stretch of equal pairs at ``lag`` around a seed."""
        left, right = place, place
        for k in self._halving(longest):
            while self._equal(k, right, right + lag):
                right += k
        for k in self._halving(longest):
            while left >= k and self._equal(k, left - k, left - k + lag):
                left -= k
        return left, right

    @staticmethod
    def _halving(k: int) -> Iterator[int]:
        while k:
            yield k
            k //= 2

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by places in the row of documents."""
        found, k = [], 4
        while True:
            places, lags, repeated = self.seeds(k)
            covered: dict[int, int] = {}
            for place, lag in zip(places.tolist(), lags.tolist()):
                if place < covered.get(lag, -1):
                    continue
                left, right = self.extended(place, lag, k)
                covered[lag] = right
                if right - left + lag >= max(SHORTEST, TIMES * lag):
                    found.append((left, right - left + lag, lag))
            if not repeated:
                return sorted(found, key=lambda run: (run[0], run[2]))
            k *= 2
            self._double(k)


def _groups(texts: Iterator[bytes | None]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = (text or b"").split()
        if held and size + len(words) > GROUP_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def analyse(documents: list[list[bytes]]) -> Iterator[tuple[list[dict[str, int]], bytes]]:
    """Runs of each document, and its words without those that repeat a run's first period."""
    group = Group(documents)
    runs = group.runs()
    starts = np.array([r[0] for r in runs], np.int64)
    # +1 where a repeated part begins, -1 behind it.
    edges = np.zeros(len(group.start) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    bounds = np.searchsorted(starts, [group.first, group.ends])
    for words, first, end, low, high in zip(documents, group.first.tolist(), group.ends.tolist(), *bounds.tolist()):
        own = [{"start": s - first, "length": n, "period": q} for s, n, q in runs[low:high]]
        rest = words if not own else [w for w, k in zip(words, kept[first:end].tolist()) if k]
        yield own, b" ".join(rest)


def find(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with n_words, runs (by start, then period) and collapsed, the text without repeats.

    ``collapsed`` holds the words that no run contains behind its first period, joined by one space.
    """

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, runs, collapsed = [], [], []
        values = batch.column(text).cast(pa.large_binary())
        for group in _groups(v.as_py() for v in values):
            counts.extend(map(len, group))
            for own, rest in analyse(group):
                runs.append(own)
                collapsed.append(rest.decode())
        return [pa.array(counts, pa.int64()), pa.array(runs, _RUNS), pa.array(collapsed, pa.string())]

    return append_columns(documents, {"n_words": "bigint", "runs": RUNS, "collapsed": "string"}, columns)
