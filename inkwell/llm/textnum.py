"""Texts of a batch as flat numpy arrays: characters, words and their hashes.

All helpers work on many texts at once, without a Python loop over documents. Null
texts count as empty. ``slices`` cuts a batch by its number of characters, so the
arrays stay small whatever the texts' lengths; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

SLICE_CHARS = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``limit`` characters together, with the index of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


@lru_cache
def _table(kind: str) -> np.ndarray:
    test: Callable[[str], bool] = {"word": lambda c: c.isalnum() or c == "_", "space": str.isspace}[kind]
    return np.fromiter((test(chr(i)) for i in range(0x110000)), bool, 0x110000)


def flatten(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, a line break between two; start and end of each."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.cumsum(lengths + 1) - lengths - 1
    return codes, starts, starts + lengths


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words: maximal runs of letters, digits and underscores."""
    return runs(_table("word")[codes])


def token_runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens: maximal runs without white space."""
    return runs(~_table("space")[codes])


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer, so that close inputs give unrelated hashes."""
    x = x + np.uint64(int(_GOLDEN) * (2 * seed + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the characters of each run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    offset = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), 0xD6E8FEB86659FD93, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    chars = codes[offset + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(chars * powers[offset], first) + lengths.astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` words in a row; entry i starts at word i."""
    count = max(0, len(words) - size + 1)
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total = (total * np.uint64(0x9FB21C651E98DF25)) + words[k : k + count]
    return mix(total, 7)


def shingle_sets(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, one text after the other; ends of each.

    A text of fewer than ``size`` words, but one at least, has one shingle of all its
    words; a text without words has none.
    """
    codes, starts, ends = flatten([t.lower() for t in texts])
    ws, we = word_runs(codes)
    words = run_hashes(codes, ws, we)
    low, high = np.searchsorted(ws, starts), np.searchsorted(ws, ends)
    owners = np.repeat(np.arange(len(texts)), high - low)
    hashes = shingle_hashes(words, size)
    whole = owners[: len(hashes)] == owners[size - 1 :] if len(hashes) else np.zeros(0, bool)
    hashes, owners = hashes[whole], owners[: len(whole)][whole]
    short = np.flatnonzero((high - low > 0) & (high - low < size))
    if len(short):
        extra = [mix(shingle_hashes(words[low[i] : high[i]], int(high[i] - low[i])), int(high[i] - low[i]))[0] for i in short]
        hashes, owners = np.append(hashes, np.array(extra, np.uint64)), np.append(owners, short)
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owners[order], kind="stable")]
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return hashes, np.searchsorted(owners, np.arange(len(texts)), side="right")
