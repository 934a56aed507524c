"""Byte-level BPE: encode by a priority queue of merges, decode by joining symbols.

A piece of text is a doubly linked list of byte symbols. A queue holds the merges that
neighbouring symbols allow, by rank and then position. The first is taken; it is stale,
and skipped, if one of its symbols has been merged meanwhile. A merge puts the new
symbol's pairs with its neighbours into the queue.

The vocabulary is a file of the ``tokenizers`` library with a byte-level BPE model
without normalizer. Strings of added tokens in a text become these tokens, as there.

Defined results: a null text counts as empty; an empty text has no ids and decodes to
an empty text. Repeated rows are encoded alike. Other columns are returned as they are,
those named like the results are replaced. Any text is encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from inkwell.llm.shipping import map_batches

# Fixed value: how the byte-level pre-tokenizer splits a text. White space is what
# Unicode calls so; the control characters 1c to 1f are none.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Ids of distinct pieces are remembered in about twice as many bytes at most, and only of
#: pieces up to that many letters. Pieces of the text at hand come on top.
CACHED_BYTES, CACHED_LETTERS = 64 << 20, 64
_SLOT = 100


def byte_letters() -> list[str]:
    """The letter that vocabulary files write for each byte: itself where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary, given as the text of its file."""

    def __init__(self, vocabulary: str):
        data = json.loads(vocabulary)
        model, letters = data["model"], byte_letters()
        if model["type"] != "BPE" or data.get("normalizer") or data["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("only byte-level BPE without normalizer is read")
        if data["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("vocabularies that put a space before each text are not read")
        ids, of_letter = model["vocab"], {c: b for b, c in enumerate(letters)}
        self.symbols = {i: bytes(of_letter[c] for c in s) for s, i in ids.items()}
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.symbols |= {i: s.encode() for s, i in added.items()}
        self.bytes = [ids[c] for c in letters]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.made = [ids[a + b] for a, b in merges]
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.split = re.compile("(" + "|".join(map(re.escape, longest)) + ")")
        self.pieces = regex.compile(PIECES)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece. A queue entry is the merge's rank, then its position."""
        ids = [self.bytes[b] for b in piece]
        n = len(ids)
        if n < 2:
            return ids
        rank_of, made = self.ranks.get, self.made
        # The rank of the merge of each symbol with the next; none: no merge, or gone.
        ranks = [rank_of((a, b)) for a, b in zip(ids, ids[1:])]
        queue = [(r << 32) + i for i, r in enumerate(ranks) if r is not None]
        if not queue:
            return ids
        heapify(queue)
        ranks.append(None)
        before, after = list(range(-1, n)), list(range(1, n + 1))
        while queue:
            entry = heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if ranks[i] != rank:
                continue  # stale: the pair is no longer there
            ids[i] = new = made[rank]
            j = after[i]
            after[i] = k = after[j]
            before[k] = i
            ranks[j] = None
            if k < n:
                ranks[i] = rank = rank_of((new, ids[k]))
                if rank is not None:
                    heappush(queue, (rank << 32) + i)
            else:
                ranks[i] = None
            h = before[i]
            if h >= 0:
                ranks[h] = rank = rank_of((ids[h], new))
                if rank is not None:
                    heappush(queue, (rank << 32) + h)
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = after[i]
        return out

    def _plain(self, text: str) -> bytes:
        if self.held > CACHED_BYTES:
            self.older, self.cache, self.held = self.cache, {}, 0
        pieces, cache, older, long = self.pieces.findall(text), self.cache, self.older, []
        for piece in set(pieces):
            if piece not in cache:
                ids = cache[piece] = older.get(piece) or array("I", self.merge(piece.encode())).tobytes()
                if len(piece) > CACHED_LETTERS:
                    long.append(piece)
                else:
                    self.held += _SLOT + sys.getsizeof(piece) + sys.getsizeof(ids)
        found = b"".join(map(cache.__getitem__, pieces))
        for piece in long:
            del cache[piece]
        return found

    def encode(self, text: str) -> array:
        """Ids of a text, as unsigned 32-bit integers."""
        if not any(x in text for x in self.added):
            return array("I", self._plain(text))
        parts = self.split.split(text)
        parts[::2] = map(self._plain, parts[::2])
        parts[1::2] = (array("I", [self.added[x]]).tobytes() for x in parts[1::2])
        return array("I", b"".join(parts))

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.symbols.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def _little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


def encode(documents: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``documents`` with the ids of each text as an array.

    The driver reads the vocabulary file (a few MB) and sends it to the tasks.
    """
    vocabulary = open(vocabulary_path, encoding="utf-8").read()
    return _with(documents, {ids: "array<bigint>"}, lambda batch: [
        pa.array([list(codec(vocabulary).encode(t or "")) for t in batch.column(text).to_pylist()], pa.list_(pa.int64()))
    ])


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text of each row's ids; null ids count as none."""
    vocabulary = open(vocabulary_path, encoding="utf-8").read()
    return _with(encoded, {text: "string"}, lambda batch: [
        pa.array([codec(vocabulary).decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())
    ])


def round_trip(documents: DataFrame, vocabulary_path: str, text: str = "text") -> DataFrame:
    """``documents`` with n_tokens, ids_sha256 and decoded_sha256 of each text.

    Encodes, then decodes the ids; the ids themselves are not written out. The digests are
    of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8.
    """
    vocabulary = open(vocabulary_path, encoding="utf-8").read()

    def digest(batch: pa.RecordBatch) -> list[pa.Array]:
        own, counts, of_ids, of_texts = codec(vocabulary), [], [], []
        for value in batch.column(text).to_pylist():
            found = own.encode(value or "")
            counts.append(len(found))
            of_ids.append(hashlib.sha256(_little_endian(found)).hexdigest())
            of_texts.append(hashlib.sha256(own.decode(found).encode()).hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]

    return _with(documents, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, digest)


def _with(rows: DataFrame, new: dict[str, str], make) -> DataFrame:
    kept = [f for f in rows.schema.fields if f.name not in new]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{k}` {v}" for k, v in new.items()])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *make(batch)], [*names, *new])

    return map_batches(rows, run, schema)
