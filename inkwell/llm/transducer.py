"""Byte-level BPE as a finite-state transducer, and a streaming decoder.

Encoding. A sequence of tokens is what the merges give exactly if each two neighbours are
what they give for these two alone. So a transducer can guess tokens along a trie of
the vocabulary and has to remember only the last one. It is unambiguous: the bytes read so
far have one way to end in a whole token. It is made deterministic while it reads: a
state is the set of all guesses (last token, place in the trie, tokens not yet
written), a step follows one byte in all of them, and tokens in which all guesses agree are
written at once. Guesses live as long as they may become a token, so the lookahead is
bounded by the longest token. States and steps are kept for the next texts, up to
``KEPT_STATES``; beyond, they are forgotten and made again.

Whether two tokens may be neighbours follows from the merges alone: each token is made by a
fixed tree of merges, and only the symbols on the inner edges of the two trees ever
touch. A merge across comes about if it is due while both its symbols are there.

Decoding. ``Decoder`` takes ids in any portions and returns whole characters. A state
machine of UTF-8 follows the bytes and tells how many at the end wait for the rest of their
character; its steps over whole tokens are remembered.

A vocabulary is a file of ranks: a token in base64 and its rank on each line. Every
byte must be a token, and every token must be made by merges of earlier ones.

Defined results: a null text counts as empty; an empty text has no ids and decodes to an
empty text. Repeated rows are encoded alike. Other columns are returned as they are, those
named like the results are replaced. Any text is encoded whole. Bytes that are no UTF-8
become replacement characters in a decoded text. Null ids count as none.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from inkwell.llm.shipping import append_columns

#: Guesses held by all states together, some hundred bytes each.
KEPT_STATES = 1_000_000
#: Pairs of tokens whose neighbourhood is remembered.
KEPT_PAIRS = 1_000_000
#: Distinct pieces of a text whose ids are remembered, twice as many at most, and the longest such piece.
KEPT_PIECES, LONGEST_KEPT = 200_000, 48
#: Ids that are decoded at a time.
PORTION = 1 << 16
NEVER = 1 << 60


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Tokens and their ranks from a rank file's content."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


@lru_cache(maxsize=4)
def compile_merges(lines: bytes) -> tuple[bytes, bytes, bytes]:
    """Ids of all tokens by rank, and the two parts of each (-1 for a byte), as packed integers.

    The merges of a rank file are not written in it: each token's last one is found by
    merging its own bytes.
    """
    ranks = read_ranks(lines)
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must be a token")
    ids, left, right = array("q"), array("q"), array("q")
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            due = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            i = min(range(len(due)), key=due.__getitem__)
            if due[i] == NEVER:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) > 2 or (len(parts) == 2 and max(ranks[p] for p in parts) >= rank):
            raise ValueError(f"token {rank} is not made by merges of earlier tokens")
        ids.append(rank)
        left.append(ranks[parts[0]] if len(parts) == 2 else -1)
        right.append(ranks[parts[1]] if len(parts) == 2 else -1)
    return ids.tobytes(), left.tobytes(), right.tobytes()


class Transducer:
    """Bytes of one piece to ids."""

    def __init__(self, merges: tuple[bytes, bytes, bytes], byte_ids: dict[int, int]):
        ids, left, right = (array("q", packed) for packed in merges)
        byte_of = {i: b for b, i in byte_ids.items()}
        self.parts, self.symbols = {}, {}
        for i, a, b in zip(ids, left, right):
            self.parts[i] = (a, b)
            self.symbols[i] = bytes([byte_of[i]]) if a < 0 else self.symbols[a] + self.symbols[b]
        self.rank_of = {s: i for i, s in self.symbols.items()}
        # The trie: a node and a byte give the next node; node 0 is the root.
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for i, symbol in self.symbols.items():
            node = 0
            for byte in symbol:
                self.inner[node] = True
                node = self.child.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.inner.append(False)
            self.token[node] = i
        self.pairs: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}
        self.states: list[tuple] = []
        # A state's number and a byte give the next state and the tokens to write.
        self.moves: dict[int, tuple[int, tuple]] = {}
        self.numbers: dict[tuple, int] = {}
        self.held = 0
        self._number(((-1, 0, ()),))

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """Symbols on one edge of a token's tree: bytes, when made, and when merged further.

        Times are ranks, -1 the start. The last symbol, the token itself, stays.
        """
        found = self.edges.get((token, side))
        if found is None:
            chain = [token]
            while (part := self.parts[chain[-1]][side]) >= 0:
                chain.append(part)
            ends = [NEVER, *chain[:-1]]
            made = [-1 if self.parts[i][0] < 0 else i for i in chain]
            found = [(self.symbols[i], m, e) for i, m, e in zip(chain, made, ends)]
            self.edges[token, side] = found
        return found

    def fits(self, first: int, second: int) -> bool:
        """Whether the two tokens together are encoded as just these two."""
        key = first << 32 | second
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = not self._merge_across(first, second)
        return known

    def _merge_across(self, first: int, second: int) -> bool:
        rank_of, others = self.rank_of.get, self._edge(second, 0)
        for a, made_a, end_a in self._edge(first, 1):
            for b, made_b, end_b in others:
                rank = rank_of(a + b)
                if rank is None:
                    continue
                due = max(rank, made_a, made_b)
                # At equal ranks the merge further left comes first.
                if due < end_a and due <= end_b:
                    return True
        return False

    def _number(self, guesses: tuple) -> int:
        number = self.numbers.get(guesses)
        if number is None:
            number = self.numbers[guesses] = len(self.states)
            self.states.append(guesses)
            self.held += len(guesses)
        return number

    def _step(self, state: int, byte: int) -> tuple[int, tuple]:
        """The next state and the tokens that are certain now."""
        child, inner, tokens, pairs = self.child.get, self.inner, self.token, self.pairs
        guesses = []
        for last, node, waiting in self.states[state]:
            node = child(node << 8 | byte)
            if node is None:
                continue
            if inner[node]:
                guesses.append((last, node, waiting))
            token = tokens[node]
            if token >= 0:
                fits = True if last < 0 else pairs.get(last << 32 | token)
                if self.fits(last, token) if fits is None else fits:
                    guesses.append((token, 0, (*waiting, token)))
        agreed = guesses[0][2]
        for _, _, waiting in guesses:
            if not agreed:
                break
            while agreed != waiting[: len(agreed)]:
                agreed = agreed[:-1]
        rest = tuple((last, node, waiting[len(agreed) :]) for last, node, waiting in guesses) if agreed else tuple(guesses)
        if self.held > KEPT_STATES:
            for table in (self.states, self.moves, self.numbers):
                table.clear()
            self.held = 0
            self._number(((-1, 0, ()),))
            return self._number(rest), agreed
        move = self.moves[state << 8 | byte] = (self._number(rest), agreed)
        return move

    def encode(self, piece: bytes) -> list[int]:
        known, state, out = self.moves.get, 0, []
        for byte in piece:
            state, certain = known(state << 8 | byte) or self._step(state, byte)
            if certain:
                out.extend(certain)
        # At the end only the guess that stands between two tokens is left.
        out.extend(next(waiting for _, node, waiting in self.states[state] if node == 0))
        return out


def _utf8_table() -> list[list[int]]:
    """Next state by state and byte. State 0: between characters.

    1: one byte to come. 2, 3, 4: first of three bytes, by what may follow; 5: second of three.
    6, 7, 8: first of four bytes; 9 and 10: second and third of four. A byte that cannot
    follow ends the broken character and is read as a first one.
    """
    fresh = [0] * 256
    leads = [(0xC2, 0xDF, 1), (0xE0, 0xE0, 2), (0xE1, 0xEC, 3), (0xED, 0xED, 4), (0xEE, 0xEF, 3)]
    leads += [(0xF0, 0xF0, 6), (0xF1, 0xF3, 7), (0xF4, 0xF4, 8)]
    for low, high, state in leads:
        fresh[low : high + 1] = [state] * (high - low + 1)
    table = [fresh]
    follow = [(0x80, 0xBF, 0), (0xA0, 0xBF, 5), (0x80, 0xBF, 5), (0x80, 0x9F, 5), (0x80, 0xBF, 0)]
    follow += [(0x90, 0xBF, 9), (0x80, 0xBF, 9), (0x80, 0x8F, 9), (0x80, 0xBF, 10), (0x80, 0xBF, 0)]
    for low, high, state in follow:
        table.append([state if low <= b <= high else fresh[b] for b in range(256)])
    return table


UTF8 = _utf8_table()
#: Bytes of the unfinished character in each state.
UNFINISHED = [0, 1, 1, 1, 1, 2, 1, 1, 1, 2, 3]


class Decoder:
    """Ids in portions to whole characters."""

    def __init__(self, symbols: dict[int, bytes], steps: list[dict[int, int]]):
        self.symbols, self.steps, self.state, self.waiting = symbols, steps, 0, b""

    def feed(self, ids) -> bytes:
        """The bytes of all characters that are complete now."""
        state, steps = self.state, self.steps
        for i in ids:
            after = steps[state].get(i)
            if after is None:
                after = state
                for byte in self.symbols[i]:
                    after = UTF8[after][byte]
                steps[state][i] = after
            state = after
        data = self.waiting + b"".join(map(self.symbols.__getitem__, ids))
        cut = len(data) - UNFINISHED[state]
        self.state, self.waiting = state, data[cut:]
        return data[:cut]

    def end(self) -> bytes:
        """What is left, a character without its end."""
        left, self.state, self.waiting = self.waiting, 0, b""
        return left


class Pieces(dict):
    """Ids of pieces, packed; what is not there yet is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece) or array("I", self.encode(piece.encode())).tobytes()
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary and pattern."""

    def __init__(self, merges: tuple[bytes, bytes, bytes], byte_ids: tuple[int, ...], pattern: str):
        self.transducer = Transducer(merges, dict(enumerate(byte_ids)))
        # White space is what Unicode calls so; the control characters 1c to 1f are none.
        wide = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pieces = regex.compile(wide)
        self.steps: list[dict[int, int]] = [{} for _ in UTF8]
        self.known = Pieces(self.transducer.encode)

    def encode(self, text: str) -> array:
        """Ids of a text, as unsigned 32-bit integers."""
        return array("I", b"".join(map(self.known.__getitem__, self.pieces.findall(text))))

    def decoder(self) -> Decoder:
        return Decoder(self.transducer.symbols, self.steps)

    def decode(self, ids) -> str:
        own = self.decoder()
        return (own.feed(ids) + own.end()).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(merges: tuple[bytes, bytes, bytes], byte_ids: tuple[int, ...], pattern: str) -> Codec:
    return Codec(merges, byte_ids, pattern)


def compiled(ranks_path: str, pattern: str) -> tuple:
    """What tasks need to build a ``codec``; about 1 MB for 50,000 tokens.

    The driver reads the rank file (some MB at most) and finds the merges.
    """
    with open(ranks_path, "rb") as file:
        lines = file.read()
    ranks = read_ranks(lines)
    return compile_merges(lines), tuple(ranks[bytes([b])] for b in range(256)), pattern


def encode(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``documents`` with the ids of each text as an array."""
    parts = compiled(ranks_path, pattern)
    return append_columns(documents, {ids: "array<bigint>"}, lambda batch: [
        pa.array([list(codec(*parts).encode(t or "")) for t in batch.column(text).to_pylist()], pa.list_(pa.int64()))
    ])


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text of each row's ids."""
    parts = compiled(ranks_path, pattern)
    return append_columns(encoded, {text: "string"}, lambda batch: [
        pa.array([codec(*parts).decode(x or []) for x in batch.column(ids).to_pylist()], pa.string())
    ])


def round_trip(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``documents`` with n_tokens, ids_sha256 and decoded_sha256 of each text.

    Encodes, then decodes the ids portion by portion; neither ids nor decoded texts are
    written out. The digests are of the ids as little-endian unsigned 32-bit integers and of
    the decoded bytes.
    """
    parts = compiled(ranks_path, pattern)

    def digest(batch: pa.RecordBatch) -> list[pa.Array]:
        own, counts, of_ids, of_bytes = codec(*parts), [], [], []
        for value in batch.column(text):
            ids = own.encode(value.as_py() or "")
            decoder, decoded = own.decoder(), hashlib.sha256()
            for start in range(0, len(ids), PORTION):
                decoded.update(decoder.feed(ids[start : start + PORTION]))
            decoded.update(decoder.end())
            counts.append(len(ids))
            if sys.byteorder == "big":
                ids.byteswap()
            of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
            of_bytes.append(decoded.hexdigest())
        return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]

    return append_columns(documents, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, digest)
