import hashlib
import struct

import public_tokenizers
import pytest
from helpers import ODD, documents
from tokenizers import Tokenizer

from inkwell.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ODD + [
    "it's I'LL 'd  x", "  \n\n a<|endoftext|>b <|endoftext|>", "\x1c\x1d a\x85b　​ c", "a" * 5000,
    "\n" * 100 + "x", "日本語 テキスト १२३ ½ Ⅷ", "don't  stop\tnow\r\n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_round_trip_equals_library(spark, library):
    rows = {r["doc_id"]: r for r in bpe.round_trip(documents(spark, TEXTS), PATH).collect()}
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.round_trip(documents(spark, []).limit(0), PATH).count() == 0


def test_encode_then_decode(spark):
    rows = documents(spark, TEXTS)
    back = bpe.decode(bpe.encode(rows, PATH), PATH, text="again").collect()
    assert all(r["again"] == (r["text"] or "") for r in back) and len(back) == len(TEXTS) + 1


def test_every_character_is_split_like_the_library(library):
    own = bpe.Codec(open(PATH, encoding="utf-8").read())
    for start in [*range(0x20, 0x3100, 7), *range(0x3100, 0x110000, 1013)]:
        if 0xD800 <= start < 0xE000:
            continue
        text = f"a{chr(start)}b {chr(start)}{chr(start)}  {chr(start)} 1{chr(start)}"
        assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids, hex(start)


def test_queue_equals_scan_for_the_lowest_rank():
    own = bpe.Codec(open(PATH, encoding="utf-8").read())

    def slow(piece):
        ids = [own.bytes[b] for b in piece]
        while True:
            ranked = [(own.ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in own.ranks]
            if not ranked:
                return ids
            rank, i = min(ranked)
            ids[i : i + 2] = [own.made[rank]]

    for piece in (b"tionlyerthand", b" unbelievable", b"aaaaaaaaaaaaaaaaa", "èévieauxque".encode(), b"", b"z"):
        assert own.merge(piece) == slow(piece)


def test_cache_is_bounded_in_bytes(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_BYTES", 20_000)
    own = bpe.Codec(open(PATH, encoding="utf-8").read())
    for i in range(300):
        text = f"word{i} " + chr(97 + i % 26) * (50 + i) + f" {i * 7919}"
        assert list(own.encode(text)) == library.encode(text, add_special_tokens=False).ids
        held = [*own.cache, *own.older]
        assert all(len(p) <= bpe.CACHED_LETTERS for p in held)
        assert sum(map(len, held)) < 2 * bpe.CACHED_BYTES and len(held) < 600
