"""Repeated runs, vector codes and the transducer against plain versions."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import ODD, documents
from pyspark.sql import functions as F

from inkwell.llm import periodic, queries, transducer, vector_codes
from inkwell.sources.tables import table

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# Periodic runs


def plain_runs(words):
    """All runs by start, then period, and the words that stay."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            smaller = (d for d in range(1, q) if all(words[x] == words[x + d] for x in range(i, i + size - d)))
            if size >= max(6, 4 * q) and next(smaller, None) is None:
                found.append((i, size, q))
            i = max(j, i + 1)
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    return sorted(found, key=lambda r: (r[0], r[2])), [w for i, w in enumerate(words) if i not in gone]


def as_tuples(runs):
    return [(r["start"], r["length"], r["period"]) for r in runs]


def test_runs_equal_plain_version_on_random_words():
    r = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(r.randrange(1, 9)):
            words = []
            for _ in range(r.randrange(6)):
                unit = [r.choice("abcdefgh"[: r.randrange(1, 9)]) for _ in range(r.randrange(1, 25))]
                words += (unit * r.randrange(1, 7))[r.randrange(len(unit)) :]
            texts.append(words)
        for words, (own, rest) in zip(texts, periodic.analyse([[w.encode() for w in t] for t in texts])):
            runs, kept = plain_runs(words)
            assert as_tuples(own) == runs
            assert rest.decode().split() == kept


@pytest.mark.parametrize("period", [1, 2, 3, 4, 5, 8, 9, 16, 17, 31, 32, 33, 100])
def test_shortest_runs_of_each_lag_class(period):
    unit = [b"%d" % i for i in range(period)]
    need = max(6, 4 * period)
    for size, count in ((need, 1), (need - 1, 0)):
        words = [b"left", *(unit * 7)[:size], b"right"]
        [(own, _)] = periodic.analyse([words])
        assert as_tuples(own) == [(1, need, period)] * count


def test_long_runs_take_linear_time():
    words = [b"a"] * 100_000 + [b"b", b"c"] * 50_000 + [b"%d" % (i % 20_000) for i in range(100_000)]
    [(own, rest)] = periodic.analyse([words])
    assert as_tuples(own) == [(0, 100_000, 1), (100_000, 100_000, 2), (200_000, 100_000, 20_000)]
    assert len(rest.split()) == 1 + 2 + 20_000


def test_find_bears_odd_texts(spark):
    rows = documents(spark, [*ODD, "a b " * 30, "a b " * 30]).withColumn("runs", F.lit("x"))
    found = periodic.find(rows).collect()
    assert len(found) == len(ODD) + 3
    by_id = {r.doc_id: r for r in found}
    assert as_tuples(by_id[len(ODD)].runs) == as_tuples(by_id[len(ODD) + 1].runs) == [(0, 60, 2)]
    assert by_id[len(ODD)].collapsed == "a b"
    assert (by_id[0].n_words, by_id[0].runs, by_id[0].collapsed) == (0, [], "")
    assert (by_id[2].n_words, by_id[2].collapsed) == (0, "")
    assert as_tuples(by_id[6].runs) == [(0, 60_000, 5)]
    assert by_id[None].runs != [] and by_id[0].lang == "en"
    assert periodic.find(documents(spark, []).where("false")).count() == 0


def test_op11_equals_plain_version(spark):
    source = table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    assert len(found) == len(source)
    planted = 0
    for doc_id, text in source:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        if n > 1500:  # the plain version takes the square of a text
            continue
        runs, kept = plain_runs(words)
        row = found[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None, None, None))
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    assert planted > 5


# Vector codes


def plain_codes(vectors, parts, entries, rounds):
    cut = vectors.reshape(len(vectors), parts, -1).swapaxes(0, 1)
    books = cut[:, :entries].copy()

    def near():
        return np.stack([((cut[p][:, None] - books[p]) ** 2).sum(2).argmin(1) for p in range(parts)])

    for _ in range(rounds):
        codes = near()
        for p in range(parts):
            for e in set(codes[p].tolist()):
                own = cut[p][codes[p] == e]
                books[p, e] = own.sum(0) // len(own)
    codes = near()
    error = sum(((cut[p] - books[p][codes[p]]) ** 2).sum(1) for p in range(parts))
    return codes.T, error, books


RANDOM = np.random.default_rng(4)


@pytest.mark.parametrize(
    "vectors",
    [
        RANDOM.integers(-3, 4, (3000, 8)),  # many ties and equal vectors
        np.concatenate([np.zeros((2000, 8), int), RANDOM.integers(-300, 300, (300, 8)), np.full((900, 8), 7)]),
        RANDOM.integers(-(2**28), 2**28, (400, 8)),
        RANDOM.integers(-9, 9, (1, 8)),
    ],
)
def test_trees_equal_plain_rounds(vectors):
    books = np.ascontiguousarray(vectors[:16].reshape(-1, 2, 4).swapaxes(0, 1))
    blocks = [vector_codes.Forest.grown(vectors[i : i + 1000], 2) for i in range(0, len(vectors), 1000)]
    blocks = [vector_codes.Forest.unpack(b.pack()) for b in blocks]
    for _ in range(3):
        sums, counts = map(sum, zip(*[b.totals(books) for b in blocks]))
        assert counts.sum() == 2 * len(vectors)
        used = counts > 0
        books[used] = sums[used] // counts[used][:, None]
    codes, error = map(np.concatenate, zip(*[b.codes(books) for b in blocks]))
    for mine, plain in zip((codes, error, books), plain_codes(vectors, 2, 16, 3)):
        assert (mine == plain).all()


def test_a_ball_holds_its_points_and_most_balls_are_owned():
    points = RANDOM.integers(-256, 256, (4000, 4))
    forest = vector_codes.Forest.grown(points, 1)
    for node in range(len(forest.part)):
        own = points[forest.order[0, forest.start[node] : forest.end[node]]]
        assert (own.sum(0) == forest.sums[node]).all()
        assert np.sqrt(((own - forest.centre[node]) ** 2).sum(1)).max() <= forest.radius[node] + 1e-6
    books = np.array([[[-200, -200, -200, -200], [200, 200, 200, 200]]])
    single = sum(len(places) for _, _, places, _ in forest.owners(books) if places is not None)
    assert single < len(points) / 2


def test_compress_bears_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vector = [float(i) / 7 for i in range(32)]
    rows = [(i, [x + i * 0.01 for x in vector], "a", 1, "e") for i in range(70)]
    rows += [(3, vector, None, 2, "e"), (3, vector, None, 2, "e"), (None, vector, "b", 3, "e")]
    odd = [None, [], [None] * 32, [nan] * 32, [inf] * 32, vector[:16], [3e30] * 32]
    rows += [(900 + i, v, "c", 4, "e") for i, v in enumerate(odd)]
    schema = "vec_id bigint, embedding array<float>, label string, code int, error string"
    frame = spark.createDataFrame(rows, schema)
    found, books = vector_codes.compress(frame, "vec_id", "embedding")
    kept = [r for r in rows if r[1] is not None and len(r[1]) == 32 and all(x is not None and abs(x) < 1e6 for x in r[1])]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    codes, error, plain = plain_codes(np.floor(np.array([r[1] for r in order], np.float32).astype(float) * 256).astype(int), 16, 64, 2)
    assert (books == plain).all()
    mine = sorted(((r.vec_id is None, r.vec_id or 0, bytes(r.code), r.error) for r in found.collect()))
    assert mine == sorted((r[0] is None, r[0] or 0, bytes(c.astype(np.uint8)), e) for r, c, e in zip(order, codes, error))
    assert found.columns == ["vec_id", "label", "code", "error"]
    again = vector_codes.decompress(vector_codes.Compressed(found, books)).where("vec_id = 5").head()
    assert max(abs(a - b) for a, b in zip(again.vector, rows[5][1])) < 1
    nothing, books = vector_codes.compress(frame.where("false"), "vec_id", "embedding")
    assert nothing.count() == 0 and books.size == 0


def test_compress_is_the_same_in_any_layout(spark):
    rows = table(spark, FOLDER, "embeddings")
    results = []
    for frame in (rows.coalesce(1), rows.repartition(7)):
        found, books = vector_codes.compress(frame, "vec_id", "embedding")
        results.append((sorted((r.vec_id, bytes(r.code), r.error) for r in found.collect()), books.tolist()))
    assert results[0] == results[1]


# Transducer


@pytest.fixture(scope="module")
def own():
    return transducer.codec(*transducer.compiled(RANKS, public_tokenizers.PATTERN))


@pytest.fixture(scope="module")
def library():
    ranks = transducer.read_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_transducer_equals_library_on_random_letters(own, library):
    r = random.Random(1)
    for alphabet in ("ab", "abc ", "aeiou", "thein", "éèa", "0123456789", "etaoinshr", "=-_*", "\U0001f600中文", "\x1c\x85　 \n"):
        for _ in range(60):
            text = "".join(r.choice(alphabet) for _ in range(r.randrange(1, 150)))
            ids = own.encode(text).tolist()
            assert ids == library.encode_ordinary(text), text
            assert own.decode(ids) == text


def test_forgetting_states_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(transducer, "KEPT_STATES", 60)
    monkeypatch.setattr(transducer, "KEPT_PAIRS", 40)
    monkeypatch.setattr(transducer, "KEPT_PIECES", 3)
    small = transducer.Codec(*transducer.compiled(RANKS, public_tokenizers.PATTERN))
    text = "The quick brown foxes jumped unbelievably over antidisestablishmentarianism, 12345678 times. " + "ab" * 500
    assert small.encode(text).tolist() == library.encode_ordinary(text)
    assert small.transducer.held < 200 and len(small.known) <= 3


def test_long_pieces_need_few_states(own, library):
    for text in ("x" * 100_000, "=" * 60_000, " " * 60_000, "ab" * 40_000):
        before = len(own.transducer.states)
        assert own.encode(text).tolist() == library.encode_ordinary(text)
        assert len(own.transducer.states) - before < 1000


def test_tokens_are_written_after_a_bounded_lookahead(own):
    machine, state, read, written = own.transducer, 0, 0, 0
    longest = max(map(len, machine.symbols.values()))
    for byte in b"thequickbrownfoxjumpsoverthelazydog" * 50:
        state, certain = machine.moves.get(state << 8 | byte) or machine._step(state, byte)
        read += 1
        written += sum(len(machine.symbols[i]) for i in certain)
        assert read - written <= 2 * longest
    assert written > 0


def test_decoder_gives_whole_characters_in_any_portions(own):
    text = "aé中\U0001f600" * 20
    ids = own.encode(text).tolist()
    for size in (1, 2, 3, 7):
        decoder, parts = own.decoder(), []
        for i in range(0, len(ids), size):
            parts.append(decoder.feed(ids[i : i + size]).decode())
        assert "".join(parts) + decoder.end().decode() == text
    byte = own.transducer.rank_of
    r = random.Random(2)
    for _ in range(500):
        data = bytes(r.choice([0x41, 0x80, 0xA0, 0xC3, 0xE0, 0xED, 0xF0, 0xF4, 0x9F, 0xFF]) for _ in range(12))
        decoder, parts = own.decoder(), b""
        for b in data:
            parts += decoder.feed([byte[bytes([b])]])
            assert len(decoder.waiting) <= 3
        assert parts + decoder.end() == data
        assert own.decode([byte[bytes([b])] for b in data]) == data.decode("utf-8", "replace")


def test_vocabularies_without_their_own_merges_are_refused():
    lines = "\n".join(f"{base64.b64encode(bytes([b])).decode()} {b}" for b in range(256))
    with pytest.raises(ValueError):
        transducer.compile_merges((lines + "\nYWJj 256").encode())
    with pytest.raises(ValueError):
        transducer.compile_merges(b"YQ== 0")


def test_round_trip_bears_odd_texts(spark, library):
    texts = [*ODD, "same text", "same text", "<|endoftext|> a"]
    rows = documents(spark, texts).withColumn("n_tokens", F.lit("clash"))
    found = {r.doc_id: r for r in transducer.round_trip(rows, RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert found[i].lang == "en"
    coded = transducer.encode(rows, RANKS, public_tokenizers.PATTERN).drop("text")
    back = {r.doc_id: r.text for r in transducer.decode(coded, RANKS, public_tokenizers.PATTERN).collect()}
    assert [back[i] for i in range(len(texts))] == [t or "" for t in texts]


def test_op13_equals_library_on_a_whole_table(spark, library):
    source = {r.doc_id: r.text or "" for r in table(spark, FOLDER, "documents").collect()}
    found = queries.op13_bpe_transducer(spark, FOLDER).collect()
    assert len(found) == len(source)
    for row in found:
        ids = library.encode_ordinary(source[row.doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
