import hashlib
import math

import duckdb
import numpy as np
import public_tokenizers
from helpers import links
from tokenizers import Tokenizer

import corpus_pipeline
from inkwell.llm import ann, decontam, queries, warc
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_recall_and_scores(spark):
    folder = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet' ORDER BY 1").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in queries.op9_nearest_neighbours(spark, folder).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in ids if i % 100 == 0}
    hits = 0
    for q, got in found.items():
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        best = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        hits += len({ids[i] for i in best} & {v for _, v, _ in got})
        assert [r for r, _, _ in sorted(got)] == list(range(1, 11))
        assert all(math.isclose(s, d[ids == v][0], rel_tol=1e-12) for _, v, s in got)
    assert hits >= 0.9 * 10 * len(found)


def test_vectors_that_take_no_part(spark):
    good = [(i, [float(i % 7), 1.0, 2.0]) for i in range(40)]
    bad = [(100, None), (200, [0.0, 0.0, 0.0]), (300, [None, 1.0, 1.0]), (400, [float("nan"), 1.0, 1.0]),
           (500, [float("inf"), 1.0, 1.0]), (600, [1.0]), (None, [1.0, 1.0, 1.0]), (0, [0.0, 1.0, 2.0])]
    rows = spark.createDataFrame([(*r, 1) for r in good + bad], "vec_id bigint, embedding array<float>, score int")
    found = ann.nearest(rows, ann.F.col("vec_id") % 10 == 0).collect()
    assert {r["query_id"] for r in found} == {0, 10, 20, 30}
    for q in (0, 10, 20, 30):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        want = sorted((abs(i % 7 - q % 7), i) for i, _ in good if i != q)[:10]
        assert [(float(d), i) for d, i in want] == [(s, v) for _, v, s in own]
    few = ann.nearest(rows.where("vec_id in (0, 10, 20)"), ann.F.col("vec_id") == 0).collect()
    assert len(few) == 2
    assert ann.nearest(rows.limit(0), ann.F.col("vec_id") == 0).count() == 0


def ten_nearest(vectors, q):
    d = ((vectors - vectors[q]) ** 2).sum(1)
    d[q] = np.inf
    return set(np.argsort(d, kind="stable")[:10].tolist())


def neighbours(spark, vectors, wanted):
    rows = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, embedding array<double>")
    found = {}
    for r in ann.nearest(rows, wanted).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    return found


def test_recall_in_a_large_group_of_nearly_equal_vectors(spark):
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(size=32) + rng.normal(size=(1500, 32)) * 1e-4, rng.normal(size=(300, 32))])
    found = neighbours(spark, vectors, ann.F.col("vec_id") % 15 == 0)
    hits = [len(found[q] & ten_nearest(vectors, q)) for q in range(0, 1500, 15)]
    assert np.mean(hits) >= 9


def test_far_vectors_and_small_groups_have_neighbours(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    rng = np.random.default_rng(6)
    near = np.concatenate([c + rng.normal(size=(500, 16)) * 0.01 for c in rng.normal(size=(3, 16))])
    far = np.concatenate([rng.normal(size=(12, 16)) * 3, rng.normal(size=16) * 3 + rng.normal(size=(5, 16)) * 0.01])
    vectors = np.concatenate([near, far])
    found = neighbours(spark, vectors, ann.F.col("vec_id") >= 1500)
    assert {q: len(v) for q, v in found.items()} == {q: 10 for q in range(1500, 1517)}
    assert np.mean([len(found[q] & ten_nearest(vectors, q)) for q in found]) >= 9


def test_archive_equals_sql(spark):
    frame = queries.op10_warc(spark, FOLDER)
    assert compare(frame, connect(FOLDER), queries.ORACLE["op10_warc"]) is None


def test_archive_of_odd_pages(spark):
    big = "<p>é" * 400
    rows = [(1, "u", None), (2, "u", ""), (3, None, big), (4, "a\r\nb", big), (7, "u", big), (7, "u", big), (5, "u", "small"),
            (6, "u", "small"), (None, "u", big), (8, "u", "y" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, record_type string")
    index = warc.write(pages)
    read = warc.read(index).collect()
    assert len(read) == len(rows)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        for r in [r for r in read if r["page_id"] == page_id]:
            assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
            revisit = html == big and page_id in (3, 4)
            assert (r["record_type"], r["refers_to"]) == (("revisit", 7) if revisit else ("response", None))
    wanted = spark.createDataFrame([(4,), (8,), (99,)], "page_id bigint")
    assert sorted(r["page_id"] for r in warc.lookup(index, wanted).collect()) == [4, 8]
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, FOLDER), "stage")
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "bpe encoding":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good, single, clean, safe, tokens = kept.values()
    ids = sorted(good)
    classes = links([good[i]["text"] for i in ids])
    assert set(single) == {i for k, i in enumerate(ids) if classes[k][0] == k}
    items = duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    dirty = {i for i, r in single.items() if any(t in r["text"] for (t,) in items)}
    assert set(clean) <= set(single) - dirty
    near = decontam.Items(list(range(len(items))), [t for (t,) in items], decontam.SHARE)
    assert all(not decontam.matches(near, [clean[i]["text"]]) for i in clean)
    assert all(decontam.matches(near, [single[i]["text"]]) for i in set(single) - set(clean))
    assert set(safe) == set(clean) == set(tokens)
    assert all(r["n_chars"] == len(r["text"]) for r in safe.values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert all(tokens[i]["n_tokens"] == len(library.encode(r["text"], add_special_tokens=False).ids) for i, r in safe.items())


def test_pipeline_stages_bear_empty_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
