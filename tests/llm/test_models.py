import zlib

import duckdb
import numpy as np
import pytest
from helpers import ODD, documents

from inkwell.llm import langid, quality, queries, subwords, toxicity

FOLDER = "/root/testdata/sf0.01"


def fold(key, folds):
    return zlib.crc32(str(key).encode()) % folds


@pytest.mark.parametrize("query, label, folds, held, least", [
    ("op6_quality", "quality", 4, 2, 0.9), ("op3_toxicity", "toxic", 5, 0, 0.85),
])
def test_held_out_accuracy(spark, query, label, folds, held, least):
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{FOLDER}/labels.parquet'").fetchall())
    rows = queries.QUERIES[query](spark, FOLDER).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (fold(r["doc_id"], folds) == held) and 0 <= r["score"] <= 1 for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in test]) >= least
    # No constant score passes these.
    one, zero = ([r["score"] for r in test if labels[r["doc_id"]] == c] for c in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in one for b in zero]) >= 0.9
    assert any(r["predicted"] == labels[r["doc_id"]] == 1 for r in test)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, module):
    rows = documents(spark, ODD)
    nothing = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = module.fit(rows, nothing)
    scored = module.score(rows, model).collect()
    assert len(scored) == len(ODD) + 1 and all(abs(r["score"] - 0.5) < 1e-9 for r in scored)
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 0, 0), (3, 1, 1), (3, 7, 7)], "doc_id bigint, quality int, toxic int")
    assert module.score(rows, module.fit(rows, odd)).count() == len(ODD) + 1
    assert module.score(rows.limit(0), model).count() == 0


def test_sample_is_bounded(spark):
    rows = documents(spark, [f"text {i}" for i in range(300)])
    labels = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    assert 0 < subwords.labelled_sample(rows, labels, "doc_id", "quality", 40, 300).count() <= 40


def test_scores_are_means_of_bucket_weights():
    rng = np.random.default_rng(0)
    model = subwords.Model(rng.normal(size=1 << subwords.BITS).astype(np.float32), 0.25)
    texts = ["Some words, some MORE words", "", "x", "Ünïcode wörds"]
    for features in (quality.features, toxicity.features):
        found, ends = features(texts)
        for i, score in enumerate(model.score(features, texts)):
            own = found[ends[i - 1] if i else 0 : ends[i]]
            logit = 0.25 + (model.weights[own].astype(float).mean() if len(own) else 0)
            assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-6
            alone, _ = features([texts[i]])
            assert sorted(alone) == sorted(own)


def test_language(spark):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet'").fetchall())
    rows = [r for r in queries.op2_language_id(spark, FOLDER).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) >= 0.97


def test_language_of_odd_rows(spark):
    rows = documents(spark, ODD + ["12 34 .", "the cat and the dog"])
    learned = langid.learn(spark.createDataFrame(
        [("en", "the cat sat on the mat and the dog"), ("xx", "zzz qqq zzz"), (None, "a"), ("en", None)], "lang string, text string"))
    assert set(learned) == {"en", "xx"}
    found = {r["doc_id"]: r for r in langid.predict(rows, learned).collect()}
    assert len(found) == len(ODD) + 3
    assert [found[i]["lang_pred"] for i in (0, 1, 2, len(ODD))] == ["und"] * 4
    assert found[len(ODD) + 1]["lang_pred"] == "en"
    assert langid.learn(rows.limit(0)) == {}
    assert {r["lang_pred"] for r in langid.predict(rows, {}).collect()} == {"und"}


def test_distances_by_definition():
    profile, known = ["e", "n", "th"], {"e": 0, "th": 1}
    names = sorted({*profile, *known, "q"})
    code = {g: i for i, g in enumerate(names)}
    grams = np.array([code[g] for g in ["e"] * 3 + ["q"] * 2 + ["th"]])
    all_known = np.array(sorted(code[g] for g in known))
    ranks = np.array([[known[names[c]]] for c in all_known])
    apart, most = langid.distances(grams, all_known, ranks, 400)
    # e at 0 (0 apart), q at 1 (unknown: 400), th at 2 (1 apart).
    assert apart.tolist() == [401] and most == 1200


def test_a_language_of_few_texts_in_many_copies_is_learned(spark):
    for text in ("zebra quagga okapi", "tapir lemur gibbon"):
        rows = spark.range(100_000).selectExpr("'xx' AS lang", f"'{text}' AS text")
        learned = langid.learn(rows.unionByName(spark.range(5).selectExpr("'yy' AS lang", "'one two three' AS text")))
        assert set(learned) == {"xx", "yy"}


def test_every_row_has_a_fold(spark):
    rows = spark.createDataFrame([(None,), (0,), (7,), (-3,), (123456789,)], "doc_id bigint")
    for folds in (4, 5):
        for r in rows.select("doc_id", queries.fold("doc_id", folds).alias("fold")).collect():
            assert r.fold == zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % folds


def test_what_reaches_the_driver_is_bounded_in_rows_and_bytes(spark, monkeypatch):
    taken = []
    train = subwords.train
    monkeypatch.setattr(subwords, "train", lambda bags, labels, **k: taken.append(list(bags.bags)) or train(bags, labels, **k))
    # A third of the rows share one key, half of these one text.
    rows = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 7, id) AS doc_id", "if(id % 6 = 0, 'a hot text', concat('text number ', id)) AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    one = subwords.fit(rows, labels, "doc_id", "quality", quality.features, 50)
    again = subwords.fit(rows.repartition(5), labels.repartition(3), "doc_id", "quality", quality.features, 50)
    assert 0 < len(taken[0]) <= 50 and taken[0] == taken[1] and np.array_equal(one.weights, again.weights)
    subwords.fit(rows, labels, "doc_id", "quality", quality.features, 50, held=1000)
    assert 0 < len(taken[2]) < len(taken[0]) and sum(map(len, taken[2])) <= 1000
