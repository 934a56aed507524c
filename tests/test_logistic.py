"""Logistic regression on token tables against MLlib's."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from inkwell.learning import classifiers as C
from inkwell.learning import features as L
from inkwell.learning import linear, logistic
from inkwell.operators import terms
from inkwell.plans import jobs
from inkwell.sources.files import literal_comments

WORDS = "dragon king falls cover print lovely page ink ends begins".split()


@pytest.fixture(scope="module")
def documents(spark):
    rows = []
    for i in range(60):
        # Words by a fixed rule, so that classes overlap; one word is in all rows, some rows have no other.
        chosen = [WORDS[(i * k + k * k + i // 7) % 10] for k in range(1, 1 + i % 6)]
        rows.append((i % 57, int((i * 7) % 11 < 5), " ".join(["all", *chosen])))
    return spark.createDataFrame(rows, "doc_id int, class int, review string").cache()


def mllib(documents):
    model = L.fit_tfidf(documents)
    fitted = C.logistic().fit(model.transform(documents).select("class", "idf"))
    p1 = F.element_at(vector_to_array("probability"), 2).alias("p1")
    return fitted, model, fitted.transform(model.transform(documents)).select("review", "prediction", p1).collect()


@pytest.mark.parametrize("block", [20, 1 << 19])
def test_steps_and_predictions_are_those_of_mllib(documents, monkeypatch, block):
    monkeypatch.setattr(linear, "BLOCK", block)
    monkeypatch.setattr(logistic, "CUT", 4)
    fitted, _, wanted = mllib(documents)
    tokenized = terms.with_tokens(documents.withColumn("text", F.col("review")), "text")
    model = logistic.fit(tokenized, "class")
    history = list(fitted.summary.objectiveHistory)
    assert len(history) > 12 and list(model.losses)[: len(history)] == pytest.approx(history, rel=1e-5)
    assert len(model.losses) == len(history)
    found = logistic.predictions(model, tokenized).collect()
    assert len(found) == len(wanted)
    by_text = {r.review: r for r in wanted}
    for r in found:
        assert r.p1 == pytest.approx(by_text[r.review].p1, abs=1e-4) and r.prediction == by_text[r.review].prediction


def test_one_class_and_other_labels(spark):
    rows = spark.createDataFrame([(1, ["a"]), (1, ["b"])], "class int, tokens array<string>")
    assert {r.p1 for r in logistic.predictions(logistic.fit(rows, "class"), rows).collect()} == {1.0}
    with pytest.raises(ValueError, match="labels"):
        logistic.fit(rows.withColumn("class", F.lit(2)), "class")


def test_queries_beyond_the_driver_give_what_mllib_gives(spark, documents, monkeypatch):
    comments = literal_comments(spark, ["Dragon KING falls! Lovely, lovely cover. \nprint", "", "unknown"])
    fitted, features, _ = mllib(documents)
    wanted = C.score_comments(features, fitted, comments)
    model = logistic.fit(terms.with_tokens(documents), "class")
    found = logistic.score_comments(model, comments)
    assert found.columns == wanted.columns and sorted(found.collect()) == sorted(wanted.collect())
    sentences = documents.select("doc_id", "class", F.col("review").alias("reviews"))
    before = jobs.compare_sentence_classifier(sentences, "doc_id").first()
    monkeypatch.setattr(logistic, "DRIVER_TERMS", 0)
    monkeypatch.setattr(L, "fit_sentence_tfidf", None)
    after = jobs.compare_sentence_classifier(sentences, "doc_id").first()
    assert (after.model, after.n) == (before.model, before.n) and math.isclose(after.weighted_f1, before.weighted_f1)


@pytest.mark.parametrize("name", ["lr_predictions", "score_comments"])
def test_registered_queries_need_no_vocabulary_on_the_driver(spark, monkeypatch, name):
    from inkwell.plans import catalog

    wanted = catalog.QUERIES[name](spark, "/root/testdata/sf0.001").drop("p1").collect()
    monkeypatch.setattr(logistic, "DRIVER_TERMS", 0)
    monkeypatch.setattr(catalog.L, "fit_tfidf", None)
    found = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sorted(found.drop("p1").collect()) == sorted(wanted)


def test_marked_rows_are_grouped_alike(spark):
    context = spark.sparkContext
    one = context.parallelize([(i, f"a{i}") for i in range(9)], 3).partitionBy(4)
    two = context.parallelize([(i % 9, i) for i in range(18)], 2)
    plain = {k: [a, sorted(b)] for k, (a, b) in logistic._together(4, one, two).collect()}
    kept = logistic._first(one).persist(logistic.LEVEL)
    marked = logistic._together(4, kept, two, marked=True)
    assert {k: [a, sorted(b)] for k, (a, b) in marked.collect()} == plain == {i: [[f"a{i}"], [i, i + 9]] for i in range(9)}
    kept.unpersist()
