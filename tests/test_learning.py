import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from inkwell.learning import classifiers as C
from inkwell.learning import features as L
from inkwell.plans import jobs
from inkwell.session import scratch_path
from inkwell.sources import tables
from inkwell.sources.files import literal_comments

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, i % 2, ("dragon king falls" if i % 2 else "lovely cover print") + f" word{i % 5}") for i in range(40)]
    return spark.createDataFrame(rows, "doc_id int, class int, review string").cache()


@pytest.fixture(scope="module")
def fitted(documents):
    model = L.fit_tfidf(documents)
    return model, C.logistic().fit(model.transform(documents))


def test_idf_is_the_smoothed_formula(spark):
    rows = spark.createDataFrame([(1, "aa aa bb"), (2, "aa cc"), (3, "")], "doc_id int, review string")
    model = L.fit_tfidf(rows)
    found = L.vector_terms(model, model.transform(rows), ["doc_id"], "idf", "w").collect()
    expected = {(1, "aa"): 2 * math.log(4 / 3), (1, "bb"): math.log(2), (2, "aa"): math.log(4 / 3), (2, "cc"): math.log(2)}
    assert {(r.doc_id, r.token): pytest.approx(r.w) for r in found} == expected


def test_vocabulary_equals_that_of_the_vectorizer(spark, documents, fitted, monkeypatch):
    mine = {r.token for r in L.vocabulary(fitted[0], spark).collect()}
    words = documents.select(F.split("review", " ").alias("w"))
    assert mine == set(CountVectorizer(inputCol="w", outputCol="v").fit(words).vocabulary)
    monkeypatch.setattr(L, "VOCABULARY", 3)
    with pytest.raises(ValueError, match="tokens"):
        L.fit_tfidf(documents)


def test_probabilities_are_finite_and_sum_to_one(documents, fitted):
    model, classifier = fitted
    for r in classifier.transform(model.transform(documents)).select(vector_to_array("probability").alias("p")).collect():
        assert sum(r.p) == pytest.approx(1) and all(0 <= x <= 1 for x in r.p)


def test_saved_models_predict_the_same(spark, documents, fitted):
    model, classifier = fitted
    paths = scratch_path(spark, "pipeline"), scratch_path(spark, "logistic")
    C.save(model, paths[0])
    C.save(classifier, paths[1])
    again = LogisticRegressionModel.load(paths[1]).transform(PipelineModel.load(paths[0]).transform(documents))
    columns = ["doc_id", "prediction", "probability"]
    before = classifier.transform(model.transform(documents)).select(columns).orderBy("doc_id").collect()
    assert again.select(columns).orderBy("doc_id").collect() == before


def test_comments_are_cleaned_as_in_training(spark, fitted):
    comments = literal_comments(spark, ["Dragon KING falls! Lovely, lovely cover. \nprint"])
    paths = scratch_path(spark, "pipeline"), scratch_path(spark, "logistic")
    for scored in (C.score_comments(*fitted, comments), jobs.saved_model_scores(*fitted, paths, comments)):
        found = {(r.line, r.part): (r.review, r.prediction) for r in scored.collect()}
        assert found == {(0, 0): ("dragon king falls lovely lovely cover", found[0, 0][1]), (1, 0): ("print", 0.0)}


def test_classifiers_are_trained_on_train_rows(spark, documents):
    found = {r.model: r.weighted_f1 for r in jobs.compare_tfidf_classifiers(documents).collect()}
    assert found == {"logistic regression": 1.0, "naive bayes": 1.0, "linear svc": 1.0}


def test_word_vectors(spark, documents):
    sentences = documents.select("doc_id", "class", F.col("review").alias("reviews"))
    found = {r.model: r.weighted_f1 for r in jobs.compare_word2vec_classifiers(sentences, "doc_id", min_count=1, partitions=1).collect()}
    assert set(found) == {"random forest", "logistic regression"}
    assert all(0 <= f <= 1 for f in found.values())
    assert jobs.compare_sentence_classifier(sentences, "doc_id").first().weighted_f1 == 1.0


def test_naive_bayes_rejects_word_vectors(spark):
    rows = L.dense_features(spark.createDataFrame([(0, [-1.0]), (1, [1.0])], "class int, x array<double>"), "x")
    with pytest.raises(Exception, match="[Nn]egative|nonnegative"):
        C.naive_bayes("features").fit(rows)


def test_binary_auc(documents, fitted):
    model, classifier = fitted
    assert C.binary_auc(classifier.transform(model.transform(documents))).first().auc == 1.0


def test_topics(spark, documents, fitted):
    vectors = fitted[0].transform(documents).select("idf")
    found = C.topic_terms(C.topic_model(rounds=2).fit(vectors), fitted[0], spark, 4).collect()
    assert {(r.topic, r["rank"]) for r in found} == {(t, k) for t in (0, 1) for k in range(4)}


def test_whole_analyses_run(spark):
    reviews = tables.reviews(spark, FOLDER)
    sizes = {
        name: frame.count()
        for job in (jobs.corpus_profile, jobs.length_curves, jobs.label_ratios, jobs.term_weights)
        for name, frame in job(reviews).items()
    }
    sizes |= {name: frame.count() for name, frame in jobs.key_terms(reviews, "src3", "extra").items()}
    assert all(sizes.values())
    report = jobs.feature_report(reviews)
    assert report["summary"].count() == 4 and report["correlation"].count() == 16
    assert report["confusion"].count() == 4
    assert report["features"].count() == reviews.count()


def test_topics_are_learned_from_every_document(spark, monkeypatch):
    from inkwell.plans import catalog

    folder, seen = "/root/testdata/sf0.001", []
    fit = catalog.L.fit_tfidf
    monkeypatch.setattr(catalog.L, "fit_tfidf", lambda documents: seen.append(documents.count()) or fit(documents))
    assert catalog.lda_topics(spark, folder).count() > 0
    assert seen == [spark.read.parquet(f"{folder}/documents.parquet").count()]
