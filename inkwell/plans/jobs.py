"""What a user runs: whole analyses put together from the operators.

Each takes reviews (schema ``REVIEW``) or documents derived from them and returns
DataFrames by name. Tables that are read several times are written, and models fitted, when a
job is put together; the rest is computed when it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import letters_only
from inkwell.learning import classifiers as C
from inkwell.learning import features as L
from inkwell.learning import forest, linear, logistic
from inkwell.operators import evaluate, order, profile, reshape, sample, terms
from inkwell.operators.joins import enrich
from inkwell.session import keep, scratch, scratch_path

CLASSES = ("0", "1")
LENGTH_POINTS = 1001
RATIO_POINTS = 101


def documents_of(reviews: DataFrame) -> DataFrame:
    """One cleaned document per review and class, with a key of its own."""
    return L.with_clean_review(reshape.assemble_nested(reviews)).withColumn(
        "doc_id", F.concat_ws("/", "review_id", "class")
    )


def corpus_profile(reviews: DataFrame) -> dict[str, DataFrame]:
    """Documents per class and the average lengths."""
    documents = profile.with_length(documents_of(reviews))
    return {
        "class_counts": profile.class_counts(documents),
        "length_per_review": profile.mean_total_length(documents, "review_id", "has_spoiler"),
        "length_per_document": profile.mean_length(documents, "class"),
    }


def length_curves(reviews: DataFrame) -> dict[str, DataFrame]:
    """Scaled lengths per class before and after stop words: sampled and sorted."""
    documents = documents_of(reviews)
    before = documents.withColumn("length", F.char_length("review"))
    after = terms.with_tokens(documents).withColumn("length", F.size("tokens"))
    curves = {}
    for name, rows in (("before", before), ("after", after)):
        scaled = profile.scale_by_class(rows.select("doc_id", "class", "length"), "length", "class")
        drawn = sample.systematic_sample(scaled, "doc_id", "scaled", "class", CLASSES, LENGTH_POINTS)
        curves[f"{name}_sample"] = drawn
        curves[f"{name}_sorted"] = sample.sorted_curve(drawn, "scaled", "class", LENGTH_POINTS)
    return curves


def term_weights(reviews: DataFrame) -> dict[str, DataFrame]:
    """tf-idf of every token and the largest value per class."""
    tokenized = terms.with_tokens(
        documents_of(reviews).select("doc_id", "class", "book_id", "review")
    )
    weights = terms.tf_idf(tokenized)
    return {"weights": weights, "specificity": terms.item_specificity(weights)}


def key_terms(reviews: DataFrame, book_id: str, boost: str, times: int = 5) -> dict[str, DataFrame]:
    """The 100 heaviest terms of a book, and their word-cloud weights with one term boosted."""
    tokenized = terms.with_tokens(documents_of(reviews).select("doc_id", "book_id", "review"))
    idf = terms.inverse_document_frequencies(tokenized)
    of_book = terms.terms_of(tokenized, idf, F.col("book_id") == F.lit(book_id))
    top = of_book.orderBy(F.desc("tf_idf"), "token", "doc_id").limit(100)
    return {"top_terms": top, "cloud": terms.boosted_counts(top, boost, times)}


def label_ratios(reviews: DataFrame) -> dict[str, DataFrame]:
    """Share of flagged reviews per user and per book, with their sorted curves."""
    user = profile.flag_ratio(reviews, "user_id", "has_spoiler")
    book = profile.flag_ratio(reviews, "book_id", "has_spoiler")
    named = user.select(F.lit("user").alias("series"), F.col("user_id").alias("key"), "ratio").unionByName(
        book.select(F.lit("book").alias("series"), F.col("book_id").alias("key"), "ratio")
    )
    series = ("user", "book")
    scaled = profile.scale_by_class(named, "ratio", "series")
    drawn = sample.systematic_sample(scaled, "key", "scaled", "series", series, RATIO_POINTS)
    return {
        "user_ratio": user,
        "book_ratio": book,
        "curve": sample.sorted_curve(drawn, "scaled", "series", RATIO_POINTS),
    }


def ratio_features(
    rows: DataFrame, history: DataFrame, keys: Sequence[str], flag: str
) -> DataFrame:
    """Rows with the flag ratio of each key, learned from ``history``.

    Pass the train rows as ``history`` to keep the labels of test rows out. A key that is
    null, or that the history does not have, has a null ratio.
    """
    for key in keys:
        stats = profile.flag_ratio(history, key, flag).select(key, F.col("ratio").alias(f"{key}_ratio"))
        rows = enrich(rows, keep(stats.where(F.col(key).isNotNull()), "ratios"), key, "left")
    return rows


def compare_tfidf_classifiers(documents: DataFrame, key: str = "doc_id", label: str = "class") -> DataFrame:
    """Weighted F1 of three classifiers on tf-idf vectors of cleaned documents."""
    train, test = sample.split(documents, key)
    model = L.fit_tfidf(train)
    return C.compare(
        {
            "logistic regression": C.logistic(label=label),
            "naive bayes": C.naive_bayes(label=label),
            "linear svc": C.linear_svc(label=label),
        },
        model.transform(train).select(label, "idf"),
        model.transform(test).select(label, "idf"),
        label,
    )


def compare_word2vec_classifiers(
    sentences: DataFrame, key: str, label: str = "class", min_count: int = 10, partitions: int = 10
) -> DataFrame:
    """Weighted F1 of two classifiers on word vectors of cleaned sentences."""
    train, test = sample.split(L.with_clean_sentence(sentences), key)
    model = L.fit_word2vec(train, min_count=min_count, partitions=partitions)
    return C.compare(
        {
            "random forest": C.random_forest(label=label),
            "logistic regression": C.logistic("features", label),
        },
        model.transform(train).select(label, "features"),
        model.transform(test).select(label, "features"),
        label,
    )


def compare_sentence_classifier(sentences: DataFrame, key: str, label: str = "class") -> DataFrame:
    """Weighted F1 of logistic regression on tf-idf vectors of cleaned sentences."""
    cleaned = L.with_clean_sentence(sentences)
    train, test = sample.split(cleaned, key)
    tokenized = cleaned.select(key, label, F.split(F.lower("clean_review"), r"\s").alias("tokens"))
    words, others = sample.split(keep(tokenized, "tokens"), key)
    if logistic.beyond_driver(words):
        found = keep(logistic.predictions(logistic.fit(words, label), others).select(label, "prediction"), "predicted")
        return evaluate.weighted_f1(found, label).select(F.lit("logistic regression").alias("model"), "weighted_f1", "n")
    model = L.fit_sentence_tfidf(train)
    return C.compare(
        {"logistic regression": C.logistic(label=label)},
        model.transform(train).select(label, "idf"),
        model.transform(test).select(label, "idf"),
        label,
    )


def saved_model_scores(
    model: PipelineModel, classifier: Transformer, paths: tuple[str, str], comments: DataFrame
) -> DataFrame:
    """Save both models, load them again and score comments with the loaded ones."""
    C.save(model, paths[0])
    C.save(classifier, paths[1])
    return C.score_comments(
        PipelineModel.load(paths[0]), type(classifier).load(paths[1]), comments
    )


def load_tables(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The saved idf, weights of the logistic model, and nodes of the forest."""
    return [spark.read.parquet(path) for path in paths]


def table_roundtrip(tokenized: DataFrame, key: str = "doc_id", label: str = "class") -> DataFrame:
    """Whether saved and reloaded idf, logistic model and forest predict the same, for any vocabulary: all three are tables.

    Rows that share a key are compared with each other, too. A kept table.
    """
    spark = tokenized.sparkSession
    with scratch(spark):
        rows = tokenized.select(key, label, "tokens").withColumn("_n", F.monotonically_increasing_id())
        rows = keep(rows, "rows")
        idf = linear.smoothed_idf(rows)
        blocks = forest.features(rows, idf)
        # Weights as for tf-idf vectors; a token that is in all rows has idf 0 and no weight.
        weights = logistic.fit(rows, label).weights.join(idf, "token", "left")
        weight = F.when(F.col("idf") == 0, 0.0).otherwise(F.col("weight") / F.coalesce("idf", F.lit(1.0)))
        models = [idf, keep(weights.select("token", weight.alias("weight")), "weights"), forest.fit(blocks, label)]
        paths = [scratch_path(spark, name) for name in ("pipeline", "logistic", "forest")]
        for model, path in zip(models, paths):
            model.write.parquet(path)

        def predicted(idf: DataFrame, weights: DataFrame, trees: DataFrame, blocks: DataFrame, name: str) -> DataFrame:
            # Back to weights of single occurrences.
            each = weights.join(idf, "token", "left").select("token", (F.col("weight") * F.coalesce("idf", F.lit(1.0))).alias("weight"))
            by_line = logistic.predictions(linear.LinearModel(keep(each, "each"), ()), rows.select("_n", "tokens"))
            by_trees = forest.predictions(trees, blocks).select("_n", key, F.col("prediction").alias(f"{name}1"))
            return by_trees.join(by_line.select("_n", F.col("prediction").alias(f"{name}0")), "_n").drop("_n")

        loaded = load_tables(spark, paths)
        both = predicted(*models, blocks, "kept").join(predicted(*loaded, forest.features(rows, loaded[0]), "again"), key)
        same = [(F.col(f"kept{i}") == F.col(f"again{i}")).alias(f"same_{name}") for i, name in enumerate(("logistic", "forest"))]
        return keep(both.select(key, *same), "same", lasting=True)


def feature_table(reviews: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Encoded flag, ratio features, scaled rating and letters-only text of each review."""
    sentences = F.array_join(F.transform("review_sentences", lambda s: F.array_join(s, " ")), " ")
    rows = ratio_features(reviews, reviews if history is None else history, ("book_id", "user_id"), "has_spoiler")
    encoded = order.encode_labels(rows.withColumn("flag", F.col("has_spoiler")), "flag").drop("flag")
    return profile.scale(encoded, "rating").select(
        "review_id",
        F.col("code").alias("has_spoiler"),
        "book_id_ratio",
        "user_id_ratio",
        F.col("scaled").alias("rating"),
        letters_only(sentences).alias("processed_review"),
    )


def feature_report(reviews: DataFrame) -> dict[str, DataFrame]:
    """The feature table, its summary and correlations, and a naive Bayes report on its words.

    Ratios are learned from the train rows alone.
    """
    features = keep(feature_table(reviews, sample.split(reviews, "review_id", 0.7)[0]), "features")
    numbers = ("has_spoiler", "book_id_ratio", "user_id_ratio", "rating")
    train, test = sample.split(features, "review_id", 0.7)
    words = L.fit_tfidf(train, "processed_review")
    model = C.naive_bayes("vectors", "has_spoiler").fit(words.transform(train))
    predictions = model.transform(words.transform(test)).select("has_spoiler", "prediction")
    return {
        "features": features,
        "summary": profile.describe(features, numbers),
        "correlation": profile.correlation_matrix(features, numbers),
        "confusion": evaluate.confusion_matrix(predictions, (0, 1), "has_spoiler"),
        "report": evaluate.class_report(predictions, "has_spoiler"),
    }
