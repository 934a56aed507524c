"""The registered queries: each operator on the driver's tables, whole and unfiltered."""

from __future__ import annotations

from string import ascii_lowercase

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.numbers import rounded
from inkwell.functions.text import clean_punct, clean_text, letters_only
from inkwell.learning import classifiers as C
from inkwell.learning import features as L
from inkwell.learning import cooccurrence, factors, gaussian, kernel, linear, logistic, topics
from inkwell.operators import evaluate, joins, order, profile, reshape, sample, terms
from inkwell.plans import jobs
from inkwell.schema import STOP_WORDS
from inkwell.session import keep, scratch_path
from inkwell.sources import files, tables

BOOK = "src3"
# The term added to the word cloud, and how often.
BOOST, BOOST_TIMES = "dany", 5
BINARY = (0, 1)
LENGTH_POINTS = jobs.LENGTH_POINTS
RATIO_POINTS = jobs.RATIO_POINTS
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# Letters that are a stop word by themselves drop out of the letter counts.
LETTERS = "".join(c for c in ascii_lowercase if c not in STOP_WORDS)
# The rule behind the metric queries: long documents are predicted to be class 1.
LONG_DOCUMENT = 1500
# Penalty on the squared weights of linear models; without it rare tokens learn single documents.
PENALTY = 0.0001
# Factors of words and of documents.
VECTOR, TOPICS = 10, 5
KERNEL_GAMMA = 1.0
# Up to so many tokens MLlib learns topics, whose matrix is on the driver; beyond, they are a table.
DRIVER_TERMS = 1 << 18
# The folds and the smoothings that cross-validation compares.
FOLDS, SMOOTHINGS = 4, (0.1, 0.5, 1.0)


def _six(name: str):
    return F.round(name, 6).alias(name)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return tables.labelled_documents(spark, sf)


def _all_documents(spark: SparkSession, sf: str) -> DataFrame:
    return tables.all_documents(spark, sf)


def _tokenized(spark: SparkSession, sf: str) -> DataFrame:
    return terms.with_tokens(_all_documents(spark, sf).select("doc_id", "class", "source", "review"))


def _clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    return L.with_clean_review(_documents(spark, sf).select("doc_id", "class", "review"))


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    return _documents(spark, sf).select(
        "doc_id", "class", "n_chars", (F.col("n_chars") > LONG_DOCUMENT).cast("int").alias("prediction")
    )


def _all_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return tables.reviews(spark, sf, "left")


def _nested_documents(reviews: DataFrame) -> DataFrame:
    return profile.with_length(L.with_clean_review(reshape.assemble_nested(reviews)))


# Sources and sinks


def json_roundtrip(spark, sf):
    path = scratch_path(spark, "reviews")
    files.write_reviews(_all_reviews(spark, sf), path)
    return reshape.explode_sentences(files.read_reviews(spark, path)).select(
        "review_id", "user_id", "book_id", "rating", "has_spoiler", "pos", "class", "reviews"
    )


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "documents")
    clean = L.with_clean_review(_all_documents(spark, sf).select("doc_id", "class", "review"))
    files.write_documents_csv(clean, path)
    return files.read_documents_csv(spark, path)


def json_quarantine(spark, sf):
    """Lines by the reason they are kept aside, good ones under an empty reason.

    All reviews are written as JSON lines. Of those outside the hashed sample, labelled ones get a
    text as their rating, and the others lose the end of their line.
    """
    path = scratch_path(spark, "lines")
    reviews = _all_reviews(spark, sf)
    line = F.to_json(F.struct(*files.REVIEW.fieldNames()))
    worded = F.to_json(F.struct(*[F.lit("five").alias(n) if n == "rating" else n for n in files.REVIEW.fieldNames()]))
    damaged = F.when(F.col("rating").isNotNull(), worded).otherwise(F.left(line, F.char_length(line) - 1))
    whole = sample.in_sample("review_id", 0.8, 80)
    reviews.select(F.when(whole, line).otherwise(damaged).alias("value")).write.text(path)
    good, bad = files.read_reviews_apart(spark, path)
    counted = good.select(F.lit("").alias("reason"), F.col("review_id").cast("bigint").alias("key"))
    return counted.unionByName(bad.select("reason", F.lit(None).cast("bigint").alias("key"))).groupBy("reason").agg(
        F.count("*").alias("n"), F.sum("key").alias("keys")
    )


def item_lookup(spark, sf):
    """All term weights of one source, read from a table laid out by source."""
    path = scratch_path(spark, "by-item")
    weights = terms.tf_idf(_tokenized(spark, sf)).select("source", "doc_id", "token", _six("tf_idf"))
    files.write_by_item(weights, path, "source", "doc_id")
    return files.read_item(spark, path, "source", BOOK)


def bounded_scan(spark, sf):
    return sample.first_rows(
        tables.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"),
        "event_id",
        5000,
    )


def hash_pick(spark, sf):
    return sample.pick_one(tables.table(spark, sf, "documents").select("doc_id", "source", "n_chars"), "doc_id", 7)


# Reshaping


def explode_sentences(spark, sf):
    return reshape.explode_sentences(_all_reviews(spark, sf)).select(
        "review_id", "book_id", "user_id", "has_spoiler", "rating", "pos", "class", "reviews"
    )


def assemble_reviews(spark, sf):
    return reshape.assemble_reviews(tables.conversation_sentences(spark, sf))


def assemble_nested(spark, sf):
    return reshape.assemble_nested(_all_reviews(spark, sf)).select(
        "review_id", "class", "review", "book_id", "user_id", "rating", "has_spoiler"
    )


def review_left_join(spark, sf):
    reviews = _all_reviews(spark, sf)
    documents = reshape.assemble_reviews(reshape.explode_sentences(reviews))
    return joins.attach_reviews(documents, reviews.select("review_id", "book_id", "rating", "has_spoiler"))


def split_sentences(spark, sf):
    return reshape.split_comments(tables.text_table(spark, sf, "conversations").select("conv_id", "turn", "text"))


# Profile


def class_counts(spark, sf):
    return profile.class_counts(_nested_documents(_all_reviews(spark, sf)).select("class"))


def avg_length_by_class(spark, sf):
    return profile.mean_length(_nested_documents(_all_reviews(spark, sf)), "class").select("class", _six("avg_length"))


def avg_total_length(spark, sf):
    return profile.mean_total_length(_nested_documents(tables.reviews(spark, sf)), "review_id", "has_spoiler").select(
        "has_spoiler", _six("avg_length")
    )


def stopped_length(spark, sf):
    return _tokenized(spark, sf).select("doc_id", "class", F.size("tokens").alias("length"))


def null_audit(spark, sf):
    documents = tables.table(spark, sf, "documents")
    return profile.null_counts(
        documents.join(tables.table(spark, sf, "labels"), "doc_id", "left")
    )


def user_ratio(spark, sf):
    return profile.flag_ratio(tables.user_flags(spark, sf), "user_id", "flag").select(
        "user_id", "flagged", "total", _six("ratio")
    )


def book_ratio(spark, sf):
    return profile.flag_ratio(tables.book_flags(spark, sf), "book_id", "flag").select(
        "book_id", "flagged", "total", _six("ratio")
    )


def ratio_features(spark, sf):
    reviews = tables.reviews(spark, sf).drop("review_sentences", "timestamp")
    return jobs.ratio_features(reviews, reviews, ("book_id", "user_id"), "has_spoiler").select(
        "review_id", _six("book_id_ratio"), _six("user_id_ratio")
    )


def minmax_length(spark, sf):
    lengths = _clean_documents(spark, sf).select("doc_id", "class", F.char_length("review").alias("length"))
    return profile.scale_by_class(lengths, "length", "class").select(
        "doc_id", "class", "length", _six("scaled")
    )


def minmax_rating(spark, sf):
    return profile.scale(tables.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal").select(
        "c_custkey", _six("scaled")
    )


def describe_numeric(spark, sf):
    found = profile.describe(tables.table(spark, sf, "lineitem").select(*FEATURES), FEATURES)
    return found.select("column", "count", *[_six(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def correlation_matrix(spark, sf):
    found = profile.correlation_matrix(tables.table(spark, sf, "lineitem").select(*FEATURES), FEATURES)
    return found.select("x", "y", _six("r"))


def label_encode(spark, sf):
    return order.encode_labels(
        tables.table(spark, sf, "events").select("event_id", "event_type"), "event_type"
    )


# Curves


def _scaled_lengths(spark, sf):
    lengths = _documents(spark, sf).select("doc_id", "class", F.char_length("review").alias("length"))
    return profile.scale_by_class(lengths, "length", "class").select(
        "doc_id", "class", F.round("scaled", 6).alias("scaled")
    )


def systematic_sample(spark, sf):
    return sample.systematic_sample(
        _scaled_lengths(spark, sf), "doc_id", "scaled", "class", BINARY, RATIO_POINTS
    )


def sorted_curve(spark, sf):
    drawn = sample.systematic_sample(
        _scaled_lengths(spark, sf), "doc_id", "scaled", "class", BINARY, LENGTH_POINTS
    )
    return sample.sorted_curve(drawn, "scaled", "class", LENGTH_POINTS).select("class", "j", _six("x"), "y")


def ratio_curve(spark, sf):
    """User and book ratios, scaled, sampled and sorted."""
    user = profile.flag_ratio(tables.user_flags(spark, sf), "user_id", "flag")
    book = profile.flag_ratio(tables.book_flags(spark, sf), "book_id", "flag")
    of_user = user.select(F.lit("user").alias("series"), F.col("user_id").cast("string").alias("key"), "ratio")
    of_book = book.select(F.lit("book").alias("series"), F.col("book_id").alias("key"), "ratio")
    named = of_user.unionByName(of_book)
    series = ("user", "book")
    scaled = profile.scale_by_class(named, "ratio", "series")
    drawn = sample.systematic_sample(scaled, "key", "scaled", "series", series, RATIO_POINTS)
    return sample.sorted_curve(drawn, "scaled", "series", RATIO_POINTS).select(
        "series", "j", _six("x"), _six("y")
    )


def quantile_curve(spark, sf):
    lengths = _documents(spark, sf).select("class", F.char_length("review").alias("length"))
    return order.quantile_grid(lengths, "length", LENGTH_POINTS - 1, ["class"]).select(
        "class", "j", _six("p"), _six("quantile")
    )


# Terms


def token_counts(spark, sf):
    return terms.token_counts(_tokenized(spark, sf))


def tf(spark, sf):
    return terms.term_frequencies(_tokenized(spark, sf)).select("doc_id", "class", "source", "token", _six("tf"))


def sentence_tf(spark, sf):
    """Term frequencies of conversation documents, from their sentences."""
    sentences = tables.conversation_sentences(spark, sf).select(
        F.concat_ws("/", "review_id", "class").alias("doc_id"), F.col("reviews").alias("review")
    )
    return terms.term_frequencies_over_rows(terms.with_tokens(sentences), "doc_id").select(
        "doc_id", "token", _six("tf")
    )


def idf(spark, sf):
    return terms.inverse_document_frequencies(_tokenized(spark, sf)).select("token", "df", _six("idf"))


def tfidf(spark, sf):
    return terms.tf_idf(_tokenized(spark, sf)).select(
        "doc_id", "class", "source", "token", *[rounded(F.col(c)).alias(c) for c in ("tf", "idf", "tf_idf")]
    )


def tfidf_join(spark, sf):
    return terms.tf_idf_by_pair(_tokenized(spark, sf), "doc_id").select(
        "doc_id", "class", "source", "token", *[rounded(F.col(c)).alias(c) for c in ("tf", "idf", "tf_idf")]
    )


def item_specificity(spark, sf):
    return terms.item_specificity(terms.tf_idf(_tokenized(spark, sf))).select(
        "class", _six("specificity"), "token"
    )


def _book_terms(spark, sf):
    tokenized = _tokenized(spark, sf)
    return terms.terms_of(
        tokenized, terms.inverse_document_frequencies(tokenized), F.col("source") == F.lit(BOOK)
    ).select("doc_id", "token", _six("tf_idf"))


def top_terms_for_source(spark, sf):
    return _book_terms(spark, sf).orderBy(F.desc("tf_idf"), "token", "doc_id").limit(100)


def bottom_terms(spark, sf):
    return _book_terms(spark, sf).orderBy("tf_idf", "token", "doc_id").limit(100)


def top_terms_per_source(spark, sf):
    tokenized = _tokenized(spark, sf).select("source", "doc_id", "tokens")
    return terms.top_weights(tokenized, "source", ["doc_id"], 100).select("source", "doc_id", "token", "tf_idf", "rank")


def boosted_term_counts(spark, sf):
    return terms.boosted_counts(top_terms_for_source(spark, sf), BOOST, BOOST_TIMES).select(
        "token", "n", _six("weight")
    )


# Text


def clean_punct_texts(spark, sf):
    return tables.text_table(spark, sf, "documents").select("doc_id", clean_punct(F.col("text")).alias("review"))


def clean_text_sentences(spark, sf):
    sentences = tables.conversation_sentences(spark, sf)
    return L.with_clean_sentence(sentences).select("review_id", "pos", "clean_review")


def clean_pages(spark, sf):
    return tables.text_table(spark, sf, "pages").select("page_id", clean_text(F.col("html")).alias("text"))


def letters_only_texts(spark, sf):
    return tables.text_table(spark, sf, "documents").select(
        "doc_id", letters_only(F.col("text")).alias("processed_review")
    )


def char_counts(spark, sf):
    texts = tables.text_table(spark, sf, "documents").select(letters_only(F.col("text")).alias("text"))
    return terms.letter_counts(texts, "text", LETTERS)


def mutual_information(spark, sf):
    """The 100 tokens whose presence tells most about the class of a labelled document."""
    tokenized = terms.with_tokens(_documents(spark, sf).select("doc_id", "class", "review"))
    return terms.top_informative(terms.mutual_information(tokenized, "class"), 100).select("token", "df", _six("mi"))


def vocabulary_conflation(spark, sf):
    return terms.conflated_vocabulary(_tokenized(spark, sf))


def porter_vocabulary(spark, sf):
    return terms.stems(_tokenized(spark, sf))


def stemmed_term_counts(spark, sf):
    return terms.stemmed_bags(_tokenized(spark, sf).select("doc_id", "tokens"))


# Splits and metrics


def exact_split(spark, sf):
    """Exactly four fifths of each class, unlabelled documents being one of their own."""
    documents = _all_documents(spark, sf).select("doc_id", "class")
    return sample.exact_split(documents, "doc_id", 0.8, 80, ["class"])


def split_counts(spark, sf):
    documents = _documents(spark, sf).select("class", sample.in_sample("doc_id", 0.8, 80).alias("train"))
    return documents.groupBy("train", "class").agg(F.count("*").alias("n"))


def split_anti(spark, sf):
    documents = _all_documents(spark, sf).select("doc_id", "class")
    train, _ = sample.split(documents, "doc_id")
    return joins.complement(documents, train, "doc_id")


def weighted_f1(spark, sf):
    return evaluate.weighted_f1(_predicted(spark, sf)).select(_six("weighted_f1"), "n")


def auc(spark, sf):
    return order.area_under_roc(_predicted(spark, sf), "class", "n_chars").select(
        "positives", "negatives", _six("auc")
    )


def confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_predicted(spark, sf), BINARY)


def class_report(spark, sf):
    return evaluate.class_report(_predicted(spark, sf)).select(
        "label", _six("precision"), _six("recall"), _six("f1"), "support"
    )


# Learning


def _fitted(spark, sf):
    documents = _clean_documents(spark, sf)
    return L.fit_tfidf(documents), documents


def count_vector_terms(spark, sf):
    """Token counts of every document, as a count vector has them, for any vocabulary."""
    return terms.term_bags(_tokenized(spark, sf).select("doc_id", "tokens")).select(
        "doc_id", "token", F.col("n").cast("bigint").alias("n")
    )


def ml_tfidf_terms(spark, sf):
    """The weights of an idf vector of every document, for any vocabulary."""
    documents = tables.table(spark, sf, "documents").count()
    return terms.smoothed_weights(_tokenized(spark, sf), "doc_id", documents).select("doc_id", "token", _six("weight"))


def nb_predictions(spark, sf):
    return terms.naive_bayes(_tokenized(spark, sf), "doc_id", "class")


def nb_cross_validation(spark, sf):
    """Weighted F1 of naive Bayes for each fold and smoothing."""
    tokenized = terms.with_tokens(_documents(spark, sf).select("doc_id", "class", "review"))
    digest = F.md5(F.col("doc_id").cast("string").cast("binary"))
    fold = F.conv(F.left(digest, F.lit(7)), 16, 10).cast("bigint") % FOLDS
    found = keep(terms.cross_validated_bayes(tokenized, "class", fold, FOLDS, SMOOTHINGS), "validated")
    return evaluate.weighted_f1_by(found, ["fold", "smoothing"]).select("fold", "smoothing", _six("weighted_f1"), "n")


def _labelled_tokens(spark, sf):
    return keep(terms.with_tokens(_documents(spark, sf).select("doc_id", "class", "review")), "tokens")


def lr_predictions(spark, sf):
    train, test = sample.split(_labelled_tokens(spark, sf), "doc_id")
    if logistic.beyond_driver(train):
        found = logistic.predictions(logistic.fit(train, "class"), test)
        return found.select("doc_id", "class", "prediction", "p1")
    train, test = sample.split(_clean_documents(spark, sf), "doc_id")
    model = L.fit_tfidf(train)
    fitted = C.logistic().fit(model.transform(train).select("class", "idf"))
    return fitted.transform(model.transform(test)).select(
        "doc_id", "class", "prediction", F.element_at(vector_to_array("probability"), 2).alias("p1")
    )


def _linear(spark, sf, loss):
    """A linear model of the train rows' terms, and the weighed test rows."""
    train, test = sample.split(_labelled_tokens(spark, sf), "doc_id")
    idf = linear.smoothed_idf(train)
    model = linear.fit(linear.weigh_rows(train, idf), "class", loss, penalty=PENALTY)
    return model, linear.weigh_rows(test, idf)


def lr_term_weights(spark, sf):
    """The weights of a logistic model over all tokens, and its bias under the empty token."""
    model, _ = _linear(spark, sf, linear.LOGISTIC)
    return model.weights.select("token", _six("weight"))


def lr_term_predictions(spark, sf):
    model, test = _linear(spark, sf, linear.LOGISTIC)
    return linear.predict(model, test).select(
        "doc_id", "class", "prediction", F.round(linear.probability(F.col("margin")), 6).alias("p1")
    )


def svc_term_predictions(spark, sf):
    model, test = _linear(spark, sf, linear.SQUARED_HINGE)
    return linear.predict(model, test).select("doc_id", "class", "prediction", _six("margin"))


def lr_auc(spark, sf):
    """Area under the curve of the logistic model's margins on the test rows."""
    model, test = _linear(spark, sf, linear.LOGISTIC)
    scored = keep(linear.predict(model, test).select("class", F.round("margin", 9).alias("margin")), "margins")
    return order.area_under_roc(scored, "class", "margin").select("positives", "negatives", _six("auc"))


def _binary_embeddings(spark, sf):
    rows = tables.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") < 5).cast("int").alias("class")
    )
    return sample.split(L.dense_features(rows, "embedding"), "vec_id")


def svc_predictions(spark, sf):
    train, test = _binary_embeddings(spark, sf)
    return C.linear_svc("features").fit(train).transform(test).select("vec_id", "class", "prediction")


def rf_predictions(spark, sf):
    train, test = _binary_embeddings(spark, sf)
    return C.random_forest().fit(train).transform(test).select("vec_id", "class", "prediction")


def gnb_predictions(spark, sf):
    """Gaussian naive Bayes on the embeddings and their ten labels."""
    vectors = tables.table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    train, test = sample.split(vectors, "vec_id")
    return gaussian.predict(gaussian.fit(train, "embedding", "label"), test, "embedding", "label")


def w2v_vectors(spark, sf):
    sentences = L.with_clean_sentence(tables.conversation_sentences(spark, sf))
    return L.fit_word2vec(sentences).transform(sentences).select(
        "review_id", "pos", vector_to_array("features").alias("features")
    )


def _clean_words(spark, sf):
    sentences = L.with_clean_sentence(tables.conversation_sentences(spark, sf))
    return sentences.select("review_id", "pos", F.split("clean_review", " ").alias("tokens"))


def cooccurrence_pmi(spark, sf):
    """Positive mutual information of words that stand near each other in conversations."""
    return cooccurrence.positive_pmi(_clean_words(spark, sf)).select("token", "context", "n", _six("pmi"))


def cooccurrence_vectors(spark, sf):
    """Word vectors of 10 numbers, without a word table on the driver."""
    return cooccurrence.word_vectors(_clean_words(spark, sf), VECTOR).rows.select("token", "factors")


def latent_factors(spark, sf):
    """Each document's coordinates in the leading factors of the term weights."""
    documents = tables.table(spark, sf, "documents").count()
    weights = lambda: terms.smoothed_weights(_tokenized(spark, sf), "doc_id", documents)
    return factors.truncated_svd(weights, "doc_id", "token", "weight", TOPICS).rows


def kernel_svc_predictions(spark, sf):
    """A kernel machine that tells the first five labels of the embeddings from the others."""
    vectors = tables.table(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") < 5).cast("int").alias("class")
    )
    # Embeddings have 64 components; the kernel falls to 1/e at the distance at which gamma * d^2 is 1.
    train, test = sample.split(kernel.mapped(vectors, "embedding", kernel.FourierMap(64, KERNEL_GAMMA)), "vec_id")
    return kernel.kernel_svc().fit(train).transform(test).select("vec_id", "class", "prediction")


def lda_topics(spark, sf):
    """The heaviest tokens of each topic. Topics need no label; a document without text is one without words."""
    tokenized = _tokenized(spark, sf).select("doc_id", "tokens")
    if terms.token_counts(tokenized).count() > DRIVER_TERMS:
        return topics.heaviest(topics.fit(tokenized, "doc_id"))
    documents = L.with_clean_review(_all_documents(spark, sf).select("doc_id", "review").na.fill("", ["review"]))
    model = L.fit_tfidf(documents)
    # A fixed layout, so that the result does not follow the number of cores.
    laid = documents.repartition(16, "doc_id").sortWithinPartitions("doc_id")
    vectors = model.transform(laid).select("idf")
    return C.topic_terms(C.topic_model().fit(vectors), model, spark)


def model_roundtrip(spark, sf):
    """Do a saved and reloaded pipeline, logistic model and forest predict the same?"""
    tokenized = _labelled_tokens(spark, sf)
    if logistic.beyond_driver(tokenized):
        return jobs.table_roundtrip(tokenized, "doc_id", "class")
    model, documents = _fitted(spark, sf)
    fitted = C.logistic().fit(model.transform(documents).select("class", "idf"))
    forest = C.random_forest("idf").fit(model.transform(documents).select("class", "idf"))
    paths = [scratch_path(spark, name) for name in ("pipeline", "logistic", "forest")]
    for stage, path in zip((model, fitted, forest), paths):
        C.save(stage, path)
    again = PipelineModel.load(paths[0]).transform(documents).select("doc_id", F.col("idf").alias("again"))
    both = model.transform(documents).select("doc_id", "idf").join(again, "doc_id")
    pairs = [
        (fitted, type(fitted).load(paths[1])),
        (forest, RandomForestClassificationModel.load(paths[2])),
    ]
    for i, (kept, loaded) in enumerate(pairs):
        for stage, column in ((kept, "idf"), (loaded, "again")):
            stage = stage.copy().setFeaturesCol(column).setPredictionCol(f"{column}{i}")
            stage = stage.setProbabilityCol("").setRawPredictionCol("")
            both = stage.transform(both)
    return both.select(
        "doc_id",
        (F.col("idf0") == F.col("again0")).alias("same_logistic"),
        (F.col("idf1") == F.col("again1")).alias("same_forest"),
    )


def score_comments(spark, sf):
    comments = tables.text_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    tokenized = _labelled_tokens(spark, sf)
    if logistic.beyond_driver(tokenized):
        return logistic.score_comments(logistic.fit(tokenized, "class"), comments)
    model, documents = _fitted(spark, sf)
    fitted = C.logistic().fit(model.transform(documents).select("class", "idf"))
    return C.score_comments(model, fitted, comments)


def tfidf_classifiers(spark, sf):
    return jobs.compare_tfidf_classifiers(_clean_documents(spark, sf))


def word2vec_classifiers(spark, sf):
    sentences = tables.conversation_sentences(spark, sf).select(
        F.concat_ws("/", "review_id", "pos").alias("sentence_id"),
        (F.col("class") == "assistant").cast("int").alias("class"),
        "reviews",
    )
    return jobs.compare_word2vec_classifiers(sentences, "sentence_id")


def sentence_classifier(spark, sf):
    sentences = tables.conversation_sentences(spark, sf).select(
        F.concat_ws("/", "review_id", "pos").alias("sentence_id"),
        (F.col("class") == "assistant").cast("int").alias("class"),
        "reviews",
    )
    return jobs.compare_sentence_classifier(sentences, "sentence_id")


def feature_table(spark, sf):
    return jobs.feature_table(tables.reviews(spark, sf)).select(
        "review_id", "has_spoiler", _six("book_id_ratio"), _six("user_id_ratio"), _six("rating"), "processed_review"
    )


QUERIES = {
    f.__name__: f
    for f in (
        json_roundtrip, csv_roundtrip, bounded_scan, hash_pick,
        explode_sentences, assemble_reviews, assemble_nested, review_left_join, split_sentences,
        class_counts, avg_length_by_class, avg_total_length, stopped_length, null_audit,
        user_ratio, book_ratio, ratio_features, minmax_length, minmax_rating,
        describe_numeric, correlation_matrix, label_encode,
        systematic_sample, sorted_curve, ratio_curve, quantile_curve,
        token_counts, tf, sentence_tf, idf, tfidf, tfidf_join, item_specificity,
        top_terms_for_source, bottom_terms, top_terms_per_source, boosted_term_counts,
        clean_pages, char_counts, vocabulary_conflation,
        split_counts, split_anti, weighted_f1, auc, confusion_matrix, class_report,
        count_vector_terms, ml_tfidf_terms, nb_predictions, lr_predictions, svc_predictions,
        rf_predictions, w2v_vectors, lda_topics, model_roundtrip, score_comments,
        tfidf_classifiers, word2vec_classifiers, sentence_classifier, feature_table,
        lr_term_weights, lr_term_predictions, svc_term_predictions,
        nb_cross_validation, lr_auc, porter_vocabulary, stemmed_term_counts, exact_split, gnb_predictions, mutual_information,
        json_quarantine, item_lookup, cooccurrence_pmi, cooccurrence_vectors, latent_factors, kernel_svc_predictions,
    )
}
QUERIES["clean_punct"] = clean_punct_texts
QUERIES["clean_text"] = clean_text_sentences
QUERIES["letters_only"] = letters_only_texts
