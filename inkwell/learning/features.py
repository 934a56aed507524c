"""MLlib feature pipelines and their vectors as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, StopWordsRemover, Tokenizer, Word2Vec
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import clean_punct, clean_text
from inkwell.operators.derive import compute_once
from inkwell.operators.terms import token_counts
from inkwell.schema import STOP_WORDS
from inkwell.session import keep, scratch_path

SEED = 80
# The most tokens a count vector has room for: MLlib keeps them all on the driver. A corpus
# with more is refused, not cut.
VOCABULARY = 1 << 22


def with_clean_review(documents: DataFrame, text: str = "review") -> DataFrame:
    """The one cleaning step shared by training and scoring."""
    return documents.withColumn(text, clean_punct(F.col(text)))


def with_clean_sentence(sentences: DataFrame, text: str = "reviews") -> DataFrame:
    """Cleaned sentences; those with no word left are dropped."""
    return compute_once(sentences, "clean_review", clean_text(F.col(text))).where(
        F.col("clean_review") != ""
    )


def fit_tfidf(documents: DataFrame, text: str = "review") -> PipelineModel:
    """Tokens, stop words, counts (``vectors``) and tf-idf vectors (``idf``)."""
    return _fit_counts(
        documents,
        [
            Tokenizer(inputCol=text, outputCol="tokens"),
            StopWordsRemover(inputCol="tokens", outputCol="stopped", stopWords=STOP_WORDS),
        ],
    )


def fit_sentence_tfidf(sentences: DataFrame, text: str = "clean_review") -> PipelineModel:
    """The variant for cleaned sentences: their stop words are gone already."""
    return _fit_counts(sentences, [Tokenizer(inputCol=text, outputCol="tokens")])


def _fit_counts(rows: DataFrame, stages: list) -> PipelineModel:
    """Add counts and idf to tokenizing stages.

    Fitted on the corpus, ``CountVectorizer`` would send a vocabulary of every task to
    the driver. So tokens are counted as a DataFrame, and the vectorizer is fitted on
    the distinct tokens alone. None is left out.
    """
    column = stages[-1].getOutputCol()
    tokenized = PipelineModel(stages).transform(rows)
    counts = keep(token_counts(tokenized.select(F.col(column).alias("tokens"))), "vocabulary")
    if (size := counts.count()) > VOCABULARY:
        raise ValueError(f"{size} tokens do not fit into vectors of {VOCABULARY}; raise features.VOCABULARY")
    ordered = counts.select(F.array("token").alias(column))
    vectorizer = CountVectorizer(inputCol=column, outputCol="vectors", vocabSize=VOCABULARY).fit(ordered)
    idf = IDF(inputCol="vectors", outputCol="idf").fit(vectorizer.transform(tokenized))
    return PipelineModel([*stages, vectorizer, idf])


def fit_word2vec(
    sentences: DataFrame,
    text: str = "clean_review",
    size: int = 200,
    min_count: int = 10,
    partitions: int = 10,
) -> PipelineModel:
    """Mean word vectors (``features``) of cleaned sentences.

    MLlib trains one task per partition and averages, so ``partitions`` is part of the model
    and does not follow the number of cores. Fits are not repeatable to the last digit, even
    with the seed. All words' vectors are held on the driver: raise ``min_count`` with the
    corpus.
    """
    stages = [
        Tokenizer(inputCol=text, outputCol="tokens"),
        Word2Vec(
            inputCol="tokens",
            outputCol="features",
            vectorSize=size,
            minCount=min_count,
            numPartitions=partitions,
            seed=SEED,
        ),
    ]
    return Pipeline(stages=stages).fit(sentences)


def vocabulary(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """idx and token of the fitted vocabulary, ``VOCABULARY`` rows at most.

    Read from the saved stage, so the words do not pass through Python.
    """
    path = scratch_path(spark, "vectorizer")
    next(s for s in model.stages if isinstance(s, CountVectorizerModel)).write().save(path)
    return spark.read.parquet(f"{path}/data").select(
        F.posexplode("vocabulary").alias("idx", "token")
    )


def vector_terms(
    model: PipelineModel, transformed: DataFrame, keep: Sequence[str], vectors: str, value: str
) -> DataFrame:
    """One row per non-zero entry of a sparse vector, with its token."""
    entries = F.unwrap_udt(vectors)
    return (
        transformed.select(
            *keep,
            F.inline_outer(
                F.arrays_zip(entries["indices"].alias("idx"), entries["values"].alias(value))
            ),
        )
        .where(F.col("idx").isNotNull())
        .join(F.broadcast(vocabulary(model, transformed.sparkSession)), "idx")
        .drop("idx")
    )


def dense_features(rows: DataFrame, array: str) -> DataFrame:
    """Numeric arrays as an MLlib ``features`` vector."""
    return rows.withColumn("features", array_to_vector(F.col(array).cast("array<double>"))).drop(array)
