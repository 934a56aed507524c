"""The driver's Parquet tables in the roles of the review corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A line longer than this stands for an annotated (class 1) sentence.
LONG_LINE = 200


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of long texts, spread over all cores.

    Work on text is far dearer than moving it, and a small table may be one file that
    only one task can read. A table with a split for each core is left as it is.
    """
    rows = table(spark, folder, name)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, review, source, n_chars and class for each labelled document."""
    documents = text_table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("review"), "source", "n_chars"
    )
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("class"))
    return documents.join(labels, "doc_id")


def all_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same for every document; class is null where there is no label."""
    documents = text_table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("review"), "source", "n_chars"
    )
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("class"))
    return documents.join(labels, "doc_id", "left")


def reviews(spark: SparkSession, folder: str, how: str = "inner") -> DataFrame:
    """Labelled documents as reviews with their lines as nested sentences.

    With ``how="left"`` all documents; one without a label has a null rating and flag.
    """
    sentences = F.transform(
        F.split("text", "\n"),
        lambda s: F.array(F.when(F.char_length(s) > LONG_LINE, "1").otherwise("0"), s),
    )
    labelled = text_table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", how)
    return labelled.select(
        F.col("lang").alias("user_id"),
        F.lit(None).cast("string").alias("timestamp"),
        sentences.alias("review_sentences"),
        F.col("quality").cast("bigint").alias("rating"),
        (F.col("toxic") == 1).alias("has_spoiler"),
        F.col("source").alias("book_id"),
        F.col("doc_id").cast("string").alias("review_id"),
    )


def conversation_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as flat sentences: review_id, pos, class, reviews."""
    return text_table(spark, folder, "conversations").select(
        F.col("conv_id").alias("review_id"),
        F.col("turn").alias("pos"),
        F.col("role").alias("class"),
        F.col("text").alias("reviews"),
    )


def user_flags(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event: who, and whether it was an error."""
    return table(spark, folder, "events").select(
        "user_id", (F.col("event_type") == "error").alias("flag")
    )


def book_flags(spark: SparkSession, folder: str) -> DataFrame:
    """One row per labelled document: where from, and whether it is toxic."""
    return (
        table(spark, folder, "documents")
        .select("doc_id", F.col("source").alias("book_id"))
        .join(table(spark, folder, "labels"), "doc_id")
        .select("doc_id", "book_id", (F.col("toxic") == 1).alias("flag"))
    )
