"""From raw documents to token counts: filter, deduplicate, decontaminate, redact, encode.

Each stage reads all that its predecessor kept. ``run`` writes each stage's result as
Parquet below the shared folder and reads it again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import bpe, decontam, ngram_join, quality, secrets
from inkwell.llm.queries import VOCABULARY, fold
from inkwell.session import keep
from inkwell.sources.tables import table

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.7 or more.

    The classifier learns from the labelled documents of one fold split, as in op6.
    """
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return quality.score(docs.select(*DOCUMENT), model).where(F.col("score") >= quality.KEEP).drop("score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of each group of near copies.

    Rows that share a doc_id are one document and stay together.
    """
    groups = ngram_join.classes(docs.select("doc_id", "text"))
    dropped = keep(groups.where(F.col("class_id") != F.col("doc_id")).select("doc_id").distinct(), "dropped")
    return docs.select(*DOCUMENT).join(dropped, "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    found = keep(found, "contaminated")
    return docs.select(*DOCUMENT).join(found, "doc_id", "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a placeholder."""
    found = secrets.find(docs, carry=DOCUMENT, twice=True)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col("spans")))
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*DOCUMENT)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each document's tokens."""
    return bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY)).drop("text")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("bpe encoding", encode),
]

# Learned models, set joins and merges are beyond SQL; a brute-force test stands in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
