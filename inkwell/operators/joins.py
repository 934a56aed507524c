"""Joins that keep their speed when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(rows: DataFrame, stats: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with one stats row per key; a null key matches nothing.

    ``stats`` has each key once, so a key with a large share of the rows is hot on one side
    only. Adaptive execution cuts its partition, whatever the key looks like, for inner and
    left joins alike; ``rows`` is evaluated once. Pass a kept table, so that its size is known
    and a small one is broadcast.
    """
    return rows.join(stats, key, how)


def attach_reviews(documents: DataFrame, reviews: DataFrame, key: str = "review_id") -> DataFrame:
    """Left join of assembled documents with the columns of their reviews.

    Written as an inner join, for adaptive execution cuts a hot key of either side there, but
    never one on the right of a left join. A blank review stands for each key of the
    documents, null included, that no review has. The documents are joined once; a second
    time only their keys are read.
    """
    lone = documents.select(key).distinct().join(reviews.select(key).distinct(), key, "left_anti")
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in reviews.schema if f.name != key]
    partners = reviews.where(F.col(key).isNotNull()).unionByName(lone.select(key, *blanks))
    partners = partners.withColumnRenamed(key, "_partner")
    matched = documents.join(partners, documents[key].eqNullSafe(partners["_partner"])).drop("_partner")
    return matched.select(key, *[c for c in matched.columns if c != key])


def complement(rows: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``sample``."""
    return rows.join(sample.select(key).distinct(), key, "left_anti")
