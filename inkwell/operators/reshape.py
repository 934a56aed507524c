"""From nested reviews to sentences and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import comment_sentences

BLOCK = 1024


def explode_sentences(reviews: DataFrame) -> DataFrame:
    """One row per annotated sentence; ``pos`` keeps the order in the review.

    Reviews without a sentence vanish. The outer form and a filter are used, because
    Spark repeats the input of an inner explode in a filter of its own.
    """
    kept = [c for c in reviews.columns if c != "review_sentences"]
    return (
        reviews.select(*kept, F.posexplode_outer("review_sentences").alias("pos", "pair"))
        .where(F.col("pos").isNotNull())
        .select(
            *kept,
            "pos",
            F.get("pair", F.lit(0)).alias("class"),
            F.get("pair", F.lit(1)).alias("reviews"),
        )
    )


def _joined_in_order(position: str, text: str) -> Column:
    """Collected texts in order of position, joined by spaces; null if all are null."""
    ordered = F.sort_array(F.collect_list(F.struct(position, text)))
    texts = F.filter(F.transform(ordered, lambda s: s[text]), lambda t: t.isNotNull())
    return F.when(F.size(texts) > 0, F.concat_ws(" ", texts))


def assemble_parts(
    sentences: DataFrame,
    keys: Sequence[str] = ("review_id", "class"),
    pos: str = "pos",
    text: str = "reviews",
    block: int = BLOCK,
) -> DataFrame:
    """One row per (key, part): up to ``block`` positions of a document in order.

    A document of any length is spread over many tasks this way.
    """
    return sentences.groupBy(*keys, F.floor(F.col(pos) / block).alias("part")).agg(
        _joined_in_order(pos, text).alias("review")
    )


def assemble_reviews(
    sentences: DataFrame,
    keys: Sequence[str] = ("review_id", "class"),
    pos: str = "pos",
    text: str = "reviews",
    block: int = BLOCK,
) -> DataFrame:
    """One document per key: its sentences in order, joined by spaces.

    Sentences are joined in parts first, so the last step only puts a few long
    strings together. The document is one cell, which Spark bounds at 2 GB; where
    no whole text is needed, use :func:`assemble_parts` or the sentences.
    """
    parts = assemble_parts(sentences, keys, pos, text, block)
    return parts.groupBy(*keys).agg(
        F.coalesce(_joined_in_order("part", "review"), F.lit("")).alias("review")
    )


def assemble_nested(reviews: DataFrame) -> DataFrame:
    """Documents of each review with all review columns, straight from the nested array.

    A review is one row, so its sentences are already together: this needs neither
    the shuffle of a regrouping nor a join back to the reviews. Where a review_id may
    occur in several rows, use ``assemble_reviews`` and ``attach_reviews``.
    """
    kept = [c for c in reviews.columns if c != "review_sentences"]
    classes = F.transform(
        F.array_distinct(F.transform("review_sentences", lambda s: F.get(s, F.lit(0)))),
        lambda c: F.struct(c.alias("class")),
    )
    review = F.concat_ws(
        " ",
        F.transform(
            F.filter(
                "review_sentences",
                lambda s: F.get(s, F.lit(0)).eqNullSafe(F.col("found.class")),
            ),
            lambda s: F.get(s, F.lit(1)),
        ),
    )
    return (
        reviews.select(*kept, "review_sentences", F.explode_outer(classes).alias("found"))
        .where(F.col("found").isNotNull())
        .select(*kept, "found.class", review.alias("review"))
    )


def split_comments(comments: DataFrame, text: str = "text") -> DataFrame:
    """One row per sentence of each comment, with its line and place in the line."""
    kept = [c for c in comments.columns if c != text]
    return (
        comments.select(*kept, F.posexplode_outer(comment_sentences(F.col(text))).alias("line", "found"))
        .select(*kept, "line", F.posexplode("found").alias("part", "review"))
    )
