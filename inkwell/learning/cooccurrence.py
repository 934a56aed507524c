"""Which tokens stand near which: pair counts in the row, positive pointwise mutual information, vectors.

Defined results: a null or empty list of tokens has no pair; a null token pairs with nothing but
keeps its place. A token next to itself counts in both directions, like any other pair.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.learning import factors
from inkwell.operators.joins import enrich
from inkwell.session import keep, release

WINDOW = 5
#: Singular values of mutual information lie close together; more digits of them take many
#: passes and do not bring like words nearer.
TOLERANCE = 1e-3
#: Places of a task's share of the texts; its distinct pairs, up to ``WINDOW`` times as many, are held in memory.
SHARE = 1 << 21


def in_shares(tokenized: DataFrame, share: int = SHARE) -> DataFrame:
    """The lists of tokens, dealt over so many tasks that each has about ``share`` places.

    A split of a file may hold any number of texts, and what counting pairs takes in memory would grow
    with it. The lists are kept for that and moved once; they are a tenth of their pairs.
    """
    rows = keep(tokenized.select("tokens"), "words")
    places = rows.agg(F.sum(F.greatest(F.size("tokens"), F.lit(0)))).first()[0] or 0
    return rows.repartition(max(math.ceil(places / share), rows.rdd.getNumPartitions(), 1))


def _met(tokenized: DataFrame, window: int) -> DataFrame:
    """x, y and n: how often the two stand within ``window`` places. Each unordered pair once, in one of its orders.

    Pairs are made in the row that holds the tokens, and counted before they move, so no
    token's rows come together.
    """
    last = F.size("tokens")

    def at_distance(d):
        ahead = F.slice("tokens", d + 1, F.greatest(last - d, F.lit(0)))
        behind = F.slice("tokens", F.lit(1), F.greatest(last - d, F.lit(0)))
        return F.zip_with(behind, ahead, lambda a, b: F.struct(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"), (a.isNotNull() & b.isNotNull()).alias("whole")))

    pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(window)), at_distance))
    return tokenized.select(F.inline(pairs)).where("whole").groupBy("x", "y").agg(
        # A token next to itself counts in both directions.
        F.when(F.col("x") == F.col("y"), 2 * F.count("*")).otherwise(F.count("*")).alias("n")
    )


def _both_ways(met: DataFrame, *values: str) -> DataFrame:
    """token, context and values of both directions of each pair, one for a token next to itself."""
    way, back = (F.struct(F.col(a).alias("token"), F.col(b).alias("context"), *values) for a, b in (("x", "y"), ("y", "x")))
    return met.select(F.inline(F.when(F.col("x") == F.col("y"), F.array(way)).otherwise(F.array(way, back))))


def pair_counts(tokenized: DataFrame, window: int = WINDOW) -> DataFrame:
    """token, context and n: how often the two stand within ``window`` places, in either order.

    Each unordered pair is shuffled once; its two directions are written out after that.
    """
    return _both_ways(_met(tokenized, window), "n")


def positive_pmi(tokenized: DataFrame, window: int = WINDOW) -> DataFrame:
    """token, context, n and pmi = ln(n * total / (n of the token * n of the context)), where that is above 0.

    The counts of single tokens are a kept table, joined twice; a frequent token is hot on
    the pairs' side alone, where adaptive execution cuts it. Both directions of a pair have the same
    information, so pairs are kept and joined once, and written out both ways at the end.
    """
    met = keep(_met(in_shares(tokenized), window), "pairs")
    # Pairs are counted; their shuffle files are not needed.
    release(met.sparkSession)
    single = keep(_both_ways(met, "n").groupBy("token").agg(F.sum("n").alias("met")), "single")
    total = single.agg(F.sum("met")).first()[0] or 0
    of_x, of_y = (single.select(F.col("token").alias(a), F.col("met").alias(f"{a}_met")) for a in ("x", "y"))
    joined = enrich(enrich(met, of_x, "x"), of_y, "y")
    pmi = F.ln(F.col("n") * F.lit(float(total)) / (F.col("x_met").cast("double") * F.col("y_met")))
    return _both_ways(joined.withColumn("pmi", pmi).where("pmi > 0"), "n", "pmi")


def word_vectors(
    tokenized: DataFrame, size: int, window: int = WINDOW, tolerance: float = TOLERANCE
) -> factors.Factors:
    """Vectors of all tokens: the leading factors of their positive mutual information.

    Passes end when no singular value moves by more than ``tolerance`` of the largest.
    """
    return factors.truncated_svd(lambda: positive_pmi(tokenized, window).select("token", "context", "pmi"), "token", "context", "pmi", size, tolerance=tolerance)
