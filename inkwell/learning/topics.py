"""Topics of weighted term bags by online variational Bayes, whose topics are a table and not a matrix.

The steps are those of MLlib's online LDA with its defaults: each round draws a share of the documents
with replacement, fits their topic shares to the present topics, moves the topics towards
what the drawn documents would give if all were like them, and moves the prior of the shares by a
Newton step. But a token's weights are a row of a table, so a vocabulary of any size takes part; a round
shuffles the terms of its own documents alone. Of them, the topics' totals, a prior and a sum of as
many numbers as there are topics reach the driver.

Draws and starts are hashes of a document's key and terms or of a token, so results do not depend on
partitions or cores, but for the order in which sums are added up. Draws differ from MLlib's,
whose generators run through all tokens on the driver. Defined results: tokens that are in
every document weigh 0; documents without a token of weight take no part but count in the
corpus. Rows may share a key or have none. Without a token there is no topic.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.learning.special import digamma, trigamma
from inkwell.llm.shipping import map_batches
from inkwell.operators.joins import enrich
from inkwell.operators.terms import term_bags
from inkwell.session import keep, scratch

SEED = 80
SHARE, DELAY, DECAY = 0.05, 1024.0, 0.51
#: Topics and topic shares start as draws of a gamma distribution of this shape, divided by it.
SHAPE = 100.0
#: A document's shares are settled when they move by less than this on average; rounds at most.
SETTLED, INNER = 1e-3, 1000


@dataclass(frozen=True)
class TopicModel:
    weights: DataFrame
    """token and, for each topic k, ``w<k>``: its weight, not scaled to sum 1."""
    totals: tuple[float, ...]
    """Sum of each topic's weights."""
    prior: tuple[float, ...]


def _uniform(*key: Column | str) -> Column:
    """Above 0 and below 1."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) / 2.0**53


def _gamma(seed: int, *key: Column | str) -> Column:
    """A draw of the start distribution, by the cube of a normal draw."""
    one, two = _uniform(*key, F.lit(seed), F.lit(1)), _uniform(*key, F.lit(seed), F.lit(2))
    normal = F.sqrt(-2 * F.ln(one)) * F.cos(2 * math.pi * two)
    return F.pow(1 - 1 / (9 * SHAPE) + normal / (3 * math.sqrt(SHAPE)), F.lit(3.0))


def _times_drawn(round_: int, *key: Column | str) -> Column:
    """How often a round draws a document: a Poisson number of mean ``SHARE``."""
    at, drawn, below = _uniform(*key, F.lit(SEED + round_)), F.lit(0), 0.0
    for n in range(8):
        below += math.exp(-SHARE) * SHARE**n / math.factorial(n)
        drawn = drawn + (at > below).cast("int")
    return drawn


def settle(
    starts: np.ndarray, counts: np.ndarray, share: np.ndarray, start: np.ndarray, prior: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Topic shares of documents, and what each of their terms adds to the topics.

    Terms from ``starts[d]`` on are those of document d; ``share`` is the expectation of the topics
    at them. Documents that are settled stay as they are.
    """
    sizes = np.diff(np.append(starts, len(counts)))
    found, live = start.copy(), np.arange(len(starts))
    at = np.repeat(np.arange(len(starts)), sizes)
    terms, seen = share, counts

    def expected(g: np.ndarray) -> np.ndarray:
        return np.exp(digamma(g) - digamma(g.sum(1, keepdims=True)))

    for _ in range(INNER):
        held = expected(found[live])
        norm = (terms * held[at]).sum(1) + 1e-100
        first = np.searchsorted(at, np.arange(len(live)))
        new = held * np.add.reduceat(terms * (seen / norm)[:, None], first) + prior
        moving = np.abs(new - found[live]).mean(1) > SETTLED
        found[live] = new
        if not moving.any():
            break
        left = moving[at]
        at = (np.cumsum(moving) - 1)[at[left]]
        terms, seen, live = terms[left], seen[left], live[moving]
    held = expected(found)[np.repeat(np.arange(len(starts)), sizes)]
    norm = (share * held).sum(1) + 1e-100
    return found, held * (counts / norm)[:, None] * share


def _added(drawn: DataFrame, topics: int, totals: np.ndarray, prior: np.ndarray) -> DataFrame:
    """token and what the drawn documents add to it; under a null token the sums of their shares' logs, and ``n``."""
    below = digamma(totals)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column("terms")
            starts = np.asarray(terms.offsets)[:-1] - terms.offsets[0].as_py()
            fields = terms.flatten()
            weights = np.stack([fields.field(f"w{k}").to_numpy(zero_copy_only=False) for k in range(topics)], 1)
            start = np.stack([batch.column(f"g{k}").to_numpy(zero_copy_only=False) for k in range(topics)], 1)
            times = batch.column("times").to_numpy(zero_copy_only=False).astype(float)
            values = fields.field("value").to_numpy(zero_copy_only=False)
            shares, adds = settle(starts, values, np.exp(digamma(weights) - below), start, prior)
            adds *= np.repeat(times, np.diff(np.append(starts, len(values))))[:, None]
            logs = (digamma(shares) - digamma(shares.sum(1, keepdims=True))) * times[:, None]
            tokens = pa.concat_arrays([fields.field("token").cast(pa.string()), pa.nulls(1, pa.string())])
            columns = np.concatenate([adds, logs.sum(0, keepdims=True)])
            n = np.append(np.zeros(len(values)), times.sum())
            yield pa.RecordBatch.from_arrays(
                [tokens, *[pa.array(columns[:, k]) for k in range(topics)], pa.array(n)], ["token", *[f"a{k}" for k in range(topics)], "n"]
            )

    sums = [f"a{k}" for k in range(topics)]
    made = map_batches(drawn, turn, ", ".join(["token string", *[f"{s} double" for s in sums], "n double"]))
    return made.groupBy("token").agg(*[F.sum(s).alias(s) for s in [*sums, "n"]])


def _next_prior(prior: np.ndarray, logs: np.ndarray, documents: float, pace: float) -> np.ndarray:
    """The prior of the shares after a Newton step, or as it was if one would be 0 or less."""
    slope = documents * (digamma(prior.sum()) - digamma(prior) + logs)
    c, q = documents * trigamma(prior.sum()), -documents * trigamma(prior)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    new = prior - pace * (slope - b) / q
    return new if (new > 0).all() else prior


def fit(tokenized: DataFrame, key: str, topics: int = 2, rounds: int = 10) -> TopicModel:
    """Topics of the documents' (key, tokens) term weights n * ln((N + 1) / (df + 1))."""
    spark = tokenized.sparkSession
    names = [f"w{k}" for k in range(topics)]
    with scratch(spark):
        # Equal rows are drawn together, whatever partition they are in.
        mark = F.xxhash64(key, F.array_sort("tokens"))
        rows = keep(tokenized.select("tokens", mark.alias("_mark"), F.monotonically_increasing_id().alias("_row")), "rows")
        size = rows.count()
        df = rows.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
        idf = F.ln((F.lit(size) + 1) / (F.col("df") + 1)).alias("idf")
        weights = keep(df.select("token", idf, *[_gamma(SEED + k, "token").alias(n) for k, n in enumerate(names)]), "topics")
        prior = np.full(topics, 1.0 / topics)

        def summed() -> np.ndarray:
            """A number for each topic."""
            return np.array([x or 0.0 for x in weights.agg(*[F.sum(n) for n in names]).first()], float)

        for i in range(rounds):
            starts = [_gamma(SEED + 1000 * (i + 1) + k, "_mark").alias(f"g{k}") for k in range(topics)]
            batch = rows.withColumn("times", _times_drawn(i, "_mark")).where("times > 0").select("_row", "times", *starts, "tokens")
            shares = ["times", *[f"g{k}" for k in range(topics)]]
            bags = term_bags(batch).drop("n_tokens")
            met = enrich(bags, weights, "token").where("idf != 0")
            term = F.struct("token", (F.col("n") * F.col("idf")).alias("value"), *names)
            # Sorted, so that sums are added up in the same order each time.
            drawn = met.groupBy("_row", *shares).agg(F.array_sort(F.collect_list(term)).alias("terms")).drop("_row")
            added = keep(_added(drawn, topics, summed(), prior), "added")
            # One row.
            told = added.where("token is null").first()
            if told is None:
                continue
            pace = (DELAY + i + 1) ** -DECAY
            more = size / math.ceil(SHARE * size)
            moved = [
                ((1 - pace) * F.col(n) + pace * (more * F.coalesce(f"a{k}", F.lit(0.0)) + 1.0 / topics)).alias(n)
                for k, n in enumerate(names)
            ]
            weights = keep(weights.join(added.where("token is not null").drop("n"), "token", "left").select("token", "idf", *moved), "topics")
            prior = _next_prior(prior, np.array([told[f"a{k}"] for k in range(topics)]) / told["n"], told["n"], pace)
        totals = tuple(float(x) for x in summed())
        return TopicModel(keep(weights.select("token", *names), "model", lasting=True), totals, tuple(float(x) for x in prior))


def heaviest(model: TopicModel, terms: int = 10) -> DataFrame:
    """topic, rank from 0, weight (of 1 for the whole topic) and token of the ``terms`` heaviest tokens of each topic."""
    parts = []
    for k, total in enumerate(model.totals):
        # A few rows of each topic.
        top = model.weights.select("token", (F.col(f"w{k}") / F.lit(total or 1.0)).alias("weight")).orderBy(F.desc("weight"), "token").limit(terms)
        listed = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("less"), "token"))).alias("found"))
        ranked = listed.select(F.lit(k).alias("topic"), F.posexplode("found").alias("rank", "term"))
        parts.append(ranked.select("topic", "rank", (-F.col("term.less")).alias("weight"), F.col("term.token").alias("token")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found
