"""MLlib's random forest on tf-idf vectors, for any vocabulary: no vector of all tokens and no table of their splits on the driver.

Trees grow level by level, all at once. Rows lie in blocks (``linear._packed``) that hold the idf of their tokens; a
pass routes each row through the trees so far, draws its bootstrap weights again, and adds up the weights by
class for each new node, token and bin. Each node takes the split with the most gain; the driver gets
one split a node, 31 a tree at most.

As in MLlib: 20 trees of depth 5, Poisson bootstrap, gini, one instance a child at least, and as many tokens a node as the root of
their number. Which ones and the bootstrap are drawn by hashes, so draws are others than MLlib's, and the number of tokens holds on
average. A token's weight is its count times its idf, so its 32 bins are bins of counts, the same for all tokens: up to 24 exact,
then two for each doubling; MLlib takes its bins from about 10,000 rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.learning import linear
from inkwell.learning.features import SEED
from inkwell.learning.linear import BIAS, _flat, _row_of
from inkwell.operators.terms import bags_in_rows
from inkwell.session import keep, scratch

# What tasks call here travels with the call, by name (see learning.logistic), so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES, DEPTH = 20, 5
#: The least count of each bin but the first, which has rows without the token.
EDGES = np.array([*range(1, 25), 32, 48, 64, 96, 128, 192, 256], float)
#: Nodes are numbered from 1, the children of i being 2i and 2i + 1; this many numbers a tree.
NUMBERS = 2 << DEPTH
#: A model: nodes by tree and number. Inner ones have a token, and rows of a larger weight go to the second child; leaves have none. ``p0`` and ``p1`` are shares of the classes.
MODEL = "tree int, node int, token string, threshold double, p0 double, p1 double"


def features(tokenized: DataFrame, idf: DataFrame) -> DataFrame:
    """Rows in blocks with their counts and the idf of their tokens; the other columns as the array ``row``. A kept table."""
    others = [c for c in tokenized.columns if c != "tokens"]
    with scratch(tokenized.sparkSession):
        bags = bags_in_rows(tokenized).select(F.struct(*others).alias("row"), "terms")
        blocks = linear._packed(bags)
        met = linear._met(blocks, linear._places(blocks), idf.select("token", F.col("idf").alias("weight")))
        return keep(met, "features", lasting=True)


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Evenly spread 64-bit numbers (the last steps of splitmix64)."""
    codes = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    codes = (codes ^ (codes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return codes ^ (codes >> np.uint64(31))


def _block(batch: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row, place of the token and weight of each term, and the number of rows."""
    place = _flat(batch, at, "at")
    weight = _flat(batch, at, "value") * _flat(batch, at, "weights")[place]
    return _row_of(batch, at), place, weight, len(_flat(batch, at, "ends"))


def _routed(batch: pa.RecordBatch, at: int, splits: Sequence[tuple]) -> np.ndarray:
    """The node that each row has reached, by tree."""
    of, place, weight, rows = _block(batch, at)
    node = np.ones((TREES, rows), np.int64)
    names = sorted({token for _, _, token, _ in splits})
    known = pc.fill_null(pc.index_in(batch.column("tokens")[at].values, value_set=pa.array(names, pa.string())), -1).to_numpy(zero_copy_only=False)
    used = known[place] >= 0
    of, which, weight = of[used], known[place[used]], weight[used]
    numbers = {name: i for i, name in enumerate(names)}
    for tree, number, token, threshold in sorted(splits):
        right = np.zeros(rows, np.int64)
        right[of[(which == numbers[token]) & (weight > threshold)]] = 1
        here = node[tree] == number
        node[tree, here] = 2 * number + right[here]
    return node


def _gini(zeros: Column, ones: Column) -> Column:
    total = zeros + ones
    return 1 - (zeros * zeros + ones * ones) / (total * total)


def _best(sums: DataFrame, totals: DataFrame) -> DataFrame:
    """For each node the split with the most gain, first by token and bin among equals; nodes without gain are left out."""
    above = Window.partitionBy("node", "token").orderBy(F.desc("bin"))
    right = sums.select("node", "token", "bin", "idf", F.sum("n0").over(above).alias("r0"), F.sum("n1").over(above).alias("r1"))
    left0, left1 = F.col("t0") - F.col("r0"), F.col("t1") - F.col("r1")
    left, taken, total = left0 + left1, F.col("r0") + F.col("r1"), F.col("t0") + F.col("t1")
    both = right.join(F.broadcast(totals), "node").where((left > 0) & (taken > 0))
    gain = _gini(F.col("t0"), F.col("t1")) - left / total * _gini(left0, left1) - taken / total * _gini(F.col("r0"), F.col("r1"))
    found = both.withColumn("gain", gain).where(F.col("gain") > 0)
    split = F.struct("token", "bin", "idf", "r0", "r1")
    return found.groupBy("node").agg(F.min_by(split, F.struct(-F.col("gain"), "token", "bin")).alias("split")).select("node", "split.*")


def fit(blocks: DataFrame, label: str) -> DataFrame:
    """A model (``MODEL``) of the rows in ``features``, whose label is 0 or 1 and never null. A kept table.

    Each level reads the blocks once.
    """
    spark = blocks.sparkSession
    with scratch(spark):
        coded = keep(blocks.withColumn("codes", F.transform("tokens", lambda t: F.xxhash64(t))), "coded")
        # The bias is in every block and no token.
        size = coded.select(F.explode("tokens").alias("token")).distinct().count() - 1
        limit = np.uint64(min(2.0**64 / np.sqrt(max(size, 1)), 2.0**64 - 2048))
        splits: list[tuple] = []
        shares = {}
        active = {(tree, 1) for tree in range(TREES)}
        for _ in range(DEPTH):
            if not active:
                break
            now, new = list(splits), np.zeros((TREES, NUMBERS), bool)
            new[tuple(np.array(sorted(active)).T)] = True

            def sums(batches: Iterator[pa.RecordBatch], now=now, new=new) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for at in range(batch.num_rows):
                        of, place, weight, rows = _block(batch, at)
                        label_of = batch.column("row")[at].values.field(label).to_numpy(zero_copy_only=False).astype(float)
                        tokens, idf = batch.column("tokens")[at].values, _flat(batch, at, "weights")
                        codes = _flat(batch, at, "codes").astype(np.uint64)
                        bins = np.searchsorted(EDGES, _flat(batch, at, "value"), side="right")
                        bins_all = len(EDGES) + 1
                        reached, number = _routed(batch, at, now), batch.column("block")[at].as_py()
                        for tree in range(TREES):
                            drawn = np.random.default_rng([SEED, tree, number]).poisson(1.0, rows).astype(float)
                            live = new[tree, reached[tree]] & (drawn > 0)
                            if not live.any():
                                continue
                            # Weights without a sign change: a token that is in all rows splits nothing.
                            used = live[of] & (weight > 0)
                            row, at_token = of[used], place[used]
                            node = reached[tree, row]
                            salt = _mixed(np.uint64(tree * NUMBERS + 1) + node.astype(np.uint64))
                            chosen = _mixed(codes[at_token] ^ salt) <= limit
                            row, at_token, node, found = row[chosen], at_token[chosen], node[chosen], bins[used][chosen]
                            # All rows of a node, under the bias.
                            every = np.flatnonzero(live)
                            row = np.concatenate([row, every])
                            keys = (np.concatenate([node, reached[tree, every]]) * len(tokens) + np.concatenate([at_token, np.full(len(every), len(tokens) - 1)])) * bins_all
                            keys, back = np.unique(keys + np.concatenate([found, np.zeros(len(every), np.int64)]), return_inverse=True)
                            n1 = np.bincount(back, drawn[row] * label_of[row], len(keys))
                            n0 = np.bincount(back, drawn[row], len(keys)) - n1
                            at_token = keys // bins_all % len(tokens)
                            columns = [pa.array((keys // bins_all // len(tokens) + tree * NUMBERS).astype(np.int32)), tokens.take(pa.array(at_token))]
                            columns += [pa.array((keys % bins_all).astype(np.int32)), pa.array(idf[at_token]), pa.array(n0), pa.array(n1)]
                            yield pa.record_batch(columns, ["node", "token", "bin", "idf", "n0", "n1"])

            found = coded.mapInArrow(sums, "node int, token string, bin int, idf double, n0 double, n1 double")
            added = found.groupBy("node", "token", "bin").agg(F.max("idf").alias("idf"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
            with scratch(spark):
                added = keep(added, "sums")
                totals = added.where(F.col("token") == BIAS).select("node", F.col("n0").alias("t0"), F.col("n1").alias("t1"))
                # Sixteen nodes a tree at most, twice.
                whole = {divmod(r[0], NUMBERS): (r[1], r[2]) for r in totals.collect()}
                best = _best(added.where(F.col("token") != BIAS), totals).collect()
            shares |= {key: value for key, value in whole.items() if key not in shares}
            active = set()
            for r in sorted(best, key=lambda r: r.node):
                tree, node = divmod(r.node, NUMBERS)
                splits.append((tree, node, r.token, float((EDGES[r.bin - 1] - 0.5) * r.idf)))
                t0, t1 = whole[tree, node]
                for child, n in ((2 * node, (t0 - r.r0, t1 - r.r1)), (2 * node + 1, (r.r0, r.r1))):
                    shares[tree, child] = n
                    if min(n) > 0:
                        active.add((tree, child))
        inner = {(tree, node): (token, threshold) for tree, node, token, threshold in splits}
        rows = [(*key, *inner.get(key, (None, None)), n0 / (n0 + n1), n1 / (n0 + n1)) for key, (n0, n1) in sorted(shares.items())]
        return keep(spark.createDataFrame(rows, MODEL), "forest", lasting=True)


def predictions(model: DataFrame, blocks: DataFrame) -> DataFrame:
    """The rows of ``features`` with ``prediction``: the class with the larger sum of its shares in the leaves."""
    # 63 nodes a tree at most.
    nodes = [tuple(r) for r in model.collect()]
    splits = [(tree, node, token, threshold) for tree, node, token, threshold, _, _ in nodes if token is not None]
    # A tree whose bootstrap drew no row has no say.
    margin = np.zeros((TREES, NUMBERS))
    for tree, node, _, _, p0, p1 in nodes:
        margin[tree, node] = p1 - p0
    kind = blocks.schema["row"].dataType.elementType

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                reached = _routed(batch, at, splits)
                ones = margin[np.arange(TREES)[:, None], reached].sum(axis=0) > 0
                yield pa.record_batch([batch.column("row")[at].values, pa.array(ones.astype(float))], ["row", "prediction"])

    return blocks.mapInArrow(scored, f"row {kind.simpleString()}, prediction double").select("row.*", "prediction")
