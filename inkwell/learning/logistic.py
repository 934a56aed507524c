"""MLlib's logistic regression on term counts, for any vocabulary: the same steps, no vector of all tokens anywhere.

MLlib scales tf-idf vectors to unit deviation, centres them and takes up to 100 L-BFGS steps, whose vectors, one
number a token, are on the driver. All these vectors are sums of the rows, each times some number: the slopes of
the loss at the rows give a gradient, and steps are sums of gradients. So a vector is held here by its numbers
for the rows (``coordinates``) and its products with the rows (``margins``), beside the rows in blocks; the products of
two vectors, which L-BFGS needs, are sums over the rows. The driver sees these sums alone.

A pass adds a gradient: each block sends sums by token to shards of the vocabulary, which add them up and send
each block the totals of its tokens. Order and places are fixed beforehand, so only numbers move, and only for tokens
that several blocks have. What a shard or block holds does not grow with the input; their number does.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import tokens as word_list
from inkwell.learning import linear
from inkwell.learning.features import with_clean_review
from inkwell.learning.linear import BIAS, LOGISTIC, LinearModel, _flat, _list
from inkwell.learning.linear import _row_of as _term_rows
from inkwell.operators.reshape import split_comments
from inkwell.operators.terms import bags_in_rows, token_counts
from inkwell.session import keep, release, scratch

# What tasks call here travels with the call, so that executors need not have this package. They call functions by name:
# a module that is named in a task would be needed there with all that it imports.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Tokens up to which MLlib is used: at six vectors a pass, 100 passes send less than 1 GB to the driver.
DRIVER_TERMS = 3 << 16
#: MLlib's settings for ``classifiers.logistic``: steps, remembered steps and tolerance.
STEPS, MEMORY, TOLERANCE = 100, 10, 1e-6
#: Places of tokens in blocks that a shard of the vocabulary takes.
SHARD = 1 << 20
#: Blocks that a task takes at most, once there are more than three a core.
TOGETHER = 8
#: Passes after which states are written, so that their shuffle files can go.
CUT = 4
LEVEL = StorageLevel.MEMORY_AND_DISK


def beyond_driver(tokenized: DataFrame) -> bool:
    """Whether there are too many tokens for vectors on the driver."""
    return token_counts(tokenized).count() > DRIVER_TERMS


def counted(tokenized: DataFrame) -> DataFrame:
    """Rows with ``terms``, token and number of occurrences, and a row number ``_row``. A kept table."""
    return keep(bags_in_rows(tokenized.withColumn("_row", F.monotonically_increasing_id())), "counted")


def predictions(model: LinearModel, tokenized: DataFrame) -> DataFrame:
    """Rows without their tokens, with MLlib's ``prediction`` and the probability ``p1`` of class 1. A kept table."""
    with scratch(tokenized.sparkSession):
        found = linear.predict(model, counted(tokenized)).withColumn("prediction", F.col("prediction").cast("double"))
        return keep(found.withColumn("p1", linear.probability(F.col("margin"))).drop("margin"), "predicted", lasting=True)


def score_comments(model: LinearModel, comments: DataFrame, text: str = "text") -> DataFrame:
    """Prediction for every sentence of every comment, as ``classifiers.score_comments`` gives it."""
    cleaned = with_clean_review(split_comments(comments, text))
    tokenized = cleaned.withColumn("tokens", word_list(F.col("review")))
    return predictions(model, tokenized).select(*cleaned.columns, "prediction")


class SearchFailed(Exception):
    """A line search found no step."""


def _line_search(phi: Callable[[float], tuple[float, float]], value: float, slope: float, first: float) -> float:
    """The step that Breeze's strong Wolfe search takes; ``phi`` gives value and slope at a step."""
    if slope > 0:
        raise SearchFailed

    def between(a: tuple, b: tuple) -> float:
        (lt, lf, ld), (rt, rf, rd) = sorted((a, b))
        d1 = ld + rd - 3 * (lf - rf) / (lt - rt)
        with np.errstate(invalid="ignore", divide="ignore"):
            d2 = np.sqrt(np.float64(d1 * d1 - ld * rd))
            t = rt - (rt - lt) * (rd + d2 - d1) / (rd - ld + 2 * d2)
        low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
        return float(low if t < low else high if t > high else t)

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(10):
            t = between(low, high)
            found = (t, *phi(t))
            if found[1] > value + 1e-4 * t * slope or found[1] >= low[1]:
                high = found
            else:
                if abs(found[2]) <= 0.9 * abs(slope):
                    return t
                if found[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = found
        raise SearchFailed

    t, low = first, (0.0, value, slope)
    for i in range(10):
        found = (t, *phi(t))
        if not np.isfinite(found[1]):
            t /= 2
            continue
        if found[1] > value + 1e-4 * t * slope or (found[1] >= low[1] and i > 0):
            return zoom(low, found)
        if abs(found[2]) <= 0.9 * abs(slope):
            return t
        if found[2] >= 0:
            return zoom(found, low)
        low, t = found, t * 1.5
    raise SearchFailed


def _direction(steps: int, gram: np.ndarray) -> np.ndarray:
    """L-BFGS's direction as factors of the remembered steps, changes of the gradient and the gradient.

    ``gram`` has the products of these vectors, each group from old to new; those of two steps are not used.
    """
    found = np.zeros(2 * steps + 1)
    found[-1] = 1.0
    kept = {}
    for i in reversed(range(steps)):
        kept[i] = gram[i] @ found / gram[i, steps + i]
        found[steps + i] -= kept[i]
    if steps and gram[steps - 1, 2 * steps - 1] < 0:
        raise SearchFailed
    if steps:
        found *= gram[steps - 1, 2 * steps - 1] / gram[2 * steps - 1, 2 * steps - 1]
    for i in range(steps):
        beta = gram[steps + i] @ found / gram[i, steps + i]
        found[i] += kept[i] - beta
    if np.isnan(found).any():
        raise SearchFailed
    return -found


def _links(places: DataFrame, shards: int) -> DataFrame:
    """For each shard of the vocabulary and block: places in the block, and in the shard, of tokens that other blocks have, too. A kept table."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        whole = pa.Table.from_batches(held)
        codes = whole.column("token").combine_chunks().dictionary_encode().indices.to_numpy()
        shared = np.bincount(codes)[codes] > 1
        if not shared.any():
            return
        codes = np.unique(codes[shared], return_inverse=True)[1].astype(np.int32)
        block, place = (whole.column(n).to_numpy()[shared] for n in ("block", "place"))
        order = np.lexsort((place, block))
        codes, block, place = codes[order], block[order], place[order].astype(np.int32)
        shard = whole.column("_shard")[0].as_py()
        for part in np.split(np.arange(len(block)), np.flatnonzero(np.diff(block)) + 1):
            row = [[shard], [int(block[part[0]])], [place[part].tobytes()], [codes[part].tobytes()]]
            yield pa.record_batch([pa.array(row[0], pa.int32()), pa.array(row[1]), *[pa.array(v, pa.binary()) for v in row[2:]]], ["shard", "block", "places", "positions"])

    dealt = places.select("token", "block", "place").repartition(shards, "token").select("*", F.spark_partition_id().alias("_shard"))
    return keep(dealt.mapInArrow(link, "shard int, block bigint, places binary, positions binary"), "links", lasting=True)


def _first(rdd: RDD) -> RDD:
    """The RDD as ``_together`` takes its first one if that is ``marked``; kept so, it passes through Python once less each time."""
    return rdd.mapValues(lambda v: (0, v))


def _together(parts: int, *rdds: RDD, marked: bool = False) -> RDD:
    """The values of each key, a list for each RDD. What lies in ``parts`` partitions by key does not move."""
    count, tagged = len(rdds), [r if marked and i == 0 else r.mapValues(lambda v, i=i: (i, v)) for i, r in enumerate(rdds)]
    return reduce(RDD.union, tagged).groupByKey(parts).mapValues(lambda found: _by_tag(list(found), count))


def _by_tag(found: list[tuple], count: int) -> list[list]:
    return [[v for tag, v in found if tag == i] for i in range(count)]


def _block(data: tuple, links: list[tuple]) -> dict:
    """Rows of a block: their scaled terms, labels, and the places of its tokens in the shards."""
    size, at, value, ends, side = data
    return {
        "size": size, "at": np.frombuffer(at, np.int32), "value": np.frombuffer(value),
        "lengths": np.diff(np.frombuffer(ends, np.int32), prepend=0), "label": (np.frombuffer(side) > 0).astype(float),
        "links": [(shard, np.frombuffer(places, np.int32)) for shard, places in sorted(links)],
    }


def _row_of(block: dict) -> np.ndarray:
    """The place of its row for each term of a block."""
    return np.repeat(np.arange(len(block["lengths"])), block["lengths"])


def _by_token(block: dict, slopes: np.ndarray) -> np.ndarray:
    return np.bincount(block["at"], slopes[_row_of(block)] * block["value"], block["size"])


def _by_row(block: dict, slopes: np.ndarray, sent: list[tuple]) -> np.ndarray:
    totals, sent = _by_token(block, slopes), dict(sent)
    for shard, places in block["links"]:
        totals[places] = sent[shard]
    return np.bincount(_row_of(block), totals[block["at"]] * block["value"], len(block["lengths"]))


class _Rows:
    """The rows in blocks, and the shards of their vocabulary."""

    def __init__(self, blocks: DataFrame, links: DataFrame, shards: int):
        self.spark = blocks.sparkSession
        # One number a block.
        self.ids = sorted(r[0] for r in blocks.select("block").collect())
        number = {b: i for i, b in enumerate(self.ids)}
        cores = self.spark.sparkContext.defaultParallelism
        self.parts, self.shards = max(min(len(self.ids), 3 * cores), len(self.ids) // TOGETHER, 1), shards

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    value = [_flat(batch, at, n) for n in ("at", "value", "ends", "side")]
                    value[1] = value[1] * _flat(batch, at, "weights")[value[0]]
                    size = len(batch.column("tokens")[at])
                    columns = [pa.array([v.tobytes()], pa.binary()) for v in value]
                    yield pa.record_batch([batch.column("block").slice(at, 1), pa.array([size]), *columns], ["block", "size", "at", "value", "ends", "side"])

        packed = blocks.mapInArrow(pack, "block bigint, size bigint, at binary, value binary, ends binary, side binary").rdd
        data = packed.map(lambda r: (number[r[0]], (r[1], *map(bytes, r[2:])))).partitionBy(self.parts)
        joints = links.select("block", "shard", "places").rdd.map(lambda r: (number[r[0]], (r[1], bytes(r[2])))).partitionBy(self.parts)
        self.blocks = _first(_together(self.parts, data, joints).mapValues(lambda f: _block(f[0][0], f[1]))).persist(LEVEL)
        positions = links.select("shard", "block", "positions").rdd.map(lambda r: (r[0], (number[r[1]], bytes(r[2]))))
        self.positions = _first(positions.groupByKey(shards).mapValues(sorted)).persist(LEVEL)

    def together(self, *rdds: RDD) -> RDD:
        """The blocks and what the RDDs have for them."""
        return _together(self.parts, self.blocks, *rdds, marked=True)

    def sent(self, state: RDD) -> RDD:
        """For each block the sums by token of the last coordinates' rows, for tokens that other blocks have, too."""

        def up(pair: tuple) -> Iterator[tuple]:
            number, ((block,), (state,)) = pair
            sums = _by_token(block, state["coordinates"][-1])
            for shard, places in block["links"]:
                yield shard, (number, sums[places])

        def total(pair: tuple) -> Iterator[tuple]:
            shard, (positions, found) = pair
            found = dict(found)
            held = [(number, np.frombuffer(at, np.int32)) for number, at in positions[0]] if positions else []
            sums = np.zeros(max((int(at.max()) for _, at in held), default=-1) + 1)
            # In the order of the blocks, so that sums do not follow the order of arrival. A block has a token once.
            for number, at in held:
                sums[at] += found[number]
            for number, at in held:
                yield number, (shard, sums[at])

        sums = self.together(state).flatMap(up).partitionBy(self.shards)
        return _together(self.shards, self.positions, sums, marked=True).flatMap(total).partitionBy(self.parts)

    def close(self) -> None:
        self.blocks.unpersist()
        self.positions.unpersist()


def _slope(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    return LOGISTIC.slope(margin, 2 * label - 1)


def _added(sums: RDD) -> np.ndarray:
    """Sums over the blocks, added in their order."""
    return np.sum([v for _, v in sorted(sums.collect(), key=lambda p: p[0])], axis=0)


def _steps(rows: _Rows, size: float, bias: float, steps: int) -> tuple[RDD, dict, list[float]]:
    """The blocks' states after the last step, sums over them, and the loss before each step and after the last.

    A state has the ``margin`` and the coordinates ``point`` of the model, label and centre of its rows, and ``margins`` and
    ``coordinates`` of the remembered steps, the changes of the gradient and the gradient.
    """
    old: list[RDD] = []

    def held(state: RDD) -> RDD:
        old.append(state.persist(LEVEL))
        return state

    def dropped() -> None:
        """All states but the last are not needed when its sums are taken."""
        for state in old[:-1]:
            state.unpersist()
        del old[:-1]

    def cut(state: RDD) -> RDD:
        """The state as a table, so that it can do without the passes before; their shuffle files go."""
        found = rows.spark.createDataFrame(state.map(lambda p: (p[0], pickle.dumps(p[1]))), "block int, state binary")
        return keep(found, "state").rdd.map(lambda r: (r[0], pickle.loads(bytes(r[1])))).partitionBy(rows.parts)

    # The centre: products of the rows with their mean.
    ones = held(rows.blocks.mapValues(lambda b: {"coordinates": np.full((1, len(b[1]["label"])), 1 / size)}))

    def begin(found: list) -> dict:
        (block,), sent = found
        n = len(block["label"])
        margin = np.full(n, bias)
        return {
            "label": block["label"], "centre": _by_row(block, np.full(n, 1 / size), sent), "margin": margin, "point": np.zeros(n),
            "margins": np.zeros((0, n)), "coordinates": _slope(margin, block["label"])[None] / size,
        }

    state = held(rows.together(rows.sent(ones)).mapValues(begin))

    def totals(margin: np.ndarray, s: dict) -> list[float]:
        """A block's share of the loss, and of what a gradient needs: the mean slope, the mean slope times centre, the centre's square."""
        r = _slope(margin, s["label"]) / size
        return [LOGISTIC.value(margin, 2 * s["label"] - 1).sum() / size, r.sum(), r @ s["centre"], s["centre"].sum() / size]

    value, mean, shift, square = map(float, _added(state.mapValues(lambda s: np.array(totals(s["margin"], s)))))
    start, losses, recent = value, [value], [np.inf]
    gram, known, taken, failed = np.zeros((1, 1)), 0, 0, False
    fresh = True
    while True:
        if fresh:
            # The gradient's margins; from them the change of the gradient, if there was a step.
            def add(found: list, known=known, mean=mean, shift=shift, square=square, step=taken > 0) -> dict:
                (block,), (s,), sent = found
                slopes = s["coordinates"][-1]
                own = _by_row(block, slopes, sent) - mean * s["centre"] - shift + mean * square + mean
                s = dict(s)
                if step:
                    # Before: steps, changes, the gradient then, the new step.
                    m, c, first = s["margins"], s["coordinates"], known >= MEMORY
                    steps, changes = [*range(first, known), 2 * known + 1], [*range(known + first, 2 * known)]
                    s["margins"] = np.vstack([m[steps], m[changes], own - m[2 * known], own])
                    s["coordinates"] = np.vstack([c[steps], c[changes], slopes - c[2 * known], slopes])
                else:
                    s["margins"] = own[None]
                return s

            state = held(rows.together(state, rows.sent(state)).mapValues(add))
            known = min(known + 1, MEMORY) if taken else 0

            # Products with the gradient and with its last change: the coordinates of one, the margins of the other.
            products = _added(state.mapValues(lambda s: s["coordinates"][-2:] @ s["margins"].T))
            last = 2 * known
            bigger = np.zeros((last + 1, last + 1))
            if known:
                drop, was = known * 2 == len(gram) - 1, (len(gram) - 1) // 2
                keep_old = [*range(drop, was), *range(was + drop, 2 * was)]
                to = [*range(known - 1), *range(known, last - 1)]
                bigger[np.ix_(to, to)] = gram[np.ix_(keep_old, keep_old)]
                bigger[last - 1], bigger[:, last - 1] = products[0], products[0]
            bigger[last], bigger[:, last] = products[-1], products[-1]
            gram = bigger
            if taken % CUT == CUT - 1:
                state = held(cut(state))
                state.count()
            dropped()
            if taken % CUT == CUT - 1:
                # Only what nothing refers to any more goes.
                phi = None
                release(rows.spark)
        norm = float(np.sqrt(max(gram[-1, -1], 0.0)))
        # Breeze stops at the last step, where the loss no longer falls, or where the gradient vanishes.
        stalled = len(recent) >= 2 and abs(value - max(recent)) <= TOLERANCE * start
        if taken >= steps or stalled or norm <= max(TOLERANCE * value, 1e-8):
            break
        try:
            factors = _direction(known, gram)
            slope = float(factors @ gram[-1])

            tried: dict[float, list[float]] = {}

            def phi(t: float, factors=factors, state=state, tried=tried) -> tuple[float, float]:
                def at(s: dict) -> np.ndarray:
                    along = factors @ s["margins"]
                    margin = s["margin"] + t * along
                    return np.array([*totals(margin, s), _slope(margin, s["label"]) @ along / size])

                *tried[t], slope = map(float, _added(state.mapValues(at)))
                return tried[t][0], slope

            first = 1.0 if taken else 1 / norm
            step = _line_search(phi, value, slope, first)
            if step * norm < 1e-10:
                raise SearchFailed
            failed = False
        except SearchFailed:
            if failed:
                break
            # Once, without the remembered steps.
            failed, fresh = True, False
            state = held(state.mapValues(lambda s: {**s, "margins": s["margins"][-1:], "coordinates": s["coordinates"][-1:]}))
            gram, known = gram[-1:, -1:], 0
            continue

        def move(s: dict, factors=factors, step=step) -> dict:
            s = dict(s)
            along, own = step * (factors @ s["margins"]), step * (factors @ s["coordinates"])
            s["margin"], s["point"] = s["margin"] + along, s["point"] + own
            s["margins"] = np.vstack([s["margins"], along])
            s["coordinates"] = np.vstack([s["coordinates"], own, _slope(s["margin"], s["label"])[None] / size])
            return s

        state = held(state.mapValues(move))
        value, mean, shift, square = tried[step]
        losses.append(value)
        recent = [*recent, value][-20:]
        taken, fresh = taken + 1, True
    point = _added(state.mapValues(lambda s: np.array([s["point"].sum(), s["point"] @ s["centre"]])))
    return state, {"mean": point[0], "shift": point[1], "square": square}, losses


def _scales(blocks: DataFrame, size: float) -> DataFrame:
    """token, mean number of occurrences and, as ``weight``, 1 / its deviation; 0 for a token that is in all rows alike, or has idf 0. A kept table."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                place, value = _flat(batch, at, "at"), _flat(batch, at, "value")
                tokens = batch.column("tokens").slice(at, 1)
                found = [np.bincount(place, v, len(tokens[0])) for v in (np.ones(len(value)), value, value * value)]
                yield pa.record_batch([tokens, *map(_list, found)], ["token", "rows", "n", "squares"])

    found = blocks.select("tokens", "at", "value").mapInArrow(sums, "token array<string>, rows array<double>, n array<double>, squares array<double>")
    by = found.select(F.inline(F.arrays_zip("token", "rows", "n", "squares"))).where(F.col("token") != BIAS).groupBy("token")
    by = by.agg(*[F.sum(c).alias(c) for c in ("rows", "n", "squares")])
    n = F.col("n")
    deviation = F.sqrt((F.col("squares") - n * n / size) / max(size - 1, 1))
    weight = F.when((F.col("rows") < size) & (deviation > 0), 1 / deviation).otherwise(0.0)
    return keep(by.select("token", weight.alias("weight"), (n / size).alias("mean")), "scales", lasting=True)


def fit(tokenized: DataFrame, label: str) -> LinearModel:
    """What ``classifiers.logistic`` learns from tf-idf vectors of the rows, as a weight for each occurrence of a token.

    The label is 0 or 1 and never null. A token that is in all rows has idf 0 and no weight. The rows are read twice.
    """
    spark = tokenized.sparkSession
    with scratch(spark):
        # A row for each label.
        sizes = {r[0]: r[1] for r in tokenized.groupBy(label).agg(F.count("*")).collect()}
        if not sizes or not set(sizes) <= {0, 1}:
            raise ValueError(f"labels must be 0 or 1, and there must be rows: {sizes}")
        size, ones = float(sum(sizes.values())), sizes.get(1, 0)
        none = spark.range(1).select(F.lit(BIAS).alias("token"))
        if len(sizes) == 1:
            return LinearModel(keep(none.withColumn("weight", F.lit(math.inf if ones else -math.inf)), "model", lasting=True), ())
        with scratch(spark):
            side = (2 * F.col(label) - 1).cast("double").alias("side")
            blocks = linear._packed(bags_in_rows(tokenized.select(side, "tokens")))
            places = linear._places(blocks)
            scales = _scales(blocks, size)
            met = keep(linear._met(blocks, places, scales), "met", lasting=True)
            shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), places.count() // SHARD + 1)
            links = _links(places.where(F.col("token") != BIAS), shards)
        held = _Rows(met, links, shards)
        bias = math.log(ones / (size - ones))
        state, sums, losses = _steps(held, size, bias, STEPS)
        ids = held.ids
        points = spark.createDataFrame(state.map(lambda p: (ids[p[0]], p[1]["point"].tobytes())), "block bigint, point binary")

        def by_token(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    point = np.frombuffer(batch.column("point")[at].as_py())
                    tokens, place = batch.column("tokens"), _flat(batch, at, "at")
                    value = _flat(batch, at, "value") * _flat(batch, at, "weights")[place]
                    found = np.bincount(place, point[_term_rows(batch, at)] * value, len(tokens[at]))
                    yield pa.record_batch([tokens.slice(at, 1), _list(found)], ["token", "sum"])

        found = met.join(keep(points, "points"), "block").select("tokens", "at", "value", "ends", "weights", "point")
        found = found.mapInArrow(by_token, "token array<string>, sum array<double>").select(F.inline(F.arrays_zip("token", "sum")))
        by = found.groupBy("token").agg(F.sum("sum").alias("sum")).where(F.col("token") != BIAS)
        weight = (F.col("sum") - float(sums["mean"]) * F.col("mean") * F.col("weight")) * F.col("weight")
        constant = float(bias + sums["mean"] - sums["shift"] + sums["mean"] * sums["square"])
        model = by.join(scales, "token").select("token", weight.alias("weight")).unionByName(none.withColumn("weight", F.lit(constant)))
        model = keep(model, "model", lasting=True)
        held.close()
        state.unpersist()
        return LinearModel(model, tuple(losses))
