"""Linear classifiers on term weights, whose weights are a table and not a vector.

A model is a table of (token, weight), the bias being the weight of the empty token, which no text
has; so a vocabulary of any size takes part and none is on the driver. Features are rows with their terms inside: ``terms`` is an array of
(token, value). They are packed once into blocks of up to ``BLOCK`` terms, each with its distinct tokens
and one sparse matrix, in a table that Spark keeps bucketed by block, so that blocks never move. A pass
sends each block the weights of its own tokens, takes margins, slopes of the loss and sums of slope
times value by token with numpy within the block, and adds the blocks' sums up by token. What a pass
shuffles is one row a token of a block, not one a term; a token that is in all blocks has no more
rows than there are blocks.

Each weight has a step of its own. The loss bends by at most ``bend`` (1/4 for the logistic, 2
for the squared hinge), so, by convexity, all weights may move at once if that of token j moves by
its slope over ``bend * mean(|x_j| * (1 + sum |x|))``. With these steps the loss
falls in every pass; rare tokens move far, frequent ones little. ``penalty`` adds half its
product with the squared weights, but the bias', to the mean loss.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.terms import bags_in_rows
from inkwell.session import keep, keep_by, scratch

# What tasks call here travels with the call, so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PASSES = 8
BIAS = ""
#: Terms of a block, but for the last row's: 6 MB of numbers. Larger blocks repeat fewer tokens and take more memory.
BLOCK = 1 << 19


@dataclass(frozen=True)
class Loss:
    """A loss of margin and class (1 or -1), its slope, and the most it bends."""

    name: str
    bend: float

    def value(self, margin: np.ndarray, side: np.ndarray) -> np.ndarray:
        if self.name == "logistic":
            # ln(1 + e^-ym), without overflow
            return np.logaddexp(0.0, -side * margin)
        return np.maximum(1 - side * margin, 0.0) ** 2

    def slope(self, margin: np.ndarray, side: np.ndarray) -> np.ndarray:
        if self.name == "logistic":
            return -side * np.exp(-np.logaddexp(0.0, side * margin))
        return -2 * side * np.maximum(1 - side * margin, 0.0)


LOGISTIC = Loss("logistic", 0.25)
SQUARED_HINGE = Loss("squared hinge", 2.0)


@dataclass(frozen=True)
class LinearModel:
    weights: DataFrame
    """token and weight, each token of the training rows once; the bias is that of ``BIAS``."""
    losses: tuple[float, ...]
    """Mean loss before each pass, penalty left out."""


def smoothed_idf(tokenized: DataFrame) -> DataFrame:
    """token and idf = ln((N + 1) / (df + 1)); N counts all rows, also those without a token. A kept table."""
    rows = tokenized.count()
    df = tokenized.select(F.explode(F.array_distinct("tokens")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return keep(df.select("token", F.ln((F.lit(rows) + 1) / (F.col("df") + 1)).alias("idf")), "idf")


def _list(values: np.ndarray | pa.Array) -> pa.Array:
    """One list that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def _flat(batch: pa.RecordBatch, at: int, name: str) -> np.ndarray:
    return batch.column(name)[at].values.to_numpy(zero_copy_only=False)


def _packed(rows: DataFrame) -> DataFrame:
    """Blocks of the rows, in the order and partition they lie in; rows without an array of ``terms`` are left out.

    ``at`` and ``value`` are the terms, row after row; ``ends`` tells where each row's end. The last
    token is the bias, which is in every row and has no terms. The rows' other columns are arrays.
    """
    names = [c for c in rows.columns if c != "terms"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, made = [], 0, 0

        def block() -> pa.RecordBatch:
            whole = {n: pa.concat_arrays([b.column(n) for b in held]) for n in ("_part", "terms", *names)}
            terms = whole["terms"].flatten()
            coded = terms.field("token").dictionary_encode()
            tokens = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([BIAS])])
            number = (whole["_part"][0].as_py() << 32) + made
            ends = np.cumsum(whole["terms"].value_lengths().to_numpy(zero_copy_only=False), dtype=np.int32)
            columns = [pa.array([number]), *map(_list, (tokens, coded.indices.cast(pa.int32()), terms.field("value"), ends, *[whole[n] for n in names]))]
            return pa.record_batch(columns, ["block", "tokens", "at", "value", "ends", *names])

        for batch in batches:
            batch = batch.filter(batch.column("terms").is_valid())
            start = 0
            lengths = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
            while start < batch.num_rows:
                before = lengths[start - 1] if start else 0
                # Up to the row that fills the block.
                stop = min(int(np.searchsorted(lengths, before + BLOCK - size)) + 1, batch.num_rows)
                held.append(batch.slice(start, stop - start))
                size += int(lengths[stop - 1] - before)
                start = stop
                if size >= BLOCK:
                    yield block()
                    held, size, made = [], 0, made + 1
        if held:
            yield block()

    schema = "block bigint, tokens array<string>, at array<int>, value array<double>, ends array<int>"
    schema = ", ".join([schema, *[f"`{n}` array<{rows.schema[n].dataType.simpleString()}>" for n in names]])
    found = rows.select(F.spark_partition_id().cast("bigint").alias("_part"), *names, "terms").mapInArrow(pack, schema)
    return keep_by(found, "blocks", "block")


def _places(blocks: DataFrame) -> DataFrame:
    """token, block and place of each token of each block, in buckets of token."""
    return keep_by(blocks.select("block", F.posexplode("tokens").alias("place", "token")).repartition("token"), "places", "token")


def _met(blocks: DataFrame, places: DataFrame, weights: DataFrame) -> DataFrame:
    """Blocks with the weights of their tokens; unknown tokens have 0.

    Weights move to the buckets of places, and those of a block to its bucket; blocks and places stay.
    """
    known = places.join(weights.select("token", "weight").hint("shuffle_hash"), "token", "left")
    sent = known.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("place", F.coalesce("weight", F.lit(0.0)).alias("weight")))).alias("_sent")
    )
    return blocks.join(sent.select("block", F.col("_sent.weight").alias("weights")).hint("shuffle_hash"), "block")


def _row_of(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """The place of its row for each term of a block."""
    ends = _flat(batch, at, "ends")
    return np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


def _margin(batch: pa.RecordBatch, at: int, of: np.ndarray) -> np.ndarray:
    weights = _flat(batch, at, "weights")
    products = _flat(batch, at, "value") * weights[_flat(batch, at, "at")]
    return np.bincount(of, products, len(_flat(batch, at, "ends"))) + weights[-1]


def weigh_rows(tokenized: DataFrame, idf: DataFrame) -> DataFrame:
    """Rows with ``terms``: token and n * idf, scaled to length 1, and a row number ``_row``.

    Tokens without idf are left out; a row without any has no terms. Rows are told
    apart by their number alone, so null and repeated keys do no harm. A kept table. Terms
    are weighed block by block, so that they do not move.
    """
    others = [c for c in tokenized.columns if c != "tokens"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                of, place = _row_of(batch, at), _flat(batch, at, "at")
                value = _flat(batch, at, "value") * _flat(batch, at, "weights")[place]
                used = value != 0
                of, place, value = of[used], place[used], value[used]
                count = len(_flat(batch, at, "ends"))
                value = value / np.sqrt(np.bincount(of, value * value, count))[of]
                tokens = batch.column("tokens")[at].values.take(pa.array(place))
                terms = pa.StructArray.from_arrays([tokens, pa.array(value)], ["token", "value"])
                starts = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=count))]).astype(np.int32)
                yield pa.record_batch([batch.column("row")[at].values, pa.ListArray.from_arrays(pa.array(starts), terms)], ["row", "terms"])

    with scratch(tokenized.sparkSession):
        bags = bags_in_rows(tokenized.withColumn("_row", F.monotonically_increasing_id()))
        rows = bags.select(F.struct("_row", *others).alias("row"), "terms")
        blocks = _packed(rows)
        met = _met(blocks, _places(blocks), idf.select("token", F.col("idf").alias("weight"))).select("tokens", "at", "value", "ends", "row", "weights")
        schema = f"row {rows.schema['row'].dataType.simpleString()}, terms array<struct<token:string,value:double>>"
        return keep(met.mapInArrow(weigh, schema).select("row.*", "terms"), "weighed", lasting=True)


def fit(rows: DataFrame, label: str, loss: Loss = LOGISTIC, passes: int = PASSES, penalty: float = 0.0) -> LinearModel:
    """A model of the rows (``_row``, ``terms`` and a label of 0 or 1), as ``weigh_rows`` makes them.

    Rows whose label is null take no part. No row at all gives no weights, and 0 as every margin.
    """
    spark = rows.sparkSession
    with scratch(spark):
        side = (2 * F.col(label) - 1).cast("double").alias("side")
        rows = rows.where(F.col(label).isNotNull()).select("terms", side)
        size = float(max(rows.count(), 1))
        blocks = _packed(rows)
        places = _places(blocks)

        def reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    of, sizes = _row_of(batch, at), np.abs(_flat(batch, at, "value"))
                    mass = 1 + np.bincount(of, sizes, len(_flat(batch, at, "ends")))
                    sums = np.bincount(_flat(batch, at, "at"), sizes * mass[of], len(batch.column("tokens")[at]))
                    sums[-1] = mass.sum()
                    yield pa.record_batch([batch.column("tokens").slice(at, 1), _list(sums)], ["token", "sum"])

        def slopes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    of, sides = _row_of(batch, at), _flat(batch, at, "side")
                    margin = _margin(batch, at, of)
                    slope = loss.slope(margin, sides)
                    sums = np.bincount(_flat(batch, at, "at"), slope[of] * _flat(batch, at, "value"), len(batch.column("tokens")[at]))
                    sums[-1] = slope.sum()
                    lost = pa.array([loss.value(margin, sides).sum()])
                    yield pa.record_batch([batch.column("tokens").slice(at, 1), _list(sums), lost], ["token", "sum", "loss"])

        def rows_of(sums: DataFrame, *columns: str) -> DataFrame:
            return sums.select(*columns, F.inline(F.arrays_zip("token", "sum")))

        reach = blocks.select("tokens", "at", "value", "ends").mapInArrow(reaches, "token array<string>, sum array<double>")
        reach = rows_of(reach).groupBy("token").agg((F.sum("sum") / size).alias("reach"))
        weights = keep(reach.select("token", F.lit(0.0).alias("weight"), "reach"), "weights")
        passed = []
        for _ in range(passes):
            met = _met(blocks, places, weights).select("tokens", "at", "value", "ends", "side", "weights")
            found = met.mapInArrow(slopes, "token array<string>, sum array<double>, loss double")
            by_token = rows_of(found, "loss").groupBy("token").agg((F.sum("sum") / size).alias("_slope"), (F.sum("loss") / size).alias("loss"))
            held = F.when(F.col("token") == BIAS, 0.0).otherwise(penalty)
            moved = (F.col("_slope") + held * F.col("weight")) / (loss.bend * F.col("reach") + held)
            joined = weights.drop("loss").join(by_token, "token")
            weights = keep(joined.select("token", (F.col("weight") - moved).alias("weight"), "reach", "loss"), "weights")
            # The bias is in every block, so its loss is that of all.
            passed.append(weights.where(F.col("token") == BIAS).select(F.lit(len(passed)).alias("pass"), "loss"))
        # One number a pass.
        losses = [r[1] for r in reduce(DataFrame.union, passed).orderBy("pass").collect()] if passed else []
        return LinearModel(keep(weights.select("token", "weight"), "model", lasting=True), tuple(losses))


def _margins(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """_row and margin, the sum of value times weight; unknown tokens have none. A kept table."""

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                margin = _margin(batch, at, _row_of(batch, at))
                yield pa.record_batch([pa.array(_flat(batch, at, "_row")), pa.array(margin)], ["_row", "margin"])

    with scratch(rows.sparkSession):
        blocks = _packed(rows.select("_row", "terms"))
        met = _met(blocks, _places(blocks), weights).select("at", "value", "ends", "_row", "weights")
        return keep(met.mapInArrow(margins, "_row bigint, margin double"), "margins", lasting=True)


def predict(model: LinearModel, rows: DataFrame) -> DataFrame:
    """Rows without their terms, with ``margin`` and ``prediction``: 1 where the margin is above 0."""
    found = rows.drop("terms").join(_margins(rows, model.weights), "_row", "left").drop("_row")
    margin = F.coalesce("margin", F.lit(0.0))
    return found.withColumn("margin", margin).withColumn("prediction", (margin > 0).cast("int"))


def probability(margin: Column) -> Column:
    """Of class 1, for a logistic model."""
    return 1 / (1 + F.exp(-margin))
