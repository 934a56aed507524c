"""Latent factors of a sparse table: truncated singular value decomposition by block Krylov iteration.

The matrix is a table of (row, column, value) of any height and width. It is laid out once in blocks of whole rows, with
the places of their columns; it and its transpose multiply a block of vectors there. A pass does so ``depth`` times and
finds the best factors that the vectors and their images can make up (Rayleigh-Ritz); the next vectors are their image.

All vectors but the first are images of vectors of the rows under the transpose, so only those are held, beside the rows
(``_Matrix``), and products of the vectors are products of the rows' vectors with each other. A multiplication moves sums by column,
once to a shard of the columns and the totals back, for columns that several blocks have. Only products
of the vectors with each other, a few thousand numbers, reach the driver. What a block or shard holds follows neither the
input nor the number of passes, but for a row of more entries than a block: it is in one block, whole.

The start is a hash of the columns' keys, so results do not depend on partitions or cores, but for
the order in which sums are added up. Signs are such that the cubes of a factor's column
vector have a positive sum. Passes end when no wanted value moves by more than ``tolerance`` of the
largest, or after ``passes``; ``moved`` tells how far they still moved.

Defined results: entries with a null row, column or value or a value that is not finite count as 0; repeated
entries are added up. A matrix of lower rank than asked for gives as many factors as it has.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from inkwell.learning.logistic import _added, _links, _together
from inkwell.session import keep, release, scratch

# What tasks call here travels with the call, by name (see learning.logistic), so that executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of the block beyond the factors asked for; more of them need fewer passes.
SPARE, DEPTH, PASSES, TOLERANCE = 12, 3, 20, 1e-10
SEED = 80
#: Directions this much shorter than the longest are rounding errors.
_RANK = 1e-11
#: Entries of a block, 12 bytes each, and the least that are worth a task of their own. Larger blocks have fewer columns in common.
BLOCK, LEAST = 1 << 22, 1 << 18
#: Places of columns in blocks that a shard of the columns takes, and the least that are worth a task.
SHARD, LEAST_PLACES = 1 << 18, 1 << 14
#: Entries that are multiplied at once: what fits a cache.
_CHUNK = 1 << 12


@dataclass(frozen=True)
class Factors:
    values: tuple[float, ...]
    """The largest singular values, falling."""
    rows: DataFrame
    """The row's key and ``factors``: its coordinates in the left singular vectors."""
    columns: DataFrame
    """The column's key and ``factors``: its coordinates in the right singular vectors."""
    moved: float


def _names(prefix: str, count: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(count)]


def _products(rows: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """The matrix of sums of products of two lists of columns.

    Each batch of rows is one matrix product in its task; a handful of numbers a batch are
    added up by place. Sums of products as rows or columns in SQL take ten times as long.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in {*left, *right}}
            product = np.array([dense[n] for n in left]) @ np.array([dense[n] for n in right]).T
            yield pa.record_batch([pa.array(np.arange(product.size)), pa.array(product.ravel())], ["at", "x"])

    used = rows.select(*dict.fromkeys([*left, *right]))
    sums = used.mapInArrow(partial, "at bigint, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    found = np.zeros(len(left) * len(right))
    for r in sums:
        found[r["at"]] = r["x"]
    return found.reshape(len(left), len(right))


def _turned(rows: DataFrame, key: str, names: list[str], by: np.ndarray, to: str) -> DataFrame:
    """The key and its vector times a small matrix, a batch of rows at a time.

    Spelled out in SQL, the matrix would be hundreds of terms that are compiled anew in every pass.
    """

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense = np.array([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
            columns = [batch.column(key), *map(pa.array, by.T @ dense)]
            yield pa.RecordBatch.from_arrays(columns, [key, *found])

    found = _names(to, by.shape[1])
    kind = rows.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", *[f"{n} double" for n in found]])
    return rows.select(key, *names).mapInArrow(turn, schema)


def _symmetric(square: np.ndarray) -> np.ndarray:
    return (square + square.T) / 2


def _straight(gram: np.ndarray) -> np.ndarray:
    """A matrix that makes vectors of these products orthonormal, without directions of no length."""
    lengths = np.sqrt(np.maximum(np.diag(gram), 0.0))
    scale = np.divide(1.0, lengths, out=np.zeros_like(lengths), where=lengths > 0)
    size, way = np.linalg.eigh(_symmetric(gram * np.outer(scale, scale)))
    long = size > max(size.max(initial=0.0), 0.0) * _RANK
    return scale[:, None] * way[:, long] / np.sqrt(size[long])


def _best(products: np.ndarray, images: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the shares of the vectors in their factors.

    The products of the vectors with each other, and with each other's images.
    """
    way = _straight(products)
    squares, turn = np.linalg.eigh(_symmetric(way.T @ images @ way))
    return squares[::-1], way @ turn[:, ::-1]


def _start(codes: np.ndarray, width: int) -> np.ndarray:
    """``_start_of`` of keys, whose ``xxhash64`` are given: Spark's hash of a further int goes on from there."""
    p1, p2, p3, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    found = np.empty((len(codes), width))
    for j in range(width):
        # Scalars would warn of overflow, arrays do not.
        code = codes.astype(np.int64).view(np.uint64) + (p5 + np.uint64(4))
        code ^= np.array([SEED + j], np.uint64) * p1
        code = ((code << np.uint64(23)) | (code >> np.uint64(41))) * p2 + p3
        code = (code ^ (code >> np.uint64(33))) * p2
        code = (code ^ (code >> np.uint64(29))) * p3
        found[:, j] = (code ^ (code >> np.uint64(32))).view(np.int64) / 2.0**63
    return found


def _start_of(key: str, width: int) -> list[str]:
    return [f"cast(xxhash64({key}, {SEED + j}) as double) / {2**63}D as v0_{j}" for j in range(width)]


def _summed(to: np.ndarray, of: np.ndarray, value: np.ndarray, vectors: np.ndarray, count: int) -> np.ndarray:
    """Sums of value times the vector of ``of`` for each ``to``, which is sorted."""
    found = np.zeros((count, vectors.shape[1]))
    for at in range(0, len(to), _CHUNK):
        part = slice(at, at + _CHUNK)
        key = to[part]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        terms = np.take(vectors, of[part], axis=0, mode="clip")
        terms *= value[part, None]
        found[key[heads]] += np.add.reduceat(terms, heads, axis=0)
    return found


class _Block:
    """Whole rows of the matrix: entry after entry the place of the row, of the column and the value."""

    def __init__(self, data: tuple[int, int, bytes, bytes, bytes]):
        self.rows, self.size, lengths, at, value = data
        self.of = np.repeat(np.arange(self.rows, dtype=np.int32), np.frombuffer(lengths, np.int32))
        self.at, self.value = np.frombuffer(at, np.int32), np.frombuffer(value)

    def by_row(self, vectors: np.ndarray) -> np.ndarray:
        return _summed(self.of, self.at, self.value, vectors, self.rows)

    def by_column(self, vectors: np.ndarray) -> np.ndarray:
        order = np.argsort(self.at, kind="stable")
        return _summed(self.at[order], self.of[order], self.value[order], vectors, self.size)


def _vectors(held: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(held).reshape(rows, -1)


def _packed(entries: DataFrame, count: int) -> DataFrame:
    """Blocks of so many entries. A kept table."""
    parts = max(math.ceil(count / BLOCK), min(entries.sparkSession.sparkContext.defaultParallelism, math.ceil(count / LEAST)))
    kinds = {n: entries.schema[n].dataType.simpleString() for n in ("row", "column")}
    limit = 2 * BLOCK

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, size, full = TaskContext.get().partitionId(), 0, [], 0, limit

        def block(whole: pa.Table, of: np.ndarray, keys: pa.Array) -> pa.RecordBatch:
            columns = whole.column("column").combine_chunks().dictionary_encode()
            found = {
                "block": pa.array([(part << 32) + made]), "at": columns.indices.to_numpy().astype(np.int32),
                "lengths": np.bincount(of, minlength=len(keys)).astype(np.int32), "value": whole.column("value").to_numpy(), "rows": keys, "columns": columns.dictionary,
            }
            for name in ("at", "lengths", "value"):
                found[name] = pa.array([found[name].tobytes()], pa.binary())
            for name in ("rows", "columns"):
                found[name] = pa.ListArray.from_arrays(pa.array([0, len(found[name])], pa.int32()), found[name])
            return pa.RecordBatch.from_pydict(found)

        def coded() -> tuple[pa.Table, np.ndarray, pa.Array]:
            whole = pa.Table.from_batches(held)
            rows = whole.column("row").combine_chunks().dictionary_encode()
            # Rows are sorted, so their codes rise.
            return whole, rows.indices.to_numpy().astype(np.int32), rows.dictionary

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size < full:
                continue
            whole, of, keys = coded()
            # The last row may go on.
            cut = int(np.searchsorted(of, of[-1]))
            if cut:
                yield block(whole.slice(0, cut), of[:cut], keys.slice(0, len(keys) - 1))
                held, size, made = whole.slice(cut).combine_chunks().to_batches(), size - cut, made + 1
            full = max(limit, 2 * size)
        if size:
            yield block(*coded())

    schema = f"block bigint, at binary, lengths binary, value binary, rows array<{kinds['row']}>, columns array<{kinds['column']}>"
    dealt = entries.select("row", "column", "value").repartition(parts, "row").sortWithinPartitions("row")
    return keep(dealt.mapInArrow(pack, schema), "blocks", lasting=True)


class _Matrix:
    """The matrix in blocks. Vectors of its rows are kept tables: for each block an array of rows by width."""

    def __init__(self, table: DataFrame):
        self.table, self.spark = table, (spark := table.sparkSession)
        # One number a block.
        self.ids = sorted(r[0] for r in self.table.select("block").collect())
        self.parts = len(self.ids)
        number = {b: i for i, b in enumerate(self.ids)}
        with scratch(spark):
            places = keep(self.table.select("block", F.posexplode("columns").alias("place", "token")), "places")
            count = places.count()
            self.shards = max(1, math.ceil(count / SHARD), min(spark.sparkContext.defaultParallelism, count // LEAST_PLACES))
            links = _links(places, self.shards)
        sized = self.table.select("block", F.size("rows"), F.size("columns"), "lengths", "at", "value")
        data = sized.rdd.map(lambda r: (number[r[0]], (r[1], r[2], *map(bytes, r[3:]))))
        self.blocks = data.partitionBy(self.parts)
        joints = links.select("block", "shard", "places").rdd.map(lambda r: (number[r[0]], (r[1], bytes(r[2]))))
        self.joints = joints.partitionBy(self.parts)
        positions = links.select("shard", "block", "positions").rdd.map(lambda r: (r[0], (number[r[1]], bytes(r[2]))))
        self.positions = positions.partitionBy(self.shards)

    def kept(self, vectors: RDD, name: str = "images", lasting: bool = False) -> DataFrame:
        found = self.spark.createDataFrame(vectors.map(lambda p: (p[0], p[1].tobytes())), "number int, vectors binary")
        return keep(found, name, lasting)

    def read(self, vectors: DataFrame) -> RDD:
        return vectors.rdd.map(lambda r: (r[0], bytes(r[1]))).partitionBy(self.parts)

    def first(self, width: int) -> DataFrame:
        """The rows' products with the start."""

        def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = [c.values.to_numpy(zero_copy_only=False).tobytes() for c in batch.column("codes")]
                yield pa.record_batch([batch.column("block"), pa.array(codes, pa.binary())], ["block", "codes"])

        number = {b: i for i, b in enumerate(self.ids)}
        codes = self.table.select("block", F.transform("columns", lambda c: F.xxhash64(c)).alias("codes"))
        codes = codes.mapInArrow(plain, "block bigint, codes binary").rdd.map(lambda r: (number[r[0]], bytes(r[1]))).partitionBy(self.parts)

        def times(found: list) -> np.ndarray:
            (data,), (codes,) = found
            return _Block(data).by_row(_start(np.frombuffer(codes, np.int64), width))

        return self.kept(_together(self.parts, self.blocks, codes).mapValues(times))

    def times(self, vectors: DataFrame) -> DataFrame:
        """The matrix times its transpose times vectors of the rows."""
        given = self.read(vectors)

        def up(pair: tuple) -> Iterator[tuple]:
            number, ((data,), links, (held,)) = pair
            block = _Block(data)
            sums = block.by_column(_vectors(held, block.rows))
            for shard, places in links:
                yield shard, (number, sums[np.frombuffer(places, np.int32)])

        def total(pair: tuple) -> Iterator[tuple]:
            shard, (positions, found) = pair
            found = dict(found)
            held = [(number, np.frombuffer(at, np.int32)) for number, at in sorted(positions)]
            sums = np.zeros((max(int(at.max()) for _, at in held) + 1, next(iter(found.values())).shape[1]))
            # In the order of the blocks, so that sums do not follow the order of arrival. A block has a column once.
            for number, at in held:
                sums[at] += found.pop(number)
            for number, at in held:
                yield number, (shard, sums[at])

        def down(found: list) -> np.ndarray:
            (data,), links, (held,), sent = found
            block, sent = _Block(data), dict(sent)
            sums = block.by_column(_vectors(held, block.rows))
            for shard, places in links:
                sums[np.frombuffer(places, np.int32)] = sent.pop(shard)
            return block.by_row(sums)

        sums = _together(self.parts, self.blocks, self.joints, given).flatMap(up).partitionBy(self.shards)
        totals = _together(self.shards, self.positions, sums).flatMap(total).partitionBy(self.parts)
        found = self.kept(_together(self.parts, self.blocks, self.joints, given, totals).mapValues(down))
        del given, sums, totals
        release(self.spark)
        return found

    def products(self, vectors: list[DataFrame], width: int) -> np.ndarray:
        """The matrix of sums of products of vectors of this width, one after the other."""

        def product(found: list) -> np.ndarray:
            whole = np.hstack([np.frombuffer(v).reshape(-1, width) for (v,) in found])
            return whole.T @ whole

        return _added(_together(self.parts, *map(self.read, vectors)).mapValues(product))

    def turned(self, vectors: list[DataFrame], width: int, by: np.ndarray, name: str = "turned", lasting: bool = False) -> DataFrame:
        """The vectors, one after the other, times a small matrix."""

        def turn(found: list) -> np.ndarray:
            return np.hstack([np.frombuffer(v).reshape(-1, width) for (v,) in found]) @ by

        return self.kept(_together(self.parts, *map(self.read, vectors)).mapValues(turn), name, lasting)

    def _keyed(self, vectors: DataFrame, side: str, names: list[str]) -> DataFrame:
        """A row with numbers of these names for each of the blocks' ``rows`` or ``columns``."""
        kind = self.table.schema[side].dataType.elementType.simpleString()

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    numbers = np.frombuffer(batch.column("vectors")[at].as_py()).reshape(-1, len(names)).T
                    columns = [batch.column("key")[at].values, *map(pa.array, np.ascontiguousarray(numbers))]
                    yield pa.RecordBatch.from_arrays(columns, ["key", *names])

        ids = self.spark.createDataFrame(list(enumerate(self.ids)), "number int, block bigint")
        met = vectors.join(ids, "number").join(self.table.select("block", F.col(side).alias("key")), "block")
        # About one block a task, for a task's rows come to Python together.
        met = met.select("key", "vectors", "number").repartition(self.parts, "number")
        return met.select("key", "vectors").mapInArrow(spread, ", ".join([f"key {kind}", *[f"{n} double" for n in names]]))

    def by_row(self, vectors: DataFrame, names: list[str]) -> DataFrame:
        """``row`` and its vector."""
        return self._keyed(vectors, "rows", names).withColumnRenamed("key", "row")

    def by_column(self, vectors: DataFrame, names: list[str]) -> DataFrame:
        """``column`` and its image of vectors of the rows under the transpose."""
        data = _together(self.parts, self.blocks, self.read(vectors))

        def image(found: list) -> np.ndarray:
            (data,), (held,) = found
            block = _Block(data)
            return block.by_column(_vectors(held, block.rows))

        found = self._keyed(self.kept(data.mapValues(image), "sums"), "columns", names)
        return found.groupBy(F.col("key").alias("column")).agg(*[F.sum(n).alias(n) for n in names])


def truncated_svd(
    entries: DataFrame | Callable[[], DataFrame], row: str, column: str, value: str, size: int, spare: int = SPARE,
    depth: int = DEPTH, passes: int = PASSES, tolerance: float = TOLERANCE,
) -> Factors:
    """The ``size`` leading factors of the matrix that the entries make up.

    What a function that makes the entries keeps goes when they are laid out.
    """
    spark = entries.sparkSession if isinstance(entries, DataFrame) else SparkSession.getActiveSession()
    with scratch(spark):
        with scratch(spark):
            made = entries if isinstance(entries, DataFrame) else entries()
            x = F.col(value).cast("double")
            fits = F.col(row).isNotNull() & F.col(column).isNotNull() & x.isNotNull() & (F.abs(x) < float("inf"))
            own = made.where(fits).select(F.col(row).alias("row"), F.col(column).alias("column"), x.alias("value"))
            own = keep(own.where("value != 0"), "entries")
            count = own.count()
            # What made the entries has left its shuffle files.
            release(spark)
            blocks = _packed(own, count) if count else None
        release(spark)
        matrix = _Matrix(blocks) if count else None
        width, found, moved = size + spare, np.zeros(0), float("inf")
        if matrix is not None:
            keys = matrix.table.select(F.explode("columns").alias("column")).distinct()
            start = _names("v0_", width)
            begun = _products(keys.selectExpr(*_start_of("column", width)), start, start)
        # Vectors of the rows whose images are those of the columns that a pass begins with; the start has none.
        block = None
        for at in range(passes if matrix is not None else 0):
            # A pass leaves the next block alone: its images are deleted when that is written.
            with scratch(spark):
                images = [matrix.first(width) if block is None else matrix.times(block)]
                while len(images) < depth:
                    images.append(matrix.times(images[-1]))
                held = images if block is None else [block, *images]
                products = matrix.products(held, width)
                # Products of columns' vectors: those of the rows' of one with the next image of the other.
                later = products[-depth * width:, -depth * width:]
                if block is None:
                    whole = np.zeros_like(later)
                    whole[:width, :width], whole[width:, :] = begun, later[:-width, :]
                    whole[:width, width:] = whole[width:, :width].T
                else:
                    whole = products[: depth * width, width:]
                squares, turn = _best(whole, later)
                squares, turn = squares[: size + spare], turn[:, : size + spare]
                real = squares > max(squares.max(initial=0.0), 0.0) * _RANK
                squares, turn = squares[real], turn[:, real]
                now = np.sqrt(squares[:size])
                moved = float(np.abs(now - found).max(initial=0.0) / now.max(initial=1e-300)) if len(now) == len(found) else float("inf")
                found = now
                ended = moved <= tolerance or not len(now)
                if len(found) and (ended or at == passes - 1):
                    best, names = turn[:, : len(found)], _names("f", len(found))
                    left = matrix.turned(images, width, best, "left", lasting=True)
                    # The start is known by the columns' keys alone.
                    own_start = best[:width] if block is None else np.zeros((width, len(found)))
                    rest = held[: depth - 1] if block is None else held[:depth]
                    right = None
                    if rest:
                        right = matrix.by_column(matrix.turned(rest, width, best[width:] if block is None else best), names)
                    if block is None:
                        keyed = keys.selectExpr("column", *_start_of("column", width))
                        zeros = [F.lit(0.0).alias(n) for n in names]
                        keyed = keyed.select("*", *zeros) if right is None else keyed.join(right, "column")
                        right = _turned(keyed, "column", [*start, *names], np.vstack([own_start, np.eye(len(found))]), "f")
                    right = keep(right, "right", lasting=True)
                elif not ended:
                    # Images of the factors found, each by its value shorter: never near to each other.
                    block = matrix.turned(images, width, turn / squares, "block", lasting=True)
                    width = len(squares)
            release(spark)
            if ended:
                break
        if not len(found):
            none = spark.createDataFrame([], StructType([*own.schema.fields[:2], StructField("factors", ArrayType(DoubleType()))]))
            return Factors((), *(
                keep(none.select(F.col(a).alias(b), "factors"), "factors", lasting=True) for a, b in (("row", row), ("column", column))
            ), 0.0)
        # What rounding left of products between different factors goes here.
        size_of, way = np.linalg.eigh(_symmetric(_products(right, names, names)))
        exact = way / np.sqrt(size_of) @ way.T
        right = keep(_turned(right, "column", names, exact, "f"), "orthonormal")
        cubes = right.agg(*[F.expr(f"sum(pow({n}, 3))").alias(n) for n in names]).first()
        signs = np.diag([-1.0 if c < 0 else 1.0 for c in cubes])
        right = keep(_turned(right, "column", names, signs, "f"), "signed")
        left = matrix.by_row(matrix.turned([left], len(found), exact @ signs / found), names)
        return Factors(
            tuple(float(x) for x in found),
            keep(left.select(F.col("row").alias(row), F.array(*names).alias("factors")), "rows", lasting=True),
            keep(right.select(F.col("column").alias(column), F.array(*names).alias("factors")), "columns", lasting=True),
            moved,
        )
