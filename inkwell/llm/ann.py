"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Equal vectors are one node of the graph, with up to ``MEMBERS`` of their ids, the smallest;
no other id of the node can be among the nearest ``k`` (ties go to smaller ids).

*Building.* Nodes that fall on the same side of some random planes start as neighbours, and
so do those of random blocks over all nodes, so that a node with no other on its side has
neighbours, too.
Then, again and again, each node's neighbours (its nearest and the nearest of those that it
is nearest to) are joined with their vectors and compared with each other: the neighbours
of a neighbour are likely neighbours. Each node keeps its ``NEIGHBOURS`` nearest. Rounds end
when distances hardly shrink any more, each by its own measure, so that a group of nearly
equal vectors counts as much as one of far ones.

*Searching.* A query starts at its own node, and each hop expands the nearest nodes of its
pool that have not been expanded, by a join with the graph. It ends when all the ``POOL``
nearest are expanded.

Nothing is rounded: graph and pool are ranked by distances of the original vectors, in
double precision and, while building, from a centre of the vectors compared.

Lists are merged by many nodes at once, first inside each task, so that a node which
very many others offer something reaches one task as a few rows from each.

Defined results: rows without an id, null, zero, or non-finite vectors, and vectors with
a null component or another length than most take no part. An id that occurs several times
counts once, with the smallest of its vectors. Tables without a usable row give no rows.
With fewer candidates than ``k`` all are found. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.llm.shipping import map_batches, ship
from inkwell.operators.terms import top_per_group
from inkwell.session import keep

K = 10
MEMBERS = K + 1
NEIGHBOURS, REVERSE, OFFERS = 32, 24, 12
#: Nodes of a starting block, and the number of times all nodes are put into blocks.
BLOCK, STARTS = 150, 4
ROUNDS, SHRINK = 14, 0.004
POOL, EXPANDED, HOPS = 300, 60, 16
_BUNDLE = 500
EDGE = "id bigint, nbr bigint, d float"


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and embedding of the rows that take part."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    found = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"))
    found = found.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    found = found.where(F.exists("embedding", lambda x: x != 0))
    found = keep(found.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    sizes = found.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.desc("n"), "size").select("size").first()
    return found.where(F.size("embedding") == (usual["size"] if usual else 0))


def nodes(vectors: DataFrame, single: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (id, mark, code) with their vectors as bytes, members (id, vec_id) of each, and
    the mark of the vector of each vec_id.

    ``single``: the components are of single precision, so four bytes hold each as it is.
    """
    kind = np.float32 if single else np.float64

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [bytes([kind().itemsize]) + np.array(x, kind).tobytes() for x in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "code"])

    # -0.0 and 0.0 are equal components.
    plain = vectors.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    packed = map_batches(plain, pack, "vec_id bigint, code binary").withColumn("mark", F.sha2("code", 256))
    packed = keep(packed, "packed")
    marked = packed.select("vec_id", "mark")
    members = top_per_group(marked, "mark", [F.asc("vec_id")], ["vec_id"], MEMBERS)
    first = members.where("rank = 1").select("mark", F.col("vec_id").alias("id"))
    members = keep(members.join(first, "mark").select("id", "vec_id"), "members")

    found = packed.join(first.select(F.col("id").alias("vec_id")), "vec_id").select(F.col("vec_id").alias("id"), "mark", "code")
    return keep(found, "nodes"), members, marked


def _decoded(column) -> np.ndarray:
    """The vectors of codes, a row each: after a byte that says how long a component is."""
    values = column.to_pylist() if isinstance(column, pa.Array) else list(column)
    raw = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(raw[:, 1:]).view(f"f{raw[0, 0]}")


def _squares(a: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of ``a``, for each of a batch."""
    a = a.astype(np.float64)
    a -= a.mean(-2, keepdims=True)
    norms = (a * a).sum(-1)
    return np.maximum(norms[..., :, None] + norms[..., None, :] - 2 * (a @ np.swapaxes(a, -1, -2)), 0)


def _shortest(owner: np.ndarray, other: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest of each owner, equal pairs once, sorted by owner and distance."""
    order = np.lexsort((d, other, owner))
    o, t = owner[order], other[order]
    order = order[np.concatenate([[True], (o[1:] != o[:-1]) | (t[1:] != t[:-1])])] if len(order) else order
    order = order[np.lexsort((other[order], d[order], owner[order]))]
    o = owner[order]
    return order[np.arange(len(o)) - np.searchsorted(o, o) < k]


def _top(edges: DataFrame, k: int, count: int) -> DataFrame:
    """The k nearest neighbours (id, nbr, d) of each node."""

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("id", "nbr", "d")]
            yield batch.take(pa.array(_shortest(*columns, k)))

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[_shortest(rows["id"].to_numpy(), rows["nbr"].to_numpy(), rows["d"].to_numpy(), k)][["id", "nbr", "d"]]

    pruned = map_batches(edges.select("id", "nbr", "d"), few, EDGE)
    return pruned.groupBy(_bundle("id", count)).applyInPandas(last, EDGE)


def _start(found: DataFrame, count: int) -> DataFrame:
    """Edges between nodes on the same side of random planes, and in random blocks."""
    bits = max(0, math.ceil(math.log2(max(1, count / BLOCK))))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _decoded(batch.column("code"))
                for start in range(STARTS):
                    planes = np.random.default_rng([7, start]).normal(size=(vectors.shape[1], max(1, bits)))
                    side = ((vectors @ planes) > 0) @ (1 << np.arange(max(1, bits))) if bits else np.zeros(len(vectors), int)
                    cell = side.astype(np.int64) * STARTS + start
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("code"), pa.array(cell)], ["id", "code", "cell"])
                # One cell of all nodes, which is cut into blocks of many nodes each.
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("code"), pa.array(np.full(len(vectors), -1))], ["id", "code", "cell"])

    cells = map_batches(found, sides, "id bigint, code binary, cell bigint")
    # A cell with many nodes is cut into blocks by a hash, so any cell is done by many tasks.
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("blocks"))
    block = F.pmod(F.xxhash64("id", "cell"), F.col("blocks"))
    blocks = cells.join(sizes, "cell").withColumn("block", block).drop("blocks")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        ids, d = rows["id"].to_numpy(), _squares(_decoded(rows["code"]))
        np.fill_diagonal(d, np.inf)
        k = min(NEIGHBOURS, len(ids) - 1)
        if k < 1:
            return _edges([], [], [])
        best = np.argpartition(d, k - 1, axis=1)[:, :k]
        return _edges(np.repeat(ids, k), ids[best].ravel(), np.take_along_axis(d, best, 1).ravel())

    return _top(blocks.groupBy("cell", "block").applyInPandas(compare, EDGE), NEIGHBOURS, count)


def _edges(ids, others, d) -> pd.DataFrame:
    return pd.DataFrame({"id": np.asarray(ids, np.int64), "nbr": np.asarray(others, np.int64), "d": np.asarray(d, np.float32)})


def _around(graph: DataFrame, count: int) -> DataFrame:
    """(id, nbr) of each node: its nearest, and the nearest of those that it is nearest to."""
    turned = graph.select(F.col("nbr").alias("id"), F.col("id").alias("nbr"), "d")
    return graph.select("id", "nbr").unionByName(_top(turned, REVERSE, count).select("id", "nbr"))


def _local_joins(rows: pd.DataFrame) -> pd.DataFrame:
    """Compare the neighbours of each node; offers that would improve a neighbour's list."""
    rows = rows.drop_duplicates(["id", "nbr"]).sort_values(["id", "nbr"])
    owner, nbr, radius = rows["id"].to_numpy(), rows["nbr"].to_numpy(), rows["radius"].to_numpy(np.float32)
    vectors = _decoded(rows["code"])
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    sizes = np.diff([*starts, len(owner)])
    width = int(sizes.max())
    offers = min(OFFERS, width)
    out = [(nbr[:0], nbr[:0], radius[:0])]
    for at in range(0, len(starts), 256):
        place = starts[at : at + 256, None] + np.arange(width)
        there = np.arange(width) < sizes[at : at + 256, None]
        place = np.where(there, place, 0)
        d = _squares(vectors[place])
        d[~(there[:, :, None] & there[:, None, :])] = np.inf
        d[:, np.arange(width), np.arange(width)] = np.inf
        best = np.argpartition(d, offers - 1, axis=2)[:, :, :offers]
        near = np.take_along_axis(d, best, 2)
        # Rounding gives a known neighbour a slightly smaller distance now and then.
        group, row, column = np.nonzero(near < radius[place][:, :, None] * np.float32(1 - 1e-6))
        if len(group):
            mine, other = place[group, row], place[group, best[group, row, column]]
            out.append((nbr[mine], nbr[other], near[group, row, column]))
    found = list(map(np.concatenate, zip(*out)))
    kept = _shortest(*found, NEIGHBOURS)
    return _edges(*[x[kept] for x in found])


def _bundle(key: str, count: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(count // _BUNDLE + 1)).alias("bundle")


def build(found: DataFrame) -> DataFrame:
    """The graph (id, nbr, d) of nodes (id, code), d the squared distance."""
    count = found.count()
    ship(found.sparkSession)
    graph, total = keep(_start(found, count), "graph"), None
    for _ in range(ROUNDS):
        full = F.when(F.count("*") >= NEIGHBOURS, F.max("d")).alias("radius")
        known = found.join(graph.groupBy("id").agg(full), "id", "left").select(
            F.col("id").alias("nbr"), "code", F.coalesce("radius", F.lit(float("inf")).cast("float")).alias("radius")
        )
        around = _around(graph, count).join(known, "nbr").select(_bundle("id", count), "id", "nbr", "code", "radius")
        offers = around.groupBy("bundle").applyInPandas(_local_joins, EDGE)
        graph = keep(_top(graph.unionByName(offers), NEIGHBOURS, count), "graph")
        size = graph.agg(F.avg(F.log(F.greatest("d", F.lit(1e-37)))).alias("d"), F.count("*").alias("n")).first()
        new = (size["n"], size["d"] or 0.0)
        # Longer lists are progress, too.
        if total is not None and new[0] == total[0] and new[1] >= total[1] - SHRINK:
            break
        total = new
    return graph


def _with_distance(pairs: DataFrame, found: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, id and d (the distance) of pairs (query_id, id)."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = _decoded(batch.column("code")).astype(np.float64) - _decoded(batch.column("query"))
                d = np.sqrt((apart * apart).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(d)], ["query_id", "id", "d"])

    both = pairs.join(found.select("id", "code"), "id").join(queries.select("query_id", F.col("code").alias("query")), "query_id")
    return map_batches(both.select("query_id", "id", "code", "query"), turn, "query_id bigint, id bigint, d double")


def search(queries: DataFrame, found: DataFrame, graph: DataFrame, count: int) -> DataFrame:
    """query_id, id and d of the ``POOL`` nearest nodes found of each query (query_id, id, code).

    ``state`` of a node in a pool: 0 not expanded, 1 to be expanded in the next hop, 2 expanded.
    """
    # A node has at most NEIGHBOURS + REVERSE links.
    links = _around(graph, count).groupBy("id").agg(F.collect_set("nbr").alias("nbrs"))
    links = keep(links, "links")
    state = "query_id bigint, id bigint, d double, state int"
    pool = keep(queries.select("query_id", "id", F.lit(0.0).alias("d"), F.lit(1).alias("state")), "pool")
    size = queries.count()

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("state", ascending=False, kind="stable").drop_duplicates(["query_id", "id"])
        rows = rows.iloc[_shortest(rows["query_id"].to_numpy(), rows["id"].to_numpy(), rows["d"].to_numpy(), POOL)]
        states, owners = rows["state"].to_numpy().copy(), rows["query_id"].to_numpy()
        waiting = np.flatnonzero(states == 0)
        order = np.arange(len(waiting)) - np.searchsorted(owners[waiting], owners[waiting])
        states[waiting[order < EXPANDED]] = 1
        return rows[["query_id", "id", "d"]].assign(state=states)

    for _ in range(HOPS):
        front = pool.where("state = 1").select("query_id", "id")
        met = front.join(links, "id").select("query_id", F.explode("nbrs").alias("id")).distinct()
        new = _with_distance(met, found, queries).withColumn("state", F.lit(0))
        old = pool.withColumn("state", F.when(F.col("state") == 1, 2).otherwise(F.col("state")))
        bundle = F.pmod(F.xxhash64("query_id"), F.lit(size // 64 + 1)).alias("bundle")
        pool = keep(old.unionByName(new).groupBy(bundle).applyInPandas(merge, state), "pool")
        if pool.where("state = 1").isEmpty():
            break
    return pool.select("query_id", "id", "d")


def nearest(rows: DataFrame, wanted: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of each row that ``wanted`` chooses.

    ``wanted`` is a condition on vec_id. A row is not its own neighbour.
    """
    if k >= MEMBERS:
        raise ValueError(f"k is at most {K}")
    single = rows.schema[vector].dataType == T.ArrayType(T.FloatType(), rows.schema[vector].dataType.containsNull)
    found, members, marked = nodes(usable(rows, key, vector), single)
    graph = build(found.select("id", "code"))
    # A query's vector is that of its node; ids beyond MEMBERS are queries, too, though no results.
    queries = marked.where(wanted).withColumnRenamed("vec_id", "query_id").join(found, "mark").drop("mark")
    queries = keep(queries, "queries")
    pool = search(queries, found, graph, found.count())
    offers = pool.join(members, "id").where("vec_id <> query_id").select("query_id", "vec_id", F.col("d").alias("score"))
    best = top_per_group(offers, "query_id", [F.asc("score"), F.asc("vec_id")], ["vec_id"], k, salts=1)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
