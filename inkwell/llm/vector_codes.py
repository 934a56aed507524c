"""Product codes of vectors: learned codebooks for each part, assignments through ball trees.

Components are scaled to integers, ``floor(SCALE * x)``, and vectors cut into equal consecutive
parts. Each part position has a codebook, which starts as that part of the vectors with
the smallest keys. A round assigns every part to the nearest entry (squared Euclidean distance, ties
to the lower index) and moves each entry to the componentwise floor of its parts' mean; an
entry without parts stays. All distances that decide, and all sums, are exact integers.

Vectors are handled in blocks of ``BLOCK``, and a block has a metric tree for each part position,
built once from its middle: anchors are chosen furthest first, each taking the points nearer
to it than to their anchor (points closer to theirs than half the gap between both are not even
looked at), until there are about sqrt(n); anchors are joined in pairs, the smallest ball
first, up to a root, and each anchor's points are divided in the same way, down to leaves.
Every ball caches the sum and number of its points.

A round goes down the trees with a list of entries that may own points of a ball. A child inherits
its parent's list; an entry further from the centre than the nearest one plus the ball's
diameter goes. A ball with one entry left is wholly owned and adds its cached sum and
number; only in leaves are points compared with the entries left. Blocks and their trees are a kept
table, read once a round; sums meet by part and entry, one row a task for each.

Defined results: rows whose vector is null, holds a null, NaN or infinite component or one beyond
``LARGEST`` take no part (distances would not fit a long), nor do vectors whose length is not that
of the smallest key's vector; that has a multiple of the number of parts. Null keys come last.
Rows with equal keys are ordered by their vectors. With fewer vectors than entries the codebook
has one entry for each. Repeated rows get equal codes. Other columns are returned as they are,
those named like the results are replaced. An empty table gives no rows and no codebooks.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.shipping import map_batches
from inkwell.session import keep

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Largest absolute value of a component.
LARGEST = float(1 << 20)
#: Vectors that share their trees, and the most points of a leaf that are not all equal.
BLOCK, LEAF = 4096, 12


class Compressed(NamedTuple):
    rows: DataFrame
    """The rows with ``code`` (a byte for each part) and ``error`` (squared distance)."""
    codebooks: np.ndarray
    """Integer components by part, entry and position."""


def usable(vector: str) -> Column:
    """Whether a vector takes part."""
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= LARGEST))
    return F.coalesce(fits, F.lit(False))


# Trees


def _anchors(points: np.ndarray, wanted: int) -> np.ndarray:
    """The anchor that owns each point."""
    owner = np.zeros(len(points), np.int64)
    distance = np.sqrt(((points - points[0]) ** 2).sum(1))
    pivots = points[:1]
    while len(pivots) < wanted:
        far = int(distance.argmax())
        if distance[far] == 0:
            break
        gaps = np.sqrt(((pivots - points[far]) ** 2).sum(1))
        near = np.flatnonzero(distance > gaps[owner] / 2)
        new = np.sqrt(((points[near] - points[far]) ** 2).sum(1))
        won = new < distance[near]
        owner[near[won]], distance[near[won]] = len(pivots), new[won]
        pivots = np.concatenate([pivots, points[far : far + 1]])
    return owner


class _Grower:
    """The tree of one part position: children of each node, points of each leaf."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.children: list[tuple[int, int]] = []
        self.leaves: dict[int, np.ndarray] = {}
        self.balls: list[tuple[np.ndarray, float, int]] = []
        self.root = self.grow(np.arange(len(points)))

    def _add(self, children: tuple[int, int], ball: tuple[np.ndarray, float, int]) -> int:
        self.children.append(children)
        self.balls.append(ball)
        return len(self.balls) - 1

    def grow(self, at: np.ndarray) -> int:
        points = self.points[at]
        owner = _anchors(points, int(np.ceil(np.sqrt(len(at))))) if len(at) > LEAF else np.zeros(len(at), np.int64)
        if owner.any():
            order = np.argsort(owner, kind="stable")
            groups = np.split(at[order], np.flatnonzero(np.diff(owner[order])) + 1)
            return self.join([self.grow(group) for group in groups])
        centre = points.mean(0)
        node = self._add((-1, -1), (centre, float(np.sqrt(((points - centre) ** 2).sum(1)).max()), len(at)))
        self.leaves[node] = at
        return node

    def join(self, nodes: list[int]) -> int:
        """One tree over the given ones, joining the two that fit the smallest ball first."""
        centres = np.array([self.balls[i][0] for i in nodes])
        radii = np.array([self.balls[i][1] for i in nodes])
        counts = np.array([self.balls[i][2] for i in nodes])
        nodes, size = list(nodes), len(nodes)
        cost = np.sqrt(((centres[:, None] - centres) ** 2).sum(2)) + radii[:, None] + radii
        np.fill_diagonal(cost, np.inf)
        for _ in range(size - 1):
            i, j = divmod(int(cost.argmin()), size)
            centre = (centres[i] * counts[i] + centres[j] * counts[j]) / (counts[i] + counts[j])
            gaps = np.sqrt(((centres[[i, j]] - centre) ** 2).sum(1))
            radius, count = float((gaps + radii[[i, j]]).max()), int(counts[i] + counts[j])
            nodes[i] = self._add((nodes[i], nodes[j]), (centre, radius, count))
            centres[i], radii[i], counts[i] = centre, radius, count
            cost[j], cost[:, j] = np.inf, np.inf
            left = np.isfinite(cost[i])
            line = np.where(left, np.sqrt(((centres - centre) ** 2).sum(1)) + radii + radius, np.inf)
            cost[i], cost[:, i] = line, line
        return nodes[i] if size > 1 else nodes[0]

    def laid_out(self) -> tuple[np.ndarray, ...]:
        """Order of the points in which every node is a slice; left, right, start, end and
        level of each node, the root first."""
        order, table, numbers, place = [], [], {}, 0
        stack = [(self.root, 0, -1)]
        while stack:
            node, level, parent = stack.pop()
            numbers[node] = len(table)
            if parent >= 0:
                table[parent][0 if table[parent][0] < 0 else 1] = len(table)
            count = self.balls[node][2]
            table.append([-1, -1, place, place + count, level])
            if node in self.leaves:
                order.append(self.leaves[node])
                place += count
            else:
                a, b = self.children[node]
                stack += [(b, level + 1, numbers[node]), (a, level + 1, numbers[node])]
        return np.concatenate(order), np.array(table, np.int64)


class Forest:
    """A block's vectors and the trees of all part positions.

    ``parts`` are integers by part, vector and position; ``order`` lists vectors so that each
    ball is a slice. Nodes of all trees are in one table, ``roots`` first nodes by part.
    """

    FIELDS = ("parts", "order", "roots", "part", "left", "right", "start", "end", "sums", "radius")

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)
        self.count = self.end - self.start
        self.centre = self.sums / self.count[:, None]

    @classmethod
    def grown(cls, vectors: np.ndarray, parts: int) -> Forest:
        cut = np.ascontiguousarray(vectors.reshape(len(vectors), parts, -1).swapaxes(0, 1))
        orders, tables, sums, radii, roots, at = [], [], [], [], [], 0
        for p, points in enumerate(cut):
            order, table = _Grower(points).laid_out()
            total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), points[order].cumsum(0)])
            node_sum = total[table[:, 3]] - total[table[:, 2]]
            centre = node_sum / (table[:, 3] - table[:, 2])[:, None]
            radius = np.zeros(len(table))
            for level in range(table[:, 4].max() + 1):
                # Nodes of one level are disjoint slices, in order.
                own = np.flatnonzero(table[:, 4] == level)
                count = table[own, 3] - table[own, 2]
                first = np.cumsum(count) - count
                at_point = np.repeat(table[own, 2] - first, count) + np.arange(count.sum())
                away = points[order[at_point]] - np.repeat(centre[own], count, axis=0)
                radius[own] = np.maximum.reduceat(np.sqrt((away**2).sum(1)), first)
            table[:, :2] += np.where(table[:, :2] >= 0, at, 0)
            roots.append(at)
            at += len(table)
            orders.append(order)
            tables.append(np.column_stack([np.full(len(table), p), table[:, :4]]))
            sums.append(node_sum)
            radii.append(radius)
        part, left, right, start, end = np.concatenate(tables).T
        return cls(
            parts=cut, order=np.array(orders), roots=np.array(roots), part=part, left=left, right=right,
            start=start, end=end, sums=np.concatenate(sums), radius=np.concatenate(radii),
        )

    def pack(self) -> bytes:
        small = {"parts", "order", "roots", "part", "left", "right", "start", "end", "sums"}
        out = io.BytesIO()
        np.savez(out, **{f: _narrow(getattr(self, f)) if f in small else getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def unpack(cls, packed: bytes) -> Forest:
        with np.load(io.BytesIO(packed)) as data:
            return cls(**{f: data[f] if f == "radius" else data[f].astype(np.int64) for f in cls.FIELDS})

    def owners(self, codebooks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(nodes, entries) of wholly owned balls; (part, place in order, entry) of single points.

        Yields (nodes, entries, None, None) and (parts, entries, places, vectors' numbers).
        """
        entries, books = codebooks.shape[1], codebooks.astype(np.float64)
        nodes = self.roots
        first = np.arange(len(nodes) + 1) * entries
        listed = np.tile(np.arange(entries), len(nodes))
        while len(nodes):
            # ``listed`` holds the entries of node i from first[i] to first[i + 1], ascending.
            at = np.repeat(np.arange(len(nodes)), np.diff(first))
            away = self.centre[nodes[at]] - books[self.part[nodes[at]], listed]
            distance = np.sqrt((away**2).sum(1))
            best = np.minimum.reduceat(distance, first[:-1])
            limit = (best + 2 * self.radius[nodes]) * (1 + 1e-9) + 1e-6
            stay = distance <= limit[at]
            at, listed = at[stay], listed[stay]
            left = np.bincount(at, minlength=len(nodes))
            owned = left == 1
            yield nodes[owned], listed[owned[at]], None, None
            leaf = ~owned & (self.left[nodes] < 0)
            if leaf.any():
                yield self._points(codebooks, nodes[leaf], left[leaf], listed[leaf[at]])
            inner = ~owned & ~leaf
            lists, sizes = listed[inner[at]], left[inner]
            # Both children inherit the list: once for the left ones, once for the right ones.
            nodes = np.concatenate([self.left[nodes[inner]], self.right[nodes[inner]]])
            listed = np.concatenate([lists, lists])
            first = np.concatenate([[0], np.cumsum(np.concatenate([sizes, sizes]))])

    def _points(self, codebooks, nodes, left, listed):
        """Nearest listed entry of each point in the given leaves."""
        first = np.cumsum(left) - left
        count = self.count[nodes]
        node = np.repeat(np.arange(len(nodes)), count)
        place = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count) + self.start[nodes][node]
        part = self.part[nodes][node]
        number = self.order[part, place]
        # Each point with each entry of its leaf, entries ascending.
        many = left[node]
        begin = np.cumsum(many) - many
        point = np.repeat(np.arange(len(node)), many)
        entry = listed[np.arange(len(point)) - np.repeat(begin, many) + np.repeat(first[node], many)]
        away = self.parts[part[point], number[point]] - codebooks[part[point], entry]
        distance = (away**2).sum(1)
        least = np.minimum.reduceat(distance, begin)
        hit = np.flatnonzero(distance == least[point])
        # The first hit of a point is its lowest entry.
        chosen = hit[np.searchsorted(hit, begin)]
        return part, entry[chosen], place, number

    def totals(self, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the parts of each entry."""
        sums = np.zeros(codebooks.shape, np.int64)
        counts = np.zeros(codebooks.shape[:2], np.int64)
        for at, entry, _, number in self.owners(codebooks):
            if number is None:
                np.add.at(sums, (self.part[at], entry), self.sums[at])
                np.add.at(counts, (self.part[at], entry), self.count[at])
            else:
                np.add.at(sums, (at, entry), self.parts[at, number])
                np.add.at(counts, (at, entry), 1)
        return sums, counts

    def codes(self, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each part by vector, and each vector's squared distance."""
        found = np.empty(self.parts.shape[:2], np.int64)
        for at, entry, place, number in self.owners(codebooks):
            if number is None:
                count = self.count[at]
                node = np.repeat(np.arange(len(at)), count)
                place = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count) + self.start[at][node]
                at, entry = self.part[at][node], entry[node]
                number = self.order[at, place]
            found[at, number] = entry
        away = self.parts - codebooks[np.arange(len(found))[:, None], found]
        return found.T, (away**2).sum((0, 2))


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    low, high = (values.min(), values.max()) if values.size else (0, 0)
    return values.astype(np.promote_types(np.min_scalar_type(min(low, 0)), np.min_scalar_type(max(high, 0))))


# Jobs


def _integers(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(len(vectors), -1)


def _grow(rows: DataFrame, vector: str, others: list[str], parts: int) -> DataFrame:
    """Blocks: a struct of the other columns for each vector, and the packed forest."""
    carried = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = batch.slice(start, BLOCK)
                forest = Forest.grown(_integers(block.column(vector)), parts).pack()
                own = pa.StructArray.from_arrays([block.column(c) for c in others], others)
                rows_ = pa.ListArray.from_arrays(pa.array([0, block.num_rows], pa.int32()), own)
                yield pa.RecordBatch.from_arrays([rows_, pa.array([forest], pa.binary())], ["rows", "forest"])

    return map_batches(rows.select(*others, vector), run, f"rows array<struct<{carried}>>, forest binary")


def _forests(batch: pa.RecordBatch) -> Iterator[Forest]:
    for packed in batch.column("forest"):
        yield Forest.unpack(packed.as_py())


def _totals(blocks: DataFrame, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the parts of each entry over all blocks.

    Parts times entries rows reach the driver.
    """
    parts, entries, width = codebooks.shape
    names = [f"sum_{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for forest in _forests(batch):
                more, count = forest.totals(codebooks)
                sums, counts = sums + more, counts + count
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "n", *names])

    schema = "part bigint, entry bigint, n bigint, " + ", ".join(f"{n} bigint" for n in names)
    found = map_batches(blocks.select("forest"), run, schema)
    merged = found.groupBy("part", "entry").agg(*[F.sum(n).alias(n) for n in ("n", *names)]).collect()
    sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
    for part, entry, n, *total in merged:
        sums[part, entry], counts[part, entry] = total, n
    return sums, counts


def compress(
    rows: DataFrame, key: str, vector: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Compressed:
    """Codes of all usable vectors, and the codebooks learned from all of them."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit a byte")
    kept = rows.drop("code", "error").where(usable(vector) & (F.size(vector) > 0))
    whole = kept.where(F.size(vector) % parts == 0)
    first = whole.orderBy(F.asc_nulls_last(key), vector).select(vector).limit(1).collect()
    width = len(first[0][0]) if first else parts
    kept = kept.where(F.size(vector) == width)
    start = kept.orderBy(F.asc_nulls_last(key), vector).select(vector).limit(entries).collect()
    books = np.floor(np.array([r[0] for r in start], np.float64).reshape(-1, width) * SCALE).astype(np.int64)
    books = np.ascontiguousarray(books.reshape(-1, parts, width // parts).swapaxes(0, 1))
    others = [c for c in kept.columns if c != vector]
    blocks = keep(_grow(kept, vector, others, parts), "blocks")
    for _ in range(rounds if len(start) else 0):
        sums, counts = _totals(blocks, books)
        used = counts > 0
        books[used] = sums[used] // counts[used][:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, forest in zip(batch.column("rows"), _forests(batch)):
                codes, error = forest.codes(books)
                packed = pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary())
                columns = [own.values.field(c) for c in others]
                yield pa.RecordBatch.from_arrays([*columns, packed, pa.array(error)], [*others, "code", "error"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name in others)
    return Compressed(map_batches(blocks, run, f"{schema}, code binary, error bigint"), books)


def decompress(compressed: Compressed, vector: str = "vector") -> DataFrame:
    """The rows with the vector that each code stands for, in the scale of the originals."""
    books = (compressed.codebooks / SCALE).tolist()
    parts = F.array(*[
        F.element_at(F.array(*[F.array(*[F.lit(x) for x in entry]) for entry in book]), _byte("code", p) + 1)
        for p, book in enumerate(books)
    ])
    return compressed.rows.withColumn(vector, F.flatten(parts))


def _byte(column: str, place: int) -> Column:
    return F.conv(F.hex(F.substring(column, place + 1, 1)), 16, 10).cast("int")


def written(codebooks: np.ndarray) -> str:
    """All components by part, entry and position, separated by commas."""
    return ",".join(map(str, codebooks.reshape(-1).tolist()))
