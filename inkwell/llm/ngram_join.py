"""N-gram Jaccard self-join by chosen paths, and the classes of near copies it gives.

Documents are sets of shingles (five words in a row, lower case). Two documents are
linked if the Jaccard similarity of their sets is ``THRESHOLD`` or more. Equal sets are one
*text*, told apart by a 128-bit mark and numbered; everything below works on these numbers, and
document keys come back at the end.

1. Every set is mapped to ``POSITIONS`` tokens (minimum hashes), of which two sets share each
   with a probability equal to their similarity.
2. Chosen-path tree: a bucket of documents is split by a few random positions, one child for
   each shared token there. A pair at the threshold shares ``BRANCH`` chosen tokens on average,
   so it survives any number of levels with a fixed probability; the tree is run several times
   until the wanted recall is reached. Buckets of ``SMALL`` or fewer documents are not split.
3. A small bucket is solved by brute force on one-byte sketches of the tokens: a leader is
   compared with the whole bucket, and all that may be linked to it, or to one that may be
   linked to it, join its candidate group; those far inside the group need not lead
   themselves, as the triangle inequality of the Jaccard distance shows. A bucket that stays
   large at the last level (a very large group of near copies) is cut into blocks, and every
   two blocks are solved together. No bucket is dropped, capped or sampled.
4. Candidate groups are united to connected components. Every pair within a component is
   verified by the exact similarity of whole sets, in tiles of bounded size, so a link is
   found if any chain of buckets connects its ends. Tiles return numbers of links and the
   few links that connect a tile, never all pairs.

Defined results: a text without words (null and empty ones, too) has no shingles and is
linked to nothing: its class is itself. A text of one to four words has one shingle, of
all its words. Rows without a key get a null class and no links, and count for nobody.
Rows under one key, with equal or different texts, count as often as they occur. Columns other
than key and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm import textnum
from inkwell.llm.shipping import map_batches, ship
from inkwell.llm.sieve import sieve
from inkwell.session import keep, scratch

SHINGLE, THRESHOLD = 5, 0.8
POSITIONS, BRANCH, LEVELS, SMALL = 128, 2.0, 3, 1000
RECALL = 0.999
#: A block of a bucket that stays large has about so many documents.
BLOCK = 2000
#: A tile's side weighs about so much; a document weighs its shingles and ``WEIGHT``.
TILE, WEIGHT = 250_000, 250
#: Small buckets are put together for one call up to about so many rows.
BUNDLE = 4_000
#: Similarities estimated from POSITIONS tokens are off by this, 4 standard deviations.
SLACK = 0.14


def runs_needed(recall: float = RECALL, branch: float = BRANCH, levels: int = LEVELS) -> int:
    """Runs of the tree until a pair at the threshold meets with probability ``recall``."""
    alive = 1.0
    for _ in range(levels):  # a branching process with a Poisson number of children
        alive = 1 - math.exp(-branch * alive)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - alive)))


def _min_hashes(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """POSITIONS minimum hashes of each (non-empty) set."""
    starts = np.concatenate([[0], ends[:-1]])
    low = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    rng = np.random.default_rng(3)
    out = np.empty((POSITIONS, len(ends)), np.uint32)
    for k, (a, b) in enumerate(rng.integers(1, 1 << 31, (POSITIONS, 2), dtype=np.uint32)):
        # Multiply and shift in 32 bits; the xor of both halves of a 64-bit hash is hashed.
        mixed = (low ^ (low >> np.uint32(15))) * (a * np.uint32(2) + np.uint32(1)) + b
        mixed ^= mixed >> np.uint32(13)
        out[k] = np.minimum.reduceat(mixed * np.uint32(0x9E3779B1), starts)
    return out.T


def features(documents: DataFrame, key: str) -> DataFrame:
    """key, s1, s2 (128-bit mark of the shingle set), n (its size) and tokens of each row.

    ``n`` is 0 for a row without a key or a word.
    """
    kind = documents.schema[key].dataType.simpleString()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keyed = batch.column(key).is_valid().to_pylist()
            texts = [t if k else None for t, k in zip(batch.column("text").to_pylist(), keyed)]
            for first, held in textnum.slices(texts):
                found, ends = textnum.shingle_sets(held, SHINGLE)
                sizes = np.diff(ends, prepend=0)
                some = np.flatnonzero(sizes)
                marks, tokens = np.zeros((2, len(held)), np.uint64), [b""] * len(held)
                if len(some):
                    starts = (ends - sizes)[some]
                    for seed in (0, 1):
                        marks[seed, some] = np.add.reduceat(textnum.mix(found, seed + 1), starts)
                    for i, row in zip(some, _min_hashes(found, ends[some])):
                        tokens[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(held)),
                        pa.array(marks[0].view(np.int64)),
                        pa.array(marks[1].view(np.int64)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(tokens, pa.binary()),
                    ],
                    [key, "s1", "s2", "n", "tokens"],
                )

    schema = f"`{key}` {kind}, s1 bigint, s2 bigint, n bigint, tokens binary"
    return map_batches(documents.select(key, "text"), turn, schema)


def _chosen(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and path of each child of the given paths, one for each row of ``tokens``."""
    limit = np.uint64(int(BRANCH / (THRESHOLD * POSITIONS) * (1 << 32)))
    place = np.arange(POSITIONS, dtype=np.uint64)[None, :]
    chosen = (textnum.mix(textnum.mix(paths)[:, None] + place) >> np.uint64(32)) < limit
    row, position = np.nonzero(chosen)
    return row, textnum.mix(textnum.mix(paths[row] + position.astype(np.uint64), 4) + tokens[row, position])


def _token_rows(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, 2000):
        part = batch.slice(at, 2000)
        yield part, np.frombuffer(b"".join(part.column("tokens").to_pylist()), np.uint32).reshape(-1, POSITIONS)


def rooted(texts: DataFrame, runs: int) -> DataFrame:
    """id, sketch and paths at the first level of all runs, from id and tokens."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, tokens in _token_rows(batch):
                found = [_chosen(np.full(part.num_rows, r + 1, np.uint64), tokens) for r in range(runs)]
                row = np.concatenate([f[0] for f in found])
                order = np.argsort(row, kind="stable")
                paths = np.concatenate([f[1] for f in found])[order].view(np.int64)
                ends = np.searchsorted(row[order], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array([t.tobytes() for t in tokens.astype(np.uint8)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(paths)),
                    ],
                    ["id", "sketch", "paths"],
                )

    return map_batches(texts.select("id", "tokens"), turn, "id bigint, sketch binary, paths array<bigint>")


def _children(rows: DataFrame) -> DataFrame:
    """Split buckets: (path, id, tokens) to the paths of the chosen positions."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, tokens in _token_rows(batch):
                row, child = _chosen(part.column("path").to_numpy().view(np.uint64), tokens)
                if len(row):
                    ids = part.column("id").take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), ids], ["path", "id"])

    return map_batches(rows.select("path", "id", "tokens"), turn, "path bigint, id bigint")


def _groups(sketches: np.ndarray) -> np.ndarray:
    """For each sketch the first position of its candidate group."""
    label = np.arange(len(sketches))
    leads = np.ones(len(sketches), bool)
    # A member is linked to documents at a distance of 1 - THRESHOLD; what is so near to
    # one of those that it may be linked to it is at most twice as far.
    outer, inner = 2 * THRESHOLD - 1 - SLACK, THRESHOLD + SLACK
    for i in range(len(sketches)):
        if not leads[i]:
            continue
        alike = (sketches == sketches[i]).mean(1)
        leads[alike >= inner] = False
        met = np.unique(label[alike >= outer])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
            if not label.any():
                break  # all are one group already
    return label


def _solve(buckets: DataFrame, bundle: list[str]) -> DataFrame:
    """Links (u, v) that connect the candidate groups of each bucket: (path, id, sketch)."""

    def turn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["path", "id"]).sort_values(["path", "id"])
        keys, paths = rows["id"].to_numpy(), rows["path"].to_numpy()
        sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(keys), POSITIONS)
        starts = np.flatnonzero(np.concatenate([[True], paths[1:] != paths[:-1]]))
        root = np.arange(len(keys))
        for a, b in zip(starts, [*starts[1:], len(keys)]):
            if b - a > 1:
                root[a:b] = a + _groups(sketches[a:b])
        joined = root != np.arange(len(keys))
        return pd.DataFrame({"u": keys[root[joined]], "v": keys[joined]})

    ship(buckets.sparkSession)
    return buckets.groupBy(*bundle).applyInPandas(turn, "u bigint, v bigint")


def candidate_pairs(texts: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs (u, v) whose connected components hold every link of ``texts`` (id, sketch, paths).

    ``texts`` is read several times, so pass a kept table; ``tokens`` (id, tokens) is read
    only where buckets have to be split.
    """
    sketches, live = texts.select("id", "sketch"), texts.select("id", F.explode("paths").alias("path"))
    solved, large = [], None
    for level in range(1, LEVELS + 1):
        sizes = keep(live.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
        small, large = F.col("size") <= SMALL, F.col("size") > SMALL
        counted = sizes.agg(F.sum(F.when(small, F.col("size"))).alias("rows"), F.count_if(large).alias("large")).first()
        # Paths with one text are left behind here, before anything is written.
        several = live.join(sizes, "path")
        bundle = F.pmod(F.xxhash64("path"), F.lit((counted["rows"] or 0) // BUNDLE + 1)).alias("bundle")
        rows = several.where(small).join(sketches, "id").select(bundle, "path", "id", "sketch")
        solved.append(_solve(rows, ["bundle"]))
        large = keep(several.where(large), "large") if counted["large"] else None
        if large is None:
            break
        if level < LEVELS:
            live = keep(_children(large.join(tokens, "id")), "paths")
    if large is not None:
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        rows = large.join(sketches, "id").withColumn("side", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        rows = rows.select("path", "id", "sketch", F.explode(_tiles(blocks, F.col("side"))).alias("tile"))
        solved.append(_solve(rows, ["path", "tile"]))
    pairs = solved[0]
    for more in solved[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def _tiles(blocks: Column, side: Column) -> Column:
    """All pairs (i, j), i <= j, of a row's block with a block; with itself only if it is alone."""
    other = F.filter(F.sequence(F.lit(0), blocks - 1), lambda b: (b != side) | (blocks == 1))
    return F.transform(other, lambda b: F.struct(F.least(b, side).alias("i"), F.greatest(b, side).alias("j")))


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """key and component (its smallest key) of each end of the pairs.

    Each round gives every key the smallest label among itself, its neighbours and its
    label's label. A key with very many neighbours is cut by the skew join, and labels
    are summed up before they are shuffled. Each round is written to the shared folder.
    """
    both = keep(pairs.union(pairs.select("v", "u")).toDF("key", "other").distinct(), "pairs")
    labels = keep(both.groupBy("key").agg(F.least(F.col("key"), F.min("other")).alias("label")), "labels")
    for _ in range(rounds):
        heard = both.join(labels.withColumnRenamed("key", "other"), "other").select("key", "label")
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("further"))
        jumped = labels.join(jump, "label").select("key", F.col("further").alias("label"))
        new = keep(heard.unionByName(jumped).groupBy("key").agg(F.min("label").alias("label")), "labels")
        changed = new.join(labels.withColumnRenamed("label", "old"), "key").where(F.col("label") < F.col("old"))
        if changed.isEmpty():
            return new.withColumnRenamed("label", "component")
        labels = new
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _pair_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every two sets."""
    if len(sets) == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    kinds, column, met = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = met[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    width = max(64, 4_000_000 // len(sets))
    for at in range(0, len(kinds), width):
        part = slice(*np.searchsorted(column, [at, at + width]))
        if part.start < part.stop:
            names, place = np.unique(column[part], return_inverse=True)
            dense = np.zeros((len(sets), len(names)), np.float32)
            dense[owner[part], place] = 1
            counts += dense @ dense.T
    counts = counts.astype(np.int64)
    np.fill_diagonal(counts, sizes)
    return counts


def _verify(tile: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of one tile: for each text the copies it is linked to, and links that connect it."""
    u, v, links = [], [], []
    tile = tile.drop_duplicates(["component", "id"]).sort_values(["component", "id"])
    all_keys, all_copies, all_sides = tile["id"].to_numpy(), tile["copies"].to_numpy(), tile["side"].to_numpy()
    all_sets = [np.frombuffer(x, np.uint64) for x in tile["shingles"]]
    whose, across = tile["component"].to_numpy(), bool(tile["across"].iloc[0])
    starts = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1]]))
    for a, b in zip(starts, [*starts[1:], len(whose)]):
        if b - a < 2:
            continue
        keys, sets = all_keys[a:b], all_sets[a:b]
        sizes = np.array([len(x) for x in sets])
        common = _pair_counts(sets)
        linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
        np.fill_diagonal(linked, False)
        if across:  # a tile of two blocks answers only for pairs across
            linked &= all_sides[a:b, None] != all_sides[None, a:b]
        label = np.arange(len(keys))
        for i in range(len(keys)):
            near = np.flatnonzero(linked[i])
            roots, first = np.unique(label[near], return_index=True)
            for root, member in zip(roots, near[first]):
                if label[i] != root:
                    u.append(keys[i])
                    v.append(keys[member])
                    links.append(0)
                    label[label == root] = label[i]
            if (label == label[0]).all():
                break
        total = linked @ all_copies[a:b]
        for i in np.flatnonzero(total):
            u.append(keys[i])
            v.append(keys[i])
            links.append(int(total[i]))
    return pd.DataFrame({"u": u, "v": v, "links": np.array(links, np.int64)})


def verified(documents: DataFrame, texts: DataFrame, groups: DataFrame, key: str, threshold: float) -> DataFrame:
    """Rows (u, v, links): u = v with a text's links in a tile, or a link that connects two texts.

    ``texts`` has id, a key of a document that has it, s1, s2, n and copies, ``groups`` key (an id)
    and component.
    """
    members = texts.join(groups.withColumnRenamed("key", "id"), "id")
    weight = F.col("n") + WEIGHT
    sizes = members.groupBy("component").agg(F.ceil(F.sum(weight) / TILE).cast("int").alias("blocks"))
    members = keep(members.join(sizes, "component"), "members")
    total = members.where("blocks = 1").agg(F.sum(weight)).first()[0] or 0
    bundles = max(1, math.ceil(total / TILE))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, held in textnum.slices(batch.column("text").to_pylist()):
                found, ends = textnum.shingle_sets(held, SHINGLE)
                parts = [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                s1, s2 = batch.column("s1").to_numpy(), batch.column("s2").to_numpy()
                # Rows under one key may hold several texts; the one that was meant counts.
                mine = [
                    i
                    for i, p in enumerate(parts)
                    if textnum.mix(p, 1).sum().astype(np.int64) == s1[first + i]
                    and textnum.mix(p, 2).sum().astype(np.int64) == s2[first + i]
                ]
                rows = batch.take(pa.array([first + i for i in mine], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in columns], pa.array([parts[i].tobytes() for i in mine], pa.binary())],
                    [*columns, "shingles"],
                )

    columns = ["id", "component", "blocks", "copies"]
    wanted = sieve(documents.select(key, "text"), members, key).join(members.drop("n"), key)
    schema = "id bigint, component bigint, blocks int, copies bigint, shingles binary"
    loaded = map_batches(wanted.select(*columns, "s1", "s2", "text"), sets, schema)
    side = F.pmod(F.xxhash64("id", F.lit(9)), F.col("blocks")).cast("int")
    own = F.struct(F.col("side").alias("i"), F.col("side").alias("j"))
    tiles = F.array_distinct(F.concat(F.array(own), _tiles(F.col("blocks"), F.col("side"))))
    bundle = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(bundles))).otherwise(F.xxhash64("component"))
    placed = loaded.withColumn("side", side).withColumn("tile", F.explode(tiles))
    placed = placed.withColumn("bundle", bundle).withColumn("across", F.col("tile.i") != F.col("tile.j"))

    def turn(tile: pd.DataFrame) -> pd.DataFrame:
        return _verify(tile, threshold)

    ship(documents.sparkSession)
    return placed.groupBy("bundle", "tile").applyInPandas(turn, "u bigint, v bigint, links bigint")


def classes(documents: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """key, class_id and links of each row of ``documents`` (key, text), as a kept table.

    The class is the smallest key among all documents that links connect; links counts the
    other documents that are linked to it, copies included. Tables in between are deleted.
    """
    if threshold < THRESHOLD:
        raise ValueError(f"similarities below {THRESHOLD} need other settings")
    with scratch(documents.sparkSession):
        found = keep(features(documents, key), "features")
        marks, some = ["s1", "s2"], F.col("n") > 0
        counted = found.where(some).groupBy(*marks).agg(F.min(key).alias(key), F.first("n").alias("n"), F.count("*").alias("copies"))
        texts = keep(counted.withColumn("id", F.monotonically_increasing_id()), "texts")
        with scratch(documents.sparkSession):
            # One row of each text; rows repeated under one key would come in several times.
            one = found.where(some).select(key, *marks, "tokens").join(texts.select(key, *marks, "id"), [key, *marks])
            tokens = one.dropDuplicates([key, *marks]).select("id", "tokens")
            pairs = candidate_pairs(keep(rooted(tokens, runs_needed(recall)), "representatives"), tokens)
            groups_of = keep(components(pairs), "groups", lasting=True)
        checked = keep(verified(documents, texts, groups_of, key, threshold), "verified")
        links = checked.where("u = v").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("others"))
        joined = components(checked.where("u != v").select("u", "v")).withColumnRenamed("key", "id")
        members = joined.join(texts.select("id", key), "id")
        least = keep(members.groupBy("component").agg(F.min(key).alias("class_id")), "least")
        by_text = (
            texts.join(links, "id", "left")
            .join(joined.join(least, "component").select("id", "class_id"), "id", "left")
            .select(
                *marks,
                F.coalesce("class_id", F.col(key)).alias("class_id"),
                (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
            )
        )
        linked = found.where(some).select(key, *marks).join(by_text, marks).select(key, "class_id", "links")
        alone = found.where(~some).select(key, F.col(key).alias("class_id"), F.lit(0).cast("bigint").alias("links"))
        return keep(linked.unionByName(alone), "classes", lasting=True)
