"""Averaged hashed embeddings under a linear softmax, trained by numpy gradient descent.

A document is the average of the vectors of its hashed features; a softmax over two
classes reads that average. Vectors and softmax are learned together. The score of a
document is linear in the average, so a fitted model is applied as one number per
bucket: the bucket's vector times the difference of the two class vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import textnum
from inkwell.llm.shipping import map_batches
from inkwell.session import keep, scratch

BITS = 18
#: The most bytes of packed bags that reach the driver.
HELD_BYTES = 64 << 20
#: The order in which bags are taken: by a hash of the key, then key, label and the text's hash.
ORDER = ("place", "key", "label", "mark")

# For each text of a slice: the buckets of its features, all texts after each other,
# and the end of each text's part.
Featurizer = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


def buckets(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The leading bits of 32-bit hashes."""
    return (hashes * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def char_ngrams(codes: np.ndarray, n: int) -> np.ndarray:
    """32-bit hashes of all ``n`` characters in a row; entry i starts at i."""
    count = max(0, len(codes) - n + 1)
    total = np.full(count, n, np.uint32)
    for k in range(n):
        total = total * np.uint32(0x01000193) + codes[k : k + count]
    total ^= total >> np.uint32(15)
    return total


def inside(starts: np.ndarray, ends: np.ndarray, owners: np.ndarray, n_texts: int) -> np.ndarray:
    """Ends of each text's part when features are sorted by their owners."""
    return np.searchsorted(owners, np.arange(n_texts), side="right")


@dataclass(frozen=True)
class Model:
    """One weight per bucket, and the bias: the difference of the two classes' logits."""

    weights: np.ndarray
    bias: float

    def score(self, featurize: Featurizer, texts: list[str | None]) -> np.ndarray:
        """The probability of class 1 of each text."""
        logits = np.empty(len(texts))
        for first, held in textnum.slices(texts):
            found, ends = featurize(held)
            sums = np.concatenate([[0.0], np.cumsum(self.weights[found], dtype=np.float64)])
            starts = np.concatenate([[0], ends[:-1]])
            means = (sums[ends] - sums[starts]) / np.maximum(ends - starts, 1)
            logits[first : first + len(held)] = means + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def train(
    bags: Sequence[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    dim: int = 8,
    epochs: int = 6,
    rate: float = 0.5,
    batch: int = 64,
    seed: int = 1,
    bits: int = BITS,
    least: int = 0,
) -> Model:
    """Fit vectors and softmax to bags of (buckets, shares), rows scaled by past gradients.

    Few bags are read more often than ``epochs`` times, until there were ``least`` steps.
    No bag at all, or one class only, gives the constant score of that class's share.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = np.array([0.0, np.log(share / (1 - share))])
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << bits, np.float32), float(bias[1]))
    softmax = rng.normal(0, 0.5, (dim, 2))
    seen_rows, seen_softmax, seen_bias = np.full(1 << bits, 1e-8), np.full((dim, 2), 1e-8), np.full(2, 1e-8)
    epochs = max(epochs, -(-least // -(-len(bags) // batch)))
    steps, total = 0, epochs * -(-len(bags) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pace = rate * (1 - steps / total)
            steps += 1
            chosen = [(i, *bags[i]) for i in order[at : at + batch]]
            chosen = [x for x in chosen if len(x[1])]
            if not chosen:
                continue
            index = np.concatenate([x[1] for x in chosen])
            weight = np.concatenate([x[2] for x in chosen])[:, None]
            sizes = np.array([len(x[1]) for x in chosen])
            chosen = [x[0] for x in chosen]
            means = np.add.reduceat(weight * vectors[index], np.cumsum(sizes) - sizes)
            logits = means @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error /= len(chosen)
            back = weight * np.repeat(error @ softmax.T, sizes, axis=0)
            sort = np.argsort(index, kind="stable")
            rows, heads = np.unique(index[sort], return_index=True)
            slope = np.add.reduceat(back[sort], heads)
            seen_rows[rows] += (slope**2).mean(1)
            vectors[rows] -= (pace * slope / np.sqrt(seen_rows[rows])[:, None]).astype(np.float32)
            slope = means.T @ error
            seen_softmax += slope**2
            softmax -= pace * slope / np.sqrt(seen_softmax)
            seen_bias += error.sum(0) ** 2
            bias -= pace * error.sum(0) / np.sqrt(seen_bias)
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def bags(featurize: Featurizer, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares of each text."""
    out = []
    for _, held in textnum.slices(texts):
        found, ends = featurize(held)
        for a, b in zip([0, *ends[:-1]], ends):
            kinds, counts = np.unique(found[a:b], return_counts=True)
            out.append((kinds, (counts / max(1, b - a)).astype(np.float32)))
    return out


def pack(buckets: np.ndarray, shares: np.ndarray) -> bytes:
    """A bag in few bytes: steps between its sorted buckets, then the shares."""
    steps = np.diff(buckets.astype(np.uint32), prepend=np.uint32(0))
    return zstandard.compress(steps.tobytes() + shares.astype(np.float32).tobytes())


class Packed(Sequence):
    """Packed bags, each unpacked only while it is read."""

    def __init__(self, bags: list[bytes]):
        self.bags = bags

    def __len__(self) -> int:
        return len(self.bags)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        raw = zstandard.decompress(self.bags[i])
        half = len(raw) // 2
        return np.cumsum(np.frombuffer(raw[:half], np.uint32), dtype=np.uint32), np.frombuffer(raw[half:], np.float32)


def labelled_sample(documents: DataFrame, labels: DataFrame, key: str, label: str, rows: int, bounds: int) -> DataFrame:
    """Documents of at most ``rows`` labels, chosen by a hash of the key: key, text, its mark, label and place.

    A key that several documents share brings all of them. Rows without key, label or text are left out. A key with several labels takes part
    with each of them. ``bounds`` is the number of labelled rows, which the caller counts.
    """
    chosen = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(key), F.col(label).cast("int").alias("_label")
    )
    if bounds > rows:
        least = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * rows / bounds))
        chosen = chosen.where(least)
    place = F.xxhash64(F.col(key), F.lit(12)).alias("_place")
    chosen = chosen.select(key, "_label", place).orderBy("_place", key, "_label").limit(rows)
    texts = documents.select(F.col(key), F.col("text").alias("_text"), F.xxhash64("text").alias("_mark"))
    return texts.where("_text is not null").join(chosen, key)


def fit(
    documents: DataFrame, labels: DataFrame, key: str, label: str, featurize: Featurizer, rows: int,
    held: int = HELD_BYTES, **settings
) -> Model:
    """Train on at most ``rows`` labelled documents, and on at most ``held`` bytes of packed bags.

    Tasks turn the chosen texts into bags of buckets, kept as a table; only the first of these, by a hash
    of the key, reach the driver. Each text under a repeated key counts as a document.
    """
    spark = documents.sparkSession
    bounds = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).count()
    sample = labelled_sample(documents, labels, key, label, rows, bounds)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(*bag) for bag in bags(featurize, batch.column("_text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_place"),
                    batch.column(key).cast(pa.string()),
                    batch.column("_label"),
                    batch.column("_mark"),
                    pa.array(packed, pa.binary()),
                ],
                [*ORDER, "bag"],
            )

    with scratch(spark):
        found = keep(map_batches(sample, turn, "place bigint, key string, label int, mark bigint, bag binary"), "bags")
        # As many of the first bags as fit: rows that tie in the order are copies of one text.
        sizes = found.select(*ORDER, F.length("bag").alias("bytes")).orderBy(*ORDER).limit(rows).toArrow()
        fits = int(np.searchsorted(np.cumsum(sizes.column("bytes").to_numpy()), held, side="right"))
        found = found.orderBy(*ORDER).limit(fits).toArrow()
    # Sorted, for the same model whatever the order of the rows.
    order = pc.sort_indices(found, [(c, "ascending") for c in ("key", "label", "mark")]).to_numpy()
    packed, labels = found.column("bag").to_pylist(), found.column("label").to_numpy()[order]
    del found
    bagged = Packed([packed[i] for i in order])
    return train(bagged, labels, **settings)


def apply(documents: DataFrame, model: Model, featurize: Featurizer, score: str) -> DataFrame:
    """All columns of ``documents`` and the score of each text; needs a column ``text``."""
    kept = [f for f in documents.schema.fields if f.name != score]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{score}` double"
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(featurize, batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], scores], [*names, score])

    return map_batches(documents, run, schema)
