"""Kernel machines on dense vectors: random Fourier features, then any linear model.

The Gaussian kernel exp(-gamma * |x - y|^2) is the mean of cos(w.x + b) * cos(w.y + b) * 2 over normal w
with variance 2 * gamma and uniform b. With ``size`` drawn pairs the dot product of two mapped vectors
is off by about 1 / sqrt(size). The draws are part of the map and known by their seed; rows are mapped by
themselves, as a column expression, so a fit has a fixed width however many rows there are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE, SEED = 256, 80


@dataclass(frozen=True)
class FourierMap:
    """Directions and shifts of the random features of vectors with ``width`` components."""

    width: int
    gamma: float
    size: int = SIZE
    seed: int = SEED

    def drawn(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        ways = rng.normal(0.0, np.sqrt(2 * self.gamma), (self.size, self.width))
        return ways, rng.uniform(0.0, 2 * np.pi, self.size)

    def of(self, vector: str) -> Column:
        """The mapped vector as an array; null for a vector that is null, of another width or has a null component."""
        ways, shifts = self.drawn()
        x = F.col(vector).cast("array<double>")
        dot = lambda w: F.aggregate(F.zip_with(w, x, lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
        # One literal, which is parsed when the plan is made; a literal a number takes seconds to build.
        written = json.dumps([{"w": w, "b": b} for w, b in zip(ways.tolist(), shifts.tolist())])
        drawn = F.from_json(F.lit(written), "array<struct<w:array<double>,b:double>>")
        mapped = F.transform(drawn, lambda d: float(np.sqrt(2 / self.size)) * F.cos(dot(d["w"]) + d["b"]))
        whole = (F.size(x) == self.width) & F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
        return F.when(whole, mapped)


def mapped(rows: DataFrame, vector: str, fourier: FourierMap) -> DataFrame:
    """The usable rows, their vector replaced by ``features``."""
    found = rows.withColumn("_mapped", fourier.of(vector)).where(F.col("_mapped").isNotNull())
    return found.withColumn("features", array_to_vector("_mapped")).drop("_mapped", vector)


def kernel_svc(label: str = "class", penalty: float = 1e-4, passes: int = 50) -> LinearSVC:
    """A linear machine for mapped rows."""
    return LinearSVC(featuresCol="features", labelCol=label, regParam=penalty, maxIter=passes)
