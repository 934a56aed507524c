"""Gaussian naive Bayes on dense vectors: class moments that merge, and log densities in the row.

Defined results: rows whose vector is null or holds a null or non-finite component take no part in
a fit and get no prediction. To each variance a billionth of the largest variance of any
component is added, and ``TINY``, so a constant component does no harm. Equal scores go to the
smaller class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE, TINY = 1e-9, 1e-12


@dataclass(frozen=True)
class GaussianModel:
    """For each class its value, log prior, means and variances."""

    classes: tuple[tuple[object, float, tuple[float, ...], tuple[float, ...]], ...]


def _finite(vector: str) -> Column:
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fits, F.lit(False))


def fit(rows: DataFrame, vector: str, label: str) -> GaussianModel:
    """Moments of each class and component, from one aggregate.

    Classes times components numbers reach the driver.
    """
    used = rows.where(_finite(vector) & F.col(label).isNotNull())
    entries = used.select(label, F.posexplode(F.col(vector).cast("array<double>")).alias("at", "x"))
    moments = entries.groupBy(label, "at").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
    found = moments.orderBy(label, "at").collect()
    if not found:
        return GaussianModel(())
    # The variance of a component over all classes, from the merged moments.
    spread = []
    for at in {r["at"] for r in found}:
        own = [r for r in found if r["at"] == at]
        n = sum(r["n"] for r in own)
        mean = sum(r["n"] * r["mean"] for r in own) / n
        spread.append(sum(r["n"] * (r["var"] + (r["mean"] - mean) ** 2) for r in own) / n)
    more = SHARE * max(spread) + TINY
    by_class: dict[object, list] = {}
    for r in found:
        by_class.setdefault(r[label], []).append(r)
    total = sum(own[0]["n"] for own in by_class.values())
    return GaussianModel(tuple(
        (c, math.log(own[0]["n"] / total), tuple(r["mean"] for r in own), tuple(r["var"] + more for r in own))
        for c, own in by_class.items()
    ))


def predict(model: GaussianModel, rows: DataFrame, vector: str, label: str) -> DataFrame:
    """The usable rows without their vector, and ``prediction``."""
    values = F.col(vector).cast("array<double>")
    scores = []
    for place, (value, prior, means, variances) in enumerate(model.classes):
        constant = prior - sum(math.log(2 * math.pi * v) for v in variances) / 2
        away = F.zip_with(values, F.lit(list(means)), lambda x, m: (x - m) * (x - m))
        parts = F.zip_with(away, F.lit(list(variances)), lambda d, v: d / v)
        score = F.lit(constant) - F.aggregate(parts, F.lit(0.0), lambda a, p: a + p) / 2
        scores.append(F.struct(score.alias("score"), F.lit(-place).alias("order"), F.lit(value).cast(rows.schema[label].dataType).alias("value")))
    if not scores:
        return rows.where("false").withColumn("prediction", F.col(label)).drop(vector)
    best = F.array_max(F.array(*scores))["value"]
    return rows.where(_finite(vector)).withColumn("prediction", best).drop(vector)
