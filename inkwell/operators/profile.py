"""Counts, averages, scaling and summary tables of the corpus."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators.order import quantile_grid
from inkwell.session import keep


def class_counts(rows: DataFrame, label: str = "class") -> DataFrame:
    """Rows per class and, under a null class, in total; text labels become ints."""
    code = F.col(label).try_cast("int") if dict(rows.dtypes)[label] == "string" else F.col(label)
    return (
        rows.select(code.alias(label))
        .rollup(label)
        .agg(F.count("*").alias("n"), F.grouping(label).cast("int").alias("is_total"))
    )


def with_length(rows: DataFrame, text: str = "review") -> DataFrame:
    return rows.withColumn("length", F.char_length(text))


def mean_length(rows: DataFrame, by: str, length: str = "length") -> DataFrame:
    return rows.groupBy(by).agg(F.avg(length).alias("avg_length"))


def mean_total_length(documents: DataFrame, review: str, flag: str, length: str = "length") -> DataFrame:
    """Length summed per review, then averaged per flag."""
    totals = documents.groupBy(review, flag).agg(F.sum(length).alias("total"))
    return totals.groupBy(flag).agg(F.avg("total").alias("avg_length"))


def flag_ratio(rows: DataFrame, key: str, flag: str) -> DataFrame:
    """Flagged rows, all rows and their ratio per key."""
    return (
        rows.groupBy(key)
        .agg(F.count_if(F.col(flag)).alias("flagged"), F.count("*").alias("total"))
        .withColumn("ratio", F.try_divide("flagged", "total"))
    )


def null_counts(rows: DataFrame) -> DataFrame:
    """Null values per column, in one pass."""
    found = rows.agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"))
                for c in rows.columns
            ]
        ).alias("found")
    )
    return found.select(F.inline("found"))


def scale(rows: DataFrame, value: str) -> DataFrame:
    """Add ``scaled``: the value between the column's minimum (0) and maximum (1)."""
    ends = rows.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    return rows.withColumn("scaled", _scaled(F.col(value), ends["lo"], ends["hi"]))


def scale_by_class(rows: DataFrame, value: str, label: str) -> DataFrame:
    """All rows with their value scaled inside their class; a null class is one, too.

    Bounds are one row per class, kept and joined back.
    """
    ends = rows.groupBy(F.col(label).alias("_class")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    joined = rows.join(keep(ends, "ends"), F.col(label).eqNullSafe(F.col("_class")), "left")
    return joined.withColumn("scaled", _scaled(F.col(value), F.col("_lo"), F.col("_hi"))).drop("_class", "_lo", "_hi")


def _scaled(value: Column, lo: Column, hi: Column) -> Column:
    return F.try_divide((value - lo).cast("double"), (hi - lo).cast("double"))


def describe(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column."""
    moments = rows.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(c).alias("count"),
                    F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("std"),
                    F.min(c).cast("double").alias("min"),
                    F.max(c).cast("double").alias("max"),
                )
                for c in columns
            ]
        ).alias("found")
    ).select(F.inline("found"))
    long = rows.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
        ).alias("cell")
    ).select("cell.column", "cell.value")
    quartiles = (
        quantile_grid(long, "value", 4, ["column"])
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("j") == j, F.col("quantile"))).alias(f"p{25 * j}") for j in (1, 2, 3)])
    )
    # One row per named column on both sides.
    return moments.join(F.broadcast(quartiles), "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def correlation_matrix(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, in one pass."""
    pairs = {(x, y): F.corr(x, y) for x, y in product(columns, columns) if x <= y}
    found = rows.agg(
        F.array(
            *[
                F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), pairs[min(x, y), max(x, y)].alias("r"))
                for x, y in product(columns, columns)
            ]
        ).alias("found")
    )
    return found.select(F.inline("found"))
