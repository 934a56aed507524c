"""Global order without a one-task window: running totals, quantiles, codes, AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.joins import enrich
from inkwell.session import keep


def running_totals(
    rows: DataFrame,
    order: str,
    weights: Sequence[str],
    by: Sequence[str] = (),
    wanted: Column | None = None,
) -> DataFrame:
    """Add ``upto_<weight>``, the total of each weight up to and including the row, and
    ``all_<weight>``, that of its whole group.

    ``(by, order)`` must be unique, which a preceding groupBy gives. Rows are range
    partitioned, so the totals of earlier ranges are an offset of at most one row per
    range and group; only rows of one range are summed in a window. The ranges come
    from sampling and are read twice, hence the kept table. ``wanted`` picks ranges by
    ``before_<weight>``, ``in_<weight>`` and ``all_<weight>``; rows of others are left out.
    """
    laid = keep(
        rows.repartitionByRange(*by, order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy(*by, "_range")
        .agg(*[F.sum(w).alias(f"in_{w}") for w in weights])
        .select(
            "*",
            *[F.coalesce(F.sum(f"in_{w}").over(earlier), F.lit(0)).alias(f"before_{w}") for w in weights],
            *[F.sum(f"in_{w}").over(whole).alias(f"all_{w}") for w in weights],
        )
    )
    if wanted is not None:
        # Kept, so that its size is known and Spark can broadcast it ahead of the window.
        offsets = keep(offsets.where(wanted), "offsets")
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # Rows without a group are a group of their own, as in an aggregate.
    named = offsets.withColumnsRenamed({c: f"_of_{c}" for c in [*by, "_range"]})
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return laid.join(named, [F.col("_range") == F.col("_of__range"), *same]).select(
        *rows.columns,
        *[(F.col(f"before_{w}") + F.sum(w).over(inside)).alias(f"upto_{w}") for w in weights],
        *[F.col(f"all_{w}") for w in weights],
    )


def _grid_points(first: str, end: str, steps: int) -> tuple[tuple[Column, Column], tuple[Column, Column]]:
    """First and last grid point with its lower, and with its upper neighbour among the
    ranks ``first`` .. ``end`` - 1 of ``all_n``. Point j lies at j * (all_n - 1) / steps."""
    gaps = "(all_n - 1)"

    def span(start: str, last: str) -> tuple[Column, Column]:
        # A group of one row has only rank 0, which serves every point.
        return (
            F.expr(f"if(all_n = 1, 0L, {start})"),
            F.expr(f"if(all_n = 1, {steps}L, least({last}, {steps}L))"),
        )

    lower = span(
        f"({first} * {steps} + {gaps} - 1) div {gaps}", f"({end} * {steps} + {gaps} - 1) div {gaps} - 1"
    )
    upper = span(
        f"if({first} = 0, 0L, ({first} - 1) * {steps} div {gaps} + 1)", f"({end} - 1) * {steps} div {gaps}"
    )
    return lower, upper


def quantile_grid(
    rows: DataFrame, value: str, steps: int, by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles at 0, 1/steps, .., 1 with linear interpolation, per group.

    Equal values are counted first, so a frequent value is one row. Running totals
    tell which ranks a value covers, and integer arithmetic which grid points have
    one of these ranks as lower or upper neighbour: no group meets in one task, and
    ranges without such a rank are not sorted at all.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    in_range = _grid_points("before_n", "(before_n + in_n)", steps)
    wanted = (in_range[0][0] <= in_range[0][1]) | (in_range[1][0] <= in_range[1][1])
    lower, upper = _grid_points("(upto_n - n)", "upto_n", steps)

    def points(span: tuple[Column, Column], is_lower: bool) -> Column:
        found = F.when(span[0] <= span[1], F.sequence(*span)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(found, lambda j: F.struct(j.alias("j"), F.lit(is_lower).alias("is_lower")))

    share = F.expr(f"((j * (all_n - 1)) % {steps}) / cast({steps} as double)")
    return (
        running_totals(counts, value, ["n"], by, wanted)
        .select(*by, "all_n", value, F.inline(F.concat(points(lower, True), points(upper, False))))
        .groupBy(*by, "j", "all_n")
        .agg(
            F.max(F.when(F.col("is_lower"), F.col(value))).alias("lower"),
            F.max(F.when(~F.col("is_lower"), F.col(value))).alias("upper"),
        )
        .select(
            *by,
            "j",
            (F.col("j") / F.lit(float(steps))).alias("p"),
            (F.col("lower") + (F.col("upper") - F.col("lower")) * share).alias("quantile"),
        )
    )


def label_codes(rows: DataFrame, label: str) -> DataFrame:
    """One row per distinct label: its code 0, 1, .. in label order and its row count."""
    counts = (
        rows.where(F.col(label).isNotNull())
        .groupBy(label)
        .agg(F.count("*").alias("rows"))
        .withColumn("one", F.lit(1).cast("bigint"))
    )
    codes = running_totals(counts, label, ["one"])
    return codes.select(label, (F.col("upto_one") - 1).alias("code"), "rows")


def encode_labels(rows: DataFrame, label: str) -> DataFrame:
    """Rows with the code of their label; a null label has a null code."""
    codes = keep(label_codes(rows, label), "codes")
    return enrich(rows, codes, label, "left").drop("rows")


def area_under_roc(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Rank-sum AUC in one row; tied scores count one half."""
    counts = scored.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    totals = running_totals(counts, score, ["neg"])
    wins = F.col("pos").cast("double") * (F.col("upto_neg") - F.col("neg") / 2)
    return totals.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"),
    )
