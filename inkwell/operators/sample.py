"""Splits, samples and curves that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.joins import enrich
from inkwell.session import keep

# An exact sample is found in steps of so many bits of the rows' tags.
TAG_BITS, STEP_BITS = 60, 15


def in_sample(key: str, fraction: float, seed: int) -> Column:
    """Whether a row is in the hashed sample; the same after any repartition.

    The first 8 hex digits of md5 are compared with ``fraction`` of their range; at 1 all
    rows are in it. A null key is hashed like an empty one.
    """
    if fraction >= 1:
        return F.lit(True)
    edge = f"{round(fraction * 0xFFFFFFFF):08x}"
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    tag = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return F.left(tag, F.lit(8)) < edge


def split(rows: DataFrame, key: str, fraction: float = 0.8, seed: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows: disjoint, and together all rows."""
    chosen = in_sample(key, fraction, seed)
    return rows.where(chosen), rows.where(~chosen)


def exact_split(rows: DataFrame, key: str, fraction: float, seed: int = 80, by: Sequence[str] = ()) -> DataFrame:
    """Rows with ``chosen``, true for exactly ``floor(fraction * n + 1/2)`` of each group's n rows.

    The rows with the smallest tags (hashes of seed and key, a null key like an empty one) are
    chosen. The last one's tag is found by refining histograms: counts per bucket of leading
    bits tell which bucket holds it, then only rows of that bucket are counted by their next
    bits. Nothing is sorted and no group meets in one task. Rows with the tag of the last one,
    copies of a key, are interchangeable and chosen by a row number.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    tag = F.conv(F.left(digest, F.lit(TAG_BITS // 4)), 16, 10).cast("bigint")
    group = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    tagged = keep(
        rows.withColumns({"_group": group, "_tag": tag, "_row": F.monotonically_increasing_id()}), "tagged"
    )
    wanted = tagged.groupBy("_group").agg(F.floor(F.count("*") * F.lit(float(fraction)) + 0.5).cast("bigint").alias("_left"))
    last, shift = _last_chosen(tagged, "_tag", TAG_BITS, wanted)
    found = enrich(tagged, last, "_group", "left")
    place = F.shiftright("_tag", shift)
    chosen = (place < F.col("_low")) | ((place == F.col("_low")) & (F.col("_left") == F.col("_n")))
    tied = last.where("_left < _n").select("_group", F.col("_low").alias("_tag"), "_left")
    if not tied.isEmpty():
        among = tagged.join(tied.drop("_left"), ["_group", "_tag"]).select("_group", "_row")
        row, shift = _last_chosen(among, "_row", 63, tied.select("_group", "_left"))
        found = enrich(found, row.select("_group", F.col("_low").alias("_last_row")), "_group", "left")
        chosen = chosen | ((place == F.col("_low")) & (F.shiftright("_row", shift) <= F.col("_last_row")))
    return found.select(*rows.columns, F.coalesce(chosen, F.lit(False)).alias("chosen"))


def _last_chosen(rows: DataFrame, value: str, bits: int, wanted: DataFrame) -> tuple[DataFrame, int]:
    """For each group (_group, _left) the leading bits ``_low`` of its _left-th smallest value.

    _left is then how many rows with these bits are chosen, and _n how many there are. Ends as soon
    as all are; the bits not looked at are returned. Groups that want no row have none.
    """
    shift, spans = bits, wanted.where("_left > 0").withColumn("_low", F.lit(0).cast("bigint"))
    running = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    while shift:
        step = min(STEP_BITS, shift)
        inside = enrich(rows.select("_group", value), spans, "_group").where(F.shiftright(value, shift) == F.col("_low"))
        shift -= step
        counts = inside.groupBy("_group", "_left", F.shiftright(value, shift).alias("_bucket")).agg(F.count("*").alias("_n"))
        # At most 2^STEP_BITS buckets for each group.
        before = F.sum("_n").over(running) - F.col("_n")
        hit = counts.withColumn("_before", before).where("_before < _left and _left <= _before + _n")
        spans = keep(hit.select("_group", (F.col("_left") - F.col("_before")).alias("_left"), F.col("_bucket").alias("_low"), "_n"), "spans")
        if spans.where("_left < _n").isEmpty():
            break
    return spans, shift


def first_rows(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.orderBy(key).limit(n)


def pick_one(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """One row chosen by seeded hash; a null key is hashed like an empty one."""
    tag = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"))
    return rows.orderBy(tag, key).limit(1)


def systematic_sample(
    rows: DataFrame, key: str, value: str, label: str, classes: Sequence, m: int
) -> DataFrame:
    """Every (n div m)-th row of each class, ``m`` at most, listed by md5 of ``key``.

    ``key`` must identify the row within its class; a null one counts as empty. Its md5 spreads rows evenly over
    65,536 buckets whatever the keys look like. Counts per bucket tell which buckets
    hold a wanted position, at most ``m`` per class, and only the rows of those are
    ranked. The classes are a short fixed list, which bounds the broadcast.
    """
    tag = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    listed = rows.where(F.col(label).isin(*classes)).select(
        label, key, value, tag.alias("_tag"), F.left(tag, F.lit(4)).alias("_bucket")
    )
    whole = Window.partitionBy(label)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        listed.groupBy(label, "_bucket")
        .agg(F.count("*").alias("_count"))
        .select(
            label,
            "_bucket",
            "_count",
            F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"),
            F.greatest(F.expr(f"sum(_count) over (partition by `{label}`) div {m}"), F.lit(1)).alias("_step"),
        )
        .where(
            F.expr(
                f"least((_before + _count - 1) div _step, {m - 1}) >= (_before + _step - 1) div _step"
            )
        )
    )
    position = F.col("_before") + F.row_number().over(
        Window.partitionBy(label, "_bucket").orderBy("_tag", key)
    ) - 1
    return (
        listed.join(F.broadcast(wanted), [label, "_bucket"])
        .withColumn("idx", position)
        .where((F.col("idx") % F.col("_step") == 0) & (F.col("idx") < F.col("_step") * m))
        .select(label, key, value, F.expr("idx div _step").alias("j"))
    )


def sorted_curve(sample: DataFrame, value: str, label: str, m: int) -> DataFrame:
    """The sampled values of each class in ascending order on a grid from 0 to 1.

    A class has at most ``m`` sampled rows, so its window is bounded.
    """
    place = F.row_number().over(Window.partitionBy(label).orderBy(value)) - 1
    return sample.select(
        label, place.alias("j"), (place / F.lit(float(m - 1))).alias("x"), F.col(value).alias("y")
    )
