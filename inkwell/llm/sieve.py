"""A bounded sieve for rows that a join would drop anyway."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sieve has 2^BITS bits: 16 MB at most, however many keys there are.
BITS = 27
_PER_ROW = 8 * 4096  # bits of one row of Spark's bitmap aggregate


def sieve(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among ``keys``: all that are, and few others.

    For a semi join of wide rows with few keys: what passes is shuffled, the rest is not.
    The bitmap is broadcast; with very many keys it lets more through, and nothing is lost.
    A null key is dropped, as in a join.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << BITS))
    bitmaps = (
        keys.select((place + 1).alias("_place"))
        .groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap"))
    )
    byte = F.substring("_bitmap", (place % _PER_ROW / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (place % 8).cast("int"))
    marked = rows.where(F.col(key).isNotNull()).withColumn("_bucket", F.bitmap_bucket_number(place + 1))
    return marked.join(F.broadcast(bitmaps), "_bucket").where(bit == 1).select(*rows.columns)
