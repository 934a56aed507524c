"""Reading and writing review files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.schema import DOCUMENT, REVIEW
from inkwell.session import keep

# Texts come back as they were: spaces at the ends stay, and null is told from empty (it is written as \\N).
CSV = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
}


def read_reviews(spark: SparkSession, path: str, partitions: int | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Reviews from JSON lines, plain or gzip, with the declared schema.

    One gzip file is one task whatever its size. Pass ``partitions`` to spread the
    rows after such a scan, and convert once with :func:`convert_reviews`. A line that is
    no JSON object of this schema stops the job; ``mode="PERMISSIVE"`` reads it as nulls.
    """
    reviews = spark.read.schema(REVIEW).json(path, mode=mode)
    return reviews if partitions is None else reviews.repartition(partitions)


#: Why a line is kept aside.
EMPTY, NO_OBJECT, OTHER_TYPE = "empty line", "no JSON object", "field of another type"


def read_reviews_apart(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Reviews of the good JSON lines, and the bad lines with file, reason and text.

    Each line is in one of the two. The lines are parsed once and kept, so both tables
    come from the same reading, even if files are added in between. A line that is cut off or
    no object is bad as a whole; so is one with a field that does not fit its type, which
    would be read as null otherwise. Unknown fields do no harm. Lines end with a line feed alone.
    """
    lines = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_path").alias("file"))
    broken = "_broken"
    schema = T.StructType([*REVIEW.fields, T.StructField(broken, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    # A value's own text, so that any well-formed object passes here.
    plain = F.try_parse_json("value")
    whole = plain.isNotNull() & F.schema_of_variant(plain).startswith("OBJECT")
    reason = (
        F.when(F.trim(F.regexp_replace("value", "\r", "")) == "", EMPTY)
        .when(~F.coalesce(whole, F.lit(False)), NO_OBJECT)
        .when(F.col("review").isNull() | F.col(f"review.{broken}").isNotNull(), OTHER_TYPE)
    )
    read = keep(lines.withColumn("review", parsed).withColumn("reason", reason), "lines")
    good = read.where("reason is null").select("review.*").drop(broken)
    return good, read.where("reason is not null").select("file", "reason", F.col("value").alias("line"))


def convert_reviews(spark: SparkSession, source: str, target: str, partitions: int | None = None) -> None:
    """Rewrite JSON lines as Parquet, so that later scans split and prune."""
    read_reviews(spark, source, partitions).write.mode("overwrite").parquet(target)


def literal_comments(spark: SparkSession, texts: list[str]) -> DataFrame:
    """A handful of comments typed in by hand, as a table to score."""
    return spark.createDataFrame(list(enumerate(texts)), "comment_id int, text string")


def write_reviews(reviews: DataFrame, path: str) -> None:
    reviews.select(*REVIEW.fieldNames()).write.mode("overwrite").json(path, compression="gzip")


def write_documents_csv(documents: DataFrame, path: str) -> None:
    """Processed documents as CSV with a header; quotes are doubled inside text.

    A file with line breaks in its text is read by one task, so files are kept short.
    """
    documents.write.mode("overwrite").option("maxRecordsPerFile", 100_000).csv(path, header=True, **CSV)


def read_documents_csv(spark: SparkSession, path: str, schema=DOCUMENT) -> DataFrame:
    """Documents from CSV; text may hold line breaks."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, **CSV)


def write_by_item(
    rows: DataFrame, path: str, item: str, order: str, buckets: int = 32, files: int = 32, slices: int = 16
) -> None:
    """A table laid out for reading single items: a folder for each hash bucket of the item, sorted within.

    Rows are dealt by bucket and one of ``slices`` hashed from ``order``, so a very frequent item fills
    several files instead of one task. Unlike ranges this needs no sample of the rows, which are computed once.
    """
    bucket = F.pmod(F.xxhash64(item), F.lit(buckets)).cast("int")
    laid = rows.withColumn("_bucket", bucket).repartition(files, "_bucket", F.pmod(F.xxhash64(order), F.lit(slices)))
    laid.sortWithinPartitions("_bucket", item, order).write.mode("overwrite").partitionBy("_bucket").parquet(path)


def read_item(spark: SparkSession, path: str, item: str, value: str, buckets: int = 32) -> DataFrame:
    """The rows of one item; only its bucket's folder is read, and there the row groups that can hold it."""
    # One value, to find its bucket.
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value)), F.lit(buckets))).first()[0]
    return spark.read.parquet(path).where((F.col("_bucket") == bucket) & (F.col(item) == value)).drop("_bucket")
