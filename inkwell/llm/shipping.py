"""Arrow batches in Python tasks that import this package."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import inkwell

_SHIPPED = "spark.inkwell.shipped"


def ship(spark: SparkSession) -> None:
    """Give the tasks of this application the package, once; Spark's file server sends it."""
    context = spark.sparkContext
    if context.getLocalProperty(_SHIPPED) != context.applicationId:
        package = Path(inkwell.__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="inkwell-")) / "inkwell"
        context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        context.setLocalProperty(_SHIPPED, context.applicationId)


def map_batches(
    frame: DataFrame, turn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function that may use this package."""
    ship(frame.sparkSession)
    return frame.mapInArrow(turn, schema)


def append_columns(
    rows: DataFrame, new: dict[str, str], make: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """``rows`` with new columns (name to type) that ``make`` computes from each batch.

    Columns named like new ones are replaced.
    """
    kept = [f for f in rows.schema.fields if f.name not in new]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{k}` {v}" for k, v in new.items()])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *make(batch)], [*names, *new])

    return map_batches(rows, run, schema)
