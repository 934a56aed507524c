"""Session settings and the shared folder that long jobs write to."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str, cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, because there the driver is the only machine; it is
    removed when Python ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="inkwell-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Paths of the kept tables of each open ``scratch`` block and the names they go by, the innermost last.
_OPEN: ContextVar[tuple[list[tuple[str, str | None]], ...]] = ContextVar("open scratch blocks", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that ``keep`` writes within the block when it ends.

    Nothing may be read from them later: what leaves the block is kept with ``lasting``.
    """
    paths: list[tuple[str, str | None]] = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path, table in paths:
            if table is not None:
                spark.sql(f"drop table if exists {table}")
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through the file system that Spark uses for it."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps.

    It does so when the driver collects its garbage, which may be half an hour later; a loop whose
    passes shuffle much calls this after each of them.
    """
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def keep(frame: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """The frame as a table written to the shared folder.

    For tables that are read several times or must not change between two reads:
    they are computed once, a lost executor does not bring their lineage back, and
    Spark knows their size when it picks a join. Within a ``scratch`` block the table goes
    when the block ends, a ``lasting`` one when the block around it does.
    """
    path = scratch_path(frame.sparkSession, name)
    blocks = _OPEN.get()
    if len(blocks) > lasting:
        blocks[-1 - lasting].append((path, None))
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def keep_by(frame: DataFrame, name: str, key: str) -> DataFrame:
    """A kept table in buckets of ``key``, as many as a shuffle has partitions.

    A join on the key moves the other side to the buckets and leaves this table where it is. Kept in the
    shared folder like any other; the session's catalog has a name for it until the ``scratch`` block ends.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    table = f"inkwell_{name}_{uuid.uuid4().hex}"
    blocks = _OPEN.get()
    if blocks:
        blocks[-1].append((path, table))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    return spark.table(table)
