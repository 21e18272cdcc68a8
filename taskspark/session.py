"""Where a job may put intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: a cluster must name one,
    because an executor cannot read another machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="taskspark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


#: The folder of the job that is running, below the application's.
_JOB: ContextVar[str] = ContextVar("taskspark_job", default="")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_dir(spark).rstrip('/')}/taskspark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path for one intermediate table, in the folder of the job if one is running."""
    return f"{scratch_root(spark)}{_JOB.get()}/{label}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside go when it ends, well or not; those of others stay.

    For jobs that write their result: a DataFrame handed out of it would read tables that are gone.
    """
    inside = _JOB.set(f"{_JOB.get()}/job-{uuid.uuid4().hex}")
    folder = scratch_root(spark) + _JOB.get()
    try:
        yield
    finally:
        _JOB.reset(inside)
        delete_path(spark, folder)


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once no result is read from them any more."""
    delete_path(spark, scratch_root(spark))


def enable_checkpoints(spark: SparkSession) -> None:
    """Give iterative training a reliable checkpoint folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Statements run inside delete their shuffle files when they end, not when the driver's heap is next collected.

    For writes, which nothing runs again: a chain of stored tables then holds one table's shuffles on disk at a time.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: Codec for stored tables as large as the job's input, which then take about a third less than by default.
TIGHT = "zstd"


def store_and_reload(
    df: DataFrame, label: str, group_bytes: int | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    Cuts the lineage, survives a lost executor, and fixes values such as row positions that a
    second evaluation might assign differently. ``group_bytes`` bounds what a writer gathers of
    wide columns before it passes them on, ``compression`` is a codec of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, label)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    if compression is not None:
        writer = writer.option("compression", compression)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What one task may gather of wide rows: bytes of an Arrow batch, bytes of a Parquet row group.
BUFFERS = {"spark.sql.execution.arrow.maxBytesPerBatch": "2m", "parquet.block.size": str(32 << 20)}


def bound_buffers(spark: SparkSession, sizes: dict[str, str] = BUFFERS) -> None:
    """Keep what tasks gather of wide rows small, for the rest of the session; what the user has set stays.

    Batches to Python are otherwise up to 64 MB and row groups 128 MB, both several times per task and outside
    what Spark accounts for. Rows and results do not depend on either size.
    """
    for name, size in sizes.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, size)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
