"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Workbook and page bodies are large cells: bound Arrow batches by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def session(app: str = "toxloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    A machine-local folder is used only in local mode, where driver and executors share one disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="toxloom-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back, where a costly decode feeds several outputs.

    Unlike a cache it outlives its executors, and it cuts the lineage.
    """
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As `staged`, with the folder, for an owner that knows when to `discard` it."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of at most so many bytes for what runs inside: what is staged there, not what is returned to run later."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    if before is not None and 0 < int(before) <= most:
        yield
        return
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of `work_folder` that its owner no longer reads."""
    where, fs = _fs(spark, path)
    fs.delete(where, True)


# Small files of the shared file system ---------------------------------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _fs(spark, path)
    return fs.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where the folder is missing."""
    where, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_small(spark: SparkSession, path: str) -> str:
    where, fs = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, body: str) -> bool:
    """Make a small file appear whole, or not at all where the name is taken: of two writers one gets False.

    The body is written aside and renamed without overwriting, which the file system decides in one step.
    """
    jvm = spark._jvm
    where, fs = _fs(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".aside-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write(bytearray(body.encode()))
    stream.close()
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    plain = spark.sparkContext._gateway.new_array(option, 1)
    plain[0] = option.valueOf("NONE")
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(aside), fs.makeQualified(where), plain)
        return True
    except Exception:
        if not fs.exists(where):
            raise
        fs.delete(aside, False)
        return False
