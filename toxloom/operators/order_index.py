"""A stored order: pages and continuation tokens that open only the files they lie in.

The rows are written once, range-partitioned and sorted over the whole order, one file per partition. The index has a row for each file: how many rows
come before it, how many it has, and its first and last key. A page is found by the counts, what follows a key by the
keys, and the place of a row is its place in its file plus the rows before.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toxloom.functions.cells import named
from toxloom.operators.ordering import parts_of

PLACE = "_place"


class OrderIndex(NamedTuple):
    spark: SparkSession
    root: str
    order_by: list[str]
    files: DataFrame  # file, start, n, low, high


def _key(order_by: Sequence[str]) -> Column:
    return F.struct(*[named(c).alias(f"k{i}") for i, c in enumerate(order_by)])


def build_order(df: DataFrame, order_by: Sequence[str], root: str, partitions: int | None = None) -> OrderIndex:
    """Write the rows in order, and the index. The order should tell all rows apart: rows that tie have no fixed place among each other."""
    spark, order_by = df.sparkSession, list(order_by)
    n = partitions or parts_of(df)
    order = [named(c) for c in order_by]
    (
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
        .write.option("maxRecordsPerFile", 0).parquet(f"{root}/rows")
    )
    rows = spark.read.parquet(f"{root}/rows").select(
        "_part", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), _key(order_by).alias("k"),
    )
    counts = rows.groupBy("_part", "file").agg(F.count("*").alias("n"))  # one row per file
    # A file's first and last row hold its ends: an aggregate over the keys of all rows would sort them again.
    ends = rows.join(F.broadcast(counts), ["_part", "file"]).where((F.col("row") == 0) | (F.col("row") == F.col("n") - 1))
    files = ends.groupBy("_part", "file").agg(F.any_value("n").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    files.select("file", F.coalesce(before, F.lit(0)).alias("start"), "n", "low", "high").write.parquet(f"{root}/index")
    return open_order(spark, root, order_by)


def open_order(spark: SparkSession, root: str, order_by: Sequence[str]) -> OrderIndex:
    return OrderIndex(spark, root, list(order_by), spark.read.parquet(f"{root}/index"))


def _rows(index: OrderIndex, files: list[Any]) -> DataFrame:
    """Rows of these files with their place in the whole order, from 0."""
    if not files:
        return index.spark.read.parquet(f"{index.root}/rows").drop("_part").withColumn(PLACE, F.lit(0).cast("bigint")).limit(0)
    rows = index.spark.read.parquet(*[f["file"] for f in files]).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    starts = F.broadcast(index.spark.createDataFrame([(f["file"], f["start"]) for f in files], "_file string, _start bigint"))
    return rows.join(starts, "_file").withColumn(PLACE, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start", "_part")


def total(index: OrderIndex) -> int:
    return index.files.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def stored_page(index: OrderIndex, skip: int, limit: int) -> DataFrame:
    """Rows skip+1 to skip+limit, with `_place`. Only the files that hold them are read."""
    files = index.files.where((F.col("start") < skip + limit) & (F.col("start") + F.col("n") > skip)).collect()  # the page's files
    return _rows(index, files).where((F.col(PLACE) >= skip) & (F.col(PLACE) < skip + limit))


def page_after(index: OrderIndex, key: Sequence[Any] | None, limit: int) -> DataFrame:
    """The `limit` rows that follow a key (the first ones for None), with `_place`: a later page without counting what came before."""
    if key is None:
        return stored_page(index, 0, limit)
    kinds = index.files.schema["low"].dataType.fields
    at = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kinds)])
    first = index.files.where(F.col("high") > at).orderBy("start").limit(1).collect()
    if not first:
        return _rows(index, [])
    # Rows of the first file up to the key don't count, so the page may reach `limit` rows behind that file.
    files = index.files.where((F.col("start") >= first[0]["start"]) & (F.col("start") < first[0]["start"] + first[0]["n"] + limit)).collect()
    return _rows(index, files).where(_key(index.order_by) > at).orderBy(PLACE).limit(limit)


def token_of(index: OrderIndex, rows: DataFrame) -> tuple | None:
    """The key that a page ends with, to go on from; None for a page without rows."""
    last = rows.orderBy(F.col(PLACE).desc()).limit(1).select(*map(named, index.order_by)).collect()
    return tuple(last[0]) if last else None
