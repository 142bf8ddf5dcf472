"""Global order without one task that sees everything: dense ids, deep pages, id ranges."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toxloom.functions.cells import named
from toxloom.session import work_folder

TOP_ROWS = 100_000  # a page that ends within this many rows is a plain top-k
SAMPLE = 1_000  # rows of which two give the borders around a deep page
PART_ROWS = 500_000  # rows that a task sorts; larger tables are cut into more parts


def parts_of(df: DataFrame) -> int:
    """Parts in which to sort the rows: the session's number, or as many as bound them."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PART_ROWS))


def assign_ids(df: DataFrame, order_by: Sequence[str], column: str = "id", partitions: int | None = None, start: int = 0) -> DataFrame:
    """Dense ids from `start` + 1 in the given total order; a later load passes the highest stored id as `start`.

    The rows are written once, range-partitioned and sorted, one file per partition. A row's id is its place in its
    file plus the rows of the files before: no further shuffle, and a lost executor cannot move the borders. Ranges
    are cut over the whole order tuple, so a lead value that many rows share is cut too.
    """
    spark = df.sparkSession
    n = partitions or parts_of(df)
    order = [named(c) for c in order_by]
    path = work_folder(spark, "ordered")
    (
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_bucket", F.spark_partition_id())
        .write.option("maxRecordsPerFile", 0).parquet(path)
    )
    rows = spark.read.parquet(path).withColumn("_row", F.col("_metadata.row_index"))
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_bucket", F.coalesce(before, F.lit(0)).alias("_start"))  # one row per partition
    return rows.join(F.broadcast(starts), "_bucket").select(
        (F.col("_start") + F.col("_row") + 1 + start).alias(column), *[named(c) for c in df.columns if c != column]
    )


def page(df: DataFrame, order_by: Sequence[str], skip: int, limit: int, top_rows: int = TOP_ROWS) -> DataFrame:
    """Rows skip+1 to skip+limit in the given total order.

    For a deep page, a bounded sample gives two borders in the order that should hold the page between them; rows below
    and between are counted, and only those between are cut again and numbered, so the table itself isn't shuffled. A
    sample that misses, or many equal rows, cost time alone: then all rows left are numbered.
    """
    keys = [named(c) for c in order_by]
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    if skip + limit <= top_rows:
        return df.orderBy(*keys).offset(skip).limit(limit)
    kinds = df.select(key.alias("k")).schema["k"].dataType.fields
    total = df.count()
    for _ in range(2):
        if total <= max(top_rows, 4 * limit):
            break
        sample = [r.k for r in df.orderBy(F.rand(17)).limit(SAMPLE).select(key.alias("k")).orderBy("k").collect()]
        end, margin = min(skip + limit, total), 2 * math.sqrt(len(sample)) + 1  # four standard deviations and more
        at = int(len(sample) * skip / total - margin), int(len(sample) * end / total + margin)
        low, high = [
            F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(sample[i], kinds)]) if 0 <= i < len(sample) else None for i in at
        ]
        above = F.lit(True) if low is None else key >= low
        inside = above if high is None else above & (key < high)
        below, between = df.agg(F.count_if(~above), F.count_if(inside)).first()
        if below > skip or below + between < end or between > total // 2:
            break
        df, skip, total = df.where(inside), skip - below, between
    numbered = assign_ids(df, order_by, "_place")
    return scan_id_range(numbered, skip + 1, skip + limit + 1, "_place").drop("_place")


def row_at(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The row at 0-based position n."""
    return page(df, order_by, n, 1)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def id_chunk(i: int, size: int = 1000) -> tuple[int, int]:
    """Half-open id range of chunk i."""
    return i * size + 1, (i + 1) * size + 1


def scan_id_range(df: DataFrame, lo: int, hi: int, column: str = "id") -> DataFrame:
    """Rows with lo <= id < hi; the filter reaches the scan."""
    return df.where((named(column) >= lo) & (named(column) < hi))


def chunk_counts(df: DataFrame, column: str = "id", size: int = 1000) -> DataFrame:
    """Row count per id chunk; empty chunks have no row."""
    chunk = F.floor((named(column) - 1) / size).cast("bigint")
    return df.groupBy(chunk.alias("chunk")).agg(F.count("*").alias("n"))
