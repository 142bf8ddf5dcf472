"""Line lists, pair files and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.functions.cells import na_to_null, named, stripped


def load_order() -> Column:
    """Order in which a row was read: file, split of the file, row in the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_id_list(spark: SparkSession, path: str, trim: bool = True) -> DataFrame:
    """One id per line. Without `trim` only the line end is dropped."""
    lines = spark.read.text(path).select("value", load_order().alias("seq"))
    return lines.withColumn("value", stripped(F.col("value"))) if trim else lines


def read_pairs(spark: SparkSession, path: str, on_bad: str = "fail") -> DataFrame:
    """`title|dtxsid` lines; further fields are ignored.

    A line without a second field fails the job, or with `on_bad="keep"` has a null id for the caller to set aside.
    """
    lines = read_id_list(spark, path)
    fields = lines.select(F.split("value", r"\|").alias("f"), "value", "seq")
    dtxsid = F.get("f", 1)
    if on_bad == "fail":
        dtxsid = F.coalesce(dtxsid, F.raise_error(F.concat(F.lit("no id in line: "), F.col("value"))).cast("string"))
    return fields.select(F.get("f", 0).alias("title"), dtxsid.alias("dtxsid"), "seq")


def read_wiki_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = True,
    missing_texts: bool = True, glob: str | None = None,
) -> DataFrame:
    """Headered CSV, all columns as text, empty and missing-value texts as null.

    `multi_line=False` lets Spark split large files when no cell holds a line break.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    clean = na_to_null if missing_texts else (lambda c: c)
    return df.select(*[clean(named(c)).alias(c) for c in (columns or df.columns)], load_order().alias("seq"))


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column one frame lacks is null there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_jdbc_range(spark: SparkSession, options: dict[str, str], lo: int, hi: int, partitions: int, column: str = "id") -> DataFrame:
    """Id range of a database table in parallel strides.

    The bounds only place the strides, so the range itself is a filter, which the source evaluates.
    """
    reader = spark.read.format("jdbc").options(**options).options(
        partitionColumn=column, lowerBound=str(lo), upperBound=str(hi), numPartitions=str(partitions)
    )
    return reader.load().where((named(column) >= lo) & (named(column) < hi))
