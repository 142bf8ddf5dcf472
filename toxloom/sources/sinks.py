"""Writers for tables, CSV files and page stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from toxloom.functions.cells import named
from toxloom.operators.graph import last_by
from toxloom.session import exists
from toxloom.streaming.stored import replace_part


def append_table(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """Append by column name. A column the table does not have is an error, one the frame lacks is null.

    Without `schema`, that of the stored table holds, if there is one.
    """
    if schema is None:
        stored = stored_or_none(df.sparkSession, path)
        schema = stored.schema if stored is not None else None
    if schema is not None:
        unknown = [c for c in df.columns if c not in schema.fieldNames()]
        if unknown:
            raise ValueError(f"the table has no column {', '.join(unknown)}")
        df = df.sparkSession.createDataFrame([], schema).unionByName(df, allowMissingColumns=True)
        df = df.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    df.write.mode("append").parquet(path)


def append_nodes(df: DataFrame, path: str, key: str | Sequence[str] | None = None, order_by: Sequence[str] = ()) -> None:
    """Bulk create. With `key`, nodes already stored are skipped, so a second run adds none.

    The key must identify a node over all loads, such as (path, row) or a content id; a number given out by one run does not.
    Of rows that repeat a key the last in `order_by` is stored; ties go by the rows' content, so a rerun picks the same.
    """
    if key is not None:
        keys = [key] if isinstance(key, str) else list(key)
        stored = stored_or_none(df.sparkSession, path)
        columns = df.columns
        df = last_by(df, keys, order_by).select(*map(named, columns))
        if stored is not None:
            df = df.join(stored.select(*map(named, keys)), keys, "left_anti")
    df.write.mode("append").parquet(path)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at `path`, or None before its first write."""
    return spark.read.parquet(path) if exists(spark, path) else None


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered UTF-8 CSV with doubled quotes; nulls are empty cells."""
    df.write.mode(mode).options(
        header=True, quote='"', escape='"', emptyValue="", nullValue="", encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_pages(df: DataFrame, path: str, order_by: Sequence[str]) -> None:
    """Page store, one row per (kind, id): the last fetch wins, and a later call wins over stored pages. Other pages stay.

    The store is a table in buckets by (kind, id): a call writes only those of its pages. `read_pages` reads it.
    """
    replace_part(df.sparkSession, path, df, ["kind", "id"], order_by)
