"""Unnesting of list cells, delimited cells and id arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxloom.functions.cells import each, named, stripped


def _others(df: DataFrame, *dropped: str) -> list[Column]:
    return [named(c) for c in df.columns if c not in dropped]


def explode_first_list(rows: DataFrame, cells: str = "cells", lists: str = "lis") -> DataFrame:
    """One row per item of the first cell that holds a list; every list cell shows that item."""
    first = F.get(F.filter(named(lists), lambda x: F.size(x) > 0), 0)
    split = rows.select(*_others(rows), F.posexplode_outer(first).alias("item_pos", "_item"))
    filled = F.transform(
        named(cells),
        lambda text, i: F.when(F.size(F.get(named(lists), i)) > 0, F.col("_item")).otherwise(text),
    )
    return split.select(*_others(rows, cells, lists), F.coalesce("item_pos", F.lit(0)).alias("item_pos"), filled.alias(cells))


def longest_list(lists: Column) -> Column:
    return F.array_max(F.transform(lists, F.size))


def explode_zip_longest(rows: DataFrame, cells: str = "cells", lists: str = "lis") -> DataFrame:
    """One row per position of the longest list; shorter lists are padded with an empty text."""
    last = F.greatest(F.coalesce(longest_list(named(lists)), F.lit(1)), F.lit(1)) - 1
    split = rows.select(*_others(rows), each(F.sequence(F.lit(0), last)).alias("item_pos"))
    filled = F.transform(
        named(cells),
        lambda text, i: F.when(
            F.size(F.get(named(lists), i)) > 0,
            F.coalesce(F.get(F.get(named(lists), i), F.col("item_pos")), F.lit("")),
        ).otherwise(text),
    )
    return split.select(*_others(rows, cells, lists), "item_pos", filled.alias(cells))


def flatten_rows(rows: DataFrame, lists: str = "lis") -> DataFrame:
    """Table rows as they stand, list cells as their whole text."""
    return rows.select(*_others(rows, lists))


def explode_csv_cell(df: DataFrame, column: str, keep: Sequence[str] | None = None, pos: str | None = None) -> DataFrame:
    """One row per comma-separated part, trimmed; an empty cell keeps one row with an empty text.

    `pos` names a column for the place of the part in its cell.
    """
    kept = [c for c in (keep if keep is not None else df.columns) if c != column]
    parts = F.posexplode_outer(F.split(F.coalesce(named(column), F.lit("")), ",")).alias("_pos", "_part")
    place = [F.col("_pos").alias(pos)] if pos else []
    return df.select(*map(named, kept), parts).select(*map(named, kept), *place, stripped(F.col("_part")).alias(column))


def unnest_ids(df: DataFrame, column: str, alias: str = "dst") -> DataFrame:
    """One row per id; empty and null arrays give none."""
    return df.select(*_others(df, column), each(named(column)).alias(alias)).where(F.col(alias).isNotNull())
