"""Bioactivity exports to raw table, nodes and bridge edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxloom.functions.cells import (
    bioactivity_title, clean_props, content_id, hit_call, is_number, name_or_unknown, named, null_sentinel,
    number, parse_ids,
)
from toxloom.operators.graph import last_by
from toxloom.operators.joins import attach_dtxsid, bridge, join_few, link_chemicals
from toxloom.operators.ordering import assign_ids
from toxloom.schemas import BIOACTIVITY_COLUMNS, NUMBER_COLUMNS, SHEET_COLUMNS
from toxloom.session import staged


def _fault(numbers: Sequence[str]) -> Column:
    """Why a row that was read makes its file unfit, or null."""
    bad_number = F.lit(False)
    for c in numbers:
        bad_number = bad_number | (named(c).isNotNull() & ~is_number(named(c)))
    return (
        F.when(F.size("absent") > 0, F.concat(F.lit("missing column "), F.array_join("absent", ", ")))
        .when(F.size("extra") > 0, F.concat(F.lit("unknown column "), F.array_join("extra", ", ")))
        .when(bad_number, "text in a number column")
    )


def load_bioactivity(rows: DataFrame, titles: DataFrame, stage: bool = True) -> tuple[DataFrame, DataFrame]:
    """(good, rejects) from decoded workbooks.

    A file loads as a whole or not at all. Files with a problem, those without rows included, become one reject row
    each, with the reason, and their rows are kept out. Good rows keep `path` and `row`.

    Files are judged by a narrow pass over their rows, and it is files that meet the titles. Then the rows meet the good
    files, broadcast where those are few. `stage` writes the rows once, as decoding twice costs more; pass False for rows that are stored already.
    """
    rows = null_sentinel(staged(rows, "decoded") if stage else rows, NUMBER_COLUMNS)
    read = F.col("error").isNull()
    judged = rows.groupBy("path").agg(
        F.min("file").alias("file"), F.min("error").alias("_error"), F.max(read).alias("_read"), F.min(F.when(read, _fault(NUMBER_COLUMNS))).alias("_fault"),
    )
    judged = attach_dtxsid(judged.withColumn("TITLE", bioactivity_title(F.col("file"))), titles.select("title", "dtxsid"), "TITLE", ["path"])
    fault = F.when(F.col("dtxsid").isNotNull(), F.col("_fault")).when(F.col("_read"), "no id for title")
    files = staged(judged.select("path", "file", "TITLE", F.col("dtxsid").alias("DTXSID"), F.least("_error", fault).alias("reason")), "files")
    rejects = files.where(F.col("reason").isNotNull()).select("path", "file", "reason")
    fit = files.where(F.col("reason").isNull()).select("path", "TITLE", "DTXSID")
    typed = [
        (number(named(c)) if c in NUMBER_COLUMNS else named(c)).alias(c) for c in BIOACTIVITY_COLUMNS
    ]
    own = rows.drop("TITLE", "DTXSID").where(F.col("row").isNotNull())
    return join_few(own, fit, "path", "inner", ["row"]).select("path", "row", *typed), rejects


def with_ids(good: DataFrame, stored: DataFrame | None = None, origin: bool = False) -> DataFrame:
    """Raw table: dense `id` by file and row; with `origin`, `path` and `row` too, which tell a later load what is stored.

    With `stored`, a raw table with its origin, rows that it has are left out, and ids go on after its highest.
    """
    if stored is None:
        return assign_ids(good, ["path", "row"]).select("id", *(["path", "row"] if origin else []), *map(named, BIOACTIVITY_COLUMNS))
    start = stored.agg(F.max("id")).first()[0] or 0
    new = good.join(stored.select("path", "row"), ["path", "row"], "left_anti")
    return assign_ids(new, ["path", "row"], start=start).select("id", "path", "row", *map(named, BIOACTIVITY_COLUMNS))


def bioactivity_nodes(raw: DataFrame, inactive_only: bool = False) -> DataFrame:
    """One node per raw row, with its property map, id lists and a content id that is equal for equal rows."""
    rows = hit_call(raw) if inactive_only else raw
    name = name_or_unknown(rows)
    props = clean_props(rows)
    return rows.select(
        "id", content_id(name, clean_props(rows, [c for c in rows.columns if c != "id"])).alias("content_id"),
        name.alias("name"), named("DTXSID").alias("dtxsid"), parse_ids(named("AOP")).alias("aop_ids"),
        parse_ids(named("EVENT")).alias("event_ids"), F.map_filter(props, lambda _, v: v.isNotNull()).alias("props"),
    )


def merged_by_content(nodes: DataFrame) -> DataFrame:
    """Nodes with equal content as one, as a merge on the content id leaves them."""
    return last_by(nodes, "content_id", ["id"])


def bioactivity_edges(nodes: DataFrame, events: DataFrame, aops: DataFrame, chemicals: DataFrame) -> dict[str, DataFrame]:
    """Edge tables. `id` is the node key, so pairs are unique without a deduplicating shuffle."""
    return {
        "RELATED_TO_EVENT": bridge(nodes, events, ["id"], "event_ids", "id", "event_id", unique_src=True),
        "RELATED_TO_AOP": bridge(nodes, aops, ["id"], "aop_ids", "id", "aop_id", unique_src=True),
        "OF_CHEMICAL": link_chemicals(nodes, chemicals, ["id"]),
    }
