"""Assay and chemical exports to raw tables and the Chemical/Assay graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxloom.functions.cells import assay_name_short, list_title, named, project_props, with_leading
from toxloom.operators.graph import merge_edges, upsert_edges, upsert_nodes
from toxloom.operators.joins import join_few
from toxloom.schemas import (
    ASSAY_CHEMICAL_PROPS, ASSAY_PREFIX, CHEMICAL_PREFIX, CHEMICAL_PROPS, CHEMICAL_TYPES, RESULT_PROPS, RESULT_TYPES,
)
from toxloom.session import staged

SHEET_META = ["path", "file", "row", "absent", "extra", "error"]
ORDER = ["path", "row"]


def whole_files(rows: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Rows of the files that were read to their end and have the required columns.

    The decoded rows are written once here, as every plan reads them more than once: callers pass the scan itself.
    """
    rows = staged(rows, "sheets")
    broken = rows.where(F.col("error").isNotNull()).select("path", F.lit(True).alias("_broken")).dropDuplicates()
    kept = join_few(rows, broken, "path", "left", ["row"])
    kept = kept.where(F.col("_broken").isNull() & F.col("row").isNotNull()).drop("_broken")
    if required:
        kept = kept.where(~F.coalesce(F.arrays_overlap("absent", F.array(*map(F.lit, required))), F.lit(False)))
    return kept


def raw_list(rows: DataFrame, prefix: str, lead: str) -> DataFrame:
    """Raw table of an export: list name first, then the sheet columns."""
    good = whole_files(rows)
    return with_leading(good, {lead: list_title(F.col("file"), prefix)}).drop(*SHEET_META)


def raw_assays(rows: DataFrame) -> DataFrame:
    return raw_list(rows, ASSAY_PREFIX, "ASSAY NAME")


def raw_chemicals(rows: DataFrame) -> DataFrame:
    return raw_list(rows, CHEMICAL_PREFIX, "CHEMICAL NAME")


def chemical_nodes(rows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    good = whole_files(rows, ("DTXSID", "PREFERRED NAME", "CASRN"))
    keyed = project_props(
        good, [named("DTXSID").alias("dtxsid"), *map(F.col, ORDER)], CHEMICAL_PROPS, CHEMICAL_TYPES,
        required=("PREFERRED NAME", "CASRN"),
    )
    return upsert_nodes(base, keyed, "dtxsid", list(CHEMICAL_PROPS), ORDER)


def assay_results(rows: DataFrame, base: DataFrame | None = None, short_names: bool = False) -> dict[str, DataFrame]:
    """Chemical nodes, assay nodes and result edges: three projections of the same rows."""
    good = whole_files(rows, ("DTXSID", *ASSAY_CHEMICAL_PROPS.values(), *RESULT_PROPS.values()))
    name = assay_name_short(F.col("file")) if short_names else list_title(F.col("file"), ASSAY_PREFIX)
    keys = [named("DTXSID").alias("dtxsid"), name.alias("assay"), *map(F.col, ORDER)]
    chemicals = project_props(good, keys, ASSAY_CHEMICAL_PROPS, {"mass": "double"}, tuple(ASSAY_CHEMICAL_PROPS.values()))
    results = project_props(good, keys, RESULT_PROPS, RESULT_TYPES, tuple(RESULT_PROPS.values()))
    return {
        "Chemical": upsert_nodes(base, chemicals, "dtxsid", list(ASSAY_CHEMICAL_PROPS), ORDER),
        "Assay": merge_edges(results.where(F.col("dtxsid").isNotNull()).select(F.col("assay").alias("name")), ["name"]),
        "HAS_RESULT": upsert_edges(None, results, ["dtxsid", "assay"], list(RESULT_PROPS), ORDER),
    }
