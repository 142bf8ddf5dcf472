"""Column expressions that clean and parse single cells. All of them stay inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxloom.schemas import (
    ASSAY_PREFIX, DATED_SUFFIX, MISSING_NUMBER, NA_TEXTS, SPACES, SUMMARY_MARK, SUMMARY_SUFFIX,
)


def named(name: str) -> Column:
    """Column by its literal name, whatever dots or signs the header holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def stripped(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def each(items: Column) -> Column:
    """Explode an array that is costly to compute and never null or empty, or whose null row the caller drops.

    For a plain explode Catalyst infers a filter on the array's size and computes the array a second time for it.
    """
    return F.explode_outer(items)


# File names -----------------------------------------------------------------------------------------------------

def list_title(file: Column, prefix: str) -> Column:
    return F.regexp_replace(F.replace(file, F.lit(prefix), F.lit("")), DATED_SUFFIX, "")


def bioactivity_title(file: Column) -> Column:
    return F.regexp_replace(file, SUMMARY_SUFFIX, "")


def assay_name_short(file: Column, prefix: str = ASSAY_PREFIX) -> Column:
    """Name cut at its first hyphen. Distinct assays may collapse; `list_title` does not do that."""
    stem = F.regexp_replace(file, r"(?<=[^.])\.[^.]*$", "")
    return F.replace(F.substring_index(stem, "-", 1), F.lit(prefix), F.lit(""))


def bioactivity_name(file: Column) -> Column:
    return stripped(F.substring_index(file, SUMMARY_MARK, 1))


def safe_key(title: Column) -> Column:
    """Title as exports spell it in file names."""
    return F.translate(title, "%'/:", "____")


# Missing values and numbers --------------------------------------------------------------------------------------

def null_sentinel(df: DataFrame, cols: list[str], sentinel: str = MISSING_NUMBER) -> DataFrame:
    return df.withColumns({c: F.nullif(named(c), F.lit(sentinel)) for c in cols})


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [(n, t) for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({n: F.nanvl(named(n), F.lit(None).cast(t)) for n, t in floats})


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TEXTS), c)


NUMBER = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?)\s*$"


def is_number(c: Column) -> Column:
    return F.coalesce(c.rlike(NUMBER), F.lit(False))


def number(c: Column) -> Column:
    """Double, or null where the text is no number or is NaN. Texts are tested first: a failing cast throws inside."""
    text = c.cast("string")
    return F.when(is_number(text), text.try_cast("double"))


def int_id(c: Column) -> Column:
    """Integer of a text that may be written as a float (`12.0`); exact for plain integers, null beyond 64 bits."""
    text = c.cast("string")
    value = number(text)
    other = F.when((value >= -(2.0**63)) & (value < 2.0**63), value.try_cast("bigint"))
    # Nearly all texts are of the first kind: one pattern, no floating point.
    short = F.when(text.rlike(r"^\s*[+-]?[0-9]{1,15}(?:\.0*)?\s*$"), F.substring_index(text, ".", 1).try_cast("bigint"))
    return short.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint")).otherwise(other)


def is_digits(c: Column) -> Column:
    return c.isNotNull() & c.rlike(r"^[0-9]+\z")


def name_or_unknown(df: DataFrame, column: str = "NAME") -> Column:
    return F.coalesce(named(column), F.lit("unknown")) if column in df.columns else F.lit("unknown")


# Id lists and property maps --------------------------------------------------------------------------------------

def parse_ids(cell: Column) -> Column:
    """Digit tokens between blanks and bars, in order, duplicates kept; a null cell gives an empty array."""
    tokens = F.regexp_extract_all(stripped(cell.cast("string")), F.lit(r"(?<![^| ])[0-9]++(?![^| ])"), F.lit(0))
    return F.coalesce(F.array_compact(tokens.try_cast("array<bigint>")), F.array().cast("array<bigint>"))


def clean_name(name: str) -> str:
    return re.sub(r"\W+", "_", name)


def clean_props(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Map of cleaned column name to cell text. Where two names clean to one key, the later column wins."""
    source = {clean_name(c): c for c in (cols or df.columns)}
    return F.create_map(*[x for key, c in source.items() for x in (F.lit(key), named(c).cast("string"))])


def clean_keys(props: Column) -> Column:
    """Cleaned keys for maps whose keys are data; of keys that clean to one name the last wins. `(?U)` makes Java's word class Unicode-wide."""
    entries = F.transform(F.map_entries(props), lambda e: F.struct(F.regexp_replace(e["key"], r"(?U)\W+", "_").alias("key"), e["value"].alias("value")))
    keys = F.transform(entries, lambda e: e["key"])
    # From the end, a key's first place is its last one.
    last = F.filter(entries, lambda e, i: F.size(keys) - F.array_position(F.reverse(keys), e["key"]) == i)
    return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), entries).otherwise(last))


def content_id(name: Column, props: Column) -> Column:
    """Name plus a digest of all properties that ignores their order and is the same in every run."""
    entries = F.array_sort(F.map_entries(props))
    return F.concat(name, F.sha2(F.to_json(F.map_from_entries(entries)), 256))


# Row shapes ------------------------------------------------------------------------------------------------------

def with_leading(df: DataFrame, lead: dict[str, Column]) -> DataFrame:
    rest = [named(c) for c in df.columns if c not in lead]
    return df.select(*[c.alias(n) for n, c in lead.items()], *rest)


def project_props(
    df: DataFrame,
    keys: list[Column],
    mapping: dict[str, str],
    types: dict[str, str] | None = None,
    required: tuple[str, ...] = (),
) -> DataFrame:
    """Source columns renamed to node properties. Absent optional columns become null."""
    types = types or {}

    def prop(name: str, source: str) -> Column:
        if source not in df.columns:
            if source in required:
                raise ValueError(f"column {source!r} is required")
            return F.lit(None).cast(types.get(name, "string")).alias(name)
        kind = types.get(name)
        if kind == "double":
            return number(named(source)).alias(name)
        if kind == "bigint":
            return int_id(named(source)).alias(name)
        return named(source).alias(name)

    return df.select(*keys, *[prop(n, s) for n, s in mapping.items()])


def hit_call(df: DataFrame, call: str = "Inactive", column: str = "HIT_CALL", collation: str | None = None) -> DataFrame:
    """Rows with one hit call; pass `UTF8_LCASE` for a store whose collation ignores case."""
    c = named(column)
    return df.where((F.collate(c, collation) if collation else c) == F.lit(call))
