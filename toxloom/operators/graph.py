"""Keyed upserts and merges over node and edge tables.

Every "last one wins" is an aggregate with a map-side part, never a window: however many updates one key holds,
each task ships a single row of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxloom.functions.cells import named

Key = str | Sequence[str]


def _list(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def has_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all there. Plain null tests reach the scan, which `dropna` does not."""
    for key in keys:
        df = df.where(named(key).isNotNull())
    return df


def _digest(df: DataFrame, cols: list[str]) -> Column:
    """Final tie break, so that a task run again after an executor loss picks the same row."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    parts = [
        F.array_sort(F.map_entries(named(c))) if isinstance(fields[c], T.MapType) else named(c) for c in cols
    ]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def last_by(df: DataFrame, key: Key, order_by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one that comes last in `order_by`. Null keys carry no identity and are dropped."""
    keys = _list(key)
    cols = [c for c in (cols or df.columns) if c not in keys]
    if not cols:
        return has_keys(df, keys).select(*map(named, keys)).dropDuplicates()
    order = F.struct(*map(named, order_by), _digest(df, cols).alias("_tie"))
    last = F.max_by(F.struct(*map(named, cols)), order).alias("_last")
    return has_keys(df, keys).groupBy(*map(named, keys)).agg(last).select(*map(named, keys), "_last.*")


def upsert_nodes(
    base: DataFrame | None, updates: DataFrame, key: Key, props: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Create or overwrite the listed properties; nulls overwrite too. Other columns of `base` survive."""
    keys, props = _list(key), list(props)
    if base is None:
        return last_by(updates, keys, order_by, props)
    kinds = {f.name: f.dataType for f in updates.schema.fields}
    extras = [c for c in base.columns if c not in keys and c not in props]
    # Old rows rank below every update: their order struct is null and the flag before it is false.
    order = F.struct(*map(named, order_by), _digest(updates, props).alias("_tie"))
    order_type = updates.select(order.alias("o")).schema["o"].dataType
    old = base.select(
        *map(named, keys),
        F.struct(*[
            (named(p).cast(kinds[p]) if p in base.columns else F.lit(None).cast(kinds[p])).alias(p) for p in props
        ]).alias("_props"),
        F.struct(*map(named, extras)).alias("_extra") if extras else F.lit(None).alias("_extra"),
        F.lit(False).alias("_new"),
        F.lit(None).cast(order_type).alias("_order"),
    )
    new = updates.select(
        *map(named, keys),
        F.struct(*map(named, props)).alias("_props"),
        F.lit(None).cast(old.schema["_extra"].dataType).alias("_extra"),
        F.lit(True).alias("_new"),
        order.alias("_order"),
    )
    rows = has_keys(old.unionByName(new), keys)
    aggs = [F.max_by("_props", F.struct("_new", "_order")).alias("_props")]
    if extras:
        aggs.append(F.max_by("_extra", F.when(~F.col("_new"), 1)).alias("_extra"))
    out = rows.groupBy(*map(named, keys)).agg(*aggs)
    return out.select(
        *map(named, keys),
        *[F.col("_extra").getField(c).alias(c) for c in extras],
        *[F.col("_props").getField(p).alias(p) for p in props],
    )


def update_nodes(
    base: DataFrame, updates: DataFrame, key: Key, props: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Overwrite properties of nodes that exist; updates of unknown keys are ignored. Nulls overwrite."""
    keys, props = _list(key), list(props)
    last = last_by(updates, keys, order_by, props).select(
        *map(named, keys), F.struct(*map(named, props)).alias("_set")
    )
    kinds = {f.name: f.dataType for f in updates.schema.fields}
    joined = base.join(last, keys, "left")
    hit = F.col("_set").isNotNull()

    def column(c: str) -> Column:
        if c not in props:
            return named(c)
        return F.when(hit, F.col("_set").getField(c)).otherwise(named(c).cast(kinds[c])).alias(c)

    added = [F.col("_set").getField(p).alias(p) for p in props if p not in base.columns]
    return joined.select(*map(column, base.columns), *added)


def merge_props(
    base: DataFrame | None, updates: DataFrame, key: Key, order_by: Sequence[str], props: str = "props"
) -> DataFrame:
    """Fold property maps per node: a value overwrites, a null removes, an absent key leaves the old value.

    The fold is taken apart into (node, property) pairs and each keeps its last value, so the updates of one node
    are never gathered; only its final properties meet in one group.
    """
    keys = _list(key)
    order = F.struct(*map(named, order_by), _digest(updates, [props]).alias("_tie"))
    new = updates.select(*map(named, keys), named(props).alias("_map"), F.lit(True).alias("_new"), order.alias("_order"))
    if base is not None:
        old = base.select(
            *map(named, keys), named(props).alias("_map"), F.lit(False).alias("_new"),
            F.lit(None).cast(new.schema["_order"].dataType).alias("_order"),
        )
        new = old.unionByName(new)
    cells = has_keys(new, keys).select(
        *map(named, keys), F.explode_outer("_map").alias("_prop", "_value"), F.struct("_new", "_order").alias("_seq")
    )
    last = cells.groupBy(*map(named, keys), "_prop").agg(F.max_by(F.struct("_value"), F.col("_seq")).alias("_last"))
    kept = F.when(
        F.col("_prop").isNotNull() & F.col("_last._value").isNotNull(), F.struct("_prop", "_last._value")
    )
    return last.groupBy(*map(named, keys)).agg(F.map_from_entries(F.collect_list(kept)).alias(props))


def merge_edges(edges: DataFrame, keys: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """At most one edge per key. Rows with a null end point are no edges."""
    keys = list(keys)
    rows = edges.select(*map(named, keys))
    if existing is not None:
        rows = existing.select(*map(named, keys)).unionByName(rows)
    return has_keys(rows, keys).dropDuplicates(keys)


def new_edges(edges: DataFrame, keys: Sequence[str], existing: DataFrame) -> DataFrame:
    """The merged edges that are not stored yet: what an incremental run appends."""
    return merge_edges(edges, keys).join(existing.select(*map(named, keys)), list(keys), "left_anti")


def upsert_edges(
    existing: DataFrame | None, edges: DataFrame, keys: Sequence[str], props: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Edges with properties: one per key, the last properties win."""
    return upsert_nodes(existing, edges, keys, props, order_by)
