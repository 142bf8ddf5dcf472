"""Bridges that are kept up to date: edges between rows that name keys and the nodes that bear them, changed by what is new.

The stored table holds three sorts of rows, all in buckets by key: how often a row names a key (`pair`), which nodes bear it
(`node`), and the edges that follow (`edge`). Changes come as signed rows. With P, N and E for what is stored and dP, dN for what appears or
disappears, the edges change by `dP x N + P x dN + dP x dN`, joined by key: stored pairs meet only keys whose nodes changed, and
only buckets of changed keys are read and written. With `stubs` a key without nodes is borne by a stub, and its edges move
to the node that comes later, and back when it goes. The edges depend on the rows and nodes that hold, not on the order in which they came.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.functions.cells import named
from toxloom.operators.graph import has_keys
from toxloom.operators.joins import lookup_join
from toxloom.operators.unnest import unnest_ids
from toxloom.session import staged
from toxloom.streaming import stored

PAIR, NODE, EDGE = "pair", "node", "edge"


def named_keys(rows: DataFrame, src: str | Sequence[str], ids: str, dst: str = "key") -> DataFrame:
    """(src, key, sign): each key that a signed row's list holds, once a row."""
    src = [src] if isinstance(src, str) else list(src)
    lists = rows.select(*map(named, src), F.array_distinct(named(ids)).alias(ids), "sign")
    return unnest_ids(lists, ids, dst)


def _presence(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n, before and after: counts after the change, and whether they were and are above zero."""
    both = base.select(*keys, "n", F.lit(0).alias("_d")).unionByName(delta.select(*keys, F.lit(0).cast("bigint").alias("n"), F.col("sign").alias("_d")))
    sums = both.groupBy(*keys).agg(F.sum("n").alias("_was"), F.sum("_d").alias("_d"))
    return sums.select(*keys, (F.col("_was") + F.col("_d")).alias("n"), (F.col("_was") > 0).alias("before"), (F.col("_was") + F.col("_d") > 0).alias("after"))


def change_bridge(
    spark: SparkSession, root: str, pairs: DataFrame, nodes: DataFrame, src: str = "src", stubs: bool = False,
    buckets: int = stored.BUCKETS, meta: dict[str, Any] | None = None,
) -> stored.Version:
    """Apply signed changes: `pairs` are (src, key, sign), `nodes` are (key, node, sign). Either may be empty.

    Null keys carry no identity and are dropped. A change that is taken back within one call has no effect. Stubs are null nodes.
    """
    base = stored.open_version(spark, root)
    pairs = has_keys(pairs.select(named(src).alias("src"), "key", F.col("sign").cast("bigint").alias("sign")), ["src", "key"])
    nodes = has_keys(nodes.select("key", "node", F.col("sign").cast("bigint").alias("sign")), ["key", "node"])
    # The changes and the counts they lead to are read several times. Written once, no task holds their aggregates and the joins after them at a time.
    pairs = staged(pairs.groupBy("src", "key").agg(F.sum("sign").alias("sign")).where("sign <> 0"), "pairs")
    nodes = staged(nodes.groupBy("key", "node").agg(F.sum("sign").alias("sign")).where("sign <> 0"), "nodes")
    kinds = {"key": pairs.schema["key"].dataType.simpleString(), "src": pairs.schema["src"].dataType.simpleString(), "node": nodes.schema["node"].dataType.simpleString()}
    keys = pairs.select("key").unionByName(nodes.select(F.col("key").cast(kinds["key"]).alias("key"))).distinct()

    def rows(df: DataFrame, side: str, n: Column, sign: Column) -> DataFrame:
        own = [F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
        return df.select(*own, F.lit(side).alias("side"), n.cast("bigint").alias("n"), sign.cast("int").alias("sign"))

    def fold(old: DataFrame | None) -> DataFrame:
        if old is None:
            old = rows(pairs.limit(0), PAIR, F.lit(0), F.lit(0))
        of = lambda side: old.where(F.col("side") == side)
        p = staged(_presence(of(PAIR), pairs, ["key", "src"]), "pair-counts")
        n = staged(_presence(of(NODE), nodes, ["key", "node"]), "node-counts")
        # Nodes of the changed keys before and after, and where none bears the key, its stub.
        known = n.join(keys, "key", "left_semi")
        borne = known.select("key", "node", F.col("before").cast("int").alias("was"), F.col("after").cast("int").alias("now"))
        if stubs:
            held = borne.groupBy("key").agg(F.max("was").alias("was"), F.max("now").alias("now"))
            bare = keys.join(held, "key", "left").select(
                "key", F.lit(None).cast(kinds["node"]).alias("node"), (1 - F.coalesce("was", F.lit(0))).alias("was"), (1 - F.coalesce("now", F.lit(0))).alias("now"),
            )
            borne = borne.unionByName(bare)
        # dP x N_after + P_before x dN: the same three products in two joins.
        moved_pairs = p.where("before <> after").select("key", "src", (F.col("after").cast("int") - F.col("before").cast("int")).alias("d"))
        moved_nodes = borne.where("was <> now").select("key", "node", (F.col("now") - F.col("was")).alias("d"))
        first = lookup_join(moved_pairs, borne.where("now = 1").select("key", "node"), "key", "inner", ["src"]).select("key", "src", "node", "d")
        second = lookup_join(p.where("before").select("key", "src"), moved_nodes, "key", "inner", ["src"]).select("key", "src", "node", "d")
        live = of(EDGE).where("n > 0").select("key", "src", "node", F.lit(1).alias("e"), F.lit(0).alias("d"))
        delta = first.unionByName(second).select("key", "src", "node", F.lit(0).alias("e"), "d")
        e = live.unionByName(delta).groupBy("key", "src", "node").agg(F.sum("e").alias("e"), F.sum("d").alias("d"))
        return (
            rows(p.where("n <> 0"), PAIR, F.col("n"), F.lit(0))
            .unionByName(rows(n.where("n <> 0"), NODE, F.col("n"), F.lit(0)))
            .unionByName(rows(e.where("e + d > 0 or d <> 0"), EDGE, F.col("e") + F.col("d"), F.col("d")))
        )

    return stored.change(spark, root, "key", keys, fold, buckets, meta, base)


def catch_up(
    spark: SparkSession, root: str, facts: str, bearers: str, pairs: Callable[[DataFrame], DataFrame], nodes: Callable[[DataFrame], DataFrame],
    stubs: bool = False, buckets: int = stored.BUCKETS,
) -> stored.Version | None:
    """Bring the bridge at `root` up to the newest versions of two stored tables, from the buckets they wrote since.

    `pairs` and `nodes` make (src, key, sign) and (key, node, sign) of signed rows of `facts` and `bearers`. The bridge notes the versions it
    holds, so a run that died before it was put is made up for by the next one, and none is applied twice. `forget` on
    the two tables must leave those versions. None while either table is missing.
    """
    ends = [stored.open_version(spark, r) for r in (facts, bearers)]
    if None in ends:
        return None
    base = stored.open_version(spark, root)
    done = [base.meta[k] if base else 0 for k in ("facts", "bearers")]
    if done == [v.number for v in ends]:
        return base
    signed = [stored.signed_between(spark, r, n, v) for r, n, v in zip((facts, bearers), done, ends)]
    return change_bridge(spark, root, pairs(signed[0]), nodes(signed[1]), "src", stubs, buckets, {"facts": ends[0].number, "bearers": ends[1].number})


def bridge_edges(spark: SparkSession, version: stored.Version) -> DataFrame:
    """(key, src, node) of the edges that hold. A stub's node is null."""
    return stored.rows_of(spark, version).where((F.col("side") == EDGE) & (F.col("n") > 0)).select("key", "src", "node")


def edge_changes(spark: SparkSession, version: stored.Version) -> DataFrame:
    """(key, src, node, sign) of the edges that this version gained (1) and lost (-1)."""
    return stored.changed_rows(spark, version).where((F.col("side") == EDGE) & (F.col("sign") != 0)).select("key", "src", "node", "sign")
