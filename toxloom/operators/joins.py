"""Equi joins between fact rows and node tables, coverage audits and unnested-id bridges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.functions.cells import each, int_id, named, safe_key
from toxloom.operators.graph import has_keys, last_by, merge_edges
from toxloom.operators.unnest import unnest_ids

SALTS = 32
FEW_BYTES = 16 << 20  # a counted and measured side within this may be broadcast
BLOCK = 256  # relations of a title that meet its events together


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast this side without being told to."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def splits_skew(spark: SparkSession) -> bool:
    """Whether adaptive execution cuts oversized join partitions, copying only their counterpart."""
    on = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(spark.conf.get(k).lower() == "true" for k in on)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "inner", spread: Sequence[str] | None = None
) -> DataFrame:
    """Join many rows to a lookup side, where one key may hold a large share of the rows.

    No side is forced to be broadcast: Catalyst does so within its size limit. Beyond it, adaptive execution splits
    the partition of a hot key by its map outputs. Where the session has that switched off, rows are salted over
    `SALTS` pieces by the `spread` columns (default: all) and the lookup side is copied to each piece.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: the lookup side may be copied, so its own rows can't be kept")
    on = [on] if isinstance(on, str) else list(on)
    if broadcastable(lookup) or splits_skew(rows.sparkSession):
        return rows.join(lookup, on, how)
    piece = F.pmod(F.xxhash64(*map(named, spread or rows.columns)), F.lit(SALTS)).cast("int")
    left = rows.withColumn("_salt", piece)
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def join_few(
    rows: DataFrame, lookup: DataFrame, on: str, how: str = "left", spread: Sequence[str] | None = None
) -> DataFrame:
    """`lookup_join` to a side that is usually tiny, such as rejected paths, whatever Spark's estimate of it.

    Its rows and text are measured first; within `FEW_BYTES` it is broadcast, so the many rows don't move.
    """
    n, chars = lookup.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(named(on).cast("string"))), F.lit(0))).first()
    if 64 * n + chars <= FEW_BYTES:
        return rows.join(F.broadcast(lookup), on, how)
    return lookup_join(rows, lookup, on, how, spread)


# Key attachment and audits ---------------------------------------------------------------------------------------

def title_map(pairs: DataFrame, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """Safe title -> id, the last line of a title wins."""
    keyed = pairs.select(safe_key(F.col("title")).alias("title"), "dtxsid", *map(named, order_by))
    return last_by(keyed, "title", order_by, ["dtxsid"])


def attach_dtxsid(rows: DataFrame, titles: DataFrame, title: str = "title", spread: Sequence[str] | None = None) -> DataFrame:
    """Left join: rows whose title is unknown keep a null id, for the caller to reject."""
    lookup = titles.select(named("title").alias(title), "dtxsid")
    return lookup_join(rows, lookup, title, "left", spread)


def missing_ids(expected: DataFrame, collected: DataFrame, key: str) -> DataFrame:
    """Expected ids that were not collected. Both sides shrink to distinct ids before they meet."""
    return (
        has_keys(expected.select(named(key)), [key]).dropDuplicates()
        .join(has_keys(collected.select(named(key)), [key]).dropDuplicates(), key, "left_anti")
    )


def coverage_audit(expected: DataFrame, collected: DataFrame, key: str) -> DataFrame:
    """Both differences and repeated collections in one aggregate: status is missing, unexpected or repeated."""
    sides = expected.select(named(key), F.lit(1).alias("_e"), F.lit(0).alias("_c")).unionByName(
        collected.select(named(key), F.lit(0).alias("_e"), F.lit(1).alias("_c"))
    )
    counts = has_keys(sides, [key]).groupBy(named(key)).agg(F.sum("_e").alias("_e"), F.sum("_c").alias("collected"))
    status = (
        F.when(F.col("collected") == 0, "missing").when(F.col("_e") == 0, "unexpected")
        .when(F.col("collected") > 1, "repeated")
    )
    return counts.select(named(key), status.alias("status"), "collected").where(F.col("status").isNotNull())


# Links -----------------------------------------------------------------------------------------------------------

def _ids(nodes: DataFrame, key: str, alias: str) -> DataFrame:
    """Node ids as a lookup side. A node table has one row per id, so nothing is deduplicated here."""
    return nodes.select(named(key).alias(alias)).where(F.col(alias).isNotNull())


def matched_pairs(rows: DataFrame, nodes: DataFrame, src: Sequence[str], ids: str, node_key: str = "id", dst: str = "dst") -> DataFrame:
    """Unnested ids that meet a node, one row per occurrence in the list."""
    pairs = unnest_ids(rows.select(*map(named, src), named(ids)), ids, dst)
    return lookup_join(pairs, _ids(nodes, node_key, dst), dst, "inner", src)


def affected(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("affected"))


def bridge(
    rows: DataFrame, nodes: DataFrame, src: Sequence[str], ids: str, node_key: str = "id", dst: str = "dst",
    unique_src: bool = False,
) -> DataFrame:
    """Edges from rows to the nodes their id list names.

    Lists lose repeats before they unnest. With `unique_src` (the source key is a node key) that alone makes the
    pairs unique and no shuffle for deduplication is left.
    """
    lists = rows.select(*map(named, src), F.array_distinct(named(ids)).alias(ids))
    pairs = matched_pairs(lists, nodes, src, ids, node_key, dst)
    return pairs.select(*src, dst) if unique_src else merge_edges(pairs, [*src, dst])


def link_by_id(rows: DataFrame, nodes: DataFrame, src: str, ref: str | Column, node_key: str = "id", dst: str = "dst") -> DataFrame:
    """Edges over a reference written as number text (`12`, `12.0`); pairs are distinct before the join."""
    ref = named(ref) if isinstance(ref, str) else ref
    pairs = merge_edges(rows.select(named(src), int_id(ref).alias(dst)), [src, dst])
    return lookup_join(pairs, _ids(nodes, node_key, dst), dst, "inner", [src]).select(src, dst)


def event_key(id_: Column, title: Column) -> Column:
    """Events are keyed by id, and by title alone where only a relation names them."""
    return F.coalesce(F.concat(F.lit("id:"), id_.cast("string")), F.concat(F.lit("title:"), title))


def event_stubs(relations: DataFrame, events: DataFrame, ends: Sequence[str] = ("up", "down")) -> DataFrame:
    """Titles that relations name and no event bears; each becomes an event without id."""
    named_ends = relations.select(each(F.array(*map(named, ends))).alias("title"))
    return missing_ids(named_ends, events, "title").select(F.lit(None).cast("bigint").alias("id"), "title")


def causes_edges(relations: DataFrame, events: DataFrame) -> DataFrame:
    """upstream event -> relation -> downstream event. Every event of a title matches; a stub stands in for none.

    Keys are written before the join: each of them stands in as many edges as its title has partners. Relations meet events in
    blocks of some `BLOCK`, so an event's edges to a block follow each other: written columns take a twentieth of the bytes.
    """
    ends = relations.select(
        named("id").alias("rel_id"),
        each(F.array(
            F.struct(F.lit(True).alias("up"), named("up").alias("title")),
            F.struct(F.lit(False).alias("up"), named("down").alias("title")),
        )).alias("_end"),
    ).select("rel_id", "_end.*")
    ends = has_keys(ends, ["rel_id", "title"]).dropDuplicates()
    ends = ends.select("up", "title", F.concat(F.lit("rel:"), F.col("rel_id").cast("string")).alias("_relation"))
    sizes = ends.groupBy("up", "title").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks"))
    ends = lookup_join(ends, sizes, ["up", "title"], "inner", ["_relation"])
    blocks = ends.groupBy("up", "title", F.pmod(F.xxhash64("_relation"), F.col("_blocks")).alias("_block")).agg(F.collect_list("_relation").alias("_relations"))
    # A row stands for thousands of edges: as many parts as the session shuffles to, however few bytes they have.
    blocks = blocks.repartition(int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")), "up", "title", "_block")
    titles = has_keys(events, ["title"]).select("title", event_key(F.col("id"), F.col("title")).alias("_key"))
    hits = lookup_join(blocks, titles, "title", "left", ["up", "_block"])
    event = F.coalesce(F.col("_key"), event_key(F.lit(None), F.col("title")))
    hits = hits.select("up", event.alias("_event"), each(F.col("_relations")).alias("_relation"))
    # Distinct (relation, side, title) times distinct event keys per title: the edges are distinct already.
    return hits.select(F.when(F.col("up"), F.col("_event")).otherwise(F.col("_relation")).alias("src"), F.when(F.col("up"), F.col("_relation")).otherwise(F.col("_event")).alias("dst"))


def link_chemicals(rows: DataFrame, chemicals: DataFrame, src: Sequence[str], key: str = "dtxsid") -> DataFrame:
    """Rows to the chemical node they name."""
    links = lookup_join(rows.select(*map(named, src), named(key)), _ids(chemicals, key, key), key, "inner", src)
    return links.select(*map(named, src), named(key))
