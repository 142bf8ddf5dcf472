"""Wiki tables to the AOP graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.functions.cells import each, int_id, is_digits, named, project_props
from toxloom.operators.graph import has_keys, last_by, merge_edges, update_nodes, upsert_nodes
from toxloom.operators.joins import causes_edges, event_key, event_stubs, link_by_id
from toxloom.operators.substring import substring_link
from toxloom.operators.unnest import explode_csv_cell, explode_first_list, explode_zip_longest, flatten_rows
from toxloom.schemas import AOP_PROPS, EVENT_LEVEL_PROPS, EVENT_PROPS, RELATION_PROPS, STRESSOR_PROPS
from toxloom.session import staged
from toxloom.sources.pages import table_columns
from toxloom.streaming import bridges, stored

SHAPES = {"zip": explode_zip_longest, "first": explode_first_list, "flat": flatten_rows}


def main_page_table(table_rows: DataFrame, keys: Sequence[str], columns: Sequence[str], shape: str = "zip") -> DataFrame:
    """Rows of `html_table_rows` as named text columns with a `seq` order. Empty cells are null."""
    rows = SHAPES[shape](table_rows)
    item = F.col("item_pos") if "item_pos" in rows.columns else F.lit(0)
    rows = rows.withColumn("seq", F.struct(*map(named, keys), "pos", item.alias("item")))
    out = table_columns(rows, [*keys, "seq"], columns)
    return out.withColumns({c: F.nullif(named(c), F.lit("")) for c in columns})


def stressor_rows(stressors: DataFrame, column: str = "Associated AOPs") -> DataFrame:
    """One row per associated id; `seq` gains the place of the id in its cell."""
    parts = explode_csv_cell(stressors, column, pos="_pos")
    return parts.withColumns({column: F.nullif(named(column), F.lit("")), "seq": F.struct("seq", "_pos")}).drop("_pos")


def _keyed(rows: DataFrame, props: dict[str, str]) -> DataFrame:
    return project_props(rows, [int_id(named("ID")).alias("id"), F.col("seq")], props)


def aop_nodes(rows: DataFrame, base: DataFrame | None = None, lists: bool = False) -> DataFrame:
    """AOP nodes. Rows unnested from list cells share an id, so the last item is what a plain upsert leaves in `mie`
    and `ao`; with `lists` all items of both stay, in order, as arrays."""
    keyed = _keyed(rows, AOP_PROPS)
    if lists:
        keyed = staged(keyed, "aops")  # read four times below, and what it comes from may be pages to parse
    plain = base
    if base is not None and dict(base.dtypes).get("mie", "").startswith("array"):
        plain = base.withColumns({n: F.lit(None).cast("string") for n in ("mie", "ao")})  # lists are merged below
    nodes = upsert_nodes(plain, keyed, "id", list(AOP_PROPS), ["seq"])
    if not lists:
        return nodes
    # Unnested rows of a page row repeat its plain cells: an item counts once, at its first place. Repeats of a load fold
    # in the task that reads them, so a group holds distinct items only.
    def items(name: str) -> DataFrame:
        once = has_keys(keyed, ["id", name]).groupBy("id", name).agg(F.min("seq").alias("seq"))
        return once.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("seq", name))).alias("_items")).select(
            "id", F.transform("_items", lambda x: x[name]).alias(f"_{name}")
        )

    out = nodes.join(items("mie"), "id", "left").join(items("ao"), "id", "left").join(
        has_keys(keyed, ["id"]).select("id", F.lit(True).alias("_new")).distinct(), "id", "left"
    )
    # Stored AOPs that the load doesn't name keep what they have.
    kept = {n: F.when(F.col(n).isNotNull(), F.array(n)).otherwise(F.array().cast("array<string>")) for n in ("mie", "ao")}
    if base is not None and dict(base.dtypes).get("mie", "").startswith("array"):
        kept = {n: F.col(f"_base_{n}") for n in ("mie", "ao")}
        out = out.join(base.select("id", *[F.col(n).alias(f"_base_{n}") for n in ("mie", "ao")]), "id", "left")
    none = F.array().cast("array<string>")
    lists_of = {n: F.when(F.col("_new"), F.coalesce(f"_{n}", none)).otherwise(F.coalesce(kept[n], none)) for n in ("mie", "ao")}
    return out.select(*[lists_of[c].alias(c) if c in lists_of else named(c) for c in nodes.columns])


def event_nodes(rows: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Event nodes with the properties of both loads, which read the same rows, in one upsert."""
    props = {**EVENT_LEVEL_PROPS, **EVENT_PROPS}
    return upsert_nodes(base, _keyed(rows, props), "id", list(props), ["seq"])


def event_titles(rows: DataFrame) -> DataFrame:
    """(id, title) alone, for links over titles: the wide cells stay out of the shuffle."""
    return upsert_nodes(None, _keyed(rows, {"title": EVENT_PROPS["title"]}), "id", ["title"], ["seq"])


def relation_nodes(rows: DataFrame) -> DataFrame:
    """Relation nodes created by id, then their properties set."""
    created = last_by(_keyed(rows, {}), "id", ["seq"], ["seq"]).select("id")
    return update_nodes(created, _keyed(rows, RELATION_PROPS), "id", list(RELATION_PROPS), ["seq"])


def stressor_nodes(rows: DataFrame) -> DataFrame:
    keyed = project_props(
        rows, [int_id(named("ID")).alias("id"), F.col("seq"), int_id(named("Associated AOPs")).alias("aop_id")], STRESSOR_PROPS
    )
    return upsert_nodes(None, keyed, "id", [*STRESSOR_PROPS, "aop_id"], ["seq"])


def title_links(rows: DataFrame, aops: DataFrame, alias: str) -> DataFrame:
    """Edges AOP -> row id where the row's `AOPs` cell and the AOP title contain one another.

    `seq` tells rows apart, so cells are linked where they lie; rows of one id meet in the small edge table.
    """
    cells = rows.select(F.struct("seq", int_id(named("ID")).alias("id")).alias("row"), named("AOPs").alias("cell"))
    cells = cells.where(F.col("row.id").isNotNull() & F.col("cell").isNotNull())
    hits = substring_link(cells, "row", "cell", aops.select(F.col("id").alias("aop_id"), "title"), "aop_id", "title")
    return merge_edges(hits.select("aop_id", F.col("row.id").alias(alias)), ["aop_id", alias])


def id_links(rows: DataFrame, aops: DataFrame, alias: str) -> DataFrame:
    """As `title_links` for cells that hold AOP ids."""
    digits = rows.where(is_digits(named("AOPs"))).withColumn(alias, int_id(named("ID")))
    return link_by_id(digits, aops, alias, "AOPs", dst="aop_id")


def stressor_links(expanded: DataFrame, aops: DataFrame) -> DataFrame:
    rows = expanded.withColumn("stressor_id", int_id(named("ID")))
    return link_by_id(rows, aops, "stressor_id", "Associated AOPs", dst="aop_id")


def relation_ends(rows: DataFrame) -> DataFrame:
    """(id, up, down) of the relations that have an id."""
    ends = rows.select(
        int_id(named("ID")).alias("id"), named("Upstream Event").alias("up"), named("Downstream Event").alias("down")
    )
    return ends.where(F.col("id").isNotNull())


def with_stubs(events: DataFrame, ends: DataFrame, titles: DataFrame) -> DataFrame:
    """Event nodes plus one node without id per title only relations name."""
    return events.unionByName(event_stubs(ends, titles), allowMissingColumns=True)


def wiki_graph(
    aops: DataFrame, events: DataFrame, relations: DataFrame, stressors: DataFrame, mode: str = "title"
) -> dict[str, DataFrame]:
    """Node and edge tables from the four wiki tables (text columns plus `seq`)."""
    links = title_links if mode == "title" else id_links
    aop, ends, expanded = aop_nodes(aops), relation_ends(relations), stressor_rows(stressors)
    titles = event_titles(events)
    return {
        "AOP": aop,
        "Event": with_stubs(event_nodes(events), ends, titles),
        "KE_Relation": relation_nodes(relations),
        "Stressor": stressor_nodes(expanded),
        "HAS_EVENT": links(events, aop, "event_id"),
        "HAS_RELATIONSHIP": links(relations, aop, "relation_id"),
        "CAUSES": causes_edges(ends, titles),
        "ASSOCIATED_WITH": stressor_links(expanded, aop),
    }


# The causal graph over several loads ----------------------------------------------------------------------------------
#
# Relations name events by title and may come before them. Events are told apart by id; a title stands for every event that bears it
# now, and for a stub while none does. So the graph is the same whatever the order of the loads.

def load_relations(spark: SparkSession, root: str, ends: DataFrame, order_by: Sequence[str]) -> None:
    """Store relations (`id`, `up`, `down`), the last of an id wins, and move the edges of those that changed."""
    stored.replace_part(spark, f"{root}/relations", ends.select("id", "up", "down", *map(named, order_by)), "id", order_by)
    _settle_causes(spark, root)


def load_events(spark: SparkSession, root: str, events: DataFrame, order_by: Sequence[str]) -> None:
    """Store events (`id`, `title` and more), the last of an id wins. Edges move from stubs to events that bear their title now, and back."""
    stored.upsert_part(spark, f"{root}/events", events, "id", [c for c in events.columns if c != "id" and c not in order_by], order_by)
    _settle_causes(spark, root)


def _settle_causes(spark: SparkSession, root: str) -> None:
    def pairs(rows: DataFrame) -> DataFrame:
        end = lambda side: F.struct(F.struct("id", F.lit(side).alias("side")).alias("src"), F.col(side).alias("key"))
        return rows.select(each(F.array(end("up"), end("down"))).alias("_end"), "sign").select("_end.*", "sign")

    def nodes(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("title").alias("key"), F.col("id").alias("node"), "sign")

    for part, schema in (("relations", "id bigint, up string, down string"), ("events", "id bigint, title string")):
        if stored.open_version(spark, f"{root}/{part}") is None:  # the other load came first
            stored.change(spark, f"{root}/{part}", "id", None, lambda _: spark.createDataFrame([], schema))
    bridges.catch_up(spark, f"{root}/causes", f"{root}/relations", f"{root}/events", pairs, nodes, stubs=True)


def _causes(edges: DataFrame) -> DataFrame:
    event, relation, up = event_key(F.col("node"), F.col("key")), F.concat(F.lit("rel:"), F.col("src.id").cast("string")), F.col("src.side") == "up"
    return edges.select(
        F.when(up, event).otherwise(relation).alias("src"), F.when(up, relation).otherwise(event).alias("dst"), *[c for c in edges.columns if c == "sign"]
    )


def stored_causes(spark: SparkSession, root: str) -> DataFrame:
    """upstream event -> relation -> downstream event, as `causes_edges` gives them for all loads at once."""
    return _causes(bridges.bridge_edges(spark, stored.open_version(spark, f"{root}/causes")))


def edge_moves(spark: SparkSession, root: str) -> DataFrame:
    """Edges that the last load made (`sign` 1) and took away (-1)."""
    return _causes(bridges.edge_changes(spark, stored.open_version(spark, f"{root}/causes")))


def stored_event_nodes(spark: SparkSession, root: str) -> DataFrame:
    """Stored events and a node without id for each title that only relations name."""
    edges = bridges.bridge_edges(spark, stored.open_version(spark, f"{root}/causes"))
    stubs = edges.where("node is null").select(F.lit(None).cast("bigint").alias("id"), F.col("key").alias("title")).distinct()
    return stored.read_stored(spark, f"{root}/events").unionByName(stubs, allowMissingColumns=True)
