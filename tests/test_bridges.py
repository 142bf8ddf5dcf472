import random

import pytest
from pyspark.sql import functions as F

from toxloom.plans import wiki
from toxloom.streaming import bridges as B
from toxloom.streaming import stored as S

PAIRS, NODES = "src int, key string, sign int", "key string, node bigint, sign int"


@pytest.mark.parametrize("stubs", [False, True])
def test_equal_to_a_rebuild_after_inserts_changes_and_removals(spark, tmp_path, rows, stubs):
    rng = random.Random(stubs)
    root, facts, bears, edges = f"{tmp_path}/b", {}, set(), set()
    for step in range(6):
        pairs, nodes = [], []
        for src in rng.sample(range(30), 8):
            old, new = facts.get(src, set()), set(rng.sample("abcdefgh", rng.randint(0, 3)))
            pairs += [(src, k, -1) for k in old] + [(src, k, 1) for k in new]
            facts[src] = new
        for pair in {(rng.choice("abcdefghxy"), rng.randint(1, 6)) for _ in range(5)}:
            nodes.append((*pair, -1 if pair in bears else 1))
            bears ^= {pair}
        pairs.append((None, "a", 1))
        nodes.append((None, 5, 1))
        v = B.change_bridge(spark, root, spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(nodes, NODES), stubs=stubs, buckets=4)
        want = {(k, src, n) for src, ks in facts.items() for k in ks for kk, n in bears if kk == k}
        if stubs:
            want |= {(k, src, None) for src, ks in facts.items() for k in ks if k not in {x for x, _ in bears}}
        assert rows(B.bridge_edges(spark, v)) == sorted(want, key=repr)
        changes = rows(B.edge_changes(spark, v))
        assert changes == sorted([(*e, 1) for e in want - edges] + [(*e, -1) for e in edges - want], key=repr)
        edges = want


def test_only_buckets_of_changed_keys_are_written(spark, tmp_path):
    root = f"{tmp_path}/b"
    many = spark.range(2000).select(F.col("id").alias("src"), (F.col("id") % 500).cast("string").alias("key"), F.lit(1).alias("sign"))
    nodes = spark.range(500).select(F.col("id").cast("string").alias("key"), F.col("id").alias("node"), F.lit(1).alias("sign"))
    B.change_bridge(spark, root, many, nodes, buckets=16)
    v = B.change_bridge(spark, root, many.limit(0), spark.createDataFrame([("7", 7, -1)], NODES))
    assert len(v.changed) == 1
    assert sorted(r.src for r in B.edge_changes(spark, v).collect()) == [7, 507, 1007, 1507]
    assert B.bridge_edges(spark, v).count() == 1996
    same = B.change_bridge(spark, root, spark.createDataFrame([(1, "3", 1), (1, "3", -1)], PAIRS), nodes.limit(0))
    assert same.number == v.number  # taken back: nothing is written


def test_catches_up_with_stored_tables(spark, tmp_path, rows):
    facts, bearers, root = f"{tmp_path}/facts", f"{tmp_path}/nodes", f"{tmp_path}/b"
    lists = lambda *r: S.replace_part(spark, facts, spark.createDataFrame(r, "id int, ids array<int>, gone boolean"), "id", (), "gone")
    bear = lambda *r: S.replace_part(spark, bearers, spark.createDataFrame(r, "id int, gone boolean"), "id", (), "gone")
    up = lambda: B.catch_up(
        spark, root, facts, bearers, lambda r: B.named_keys(r, "id", "ids").withColumnRenamed("id", "src"), lambda r: r.select(F.col("id").alias("key"), F.col("id").alias("node"), "sign"))
    lists((1, [1, 2, 2], False), (2, [3], False), (3, [4], False))
    assert up() is None
    bear((1, False), (2, False), (3, False), (4, False))
    assert rows(B.bridge_edges(spark, up()).select("src", "node")) == [(1, 1), (1, 2), (2, 3), (3, 4)]
    lists((1, [2, 5], False), (2, None, True), (7, [7, 7], False))
    lists((3, [4], False))      # comes again unchanged
    bear((5, False), (4, True))
    v = up()                    # several versions at once
    assert rows(B.bridge_edges(spark, v).select("src", "node")) == [(1, 2), (1, 5)]
    assert rows(B.edge_changes(spark, v).select("src", "node", "sign")) == [(1, 1, -1), (1, 5, 1), (2, 3, -1), (3, 4, -1)]
    assert up().number == v.number
    bear((7, False), (4, False))
    assert rows(B.bridge_edges(spark, up()).select("src", "node")) == [(1, 2), (1, 5), (3, 4), (7, 7)]


def test_loads_in_either_order_give_one_graph(spark, tmp_path, rows):
    relations = spark.createDataFrame([(1, "A", "B", 0), (2, "B", "C", 1), (3, "A", None, 2)], "id bigint, up string, down string, seq int")
    events = spark.createDataFrame([(10, "A", 0), (11, "B", 1), (12, "B", 2), (13, "Z", 3)], "id bigint, title string, seq int")
    graphs = []
    for name, order in (("x", "re"), ("y", "er")):
        root = f"{tmp_path}/{name}"
        for load in order:
            if load == "r":
                wiki.load_relations(spark, root, relations, ["seq"])
            else:
                wiki.load_events(spark, root, events, ["seq"])
        graphs.append((rows(wiki.stored_causes(spark, root)), rows(wiki.stored_event_nodes(spark, root).select("id", "title"))))
    assert graphs[0] == graphs[1]
    assert graphs[0][0] == sorted([("id:10", "rel:1"), ("rel:1", "id:11"), ("rel:1", "id:12"), ("id:11", "rel:2"), ("id:12", "rel:2"), ("rel:2", "title:C"), ("id:10", "rel:3")], key=repr)
    assert graphs[0][1] == sorted([(10, "A"), (11, "B"), (12, "B"), (13, "Z"), (None, "C")], key=repr)
    # A title that gains its event, an event that changes its title, a relation that changes an end.
    wiki.load_events(spark, root, spark.createDataFrame([(14, "C", 0), (10, "A2", 1)], "id bigint, title string, seq int"), ["seq"])
    assert rows(wiki.edge_moves(spark, root)) == sorted([
        ("rel:2", "id:14", 1), ("rel:2", "title:C", -1), ("id:10", "rel:1", -1), ("title:A", "rel:1", 1), ("id:10", "rel:3", -1), ("title:A", "rel:3", 1)], key=repr)
    wiki.load_relations(spark, root, spark.createDataFrame([(3, "Z", "A2", 0)], "id bigint, up string, down string, seq int"), ["seq"])
    got = rows(wiki.stored_causes(spark, root))
    assert ("id:13", "rel:3") in got and ("rel:3", "id:10") in got and ("title:A", "rel:3") not in got and ("title:A", "rel:1") in got


def test_changes_are_computed_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    pairs = spark.range(100).selectExpr("id AS src", "id % 7 AS key", "1 AS sign").mapInArrow(counted, "src bigint, key bigint, sign int")
    nodes = spark.range(5).selectExpr("id AS key", "id AS node", "1 AS sign")
    version = B.change_bridge(spark, f"{tmp_path}/b", pairs, nodes)
    assert B.bridge_edges(spark, version).count() == sum(i % 7 < 5 for i in range(100)) and calls.value == 100
