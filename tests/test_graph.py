import random

import pytest
from pyspark.sql import functions as F

from toxloom.operators import graph as G
from toxloom.operators import joins as J
from toxloom.operators.substring import substring_link


def test_upsert_null_overwrites_and_extras_survive(spark, rows):
    base = spark.createDataFrame([(1, "keep", "old"), (2, "two", "old2")], "id int, extra string, x string")
    updates = spark.createDataFrame([(1, "a", 1), (1, None, 2), (3, "new", 1), (None, "n", 1)], "id int, x string, seq int")
    out = G.upsert_nodes(base, updates, "id", ["x"], ["seq"]).select("id", "extra", "x")
    assert rows(out) == [(1, "keep", None), (2, "two", "old2"), (3, None, "new")]
    again = G.upsert_nodes(out, updates, "id", ["x"], ["seq"]).select("id", "extra", "x")
    assert rows(again) == rows(out)


def test_upsert_does_not_depend_on_input_order(spark, rows):
    data = [(k, f"v{k}-{s}", s) for k in range(20) for s in range(30)]
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "id int, x string, seq int").repartition(4)
        results.append(rows(G.upsert_nodes(None, df, "id", ["x"], ["seq"])))
    assert results[0] == results[1] == sorted([(k, f"v{k}-29") for k in range(20)], key=repr)


def test_last_by_breaks_ties_the_same_way(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c")], "id int, x string").withColumn("seq", F.lit(0))
    picks = {rows(G.last_by(df.repartition(n), "id", ["seq"], ["x"]))[0] for n in (1, 2, 3)}
    assert len(picks) == 1


def test_merge_props(spark):
    base = spark.createDataFrame([(1, {"a": "1", "b": "2"}), (2, {})], "id int, props map<string,string>")
    new = spark.createDataFrame(
        [(1, {"b": None, "c": "3"}, 1), (1, {"c": "4"}, 2), (3, {"x": None}, 1)], "id int, props map<string,string>, seq int"
    )
    out = {r.id: r.props for r in G.merge_props(base, new, "id", ["seq"]).collect()}
    assert out == {1: {"a": "1", "c": "4"}, 2: {}, 3: {}}


def test_update_nodes_never_creates(spark, rows):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, x string, n int")
    up = spark.createDataFrame([(1, None, 1), (9, "z", 1)], "id int, x string, seq int")
    assert rows(G.update_nodes(base, up, "id", ["x"], ["seq"])) == [(1, None, 5), (2, "b", 6)]


def test_edges_merge_once(spark, rows):
    e = spark.createDataFrame([(1, 2), (1, 2), (1, None), (3, 4)], "src int, dst int")
    once = G.merge_edges(e, ["src", "dst"])
    assert rows(once) == rows(G.merge_edges(e, ["src", "dst"], once)) == [(1, 2), (3, 4)]
    assert G.new_edges(e, ["src", "dst"], once).count() == 0
    props = spark.createDataFrame([(1, 2, "a", 1), (1, 2, None, 2)], "src int, dst int, p string, seq int")
    assert rows(G.upsert_edges(None, props, ["src", "dst"], ["p"], ["seq"])) == [(1, 2, None)]


@pytest.fixture(params=["adaptive", "salted"])
def join_mode(request, spark):
    """Both ways of a join whose lookup side is too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    if request.param == "salted":
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_bridge_with_a_hot_id(spark, rows, join_mode):
    data = [(i, [7, 7, i % 50, 1000 + i]) for i in range(600)] + [(600, []), (601, None)]
    df = spark.createDataFrame(data, "id int, ids array<bigint>")
    nodes = spark.range(0, 60)
    expected = sorted([(i, d) for i in range(600) for d in {7, i % 50}], key=repr)
    assert rows(J.bridge(df, nodes, ["id"], "ids")) == expected
    assert rows(J.bridge(df, nodes, ["id"], "ids", unique_src=True)) == expected
    assert J.affected(J.matched_pairs(df, nodes, ["id"], "ids")).first().affected == 1800


def test_left_lookup_keeps_null_keys(spark, rows, join_mode):
    left = spark.createDataFrame([(i, None if i % 3 == 0 else "a") for i in range(9)], "i int, k string")
    look = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    out = J.lookup_join(left, look, "k", "left", ["i"]).select("i", "v")
    assert rows(out) == sorted([(i, None if i % 3 == 0 else 1) for i in range(9)], key=repr)


def test_link_by_id(spark, rows):
    s = spark.createDataFrame([(1, "12.0"), (1, "13"), (1, None), (1, "12"), (2, "x")], "sid int, aop string")
    assert rows(J.link_by_id(s, spark.range(12, 14), "sid", "aop")) == [(1, 12), (1, 13)]


def test_resolve_events(spark, rows):
    events = spark.createDataFrame([(1, "t"), (2, "t"), (3, "u")], "id bigint, title string")
    rel = spark.createDataFrame([(10, "t", "none"), (11, None, "u"), (12, "none", "none")], "id bigint, up string, down string")
    assert rows(J.event_stubs(rel, events)) == [(None, "none")]
    assert rows(J.causes_edges(rel, events)) == sorted([
        ("id:1", "rel:10"), ("id:2", "rel:10"), ("rel:10", "title:none"), ("rel:11", "id:3"),
        ("title:none", "rel:12"), ("rel:12", "title:none"),
    ], key=repr)


def test_relations_meet_events_in_blocks(spark):
    """Edges of an event to a block follow each other, so that a written table takes little room; titles may be null, rows repeat."""
    rel = spark.range(1000).selectExpr("id", "'t' AS up", "IF(id % 2 = 0, 'seg', null) AS down")
    events = spark.createDataFrame([(i, "t") for i in range(50)] + [(99, None)], "id bigint, title string")
    got = [tuple(r) for r in J.causes_edges(rel.unionByName(rel), events).collect()]
    assert sorted(got) == sorted([(f"id:{e}", f"rel:{r}") for r in range(1000) for e in range(50)] + [(f"rel:{r}", "title:seg") for r in range(0, 1000, 2)])
    ups = [src for src, _ in got if src.startswith("id:")]
    assert sum(a != b for a, b in zip(ups, ups[1:])) <= 50 * 2 * -(-1000 // J.BLOCK)


def test_audit(spark, rows):
    e = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    c = spark.createDataFrame([("b",), ("c",), ("b",)], "k string")
    assert rows(J.missing_ids(e, c, "k")) == [("a",)]
    assert rows(J.coverage_audit(e, c, "k")) == [("a", "missing", 0), ("b", "repeated", 2), ("c", "unexpected", 1)]


def test_title_map_and_attach(spark, rows):
    pairs = spark.createDataFrame([("a/b", "D1", 1), ("a:b", "D2", 2)], "title string, dtxsid string, seq int")
    files = spark.createDataFrame([("a_b",), ("zz",)], "title string")
    assert rows(J.attach_dtxsid(files, J.title_map(pairs))) == [("a_b", "D2"), ("zz", None)]


def brute(left, right):
    return sorted(
        [(i, j) for i, a in left for j, b in right if a is not None and b is not None and (a in b or b in a)], key=repr
    )


TEXTS = [
    "Liver fibrosis", "Liver", "liver", None, "", " ", "fibrosis of the liver and more of it", "of the liver and more of",
    "a", "ab", "b ab", "é🙂ö naïve 🙂🙂 text with surrogate pairs 🙂", "🙂🙂 text with surrogate", "Liver fibrosis", "ä ö ü ß ä ö ü ß ä ö ü ß ä",
    "line\nbreak in the middle of it", "break in the middle", "tab\tand  two  blanks  in a row here", "  two  blanks  in a ",
]


@pytest.mark.parametrize("small", [True, False])
def test_substring_link_equals_all_pairs(spark, rows, small):
    rnd = random.Random(5)
    words = ["increase", "of", "x", "cell", "death", "é", "in", "the", "liver"]
    left = list(enumerate(TEXTS + [" ".join(rnd.choices(words, k=rnd.randint(1, 14))) for _ in range(60)]))
    right = list(enumerate(TEXTS[::-1] + [" ".join(rnd.choices(words, k=rnd.randint(1, 5))) for _ in range(40)]))
    l = spark.createDataFrame(left, "l int, t string")
    r = spark.createDataFrame(right, "r int, t string")
    if not small:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(substring_link(l, "l", "t", r, "r", "t")) == brute(left, right)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_substring_link_with_shuffled_anchors(spark, rows, monkeypatch):
    import toxloom.operators.substring as mod

    monkeypatch.setattr(mod, "SMALL_ANCHORS", 3)
    monkeypatch.setattr(mod, "SMALL_CHARS", 0)
    left, right = list(enumerate(TEXTS)), list(enumerate(TEXTS[::-1]))
    l, r = spark.createDataFrame(left, "l int, t string"), spark.createDataFrame(right, "r int, t string")
    assert rows(substring_link(l, "l", "t", r, "r", "t")) == brute(left, right)


def test_substring_link_of_nothing(spark):
    l = spark.createDataFrame([(1, "a")], "l int, t string")
    r = spark.createDataFrame([], "r int, t string")
    assert substring_link(l, "l", "t", r, "r", "t").count() == 0
    assert substring_link(r, "r", "t", l, "l", "t").count() == 0
