from pyspark.sql import functions as F

from toxloom.operators import ordering as O
from toxloom.operators import unnest as U


def lists(spark):
    return spark.createDataFrame(
        [(1, ["x", "ab", "c"], [[], ["a", "b"], ["c"]]), (2, ["p", "q"], [[], []])],
        "id int, cells array<string>, lis array<array<string>>",
    )


def test_first_list(spark, rows):
    out = U.explode_first_list(lists(spark)).select("id", "item_pos", F.array_join("cells", ","))
    assert rows(out) == [(1, 0, "x,a,a"), (1, 1, "x,b,b"), (2, 0, "p,q")]


def test_zip_longest(spark, rows):
    out = U.explode_zip_longest(lists(spark)).select("id", "item_pos", F.array_join("cells", ","))
    assert rows(out) == [(1, 0, "x,a,c"), (1, 1, "x,b,"), (2, 0, "p,q")]


def test_flatten(spark, rows):
    assert rows(U.flatten_rows(lists(spark)).select("id", F.array_join("cells", ","))) == [(1, "x,ab,c"), (2, "p,q")]


def test_csv_cell(spark, rows):
    df = spark.createDataFrame([(1, "1, 2", "z"), (2, "", "z"), (3, None, "z"), (4, "a,", "z")], "id int, c string, rest string")
    out = U.explode_csv_cell(df, "c", ["id"], pos="pos")
    assert rows(out) == [(1, 0, "1"), (1, 1, "2"), (2, 0, ""), (3, 0, ""), (4, 0, "a"), (4, 1, "")]


def test_assign_ids_is_dense_with_a_hot_lead(spark):
    df = spark.range(500).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"), "id")
    out = O.assign_ids(df, ["a", "id"], "n", partitions=7).orderBy("n").collect()
    assert [r.n for r in out] == list(range(1, 501))
    assert [(r.a, r.id) for r in out] == sorted((r.a, r.id) for r in out)


def test_pages(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"))
    order = sorted(str(i) for i in range(300))
    for top in (0, 10_000):
        assert sorted(r.k for r in O.page(df, ["k"], 100, 25, top_rows=top).collect()) == order[100:125]
        assert O.page(df, ["k"], 295, 25, top_rows=top).count() == 5
        assert O.page(df, ["k"], 400, 25, top_rows=top).count() == 0
    assert O.row_at(df, ["k"], 33).first().k == order[33]
    assert O.preview(df).count() == 5


def test_chunks(spark, rows):
    assert O.id_chunk(331) == (331001, 332001)
    df = spark.range(1, 2502)
    assert O.scan_id_range(df, *O.id_chunk(1)).count() == 1000
    assert rows(O.chunk_counts(df)) == [(0, 1000), (1, 1000), (2, 501)]


def test_deep_pages_with_ties_and_nulls(spark, rows):
    data = [(None if i % 7 == 0 else i % 3, i // 2 if i % 5 else None, i) for i in range(6000)]
    df = spark.createDataFrame(data, "a int, b int, i int")
    want = sorted(data, key=lambda r: tuple((v is not None, v or 0) for v in r))
    for skip, limit in ((0, 10), (2995, 20), (5990, 30), (7000, 5)):
        got = O.page(df, ["a", "b", "i"], skip, limit, top_rows=0)
        assert rows(got) == sorted(want[skip:skip + limit], key=repr)
    same = spark.range(5000).selectExpr("1 as k")
    assert O.page(same, ["k"], 4000, 100, top_rows=0).count() == 100
