import random

from pyspark.sql import functions as F

from toxloom.operators import order_index as O
from toxloom.operators import ordering as P


def test_pages_and_tokens(spark, tmp_path, rows):
    rng = random.Random(3)
    data = [(rng.choice([None, "a", "b", "c"]), i, i * 2) for i in rng.sample(range(1000), 700)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    index = O.build_order(df, ["g", "id"], f"{tmp_path}/o", partitions=9)
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert O.total(index) == 700 and index.files.count() > 4
    for skip, limit in ((0, 5), (123, 50), (690, 30), (700, 5), (0, 700)):
        got = O.stored_page(index, skip, limit)
        assert [tuple(r)[:3] for r in got.orderBy("_place").collect()] == want[skip:skip + limit]
    assert len(O.stored_page(index, 300, 10).inputFiles()) <= 2  # of nine
    index, key, seen = O.open_order(spark, f"{tmp_path}/o", ["g", "id"]), None, []
    while True:
        page = O.page_after(index, key, 90)
        got = [tuple(r)[:3] for r in page.orderBy("_place").collect()]
        if not got:
            break
        assert len(page.inputFiles()) < 6
        seen += got
        key = O.token_of(index, page)
    assert seen == want and O.token_of(index, page) is None


def test_an_empty_order(spark, tmp_path):
    index = O.build_order(spark.range(0), ["id"], f"{tmp_path}/o")
    assert O.total(index) == 0 and O.stored_page(index, 0, 5).count() == 0 and O.page_after(index, (3,), 5).count() == 0
    assert O.stored_page(O.build_order(spark.range(3), ["id"], f"{tmp_path}/p"), 1, 5).select(F.sum("id")).first()[0] == 3


def test_more_rows_are_sorted_in_more_parts(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(P, "PART_ROWS", 50)
    df = spark.range(700).select((F.col("id") * 37 % 700).alias("k"))
    index = O.build_order(df, ["k"], f"{tmp_path}/o")
    assert index.files.count() >= 10 and index.files.agg(F.max("n")).first()[0] < 200
    assert rows(P.assign_ids(df, ["k"])) == sorted(((k + 1, k) for k in range(700)), key=repr)
