import pytest
from pyspark.sql import functions as F

from toxloom.session import put_if_absent, read_small
from toxloom.sources import pages as P
from toxloom.sources import sinks as K
from toxloom.streaming import incremental as I
from toxloom.streaming import stored as S


def nodes(spark, *rows):
    return spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(rows)], "id bigint, v string, seq int")


def test_a_name_is_taken_once(spark, tmp_path):
    path = f"{tmp_path}/x/list.json"
    assert put_if_absent(spark, path, "first é") and not put_if_absent(spark, path, "second")
    assert read_small(spark, path) == "first é"
    assert len(list((tmp_path / "x").glob(".aside*"))) == 0


def test_only_touched_buckets_are_written(spark, tmp_path, rows):
    root = f"{tmp_path}/t"
    first = S.upsert_part(spark, root, nodes(spark, *[(i, "a") for i in range(500)]), "id", ["v"], ["seq"], buckets=16)
    assert sorted(first.folders) == list(range(16))
    # An int key finds the bucket of the stored bigint.
    second = S.upsert_part(spark, root, spark.createDataFrame([(7, "b", 1), (7, "c", 2), (900, "n", 0), (None, "x", 0)], "id int, v string, seq int"), "id", ["v"], ["seq"])
    assert 1 <= len(second.changed) <= 2
    assert {b: f for b, f in second.folders.items() if b not in second.changed} == {b: f for b, f in first.folders.items() if b not in second.changed}
    want = [(i, "c" if i == 7 else "a") for i in range(500)] + [(900, "n")]
    assert rows(S.read_stored(spark, root)) == sorted(want, key=repr)
    assert S.rows_of(spark, first).count() == 500 and S.rows_of(spark, S.open_version(spark, root, 1)).where("id = 7").first().v == "a"
    third = S.update_part(spark, root, nodes(spark, (5, None), (12345, "z")), "id", ["v"], ["seq"])
    assert S.rows_of(spark, third).count() == 501 and S.rows_of(spark, third).where("v is null").first().id == 5
    assert S.forget(spark, root) >= 0 and S.read_stored(spark, root).count() == 501
    assert S.versions(spark, root) == [3]


def test_later_columns_and_other_types(spark, tmp_path, rows):
    root = f"{tmp_path}/t"
    S.upsert_part(spark, root, nodes(spark, (1, "a"), (2, "a"), (3, "a")), "id", ["v"], ["seq"], buckets=64)
    more = spark.createDataFrame([(1, 5, 0)], "id bigint, w int, seq int")
    S.upsert_part(spark, root, more, "id", ["w"], ["seq"])
    assert rows(S.read_stored(spark, root).select("id", "v", "w")) == [(1, "a", 5), (2, "a", None), (3, "a", None)]
    with pytest.raises(ValueError, match="w is stored as int"):
        S.upsert_part(spark, root, spark.createDataFrame([(2, "x", 0)], "id bigint, w string, seq int"), "id", ["w"], ["seq"])
    with pytest.raises(ValueError, match="keyed by id"):
        S.upsert_part(spark, root, more, ["id", "w"], [], ["seq"])
    # No updates: nothing is written, and an empty first load is a table without rows.
    empty = more.where("id < 0")
    assert rows(S.rows_of(spark, S.upsert_part(spark, root, empty, "id", ["w"], ["seq"]))) == rows(S.read_stored(spark, root))
    assert S.rows_of(spark, S.upsert_part(spark, f"{tmp_path}/e", empty, "id", ["w"], ["seq"])).columns == ["id", "w"]


def test_two_writers(spark, tmp_path, rows):
    root = f"{tmp_path}/t"
    base = S.upsert_part(spark, root, nodes(spark, *[(i, "a") for i in range(200)]), "id", ["v"], ["seq"], buckets=8)
    number = lambda i: spark.range(i, i + 1).select(S.bucket(["id"], base.schema, 8)).first()[0]
    other = next(i for i in range(1, 200) if number(i) != number(0))
    same = next(i for i in range(1, 200) if number(i) == number(0))
    late = lambda i: S.change(  # noqa: E731  a writer that read `base` and puts its change after the first one
        spark, root, "id", nodes(spark, (i, "late")), lambda old: old.withColumn("v", F.when(F.col("id") == i, "late").otherwise(F.col("v"))), base=base)
    S.upsert_part(spark, root, nodes(spark, (0, "first")), "id", ["v"], ["seq"])
    with pytest.raises(S.Conflict):
        late(same)
    late(other)  # other buckets: both changes hold
    got = dict(rows(S.read_stored(spark, root)))
    assert got[0] == "first" and got[other] == "late" and got[same] == "a" and len(got) == 200
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("load=")]) == 3  # the loser's folder is gone


def test_rows_outside_the_touched_buckets_are_refused(spark, tmp_path):
    root = f"{tmp_path}/t"
    S.upsert_part(spark, root, nodes(spark, *[(i, "a") for i in range(50)]), "id", ["v"], ["seq"], buckets=8)
    with pytest.raises(Exception, match="outside the touched buckets"):
        S.change(spark, root, "id", nodes(spark, (1, "a")), lambda old: S.read_stored(spark, root))
    assert S.versions(spark, root) == [1]


def test_removal(spark, tmp_path, rows):
    root = f"{tmp_path}/t"
    S.replace_part(spark, root, nodes(spark, (1, "a"), (2, "b")), "id", ["seq"])
    gone = spark.createDataFrame([(2, "x", 0, True), (3, "c", 0, None), (1, "q", 0, True), (1, "r", 1, False)], "id bigint, v string, seq int, gone boolean")
    S.replace_part(spark, root, gone, "id", ["seq"], "gone")
    assert rows(S.read_stored(spark, root).select("id", "v")) == [(1, "r"), (3, "c")]


def test_page_store_writes_its_pages_only(spark, tmp_path):
    path = f"{tmp_path}/p"
    page = lambda *ids: spark.createDataFrame([("a", i, f"h{i}", 1) for i in ids], "kind string, id int, html string, seq int")
    K.write_pages(page(*range(300)), path, ["seq"])
    K.write_pages(page(5), path, ["seq"])
    assert len(S.open_version(spark, path).changed) == 1 and P.read_pages(spark, path, "a").count() == 300


def test_folds_keep_the_rows(spark, tmp_path, rows):
    src, out, chk = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/chk"
    schema = "id bigint, v string, gone boolean, seq int"
    state, read = {}, lambda: rows(I.current_rows(spark, out, "id", ["seq"], "gone").select("id", "v"))
    files = []
    for load in range(20):
        batch = [(load % 7, f"v{load}", False, 1), (load % 5 + 10, f"w{load}", load % 3 == 0, 2), (99, None, load % 2 == 0, load)]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        I.incremental_load(spark, src, spark.createDataFrame([], schema).schema, chk, out)
        for i, v, gone, _ in batch:
            state.pop(i, None)
            if not gone:
                state[i] = v
        before = read()
        assert before == sorted(state.items(), key=repr)
        folded = I.fold_changes(spark, out, "id", ["seq"], "gone", every=4, buckets=4)
        assert folded == (load % 4 == 3) and read() == before
        if load % 8 == 7:
            assert I.drop_folded(spark, out) == 8 and read() == before
            S.forget(spark, f"{out}/folded")
        files.append(len(I.current_rows(spark, out, "id", ["seq"], "gone").inputFiles()))
    assert max(files[12:]) <= max(files[4:12])  # reading doesn't grow with the loads
    with pytest.raises(ValueError, match="is gone"):
        I.incremental_load(spark, src, spark.createDataFrame([], schema).schema, f"{tmp_path}/other", out)


def test_folds_without_marks(spark, tmp_path, rows):
    src, out, chk = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/chk"
    assert not I.fold_changes(spark, out, "id", ["seq"])
    for load in range(3):
        nodes(spark, (1, f"a{load}"), (load, "b")).write.mode("append").parquet(src)
        I.incremental_load(spark, src, nodes(spark).schema, chk, out)
        assert I.fold_changes(spark, out, "id", ["seq"])
    assert rows(I.current_rows(spark, out, "id", ["seq"]).select("id", "v")) == [(0, "b"), (1, "a2"), (2, "b")]


def test_other_numbers_of_buckets(spark, tmp_path, rows):
    root = f"{tmp_path}/t"
    first = S.upsert_part(spark, root, nodes(spark, *[(i, "a") for i in range(100)]), "id", ["v"], ["seq"], buckets=2)
    more = S.rebucket(spark, root, 8)
    assert sorted(more.folders) == list(range(8)) and S.rows_of(spark, more).count() == 100
    last = S.upsert_part(spark, root, nodes(spark, (5, "b")), "id", ["v"], ["seq"])
    assert len(last.changed) == 1 and last.buckets == 8
    signed = S.signed_between(spark, root, first.number, last).groupBy("id", "v").agg(F.sum("sign").alias("s")).where("s <> 0")
    assert rows(signed) == [(5, "a", -1), (5, "b", 1)]
