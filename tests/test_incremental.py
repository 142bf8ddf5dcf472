from toxloom.streaming import incremental as I


def test_stream_restarts_where_it_stopped(spark, tmp_path, rows):
    src, out, chk = f"{tmp_path}/src", f"{tmp_path}/out", f"{tmp_path}/chk"
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, x string, seq int")
    first.write.parquet(src)
    load = lambda: I.incremental_load(spark, src, first.schema, chk, out, files_per_batch=1)
    load()
    load()
    assert I.read_changes(spark, out).count() == 2
    spark.createDataFrame([(1, None, 0)], first.schema).write.mode("append").parquet(src)
    load()
    got = I.current_rows(spark, out, "id", ["seq"]).select("id", "x")
    assert rows(got) == [(1, None), (2, "b")]


def test_versions(spark, tmp_path, rows):
    root = f"{tmp_path}/nodes"
    assert I.read_current(spark, root) is None
    up = spark.createDataFrame([(1, "a", 1)], "id int, x string, seq int")
    I.upsert_stored(spark, root, up, "id", ["x"], ["seq"])
    (tmp_path / "nodes" / "v=2").mkdir()  # a run that died before its success marker
    more = spark.createDataFrame([(1, "q", 1), (2, "r", 1)], "id int, y string, seq int")
    assert rows(I.upsert_stored(spark, root, more, "id", ["y"], ["seq"])) == [(1, "a", "q"), (2, None, "r")]
    assert rows(I.read_current(spark, root)) == [(1, "a", "q"), (2, None, "r")]
    I.upsert_stored(spark, root, more, "id", ["y"], ["seq"])
    assert I.read_current(spark, root).count() == 2
