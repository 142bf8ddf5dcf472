import pytest
from pyspark.sql import functions as F

from toxloom.functions import cells as C
from toxloom.operators import joins as J
from toxloom.operators import ordering as O
from toxloom.plans import assays, wiki
from toxloom.sources import pages as P
from toxloom.sources import sinks as K
from toxloom.sources import workbooks as W
from toxloom.streaming import incremental as I


def test_ids_go_on_over_loads(spark, tmp_path, rows):
    path = f"{tmp_path}/nodes"
    for part in ("a", "b", "b"):
        stored = K.stored_or_none(spark, path)
        load = spark.createDataFrame([(part, i) for i in range(5)], "path string, row int")
        start = stored.agg(F.max("id")).first()[0] if stored is not None else 0
        K.append_nodes(O.assign_ids(load, ["path", "row"], start=start), path, ["path", "row"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(1, 11))


def test_a_repeated_key_keeps_its_last_row(spark, tmp_path, rows):
    K.append_nodes(spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "id int, name string, seq int"), f"{tmp_path}/n", "id", ["seq"])
    assert rows(spark.read.parquet(f"{tmp_path}/n")) == [(1, "new", 2)]


def test_unknown_column_without_a_schema(spark, tmp_path):
    K.append_table(spark.range(2), f"{tmp_path}/t")
    with pytest.raises(ValueError, match="no column zz"):
        K.append_table(spark.range(2).withColumn("zz", F.lit(1)), f"{tmp_path}/t")
    K.append_table(spark.range(2), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4


def test_page_store_keeps_other_pages(spark, tmp_path, rows):
    fetch = lambda *p: spark.createDataFrame([(*x, 1) for x in p], "kind string, id int, html string, seq int")
    K.write_pages(fetch(("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")), f"{tmp_path}/p", ["seq"])
    K.write_pages(fetch(("a", 1, "new"), ("c", 7, "w")), f"{tmp_path}/p", ["seq"])
    assert rows(P.read_pages(spark, f"{tmp_path}/p")) == [("a", 1, "new"), ("a", 2, "y"), ("b", 1, "z"), ("c", 7, "w")]
    assert P.read_pages(spark, f"{tmp_path}/p", "a").count() == 2


def test_a_lost_checkpoint_is_refused(spark, tmp_path, rows):
    source, target = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.createDataFrame([(1, "v1")], "k int, v string").write.parquet(source)
    load = lambda mark: I.incremental_load(spark, source, spark.read.parquet(source).schema, f"{tmp_path}/{mark}", target)
    load("check")
    spark.createDataFrame([(1, "v2")], "k int, v string").write.mode("append").parquet(source)
    load("check")
    assert rows(I.current_rows(spark, target, "k", ["v"]).select("v")) == [("v2",)]
    with pytest.raises(ValueError, match="is gone"):
        load("other")
    (tmp_path / "out" / "batch=9").mkdir()  # a batch that did not finish
    assert I.read_changes(spark, target).count() == 2


def test_lookup_join_refuses_sides_it_may_copy(spark):
    for how in ("right", "full"):
        with pytest.raises(ValueError, match=how):
            J.lookup_join(spark.range(2), spark.range(2), "id", how)


def test_ids_and_cells_with_many_digits(spark):
    texts = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "1e19", "12345678901234567890", "7.0", "-1e30"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.int_id(F.col("t"))).collect()]
    assert got == [2**63 - 1, None, -(2**63), None, None, 7, None]
    assert W._number("-12345678901234567", False) == "-12345678901234567"
    assert W._number("1E+16", False) == "10000000000000000" and W._number("0.5", False) == "0.5"


def test_error_cells_are_missing():
    from xml.etree import ElementTree

    cell = ElementTree.fromstring(f'<c xmlns="{W.SHEET.strip("{}")}" t="e"><v>#DIV/0!</v></c>')
    assert W._cell(cell, [], set()) is None


def test_aop_lists_beside_plain_cells_and_stored_ones(spark):
    heads = ["ID", "Title", "Point of Contact", "License", "MIE", "AO", "OECD Status", "OECD Project"]
    schema = ", ".join(f"`{h}` string" for h in heads) + ", seq bigint"
    page = spark.createDataFrame([("1", "t", None, None, "m", "a1", None, None, 1), ("1", "t", None, None, "m", "a2", None, None, 2)], schema)
    first = wiki.aop_nodes(page, lists=True)
    assert [(r.mie, r.ao) for r in first.collect()] == [(["m"], ["a1", "a2"])]
    other = spark.createDataFrame([("2", "u", None, None, None, "b", None, None, 1)], schema)
    both = {r.id: (r.mie, r.ao) for r in wiki.aop_nodes(other, first, lists=True).collect()}
    assert both == {1: (["m"], ["a1", "a2"]), 2: ([], ["b"])}


def test_a_workbook_without_rows_is_still_seen(spark, rows):
    import io
    import zipfile

    import __spark_entry__ as entry

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", entry.WORKBOOK_XML)
        z.writestr("xl/_rels/workbook.xml.rels", entry.LINKS_XML)
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {entry.MAIN}><sheetData><row><c t="inlineStr"><is><t>A</t></is></c></row></sheetData></worksheet>')
    files = spark.createDataFrame([("in/x.xlsx", out.getvalue())], "path string, content binary")
    decoded = W.decode_workbooks(files, ["A", "B"])
    assert rows(decoded.select("path", "row", "absent", "A")) == [("in/x.xlsx", None, ["B"], None)]
    assert assays.raw_assays(decoded).count() == 0


def test_few_rejected_paths_meet_their_rows(spark, rows, monkeypatch):
    data = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "path string, row int")
    few = spark.createDataFrame([("b", True)], "path string, bad boolean")
    want = [("a", 1, None), ("b", 2, True), (None, 3, None)]
    assert rows(J.join_few(data, few, "path")) == sorted(want, key=repr)
    monkeypatch.setattr(J, "FEW_BYTES", 0)
    assert rows(J.join_few(data, few, "path")) == sorted(want, key=repr)
