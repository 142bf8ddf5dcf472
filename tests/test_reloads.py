import pytest
from pyspark.sql import functions as F

from toxloom.sources import ledger as L
from toxloom.streaming import chunks as C
from toxloom.streaming import stored as S


def lines(files):
    """Files whose lines are rows."""
    cut = files.select("path", F.posexplode(F.split(F.col("content").cast("string"), "\n")).alias("row", "text"))
    return cut.where("text <> ''")


def test_replaced_files(spark, tmp_path, rows):
    root = f"{tmp_path}/r"
    files = lambda **f: spark.createDataFrame([(p, bytearray(c.encode())) for p, c in f.items()], "path string, content binary")
    assert L.load_files(spark, root, files(a="x\ny", b="z", c="", d="q"), lines, buckets=4) == {"new": 4, "changed": 0, "gone": 0}
    first = rows(L.stored_rows(spark, root).select("id", "path", "row", "text"))
    assert first == [(1, "a", 0, "x"), (2, "a", 1, "y"), (3, "b", 0, "z"), (4, "d", 0, "q")]
    version = S.open_version(spark, f"{root}/rows")
    assert L.load_files(spark, root, files(a="x\ny", b="z"), lines) == {"new": 0, "changed": 0, "gone": 0}
    assert S.open_version(spark, f"{root}/rows").number == version.number
    # `a` has another second row and a third, `b` is as it was, `c` gets a row, `e` is new, `d` isn't among all files any more.
    assert L.load_files(spark, root, files(a="x\nY\nw", b="z", c="c", e="e"), lines, complete=True) == {"new": 1, "changed": 2, "gone": 1}
    assert rows(L.stored_rows(spark, root).select("id", "path", "row", "text")) == [
        (1, "a", 0, "x"), (2, "a", 1, "Y"), (3, "b", 0, "z"), (5, "a", 2, "w"), (6, "c", 0, "c"), (7, "e", 0, "e")]
    # An id that is gone isn't given out again.
    assert L.load_files(spark, root, files(e="", d="q"), lines) == {"new": 1, "changed": 1, "gone": 0}
    assert rows(L.stored_rows(spark, root).select("id", "path").where("id > 3")) == [(5, "a"), (6, "c"), (8, "d")]


def test_a_run_that_died_before_the_ledger(spark, tmp_path, rows, monkeypatch):
    root = f"{tmp_path}/r"
    files = spark.createDataFrame([("a", bytearray(b"x\ny")), ("b", bytearray(b"z"))], "path string, content binary")
    with monkeypatch.context() as m:
        m.setattr(L.stored, "replace_part", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            L.load_files(spark, root, files, lines)
    L.load_files(spark, root, files, lines)
    assert rows(L.stored_rows(spark, root).select("path", "text")) == [("a", "x"), ("a", "y"), ("b", "z")]
    assert L.load_files(spark, root, files, lines) == {"new": 0, "changed": 0, "gone": 0}


def test_an_empty_first_load(spark, tmp_path):
    none = spark.createDataFrame([], "path string, content binary")
    assert L.load_files(spark, f"{tmp_path}/r", none, lines) == {"new": 0, "changed": 0, "gone": 0}
    assert L.stored_rows(spark, f"{tmp_path}/r").count() == 0


def test_ranges_resume(spark, tmp_path, rows):
    root, source = f"{tmp_path}/c", spark.range(1, 101).where("id % 10 <> 0").withColumn("v", F.col("id") * 2)
    totals = {"rows": F.count("*"), "sum": F.sum("v"), "ids": F.min("id")}
    load = lambda **k: C.load_ranges(spark, source, root, lambda df: df.where("id <> 55"), size=30, totals=totals, **k)
    assert load(most=2) == 2
    (tmp_path / "c" / "range=61-dead").mkdir()  # a run that died in its third range
    assert load() == 2 and load() == 0
    assert rows(C.read_ranges(spark, root).select("id")) == sorted(((i,) for i in range(1, 101) if i % 10 and i != 55), key=repr)
    assert rows(C.range_totals(spark, root).select("lo", "hi", "rows", "sum", "ids")) == [(lo, min(lo + 30, 100), n, s, i) for lo, n, s, i in (
        (lo, len(x), 2 * sum(x), min(x)) for lo, x in ((lo, [i for i in range(lo, min(lo + 30, 100)) if i % 10 and i != 55]) for lo in (1, 31, 61, 91)))]
    more = spark.range(1, 131)
    assert C.load_ranges(spark, more, root, size=30) == 2  # what came since: ids 100 to 130
    assert C.read_ranges(spark, root).count() == 89 + 31
    assert C.load_ranges(spark, more.limit(0), f"{tmp_path}/none") == 0


def test_a_range_without_rows_has_totals(spark, tmp_path):
    root = f"{tmp_path}/c"
    assert C.load_ranges(spark, spark.createDataFrame([(1,), (100,)], "id bigint"), root, size=10) == 10
    assert [r["totals"]["rows"] for r in C.journal(spark, root)] == [1, *[0] * 8, 1]


def test_two_runs_of_one_range(spark, tmp_path, monkeypatch):
    root, source = f"{tmp_path}/c", spark.range(10)
    monkeypatch.setattr(C, "journal", lambda *a: [])
    C.load_ranges(spark, source, root, size=10)
    with pytest.raises(RuntimeError, match="another run"):
        C.load_ranges(spark, source, root, size=10)


def test_ranges_of_a_wave_are_one_job(spark, tmp_path, rows):
    source = spark.range(-7, 101).where("id not between 40 and 59").withColumn("v", F.col("id") * 2)
    totals = {"rows": F.count("*"), "highest": F.max("v")}
    seen = []
    load = lambda root, **k: C.load_ranges(spark, source, root, lambda df: seen.append(1) or df.where("id <> 3"), size=10, totals=totals, **k)
    one, many = f"{tmp_path}/one", f"{tmp_path}/many"
    assert load(one) == 11 and len(seen) == 11
    seen.clear()
    assert load(many, most=1, wave=6) == 1 and load(many, most=8, wave=6) == 8 and load(many, wave=6) == 2 and len(seen) == 4
    told = lambda root: [(r["lo"], r["hi"], r["totals"]) for r in C.journal(spark, root)]
    assert told(many) == told(one)
    assert (43, 53, {"rows": 0, "highest": None}) in told(many)
    assert rows(C.read_ranges(spark, many)) == rows(C.read_ranges(spark, one))
    assert rows(C.range_totals(spark, many)) == rows(C.range_totals(spark, one))
