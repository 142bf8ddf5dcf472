import pyarrow as pa

from toxloom.sources import batches as B
from toxloom.sources import pages as P


def test_batches_are_cut_by_bytes():
    bodies = [b"x" * 3, None, b"x" * 5, b"x" * 20, b"", b"x" * 4]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(bodies, pa.binary())], names=["k", "b"])
    parts = list(B.sliced([batch.slice(0, 0), batch], 1, 8))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2], [3], [4, 5]]
    assert [x for p in parts for x in p.column(1).to_pylist()] == bodies


def test_pages_are_parsed_some_at_a_time(spark, monkeypatch):
    page = "<table><tr><th>A</th></tr>" + "<tr><td>x<ul><li>i</li></ul></td></tr>" * 2_000 + "</table>"
    pages = spark.range(0, 100, 1, 1).selectExpr("id", f"'{page}' AS html")
    sizes = []
    run = lambda frame, *a: frame
    held = {}
    monkeypatch.setattr(type(pages), "mapInArrow", lambda self, f, schema: held.update(f=f) or run(self))
    P.html_table_rows(pages, ["id"])
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array([page] * 100)], names=["id", "html"])
    for out in held["f"](iter([batch])):
        sizes.append(out.num_rows)
    assert sum(sizes) == 100 * 2_001 and len(sizes) > 2
