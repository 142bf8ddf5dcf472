import io
import random
import zipfile

import pytest

import __spark_entry__ as entry
from toxloom.sources import large_workbooks as L
from toxloom.sources import workbooks as W

COLUMNS = ["A", "B", "day", "none"]


def book(sheet, texts=None, prefix=""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", entry.WORKBOOK_XML)
        z.writestr("xl/_rels/workbook.xml.rels", entry.LINKS_XML)
        z.writestr("xl/styles.xml", entry.STYLES_XML)
        if texts is not None:
            z.writestr("xl/sharedStrings.xml", f"<sst {entry.MAIN}>" + "".join(f"<si>{t}</si>" for t in texts) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return out.getvalue()


@pytest.fixture(scope="module")
def files():
    rng = random.Random(4)
    texts = [f"<t>text {i} é &lt;row&gt;</t>" if i % 3 else f"<r><t>rich</t></r><r><t> {i}</t></r><rPh><t>no</t></rPh>" for i in range(500)]
    head = '<row r="1"><c r="A1" t="inlineStr"><is><t>A</t></is></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="inlineStr"><is><t>day</t></is></c></row>'
    rows, n = [head], 1
    for i in range(1500):
        n += rng.choice([1, 1, 1, 1, 3])
        cells = f'<c r="A{n}"><v>{i}</v></c>' + (f'<c r="B{n}" t="s"><v>{rng.randrange(500)}</v></c>' if i % 4 else "") + (f'<c r="D{n}" s="1"><v>{40000 + i}</v></c>' if i % 5 else f'<c r="D{n}" t="e"><v>#REF!</v></c>')
        rows.append(f'<row r="{n}" spans="1:4">{cells}</row>' if i % 50 else f'<row r="{n}"/>')
    rows += [f'<row r="{n + 5}"/>', f'<row r="{n + 9}"><c r="A{n + 9}" t="e"><v>#N/A</v></c></row>']  # blank rows at the end
    main = f'<?xml version="1.0" encoding="UTF-8"?>\n<worksheet {entry.MAIN}><cols><col min="1"/></cols><sheetData>{"".join(rows)}</sheetData><pageMargins left="1"/></worksheet>'
    plain = "".join(f'<row><c t="inlineStr"><is><t>{"A" if i == 0 else i}</t></is></c></row>' for i in range(400))  # no numbers on rows and cells
    other = main.replace("<row", "<x:row").replace("</row", "</x:row").replace("<c ", "<x:c ").replace("</c>", "</x:c>")
    for t in ("worksheet", "sheetData", "cols", "col", "v", "is", "t", "pageMargins"):
        other = other.replace(f"<{t}>", f"<x:{t}>").replace(f"<{t} ", f"<x:{t} ").replace(f"</{t}>", f"</x:{t}>")
    other = other.replace("xmlns=", "xmlns:x=")
    named = [t.replace("text 1 é &lt;row&gt;", "B") for t in texts]
    return [
        ("in/big.xlsx", book(main, named)), ("in/prefixed.xlsx", book(other, named)), ("in/plain.xlsx", book(f"<worksheet {entry.MAIN}><sheetData>{plain}</sheetData></worksheet>")),
        ("in/empty.xlsx", book(f"<worksheet {entry.MAIN}><sheetData/></worksheet>")), ("in/head.xlsx", book(f"<worksheet {entry.MAIN}><sheetData>{head}</sheetData></worksheet>", named)),
        ("in/late.xlsx", book(f'<worksheet {entry.MAIN}><sheetData><row r="3"><c r="A3"><v>7</v></c></row></sheetData></worksheet>')),
        ("in/cdata.xlsx", book(f"<worksheet {entry.MAIN}><sheetData>{plain.replace('<t>5</t>', '<t><![CDATA[</row>]]></t>')}</sheetData></worksheet>")),
        ("in/broken.xlsx", b"no archive"),
    ]


@pytest.mark.parametrize("limit", [2000, 1 << 20])
def test_same_rows_as_in_one_task(spark, rows, files, limit):
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in files], "path string, content binary")
    want, got = W.decode_workbooks(df, COLUMNS), L.decode_large_workbooks(df, COLUMNS, limit=limit)
    assert got.columns == want.columns
    assert rows(got) == rows(want) and want.count() > 4000


def test_a_workbook_is_cut(spark, files):
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in files[:1]], "path string, content binary")
    parts = L.unpack(df, 5000)
    kinds = {r.kind: r for r in parts.groupBy("kind").agg({"*": "count", "last": "max"}).collect()}
    assert kinds["sheet"]["count(1)"] > 5 and kinds["texts"]["max(last)"] == 500


def test_large_files_of_a_folder(spark, rows, files, tmp_path):
    for path, content in files[:3]:
        (tmp_path / path.split("/")[1]).write_bytes(content)
    want = rows(W.read_workbooks(spark, str(tmp_path), COLUMNS))
    assert rows(W.read_workbooks(spark, str(tmp_path), COLUMNS, large=8000)) == want
