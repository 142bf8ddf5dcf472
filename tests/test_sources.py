import os
import zipfile

import pytest
from pyspark.sql import functions as F

from toxloom.functions.cells import named
from toxloom.operators.unnest import explode_zip_longest
from toxloom.plans import assays, bioactivity, wiki
from toxloom.schemas import NUMBER_COLUMNS, SHEET_COLUMNS
from toxloom.sources import pages as P
from toxloom.sources import sinks as K
from toxloom.sources import text as S
from toxloom.sources import workbooks as W

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_book(path, rows, shared=(), styles=None, sheet="worksheets/sheet7.xml"):
    """Minimal workbook whose first sheet is not sheet1. Cells are ready XML."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{REL}"><sheets>'
                   '<sheet name="a" sheetId="7" r:id="rId3"/><sheet name="b" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   f'<Relationship Id="rId1" Target="worksheets/sheet1.xml"/><Relationship Id="rId3" Target="{sheet}"/></Relationships>')
        z.writestr("xl/" + sheet, f'<worksheet xmlns="{MAIN}"><sheetData>' + "".join(rows) + "</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>')


def line(*cells):
    return "<row>" + "".join(f'<c t="inlineStr"><is><t xml:space="preserve">{c}</t></is></c>' if c is not None else "<c/>" for c in cells) + "</row>"


def table(cols, *records):
    return [line(*cols)] + [line(*[r.get(c) for c in cols]) for r in records]


def test_workbook_cell_kinds(spark, tmp_path):
    write_book(
        f"{tmp_path}/in/deep/Assay List A-b-2025-02-11.xlsx",
        [
            '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c><c r="D1" t="s"><v>0</v></c><c r="E1" t="inlineStr"><is><t>when</t></is></c></row>',
            '<row r="2"><c r="A2"><v>1.50E-3</v></c><c r="C2" t="b"><v>1</v></c><c r="D2"><v>3.0</v></c><c r="E2" s="1"><v>45000.5</v></c></row>',
            '<row r="4"><c r="C4" t="str"><v>N/A</v></c><c r="D4" t="s"><v>1</v></c></row>', '<row r="9"><c r="A9"/></row>',
        ],
        shared=["<t>x</t>", "<r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh>"],
        styles='<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs>',
    )
    open(f"{tmp_path}/in/broken.xlsx", "wb").write(b"no zip")
    df = W.read_workbooks(spark, f"{tmp_path}/in")
    assert [c for c in df.columns if c not in assays.SHEET_META] == ["x", "Unnamed: 1", "rich", "x.1", "when"]
    good = df.where("error is null").orderBy("row").select("row", "file", "x", named("rich"), named("x.1"), "when").collect()
    assert [tuple(r)[2:] for r in good] == [
        ("0.0015", "True", "3", "2023-03-15 12:00:00"), (None, None, None, None), (None, None, "rich", None),
    ]
    assert good[0].file == "Assay List A-b-2025-02-11.xlsx" and [r.row for r in good] == [1, 2, 3]
    assert [r.file for r in W.failed_files(df).collect()] == ["broken.xlsx"]
    assert W.read_workbooks(spark, f"{tmp_path}/in", ["x"], recursive=False, glob="*.xlsx").where("error is null").count() == 0
    named_cols = W.read_workbooks(spark, f"{tmp_path}/in", ["rich", "gone"]).where("error is null").first()
    assert named_cols.absent == ["gone"] and "x" in named_cols.extra


def test_assay_graph(spark, tmp_path, rows):
    cols = ["DTXSID", *assays.ASSAY_CHEMICAL_PROPS.values(), *assays.RESULT_PROPS.values()]
    rec = {"DTXSID": "D1", "PREFERRED NAME": "old", "HIT CALL": "Active", "AC50": "1.5", "MONOISOTOPIC MASS": "2"}
    write_book(f"{tmp_path}/in/Assay List P-H2-2025-02-11.xlsx", table(cols, rec, {**rec, "PREFERRED NAME": "new", "AC50": "x"}))
    write_book(f"{tmp_path}/in/Assay List Q-2025-02-11.xlsx", table(cols, {**rec, "DTXSID": None}))
    write_book(f"{tmp_path}/in/Assay List R-2025-02-11.xlsx", table(["DTXSID"], {"DTXSID": "D9"}))
    sheets = W.read_workbooks(spark, f"{tmp_path}/in", cols)
    out = assays.assay_results(sheets)
    assert rows(out["Chemical"]) == [("D1", "new", None, None, 2.0)]
    assert rows(out["Assay"]) == [("P-H2",)]
    assert rows(out["HAS_RESULT"]) == [("D1", "P-H2", "Active", None, None, None, None)]
    assert rows(assays.assay_results(sheets, short_names=True)["Assay"]) == [("P",)]
    raw = assays.raw_assays(W.read_workbooks(spark, f"{tmp_path}/in"))
    assert raw.columns[0] == "ASSAY NAME" and raw.count() == 4
    assert assays.raw_chemicals(sheets).columns[0] == "CHEMICAL NAME"
    chem = assays.chemical_nodes(W.read_workbooks(spark, f"{tmp_path}/in", [*assays.CHEMICAL_PROPS.values(), "DTXSID"]))
    assert [(r.dtxsid, r.name, r.mass, r.n_active) for r in chem.collect()] == [("D1", "new", 2.0, None)]


def test_bioactivity_load_rejects_whole_files(spark, tmp_path, rows):
    base = {"NAME": "n", "HIT_CALL": "Inactive", "AOP": "1|2|2", "EVENT": "5 x", "AC50": " -  ", "TOP": "2.5"}
    files = {
        "a_b Toxcast Summary -2025-02-11.xlsx": [base, {**base, "AOP": None}],
        "bad Toxcast Summary -2025-02-11.xlsx": [base, {**base, "AC50": "high"}],
        "who Toxcast Summary -2025-02-11.xlsx": [base],
    }
    for name, recs in files.items():
        write_book(f"{tmp_path}/in/{name}", table(SHEET_COLUMNS, *recs))
    write_book(f"{tmp_path}/in/less Toxcast Summary -2025-02-11.xlsx", table([c for c in SHEET_COLUMNS if c != "BMD"], base))
    open(f"{tmp_path}/in/none Toxcast Summary -2025-02-11.zip", "wb").write(b"x")
    titles = spark.createDataFrame([("a_b", "D1"), ("bad", "D2"), ("less", "D3"), ("none", "D4")], "title string, dtxsid string")
    good, rejects = bioactivity.load_bioactivity(W.read_workbooks(spark, f"{tmp_path}/in", SHEET_COLUMNS), titles)
    reasons = {r.file.split(" ")[0]: r.reason for r in rejects.collect()}
    assert reasons["bad"] == "text in a number column" and reasons["who"] == "no id for title"
    assert reasons["less"] == "missing column BMD" and reasons["none"].startswith("BadZipFile") and len(reasons) == 4
    raw = bioactivity.with_ids(good)
    assert len(raw.columns) == 50 and dict(raw.dtypes)["AC50"] == "double" and set(NUMBER_COLUMNS) <= set(raw.columns)
    nodes = bioactivity.bioactivity_nodes(raw)
    got = [(r.id, r.name, r.dtxsid, r.aop_ids, r.event_ids) for r in nodes.orderBy("id").collect()]
    assert got == [(1, "n", "D1", [1, 2, 2], [5]), (2, "n", "D1", [], [5])]
    assert nodes.first().props["TITLE"] == "a_b" and "AC50" not in nodes.first().props
    chemicals = spark.createDataFrame([("D1",)], "dtxsid string")
    edges = bioactivity.bioactivity_edges(nodes, spark.range(5, 6), spark.range(1, 3), chemicals)
    assert rows(edges["RELATED_TO_AOP"]) == [(1, 1), (1, 2)]
    assert rows(edges["RELATED_TO_EVENT"]) == [(1, 5), (2, 5)]
    assert rows(edges["OF_CHEMICAL"]) == [(1, "D1"), (2, "D1")]


HTML = """<!DOCTYPE html><div><ul><li>out</ul><script>var a = "<table><tr><td>no</td></tr></table>";</script>
<table><tr><th>ID</th><th> Title </th><th>L</th></tr>
<tr><td> a <b> b </b><!-- c --></td><td>x &amp; y<br>z</td><td><ul><li>one<ul><li>in</li></ul></li><li> two </li></ul></td></tr>
<tr><td>r</td><td><table><tr><td>n</td></tr></table></td></tr>
</table><table><tr><td>second</td></tr></table></div>"""


def test_first_table_of_a_page(spark):
    df = spark.createDataFrame([(1, HTML), (2, "<p>none</p>"), (3, None), (4, "<table><tr><td>open<li>a<td>b")], "id int, html string")
    got = P.html_table_rows(df, ["id"]).orderBy("id", "pos").collect()
    assert [(r.id, r.pos, r.cells) for r in got] == [
        (1, 0, ["ID", "Title", "L"]), (1, 1, ["ab", "x & yz", "oneintwo"]), (1, 2, ["r", "n", "n"]), (1, 3, ["n"]),
        (4, 0, ["openab", "b"]),
    ]
    assert got[1].lis == [[], [], ["onein", "in", "two"]] and got[4].lis == [["ab"], []]
    wide = P.table_columns(P.html_table_rows(df.where("id = 1"), ["id"], partitions=2), ["id", "pos"], ["Title", "gone"])
    assert [tuple(r) for r in wide.orderBy("pos").collect()][0] == (1, 1, "x & yz", None)


def test_wiki_graph_from_pages(spark, rows):
    def html(head, *body):
        cell = lambda c: "<td>" + (c if isinstance(c, str) else "<ul>" + "".join(f"<li>{i}</li>" for i in c) + "</ul>") + "</td>"
        lines = "".join("<tr>" + "".join(map(cell, r)) + "</tr>" for r in body)
        return "<table><tr>" + "".join(f"<th>{h}</th>" for h in head) + f"</tr>{lines}</table>"

    heads = {
        "aops": ["ID", "Title", "Point of Contact", "License", "MIE", "AO", "OECD Status", "OECD Project"],
        "events": ["ID", "Title", "Biological organization", "Creation Date", "Last Updated", "AOPs"],
        "relations": ["ID", "Upstream Event", "Downstream Event", "Creation Date", "Last Updated", "AOPs"],
        "stressors": ["ID", "Prototypical Stressor Name", "Associated Chemical(s): Name, CAS-RN, DTXSID", "Associated AOPs"],
    }
    bodies = {
        "aops": [["1", "Liver fibrosis", "p", "l", ["m1", "m2"], ["a1"], "s", ""], ["2", "Kidney", "", "", "", "", "", ""]],
        "events": [["5", "E5", "Cell", "d", "u", "Liver fibrosis, Kidney"], ["6", "E6", "Cell", "d", "u", "Liver"], ["7", "E6", "", "", "", ""]],
        "relations": [["9", "E6", "lost", "d", "u", "Kidney"]],
        "stressors": [["3", "S", "chem", "1, 2"], ["4", "T", "", ""]],
    }
    data = {}
    for kind, shape in (("aops", "zip"), ("events", "first"), ("relations", "flat"), ("stressors", "first")):
        page = spark.createDataFrame([(kind, html(heads[kind], *bodies[kind]))], "page string, html string")
        data[kind] = wiki.main_page_table(P.html_table_rows(page, ["page"]), ["page"], heads[kind], shape).drop("page")
    g = wiki.wiki_graph(**data)
    assert rows(g["AOP"].select("id", "title", "mie", "ao")) == [(1, "Liver fibrosis", "m2", None), (2, "Kidney", None, None)]
    lists = wiki.aop_nodes(data["aops"], lists=True)
    assert rows(lists.select("id", F.array_join("mie", "|"), F.array_join("ao", "|"))) == [(1, "m1|m2", "a1"), (2, "", "")]
    assert rows(g["Event"].select("id", "title", "level")) == [(5, "E5", "Cell"), (6, "E6", "Cell"), (7, "E6", None), (None, "lost", None)]
    assert rows(g["HAS_EVENT"]) == [(1, 5), (1, 6), (2, 5)]
    assert rows(g["HAS_RELATIONSHIP"]) == [(2, 9)]
    assert rows(g["CAUSES"]) == sorted([("id:6", "rel:9"), ("id:7", "rel:9"), ("rel:9", "title:lost")], key=repr)
    assert rows(g["ASSOCIATED_WITH"]) == [(3, 1), (3, 2)]
    assert rows(g["Stressor"]) == [(3, "S", "chem", 2), (4, "T", None, None)]
    assert rows(g["KE_Relation"].select("id", "upstream_event", "AOPs")) == [(9, "E6", "Kidney")]


def test_lists_pairs_and_csv(spark, tmp_path, rows):
    (tmp_path / "ids").write_text(" a \nb\t\n")
    assert [r.value for r in S.read_id_list(spark, f"{tmp_path}/ids").orderBy("seq").collect()] == ["a", "b"]
    assert [r.value for r in S.read_id_list(spark, f"{tmp_path}/ids", trim=False).orderBy("seq").collect()] == [" a ", "b\t"]
    (tmp_path / "pairs").write_text('t "q"|D1|more\nonly\n')
    kept = S.read_pairs(spark, f"{tmp_path}/pairs", on_bad="keep")
    assert rows(kept.select("title", "dtxsid")) == [("only", None), ('t "q"', "D1")]
    with pytest.raises(Exception, match="no id in line"):
        S.read_pairs(spark, f"{tmp_path}/pairs").collect()
    (tmp_path / "w.csv").write_text('ID,"Name, CAS",AOPs\n1,"a ""x""\nb",\n2,NA,"1, 2"\n')
    df = S.read_wiki_csv(spark, f"{tmp_path}/w.csv")
    assert [tuple(r)[:3] for r in df.orderBy("seq").collect()] == [("1", 'a "x"\nb', None), ("2", None, "1, 2")]
    assert S.union_files([df.select("ID"), df.select("AOPs")]).count() == 4


def test_range_reader_options(spark):
    with pytest.raises(Exception):
        S.read_jdbc_range(spark, {"url": "jdbc:none:x", "dbtable": "t"}, 1, 10, 2)


def test_page_store_frontier_and_state(spark, tmp_path, rows):
    for kind, n in (("aops", 1), ("events x", 22)):
        d = tmp_path / "store" / kind / str(n)
        d.mkdir(parents=True)
        (d / f"{n}.html").write_text(f"<p>{n}\n</p>")
    assert rows(P.read_pages(spark, f"{tmp_path}/store")) == [("aops", 1, "<p>1\n</p>"), ("events x", 22, "<p>22\n</p>")]
    assert P.read_pages(spark, f"{tmp_path}/store", "aops").count() == 1
    assert sorted(r.id for r in P.url_frontier(spark, "u", "k", 1, 41).collect()) == list(range(1, 141))
    apart = sorted(r.id for r in P.url_frontier(spark, "u", "k", 1, 50, step=20, walk=3).collect())
    assert apart == [1, 2, 3, 21, 22, 23, 41, 42, 43]
    starts = spark.createDataFrame([(1,), (21,), (41,)], "start bigint")
    assert P.frontier(starts, "u/", "k").where("url = 'u/140'").count() == 1
    pages = spark.createDataFrame([(200, "ok"), (404, "ok"), (200, "x This event does not exist. y"), (None, "ok")], "status int, html string")
    assert [r.reason for r in P.page_state(pages).collect()] == [None, "status 404", "absent", "status none"]
    assert P.live_pages(pages).count() == 1
    fetched = spark.createDataFrame([("a", 1, "old", 1), ("a", 1, "new", 2), ("b", 1, "x", 1)], "kind string, id int, html string, seq int")
    K.write_pages(fetched, f"{tmp_path}/pages", ["seq"])
    assert rows(spark.read.parquet(f"{tmp_path}/pages").select("kind", "id", "html")) == [("a", 1, "new"), ("b", 1, "x")]


def test_sinks(spark, tmp_path, rows):
    schema = spark.createDataFrame([], "a int, b string").schema
    K.append_table(spark.createDataFrame([("x",)], "b string"), f"{tmp_path}/t", schema)
    K.append_table(spark.createDataFrame([(1,)], "a int"), f"{tmp_path}/t", schema)
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [(1, None), (None, "x")]
    with pytest.raises(ValueError, match="no column c"):
        K.append_table(spark.createDataFrame([(1,)], "c int"), f"{tmp_path}/t", schema)
    for _ in range(2):
        K.append_nodes(spark.range(3), f"{tmp_path}/n", "id")
    assert spark.read.parquet(f"{tmp_path}/n").count() == 3
    K.write_csv(spark.createDataFrame([('a "q",\r\n b ', None, "")], "x string, y string, z string"), f"{tmp_path}/c")
    back = S.read_wiki_csv(spark, f"{tmp_path}/c")
    assert [tuple(r)[1:3] for r in back.collect()] == [(None, None)] and '"q",' in back.first().x
