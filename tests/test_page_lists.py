from pyspark.sql import functions as F

from toxloom.plans import wiki
from toxloom.sources import pages as P

PAGE = "<table><tr><th>ID</th><th>Title</th><th>MIE</th><th>AO</th></tr><tr><td>%d</td><td>t</td><td><li>a</li><li>b</li></td><td><li>c</li></td></tr></table>"


def test_pages_of_lists_are_parsed_once(spark):
    """Nodes, both lists and the ids of the load read what was parsed once."""
    html = spark.createDataFrame([(i, PAGE % i) for i in range(5)], "n bigint, html string")
    rows = wiki.main_page_table(P.html_table_rows(html, ["n"]), ["n"], ["ID", "Title", "MIE", "AO"])
    nodes = wiki.aop_nodes(rows, lists=True)
    assert "MapInArrow" not in nodes._jdf.queryExecution().optimizedPlan().toString()
    got = nodes.select("id", F.array_join("mie", "|"), F.array_join("ao", "|")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(i, "a|b", "c") for i in range(5)]
