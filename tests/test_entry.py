import os
import re

import pytest

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


def test_every_query_has_sql_and_entry_runs(spark):
    import __spark_entry__ as entry

    # Models, permutations and packing are beyond SQL: those queries have brute-force tests.
    plain = {n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert plain <= set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["unnest_edges", "upsert_last_wins", "merge_props", "explode_zip_longest", "substring_link", "two_loads", "page_store", "append_nodes", "typed_cells", "incremental_load", "wiki_aop_lists", "url_frontier",
    "workbook_scan_flat", "chemical_export", "bioactivity_file_rejects", "incremental_arrivals", "merge_props_stored", "page_deep", "stored_upsert_partial", "bridge_kept", "wiki_causes_loads", "replaced_workbooks", "range_totals",
    "workbook_scan_parts", "substring_link_common", "page_indexed", "clean_keys_collide", "page_files"])
def test_query_equals_sql(spark, name):
    import __spark_entry__ as entry

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted((tuple(r) for r in df.select(*cols).collect()), key=repr) == sorted(want, key=repr)
