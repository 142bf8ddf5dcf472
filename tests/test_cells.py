from pyspark.sql import functions as F

from toxloom.functions import cells as C


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_parse_ids(spark):
    cells = [
        None, "", " 12|34  56 ", "Aop:12|7|7", "-3|4.0", "1" * 25, "12\n|5", "\t9", "9223372036854775807|9223372036854775808",
        "7a|a7|8", "|3|",
    ]
    expected = [[], [], [12, 34, 56], [7, 7], [], [], [5], [9], [9223372036854775807], [8], [3]]
    assert one(spark, cells, C.parse_ids) == expected


def test_titles(spark):
    file = "Assay List APR_HepG2_P-H2AX_1hr-2025-02-11.xlsx"
    assert one(spark, [file], lambda c: C.list_title(c, "Assay List ")) == ["APR_HepG2_P-H2AX_1hr"]
    assert one(spark, [file], C.assay_name_short) == ["APR_HepG2_P"]
    names = ["A Toxcast Summary -2025-02-11.zip", "B Toxcast Summary -2025-02-11.xlsx", "C"]
    assert one(spark, names, C.bioactivity_title) == ["A", "B", "C"]
    assert one(spark, [" D  Toxcast Summary -x"], C.bioactivity_name) == ["D"]
    assert one(spark, ["a%b'c/d:e"], C.safe_key) == ["a_b_c_d_e"]


def test_sentinel(spark, rows):
    df = spark.createDataFrame([(" -  ",), (" - ",), ("-",), (None,)], "x string")
    assert [r[0] for r in C.null_sentinel(df, ["x"]).collect()] == [None, " - ", "-", None]


def test_numbers(spark):
    texts = ["1.5", "12", "1e3", ".5", "nan", "x", "1d", None, " 7 ", "1" * 30]
    assert one(spark, texts, C.number) == [1.5, 12.0, 1000.0, 0.5, None, None, None, None, 7.0, float("1" * 30)]
    ids = ["12", "12.0", "12.7", "x", None, "9007199254740993", "1" * 30, "-4"]
    assert one(spark, ids, C.int_id) == [12, 12, 12, None, None, 9007199254740993, None, -4]
    assert one(spark, ["12", "12.0", "", None, "²", "1\n"], C.is_digits) == [True, False, False, False, False, False]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "a")], "x double, y string")
    assert [tuple(r) for r in C.nan_to_null(df).collect()] == [(None, "nan"), (1.0, "a")]


def test_clean_props_and_keys(spark):
    df = spark.createDataFrame([(1, None, "é")], "`a (b)` int, `c.d` string, `é-ü` string")
    assert df.select(C.clean_props(df)).first()[0] == {"a_b_": "1", "c_d": None, "é_ü": "é"}
    keys = spark.createDataFrame([({"é - x": "1"},)], "m map<string,string>")
    assert keys.select(C.clean_keys(F.col("m"))).first()[0] == {"é_x": "1"}


def test_content_id_ignores_order_and_sees_nulls(spark):
    df = spark.createDataFrame([("n", "1", None)], "n string, a string, b string")
    ids = [
        df.select(C.content_id(F.col("n"), C.clean_props(df, cols))).first()[0]
        for cols in (["a", "b"], ["b", "a"], ["a"])
    ]
    assert ids[0] == ids[1] != ids[2] and ids[0].startswith("n")


def test_row_shapes(spark):
    df = spark.createDataFrame([("x", "1")], "`a.b` string, m string")
    lead = C.with_leading(df, {"m": F.lit("first")})
    assert lead.columns == ["m", "a.b"] and tuple(lead.first()) == ("first", "x")
    out = C.project_props(df, [], {"p": "a.b", "q": "gone", "n": "m"}, {"n": "bigint", "q": "double"})
    assert tuple(out.first()) == ("x", None, 1) and dict(out.dtypes)["q"] == "double"
    try:
        C.project_props(df, [], {"q": "gone"}, required=("gone",))
        raise AssertionError
    except ValueError:
        pass
    assert df.select(C.name_or_unknown(df)).first()[0] == "unknown"


def test_hit_call(spark):
    df = spark.createDataFrame([("Inactive",), ("inactive",), ("Active",)], "HIT_CALL string")
    assert C.hit_call(df).count() == 1
    assert C.hit_call(df, collation="UTF8_LCASE").count() == 2


def test_na_texts(spark):
    assert one(spark, ["NA", "", "null", "Na", "x", None], C.na_to_null) == [None, None, None, "Na", "x", None]
