import random

from toxloom.operators import substring as X


def texts(n):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(4, 9)))
    rows = [" ".join(word() for _ in range(rng.choice([3, 60, 300]))) for _ in range(n)]
    rows += [r[5:len(r) // 2] for r in rows[::3]] + ["abc", "é🙂", "🙂", "", rows[1].replace(" ", "  ")[:200]]
    return list(enumerate(rows))


def test_containing_texts_list_few_grams(spark):
    """What shuffles is a part of the grams; texts without picked ones meet those that are marked."""
    df = spark.createDataFrame(texts(60), "id int, text string")
    every = X._hay_grams(df, X.CLASSES[:1], "id").count()
    assert X._hay_grams(df, [X.PICKED], "id").count() < every / 5
    anchors = X._rare_anchors(X._offers(df, ["id"])).join(X._offers(df, ["id"]).select("id", "kind"), "id")
    marks = X._marks(anchors, {0: 1, -1: 1})
    assert X.PICKED in marks and 0 < X._hay_grams(df, [X.CLASSES[0]], "id", marks=marks).count() < every / 5


def test_no_link_is_lost(spark, rows):
    data = texts(60)
    df = spark.createDataFrame(data, "id int, text string")
    want = sorted(((a, b) for a, x in data for b, y in data if x in y or y in x), key=repr)
    for small in (0, 20, X.SMALL_ANCHORS):
        assert rows(X.substring_self_link(df, "id", "text", "other", small)) == want


def test_texts_go_by_numbers(spark):
    """What shuffles are numbers of eight bytes, the same wherever a text is read; copies of a text share one."""
    df = spark.createDataFrame([*texts(30), (900, "abc"), (901, None)], "id int, text string").where("text is not null")
    ids, distinct = X._distinct_texts(df)
    assert dict(ids.dtypes)["t"] == dict(distinct.dtypes)["id"] == "bigint"
    number = {r["text"]: r["id"] for r in distinct.collect()}
    assert len(set(number.values())) == len(number) == distinct.count() and {r["text"]: r["id"] for r in distinct.collect()} == number
    assert {(r["id"], r["t"]) for r in ids.collect()} == {(r["id"], number[r["text"]]) for r in df.collect()}


def test_marks_by_distinct_remainders(spark, monkeypatch):
    """A class is marked where its anchors are many but their grams few; containing texts then list no others."""
    monkeypatch.setattr(X, "MARKED", 20)
    anchors = spark.createDataFrame([(i, 7919 * (i % 9), 2) for i in range(100)] + [(i, 7919 * i, 3) for i in range(100)], "id int, gram bigint, kind tinyint")
    marks = X._marks(anchors, {2: 100, 3: 100})
    bits = X.np.unpackbits(marks[X.CLASSES[2]], bitorder="little")
    assert set(marks) == {X.CLASSES[2]} and X.np.flatnonzero(bits).tolist() == [7919 * i for i in range(9)]
    df = spark.createDataFrame([(1, "BUILDING 000123456"), (2, "xyz")], "id int, text string")
    needles = spark.createDataFrame([(7, "123456"), (8, "000123")], "id int, text string")
    marks = X._marks(X._rare_anchors(X._offers(needles, ["id"])).withColumn("kind", X.F.lit(2)), {2: 2})
    assert X._hay_grams(df, [X.CLASSES[2]], "id", marks=marks).count() == 2


def test_two_tables_with_numbers_of_their_own(spark, rows):
    """Equal texts once, and contained ones whatever numbers the two tables give them."""
    data = texts(40)
    for left, right in ((data[:45], data[20:]), (data[45:], data[:45]), (data, data[::-1])):
        l, r = spark.createDataFrame(left, "id int, text string"), spark.createDataFrame(right, "id int, text string")
        want = sorted(((a, b) for a, x in left for b, y in right if x in y or y in x), key=repr)
        assert rows(X._links_large(l, r, 0)) == want
