import random

import pytest

from toxloom.operators import substring as X


@pytest.fixture(scope="module")
def texts(spark):
    """Texts between two lines that all of them hold; some hold only such lines, in an order of their own."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9)))
    line = lambda: " ".join(word() for _ in range(12))
    head, tail, third = line(), line(), line()
    rows = [f"{head} {line()} {third} {line()} {tail}" for _ in range(300)]
    rows += [r[:len(head) + 90] for r in rows[:40]]
    rows += [f"{tail} {head} {third}", f"zz {tail} {head} {third} yy", head]
    return [(i, t) for i, t in enumerate(rows)]


def brute(texts):
    return sorted((a, b) for a, x in texts for b, y in texts if x in y or y in x)


def test_lines_that_all_texts_hold_add_no_candidates(spark, rows, texts):
    df = spark.createDataFrame(texts, "id int, text string")
    assert rows(X.substring_self_link(df, "id", "text", "other")) == sorted(brute(texts), key=repr)
    assert rows(X._links_large(df, df, 0)) == sorted(brute(texts), key=repr)
    assert rows(X._links_large(df, df, X.SMALL_ANCHORS)) == sorted(brute(texts), key=repr)
    _, distinct = X._distinct_texts(df)
    found = X._candidates(distinct, distinct, X.SMALL_ANCHORS).where("h <> n").distinct().count()
    # 40 prefixes, one text of common lines inside another, and the line that really is in all; a few by chance.
    assert found < 40 + 1 + len(texts) + 60


def test_the_small_side_avoids_them_too(spark, rows, texts):
    df = spark.createDataFrame(texts, "id int, text string")
    few = spark.createDataFrame([(i, t) for i, t in texts if i in (301, 340, 342)], "other int, text string")
    assert rows(X.substring_link(df, "id", "text", few, "other", "text")) == sorted((p for p in brute(texts) if p[1] in (301, 340, 342)), key=repr)
    heavy = X._heavy(df, X.CLASSES[:1])
    assert 10 < len(heavy) < 60


def test_copies_nulls_and_empty_texts(spark, rows):
    data = [(1, "a b"), (2, "a b"), (3, None), (4, ""), (5, "xa by")]
    df = spark.createDataFrame(data, "id int, text string")
    want = sorted(((a, b) for a, x in data for b, y in data if x is not None and y is not None and (x in y or y in x)), key=repr)
    assert rows(X.substring_self_link(df, "id", "text", "other")) == want
    assert X.substring_self_link(df.limit(0), "id", "text", "other").count() == 0


def test_short_texts_meet_only_what_holds_them(spark, rows):
    names = [(i, f"BUILDING Customer#{i * 7919:09d}") for i in range(200)]
    keys = [(i, str(i)) for i in [*range(100, 1000, 3), *range(1000, 100_000, 97)]]
    l, r = spark.createDataFrame(names, "id int, text string"), spark.createDataFrame(keys, "id int, text string")
    want = sorted(((a, b) for a, x in names for b, y in keys if y in x), key=repr)
    assert rows(X._links_large(l, r, 0)) == want and rows(X._links_small(l, r)) == want
    (_, hay), (_, needles) = X._distinct_texts(l), X._distinct_texts(r)
    assert X._candidates(hay, needles, 0).distinct().count() == len(want)
