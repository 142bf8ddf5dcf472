import random

import pytest

import corpus_pipeline as C
from toxloom.session import staged

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, _id bigint, size bigint, kept boolean"
STAGE = dict(C.STAGES)
EDGES = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t", None, "a", 3), (None, None, "en", None, None), (None, "", "en", "a", 0)]


def prose(rng, n):
    return " ".join("".join(rng.choice("aeioulrnst") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    rows = [(10 + i, prose(rng, 60), "en", "ab"[i % 2], 9) for i in range(30)]
    rows += [rows[0], rows[0], (50, rows[1][1].upper(), "en", None, 1), (None, rows[2][1], None, None, None)]   # repeats, ties, a null id
    rows += [(60, prose(rng, 30_000), "en", "a", 5), (61, "x" * 60_000 + " " * 60_000 + "end", "en", "b", 5)]  # very long
    near = rows[3][1].split()
    near[5] = "zz"
    return rows + [(70, " ".join(near), "en", "a", 2)] + EDGES


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, 9, True) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("name", list(STAGE))
def test_every_stage_takes_an_empty_table(spark, name):
    assert STAGE[name](spark, frame(spark, []), "").count() == 0


def test_every_stage_takes_nulls_repeats_long_texts_and_other_columns(spark, corpus):
    docs = frame(spark, corpus)
    key = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    told = STAGE["language_id"](spark, docs, "")
    assert key(told) == sorted(((r[0], r[1]) for r in corpus if r[1] and any(c.isalpha() for c in r[1])), key=repr)
    one = STAGE["exact_dedup"](spark, docs, "")
    best = {}
    for r in corpus:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        best.setdefault(low, []).append((r[0] if r[0] is not None else -(2**63), r[0], r[1]))
    got = {}
    for doc, text in key(one):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        assert low not in got
        got[low] = doc
    assert got == {low: max(x)[1] if max(x)[0] > -(2**63) else None for low, x in best.items()}
    few = STAGE["jaccard_join"](spark, staged(one, "one"), "")
    assert {r["doc_id"] for r in few.collect()} == {r["doc_id"] for r in one.collect()} - {70}
    mixed = STAGE["mix_sources"](spark, docs, "").collect()
    assert {r["doc_id"] for r in mixed} <= {r[0] for r in corpus if r[1] and r[1].split()} and all(r["text"] and r["n_chars"] == len(r["text"]) for r in mixed)
    packed = STAGE["best_fit_packing"](spark, docs, "").toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024
    assert (packed["start"] == 0).sum() == len(corpus)  # each row has one first piece, repeats too
