"""Counting of n-grams in packed blocks, and texts that occur twice in a corpus of any size."""

import collections
import random

import numpy as np
import pytest

from toxloom.llm import ngram_trie as T


def test_packed_numbers():
    rng = np.random.default_rng(1)
    arrays = [np.empty(0, np.int64), np.zeros(5, np.int64), np.arange(300), rng.integers(0, 1 << 62, 1000), np.array([1 << 40])]
    back = T.unpack(T.pack(*arrays))
    assert len(back) == len(arrays) and all((a == b).all() for a, b in zip(arrays, back))


@pytest.mark.parametrize("parts", [1, 7])
def test_blocks_against_counter(parts):
    rng = random.Random(2)
    ids = 9
    tokens = [[rng.randrange(ids) for _ in range(rng.randrange(2, 40))] for _ in range(60)]
    two, three = collections.Counter(), collections.Counter()
    dealt = collections.defaultdict(list)
    for lo in range(0, 60, 20):  # three tasks
        held = []
        for t in tokens[lo:lo + 20]:
            two.update(zip(t, t[1:])), three.update(zip(t, t[1:], t[2:]))
            held.append((np.array(t[:-1]) * ids + t[1:], np.array([*t[2:], -1])))
        for p, block in T.blocks(held, ids, parts):
            dealt[p].append(block)
    got2, got3 = {}, {}
    for p, some in dealt.items():
        pair, c2, node, w, c3 = T.merge(some, ids)
        assert (T.part_of(pair, parts) == p).all() and (np.diff(pair) > 0).all()
        got2 |= {(k // ids, k % ids): n for k, n in zip(pair.tolist(), c2.tolist())}
        got3 |= {(k // ids, k % ids, x): n for k, x, n in zip(pair[node].tolist(), w.tolist(), c3.tolist())}
    assert got2 == {k: n for k, n in two.items() if n >= 2} and got3 == {k: n for k, n in three.items() if n >= 2}


@pytest.mark.parametrize("others", [20, 2000])
def test_a_text_that_occurs_twice_stands_out(spark, others):
    rng = random.Random(3)
    common = [f"w{i}" for i in range(200)]
    text = lambda mark: " ".join(f"{mark}{rng.randrange(10**6)}" for _ in range(60))
    twice, once = text("a"), text("b")
    rows = [(i, " ".join(rng.choices(common, k=50))) for i in range(others)] + [(10**6, twice), (10**6 + 1, twice), (10**6 + 2, once)]
    rows += [(10**6 + 3, "long " * 300_000), (10**6 + 4, None), (10**6 + 5, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = T.score(docs, T.train(docs)).toPandas().set_index("doc_id")
    gain = (got["score"] - got["base_score"]) / got["n_tokens"]
    assert gain[10**6] > 1 and gain[10**6 + 1] == gain[10**6]  # tenfold a token, at either size
    assert abs(gain[10**6 + 2]) < 0.1
    assert got["n_tokens"][10**6 + 3] == 300_001 and got["n_tokens"][10**6 + 4] == got["n_tokens"][10**6 + 5] == 1
