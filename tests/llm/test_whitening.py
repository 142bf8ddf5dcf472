import numpy as np
import pytest

from toxloom.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x int, id string"


def plain(rows):
    """Numpy over all rows at once: n, the answers by row, and the eigenvalues."""
    good = [(i, np.floor(64 * np.float32(v).astype(float)).astype(np.int64) + 1_000_000) for i, v in rows]
    fit = np.unique(np.array([x for _, x in good]), axis=0)
    n, total = len(fit), fit.sum(axis=0)
    cov = np.cov((fit - total / n).T, bias=True)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, [(i, int(((n * x.astype(object) - total) ** 2).sum()), (x - total / n) @ (vectors / np.sqrt(np.maximum(values, 1e-30)))) for i, x in good], values, cov


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 20)) * np.linspace(0.2, 3, 20)
    rows = [(i, base[i % 300].tolist()) for i in range(400)]   # a hundred vectors twice
    rows += [(500, base[0].tolist())] * 60 + [(7, base[7].tolist())]
    return rows


def check(got, rows, components=16):
    n, want, values, cov = plain(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert len(got) == len(rows) * components and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-8
    sign = None
    for i, deviation, white in want:
        own = sorted({(r.component, r.deviation, r.whitened, r.explained) for r in by[i]})
        assert {r[1] for r in own} == {deviation}
        if sign is None:
            sign = np.sign([r[2] for r in own[:components]]) * np.sign(white[:components])
        assert len({r[0] for r in own}) == components
        for c, _, w, explained in own:
            assert abs(w - sign[c - 1] * white[c - 1]) < 1e-6 and abs(explained - values[c - 1] / np.trace(cov)) < 1e-9


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_against_numpy(spark, vectors, tmp_path, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", block)
    bad = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] * 20), (905, [1.0])]
    data = [(i, v, 0, 1, "z") for i, v in vectors + bad]
    spark.createDataFrame(data, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    check(queries.QUERIES["op11_embedding_whitening"](spark, str(tmp_path)).collect(), vectors)


def test_blocks_of_many_tasks(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 64)
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    df = spark.createDataFrame([(i, v, 0, 1, "z") for i, v in vectors], SCHEMA).repartition(7)
    blocks = whitening.in_blocks(whitening.usable(df, "vec_id", "embedding"), 20, "test")
    assert blocks.frame.count() >= 7 and blocks.frame.agg({"size": "sum"}).first()[0] == len(vectors)
    assert blocks.frame.select("part", "at").distinct().count() == blocks.frame.count()


def test_few_vectors_and_none(spark):
    df = lambda *v: spark.createDataFrame([(i, x, 0, 1, "z") for i, x in enumerate(v)], SCHEMA)
    assert whitening.whiten(df()).count() == 0 and whitening.whiten(df(None, [])).count() == 0
    assert whitening.whiten(df([1.0, 2.0], [1.0, 2.0])).count() == 0  # no variance
    two = whitening.whiten(df([1.0, 2.0], [1.0, 3.0])).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 9), r.deviation, r.explained) for r in two) == [(0, 1, 1.0, 4096, 1.0), (1, 1, 1.0, 4096, 1.0)]


def test_exact_deviations_beyond_64_bits():
    x = np.array([[3_000_000, 1_000_000], [1_000_000, 1_000_000]], np.int64)
    n = 10**7
    total = [n * 1_000_000 + 5, n * 1_000_000]
    assert whitening.deviations(x, n, total) == [None, 25]
    assert whitening.deviations(x, 10**15, [10**21, 10**21]) == [None, 0]
