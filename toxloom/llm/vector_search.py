"""Nearest neighbours by probed lists with an adaptive dimension scan.

Vectors are turned by a random rotation and dealt into lists by their nearest centroid. A query probes the lists of its nearest
centroids. Within a list, distances grow block of columns by block of columns; after each, a hypothesis test on the partial
distance abandons candidates that can hardly be among the nearest. What survives is measured on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toxloom.session import staged

SAMPLE = 20_000   # vectors at most that the centroids are fitted on
LISTS = 4096      # at most
PART = 2048       # vectors of a list that one task scans
ASKED = 256       # queries of a list that one task answers
BLOCK = 16        # columns
EPSILON = 2.6     # of the test: larger abandons less
PROBED = 0.7      # share of the lists that a query probes
BATCH = 256


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): rows with an id and a finite vector that is not zero."""
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    named = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    return named.where("id is not null and vec is not null").where(~F.exists("vec", wrong) & F.exists("vec", lambda x: x != 0))


def fit_lists(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Centroids by k-means."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centre = distinct[rng.choice(len(distinct), min(lists, len(distinct)), replace=False)]
    for _ in range(rounds):
        near = nearest(sample, centre, 1)[:, 0]
        count = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, sample)
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
    return centre


def nearest(x: np.ndarray, centre: np.ndarray, n: int) -> np.ndarray:
    """Places of the n nearest centroids of each row, nearest first."""
    out = []
    for lo in range(0, len(x), 4096):
        d = (centre * centre).sum(axis=1) - 2 * x[lo:lo + 4096] @ centre.T
        out.append(np.argsort(d, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.empty((0, n), int)


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def scan(q: np.ndarray, x: np.ndarray, k: int, skip: np.ndarray) -> np.ndarray:
    """Places of the rows of x that may be among the k nearest of q. Both are rotated; `skip` rows take no part."""
    dim = x.shape[1]
    kept, held = np.empty(0, int), np.empty(0)
    limit = np.inf
    for lo in range(0, len(x), BATCH):
        alive = lo + np.flatnonzero(~skip[lo:lo + BATCH])
        partial = np.zeros(len(alive))
        for a in range(0, dim, BLOCK):
            b = min(a + BLOCK, dim)
            partial += ((x[alive, a:b] - q[a:b]) ** 2).sum(axis=1)
            if b < dim and limit < np.inf:
                # H0: the distance is within the limit. Rejected where the estimate from b columns lies far above it.
                ok = partial * (dim / b) <= limit * (1 + EPSILON / np.sqrt(b)) ** 2
                alive, partial = alive[ok], partial[ok]
        kept, held = np.concatenate((kept, alive)), np.concatenate((held, partial))
        if len(held) > k:
            limit = np.partition(held, k - 1)[k - 1]
            ok = held <= limit * (1 + 1e-9)
            kept, held = kept[ok], held[ok]
    return kept


def search(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", probed: float = PROBED, sample: int = SAMPLE) -> DataFrame:
    """The k nearest of `rows` for each of `queries`, by Euclidean distance: `query_id`, `rank`, `vec_id`, `score`.

    A query's own id is no candidate; ties go to the smaller id. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without an id or with another dimension than the smallest id's. Repeated rows are
    candidates each; a repeated query id is one query, its smallest vector. Fewer candidates give fewer rows; empty tables
    give none. The centroids are fitted on at most `sample` vectors; all vectors are in the lists.
    """
    spark = rows.sparkSession
    good = staged(usable(rows, key, vector), "vectors")
    found = good.agg(F.min(F.struct("id", F.size("vec").alias("dim"))).alias("first"), F.count("*").alias("n")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not found["n"]:
        return empty
    dim, n = found["first"]["dim"], found["n"]
    good = good.where(F.size("vec") == dim)
    picked = good.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(sample).select("vec").toPandas()["vec"]
    centre = fit_lists(np.stack(picked.to_list()), int(min(LISTS, max(1, np.sqrt(n)))))
    probes = max(1, int(np.ceil(len(centre) * probed)))
    shared = spark.sparkContext.broadcast(centre)  # at most LISTS rows

    def deal(n: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, 2048):
                    part = batch.slice(lo, 2048)
                    x = np.array(part.column("vec").flatten()).reshape(-1, dim)
                    near = nearest(x, shared.value, n)
                    at = pa.array(np.repeat(np.arange(part.num_rows), near.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(near.ravel(), pa.int32()), part.column("id").take(at), part.column("vec").take(at)], names=["list", "id", "vec"])

        return run

    schema = "list int, id bigint, vec array<double>"
    base = staged(good.mapInArrow(deal(1), schema), "lists")
    asked = usable(queries, key, vector).where(F.size("vec") == dim).groupBy("id").agg(F.min("vec").alias("vec"))
    asked = staged(asked.mapInArrow(deal(probes), schema), "probes")
    # Large lists are scanned in parts, and many queries of a list in portions. At most LISTS rows each.
    parts = base.groupBy("list").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    portions = asked.groupBy("list").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("portions"))
    shape = F.broadcast(parts.join(portions, "list"))
    span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = base.join(shape, "list").select("list", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), span("portions").alias("portion"), "id", "vec")
    right = asked.join(shape, "list").select("list", span("parts").alias("part"), F.pmod(F.xxhash64("id"), F.col("portions")).cast("int").alias("portion"), "id", "vec")
    turn = rotation(dim)

    def answer(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(have) and len(want):
            x, ids = np.stack(have["vec"].to_list()), have["id"].to_numpy()
            turned = x @ turn
            for query, q in zip(want["id"].to_numpy(), want["vec"]):
                at = scan(q @ turn, turned, k, ids == query)
                score = np.sqrt(((x[at] - q) ** 2).sum(axis=1))
                best = np.lexsort((ids[at], score))[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[at][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ["list", "part", "portion"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(answer, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
