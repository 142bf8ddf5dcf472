"""Whitening of embeddings by principal components, over block matrices.

Rows are dealt into blocks of bounded size, which are the blocks of an MLlib `BlockMatrix`. Its transpose times itself is the scatter, from
which the components come by a local decomposition (dimensions squared on the driver); block matrix times whitening matrix projects all rows.

Two layouts keep products spread over tasks. For the scatter the blocks stand in one column and the shared dimension is split, so a
task multiplies `TOGETHER` blocks at most and only partial sums meet. For the projection they stand in a square grid, times a matrix with the
whitening matrix along its diagonal: a single column of blocks would meet in few tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxloom.session import staged

COMPONENTS = 16
BLOCK_BYTES = 1 << 20  # of a block, as doubles
TOGETHER = 16          # blocks of the scatter that meet in one task
SCALE, SHIFT = 64.0, 1_000_000
SAFE = 1 << 50         # integers up to this are summed over a block as 64-bit ones, larger ones without bounds


class Blocks(NamedTuple):
    """Rows in blocks: `part` and `at` name a block, `size` counts its rows, `ids` and `x` hold them as bytes, row by row."""

    frame: DataFrame
    width: int   # of the numbers `at`; part * width + at is the number of a block
    parts: int
    rows: int    # of a full block
    dim: int

    def number(self) -> int:
        return self.parts * self.width


class Components(NamedTuple):
    n: int                # vectors of the fit list
    total: list[int]      # exact sums by dimension
    values: np.ndarray    # eigenvalues kept, falling
    explained: np.ndarray
    project: np.ndarray   # dimensions by components: unit vectors over the root of their eigenvalue


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, x): rows whose vector is there, not empty and finite; entries as whole numbers."""
    wrong = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    named = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    good = named.where("v is not null and size(v) > 0").where(~F.exists("v", wrong))
    return good.select("id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def in_blocks(rows: DataFrame, dim: int, name: str) -> Blocks:
    """Write the rows (`id`, `x`) in blocks. A task deals its rows in the order in which they come; what it wrote is then fixed."""
    per = max(64, BLOCK_BYTES // (8 * dim))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        ids, xs, held = [], [], 0

        def block(n: int) -> pa.RecordBatch:
            nonlocal ids, xs, held, at
            i, x = np.concatenate(ids), np.concatenate(xs)
            sums = x[:n].sum(axis=0) if np.abs(x[:n]).max() < SAFE else x[:n].astype(object).sum(axis=0)
            out = [[part], [at], [n], [i[:n].tobytes()], [x[:n].tobytes()], [[str(s) for s in sums]]]
            ids, xs, held, at = [i[n:]], [x[n:]], held - n, at + 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["part", "at", "size", "ids", "x", "sums"])

        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string())]
        for batch in batches:
            # A null id travels as the smallest number and comes back as null.
            ids.append(batch.column("id").fill_null(-(2**63)).to_numpy(zero_copy_only=False))
            xs.append(np.asarray(batch.column("x").flatten()).reshape(-1, dim))
            held += batch.num_rows
            while held >= per:
                yield block(per)
        if held:
            yield block(held)

    frame = staged(rows.select("id", "x").mapInArrow(deal, "part int, at int, size int, ids binary, x binary, sums array<string>"), name)
    shape = frame.agg(F.max("part").alias("part"), F.max("at").alias("at")).first()
    return Blocks(frame, (shape["at"] or 0) + 1, (shape["part"] or 0) + 1, per, dim)


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x minus the mean. Whole parts are subtracted exactly."""
    whole = np.array([t // n for t in total], np.int64)
    return (x - whole).astype(np.float64) - np.array([t % n / n for t in total])


def dense(blocks: Blocks, n: int, total: list[int], grid: int | None = None) -> RDD:
    """((row, column), matrix) of the centred blocks, full ones throughout: rows of zeros change no product.

    In one column, or with `grid` so many blocks side by side.
    """
    rows, dim, width = blocks.rows, blocks.dim, blocks.width

    def make(row) -> tuple[tuple[int, int], DenseMatrix]:
        out = np.zeros((rows, dim))
        out[:row["size"]] = centred(np.frombuffer(row["x"], np.int64).reshape(-1, dim), n, total)
        m = row["part"] * width + row["at"]
        return (m, 0) if grid is None else divmod(m, grid), DenseMatrix(rows, dim, out.ravel(order="F"))

    return blocks.frame.select("part", "at", "size", "x").rdd.map(make)


def scatter(blocks: Blocks, n: int, total: list[int]) -> np.ndarray:
    """Sum of the outer products of the centred rows."""
    count = blocks.number()
    matrix = BlockMatrix(dense(blocks, n, total), blocks.rows, blocks.dim, count * blocks.rows, blocks.dim).persist(StorageLevel.MEMORY_AND_DISK)
    turned = matrix.transpose()
    # The split of the shared dimension is a parameter of the product that its Python form does not pass on.
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, math.ceil(count / TOGETHER))
    out = BlockMatrix(product, blocks.dim, blocks.dim).toLocalMatrix().toArray()
    matrix._java_matrix_wrapper.call("blocks").unpersist(False)
    return out


def projected(blocks: Blocks, found: Components) -> RDD:
    """(number of the block, whitened rows) of all blocks. Rows beyond a block's size are padding."""
    spark = blocks.frame.sparkSession
    grid = math.isqrt(blocks.number() - 1) + 1
    high, k = -(-blocks.number() // grid), found.project.shape[1]
    wide = BlockMatrix(dense(blocks, found.n, found.total, grid), blocks.rows, blocks.dim, high * blocks.rows, grid * blocks.dim)
    values = found.project.ravel(order="F")
    diagonal = spark.sparkContext.range(grid).map(lambda j: ((j, j), DenseMatrix(len(values) // k, k, values)))
    out = wide.multiply(BlockMatrix(diagonal, blocks.dim, k, grid * blocks.dim, grid * k))
    return out.blocks.map(lambda b: (b[0][0] * grid + b[0][1], b[1].toArray()))


def fit(blocks: Blocks, components: int) -> Components:
    """Components of the covariance of the rows in the blocks, those with a variance of zero up to rounding left out."""
    sums = blocks.frame.select("size", F.posexplode("sums").alias("d", "s")).groupBy("d").agg(
        F.sum("size").cast("bigint").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    ).orderBy("d").collect()  # a row for each dimension
    n, total = sums[0]["n"], [int(r["s"]) for r in sums]
    cov = scatter(blocks, n, total) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > max(values[0], 0) * len(values) * np.finfo(float).eps
    keep = np.flatnonzero(real)[:components]
    return Components(n, total, values[keep], values[keep] / np.trace(cov), vectors[:, keep] / np.sqrt(values[keep]))


def identity_error(blocks: Blocks, found: Components) -> float:
    """How far the covariance of the whitened fit list is from the identity, at most."""
    k = len(found.values)
    # Padding is rows of zeros, so it adds nothing to sums and products.
    parts = projected(blocks, found).map(lambda b: np.vstack([b[1].T @ b[1], b[1].sum(axis=0)[None, :]]))
    total = parts.treeReduce(np.add) / found.n
    mean = total[k]
    return float(np.abs(total[:k] - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Exact sums of (n * x - total)^2 by row; null where that exceeds 64 bits."""
    total = np.array(total, object)
    most = int(np.abs(x).max()) * n + int(np.abs(total).max())
    if most < 2**62:  # differences fit; their squares may
        d = x * n - total.astype(np.int64)
        if int(np.abs(d).max()) ** 2 * x.shape[1] < 2**63:
            return (d * d).sum(axis=1).tolist()
    d = x.astype(object) * n - total
    return [int(s) if s < 2**63 else None for s in (d * d).sum(axis=1)]


def whiten(rows: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows in `components` principal components at most, scaled to variance one: `vec_id`, `component`, `n`, `deviation`, `whitened`,
    `explained`, `identity_error`.

    Mean and covariance are those of the distinct vectors, after entries became whole numbers. Vectors that are null, empty, or hold
    null or non-finite entries take no part, nor do those of another dimension than the smallest id's. Repeated rows are answered
    each, and ties of eigenvalues are any orthogonal pair, the same for all rows. Components without variance are left out: a
    single distinct vector has none, and an empty table gives an empty one. Null ids stay.
    """
    spark = rows.sparkSession
    good = staged(usable(rows, key, vector), "whole")
    first = good.agg(F.min(F.struct(F.col("id").isNull(), "id", F.size("x").alias("dim"))).alias("first")).first()["first"]
    empty = spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    if first is None:
        return empty
    good = good.where(F.size("x") == first["dim"])
    distinct = in_blocks(good.select("x").distinct().select(F.lit(0).cast("bigint").alias("id"), "x"), first["dim"], "distinct")
    found = fit(distinct, components)
    if not len(found.values):
        return empty
    error = identity_error(distinct, found)
    every = in_blocks(good, first["dim"], "blocks")
    return _told(spark, every, found, error)


def _told(spark: SparkSession, every: Blocks, found: Components, error: float) -> DataFrame:
    """Whitened blocks meet the ids of their rows, block by block."""
    width, dim, k = every.width, every.dim, len(found.values)
    blocks = projected(every, found).map(lambda b: (b[0] // width, b[0] % width, bytearray(np.ascontiguousarray(b[1]).tobytes())))
    results = spark.createDataFrame(blocks, "part int, at int, w binary")
    joined = every.frame.select("part", "at", "size", "ids", "x").join(results, ["part", "at"])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                size, ids, x, w = (batch.column(c)[i].as_py() for c in ("size", "ids", "x", "w"))
                whitened = np.frombuffer(w, np.float64).reshape(-1, k)[:size]
                away = pa.array(deviations(np.frombuffer(x, np.int64).reshape(-1, dim), found.n, found.total), pa.int64())
                named = np.frombuffer(ids, np.int64)
                at = pa.array(np.repeat(np.arange(size), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(named, mask=named == -(2**63)).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                        pa.array(np.full(size * k, found.n, np.int64)), away.take(at), pa.array(whitened.ravel()),
                        pa.array(np.tile(found.explained, size)), pa.array(np.full(size * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return joined.mapInArrow(rows_of, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
