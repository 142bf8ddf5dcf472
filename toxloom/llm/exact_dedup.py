"""Exact deduplication by recipes of content-defined chunks.

A text is cut where a rolling hash of its last bytes says so, hence copies are cut alike. Equal chunks get one identifier,
verified on their bytes; a document is then its ordered list of identifiers, and only lists are compared. Each chunk's bytes
cross the network once for a task that met it, however many documents hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toxloom.llm.words import mix, once, raw, slices
from toxloom.session import discard, staged, work_folder

WINDOW = 16      # bytes that decide a cut
MASK = 0x7FF     # a cut every 2,048 bytes on average
MOST = 1 << 16   # bytes of a chunk at most


def gear() -> np.ndarray:
    return once("gear", lambda: (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32))


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    n = len(text)
    if n <= WINDOW:
        return [n] if n else []
    g = gear()[np.frombuffer(text, np.uint8)]
    # Doubling: after each step the hash covers twice as many bytes; older bytes are shifted out of the window.
    step = 1
    while step < WINDOW:
        g = g[step:] + (g[:-step] << np.uint32(step))
        step *= 2
    at = (np.flatnonzero((g >> np.uint32(16)) & np.uint32(MASK) == 0) + WINDOW).tolist()
    out, last = [], 0
    for end in [*at, n]:
        while end - last > MOST:
            last += MOST
            out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


def normalised(text: bytes) -> bytes:
    return text.lower()  # of bytes: A-Z only


def chunked(docs: DataFrame, columns: Sequence[str], text: str, width: int) -> DataFrame:
    """`columns`, `text_sha256`, `recipe` (chunk hashes of `width` bytes) and `chunks` (their bytes)."""
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            sha, recipes, chunks = [], [], []
            for t in map(normalised, raw(part, text)):
                ends = cuts(t)
                own = [t[a:b] for a, b in zip([0, *ends], ends)]
                sha.append(hashlib.sha256(t).hexdigest())
                chunks.append(own)
                recipes.append([hashlib.blake2b(c, digest_size=width).digest() for c in own])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in columns), pa.array(sha, pa.string()), pa.array(recipes, pa.list_(pa.binary())), pa.array(chunks, pa.list_(pa.binary()))],
                names=[*columns, "text_sha256", "recipe", "chunks"],
            )

    return docs.select(*dict.fromkeys([*columns, text])).mapInArrow(run, f"{schema}, text_sha256 string, recipe array<binary>, chunks array<binary>")


def with_recipes(docs: DataFrame, columns: Sequence[str], text: str = "text", width: int = 16) -> DataFrame:
    """`columns`, `text_sha256` and `recipe`: the ordered identifiers of the chunks, equal exactly where the chunks' bytes are.

    Chunks with equal hashes are compared by their bytes. Where one hash has several contents, they are numbered and the
    identifiers that these documents carry gain the number.
    """
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "chunks")
    chunked(docs, columns, text, width).write.parquet(folder)
    cut = spark.read.parquet(folder)
    pair = cut.select(F.explode(F.arrays_zip("recipe", "chunks")).alias("x")).select(F.col("x.recipe").alias("h"), F.col("x.chunks").alias("bytes"))
    distinct = pair.groupBy("h", "bytes").agg(F.count("*").alias("n"))
    # One row per verified chunk: a hash that has two of them is ambiguous.
    doubtful = staged(distinct.groupBy("h").agg(F.count("*").alias("contents")).where("contents > 1").select("h"), "doubtful")
    plain = cut.drop("chunks")
    if doubtful.isEmpty():
        found = staged(plain, "recipes")
        discard(spark, folder)  # the texts: nothing reads them any more
        return found
    numbered = distinct.join(doubtful, "h").select(
        "h", "bytes", (F.row_number().over(Window.partitionBy("h").orderBy("bytes")) - 1).cast("string").cast("binary").alias("number")
    )
    held = cut.withColumn("_row", F.monotonically_increasing_id())
    each = held.select("_row", F.posexplode(F.arrays_zip("recipe", "chunks")).alias("at", "x")).select("_row", "at", F.col("x.recipe").alias("h"), F.col("x.chunks").alias("bytes"))
    changed = each.join(numbered, ["h", "bytes"], "left").groupBy("_row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", F.concat("h", F.coalesce("number", F.lit(b"")))))), lambda x: x["col2"]).alias("_ids")
    )
    return held.join(changed, "_row", "left").select(
        *[F.col(c) for c in plain.columns if c != "recipe"], F.coalesce("_ids", F.array().cast("array<binary>")).alias("recipe")
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", keep: Sequence[str] = (), text: str = "text", width: int = 16) -> DataFrame:
    """One row per document: `key`, `keep_id`, `group_size`, `kept`, `text_sha256` and the columns of `keep`.

    Texts are equal when they are so after lower-casing A-Z. Of equal texts the row with the largest key stays, a null key
    coming last. Null text counts as empty; all empty texts are one group. Of rows that repeat a key and a text exactly one
    is kept. An empty table gives an empty one. Columns of `docs` that aren't named are ignored.
    """
    columns = list(dict.fromkeys([key, *keep]))
    rows = with_recipes(docs, columns, text, width)
    if set(keep) & {"keep_id", "group_size", "kept", "text_sha256", "recipe"}:
        raise ValueError("a kept column has the name of a result")
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "recipes")
    tie = F.xxhash64(*[F.col(c) for c in columns])
    best = F.struct(F.coalesce(F.col(key), F.lit(-(2**63))).alias("key"), tie.alias("tie"), F.col("_row").alias("row"))
    groups = rows.groupBy("recipe").agg(F.max(best).alias("_best"), F.max(key).alias("keep_id"), F.count("*").alias("group_size"))
    out: list[Column] = [F.col(key), F.col("keep_id"), F.col("group_size"), (F.col("_best.row") == F.col("_row")).alias("kept"), F.col("text_sha256")]
    return rows.join(groups, "recipe").select(*out, *[F.col(c) for c in columns if c != key])
