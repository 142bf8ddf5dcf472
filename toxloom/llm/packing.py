"""Best-fit packing of token sequences by hierarchical residual rounds.

Documents become token ids; longer ones are cut into full pieces, and what is left packs by best fit. Each group of a bounded
number of pieces packs locally and emits its nearly full bins. The others travel on as items of the next round, in fewer
groups, until they fit in one.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from toxloom.llm.words import once, slices
from toxloom.session import work_folder

GROUP = 4096  # items that one task packs together
SLACK = 256   # a bin with this part of it free counts as nearly full in the first round; the room doubles with each round
#: Letters on which all versions of the tables of characters agree. Other texts take the tokenizer's own, slower way.
PLAIN = re.compile(r"[\t\n\r\x20-\x7EÀ-ɏ]*")
#: The faster encoder runs out of stack on much longer runs of blanks.
BLANKS = re.compile(r"\s{10000}")


def tokenizer(name: str) -> Tokenizer:
    return once(("tokenizer", name), lambda: Tokenizer.from_file(public_tokenizers.path(f"{name}.json")))


def ranked(name: str) -> tiktoken.Encoding:
    def make() -> tiktoken.Encoding:
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    return once(("ranks", name), make)


def encode(name: str, text: str) -> list[int]:
    """The ids that the vocabulary's .json gives. The same merges from its rank file are several times faster, and take plain texts."""
    if PLAIN.fullmatch(text) and "<|" not in text and not (len(text) >= 10_000 and BLANKS.search(text)):
        return ranked(name).encode_ordinary(text)
    return tokenizer(name).encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, size: int, keys: Sequence[str] = ("doc_id",), name: str = "byte_bpe_50k", end: int = 2, text: str = "text") -> DataFrame:
    """A row per piece: keys, `piece`, `start`, `length`, `ids_crc32`. The first piece of a longer document may be shorter."""
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    schema += ", piece int, start bigint, length bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            row, piece, start, length, crc = [], [], [], [], []
            for i, t in enumerate(part.column(text).to_pylist()):
                ids = np.array([*encode(name, t or ""), end], "<u4")
                cut = len(ids) % size or size
                for k, lo in enumerate([0, *range(cut, len(ids), size)]):
                    own = ids[lo:cut] if not lo else ids[lo:lo + size]
                    row.append(i), piece.append(k), start.append(lo), length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k).take(pa.array(row)) for k in keys), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=[*keys, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(*keys, text).mapInArrow(run, schema)


def best_fit(sizes: Sequence[int], limit: int) -> list[list[int]]:
    """Places of the items of each bin: from the largest item on, each goes where it leaves the least room."""
    bins: list[list[int]] = []
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_left(free, (sizes[i], -1))
        if at < len(free):
            room, b = free.pop(at)
            bins[b].append(i)
        else:
            room, b = limit, len(bins)
            bins.append([i])
        if room > sizes[i]:
            insort(free, (room - sizes[i], b))
    return bins


def packer(size: int, room: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Best fit of a group of bins; those with no more than `room` free are done."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_tie=[repr(m[0]) for m in pdf["members"]]).sort_values(["fill", "bin", "_tie"], ascending=[False, True, True])
        fill, member, number = pdf["fill"].to_numpy(), pdf["members"].tolist(), int(pdf["bin"].iat[0])
        bins = best_fit(fill.tolist(), size)
        total = [int(fill[b].sum()) for b in bins]
        return pd.DataFrame({
            "bin": [(number + i * 0x9E3779B97F4A7C15 + 2**63) % 2**64 - 2**63 for i in range(len(bins))],
            "fill": total,
            "members": [[m for i in b for m in member[i]] for b in bins],
            "done": [size - t <= room for t in total],
        })

    return run


def pack(items: DataFrame, size: int, group: int = GROUP, slack: int = SLACK) -> DataFrame:
    """Pack rows with a `length` of 1 to `size` into sequences: adds `sequence_id` and `offset`.

    Rows may repeat: each is an item of its own. No column may be null in `length`; an empty table gives an empty one.
    Bins and their members travel as one row (at most `size` members), so no task holds more than `group` bins. Rounds end
    when one group is left, or when a round can't join any more: then its bins stand as they are.
    """
    spark, columns = items.sparkSession, items.columns
    folder = work_folder(spark, "packing")
    items.write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    members = ", ".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in items.schema)
    schema = f"bin bigint, fill int, members array<struct<{members}>>"
    full = items.where(F.col("length") == size)
    order = F.xxhash64(*columns)
    rest = items.where(F.col("length") < size).select(
        order.alias("bin"), F.col("length").cast("int").alias("fill"), F.array(F.struct(*columns)).alias("members")
    )
    left, levels, level = rest.count(), [], 0
    while left:
        groups, room = -(-left // group), (size << min(level, 20)) // slack

        out = f"{folder}/round-{level}"
        rest.groupBy(F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)).alias("_group")).applyInPandas(
            packer(size, size if groups == 1 else room), f"{schema}, done boolean"
        ).write.partitionBy("done").parquet(out)
        packed = spark.read.schema(f"{schema}, done boolean").parquet(out)
        levels.append(packed.where("done").drop("done"))
        rest = packed.where("not done").drop("done")
        before, left = left, 0 if groups == 1 else rest.count()
        if left > 0.9 * before:
            levels.append(rest)  # such as pieces that are all longer than half a sequence
            break
        level += 1
    bins = full.select(F.array(F.struct(*columns)).alias("members"))
    for x in levels:
        bins = bins.unionByName(x.select("members"))
    numbered = bins.withColumn("sequence_id", F.monotonically_increasing_id())
    # The running sum of lengths in a bin is a member's offset.
    ahead = F.expr("transform(members, (m, i) -> struct(m as m, cast(aggregate(slice(members, 1, i), 0L, (s, x) -> s + x.length) as bigint) as offset))")
    return numbered.select("sequence_id", F.explode(ahead).alias("x")).select("x.m.*", "sequence_id", "x.offset")


def pack_documents(docs: DataFrame, size: int = 1024, keys: Sequence[str] = ("doc_id",), name: str = "byte_bpe_50k", end: int = 2) -> DataFrame:
    """Pack documents into sequences of at most `size` tokens: keys, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`.

    Null and empty texts are one piece, the end token. Repeated rows are packed each on its own. Other columns are ignored.
    """
    return pack(pieces(docs, size, keys, name, end), size)
