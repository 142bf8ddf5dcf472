"""Mix sources to target weights: fixed-length blocks, multinomial source counts per shard, index permutations.

The words of a source stand in one row, cut into blocks of equal length. Each output shard draws how many of its slots go to
each source, multinomially under the condition that the totals match the quotas. A source's slots, numbered through all shards,
take its blocks in the order of a pseudorandom permutation, anew for each epoch. Blocks and slots meet in a join by index.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toxloom.llm.words import mix, raw, slices, words
from toxloom.session import staged

BLOCK = 128        # words; sources with fewer than BLOCK * FINE have shorter ones
FINE = 256         # blocks that a source has at least, where it has so many words
SHARD = 1024       # slots of an output shard
DEAL = 64          # shards that are dealt together, so that their totals are exact
LANE = 4096        # rows of a source that one task numbers
WORD = r"[^\x20\x09-\x0D]+"
REPEAT = 3


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = REPEAT) -> DataFrame:
    """Targets from (source, source_size): `weights` repeat over the sources by code point, null last, and share all words.

    A target stops at `most` times its source's size and the excess is shared again by weight, until none is above. Sources
    fill up in the order of size to weight, so the final share of a unit of weight follows from running sums.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1  # one row per source
    choices = F.array(*[F.lit(float(w)) for w in weights])
    cap, weight = F.col("source_size") * float(most), F.col("weight")
    by_fill = Window.orderBy(cap / weight, F.col("source").isNull(), "source")
    rows = sizes.withColumn("weight", F.element_at(choices, (place % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    rows = rows.select(
        "*", F.sum("source_size").over(everything).alias("_all"), F.sum("weight").over(everything).alias("_weights"),
        F.coalesce(F.sum(cap).over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_capped"),
        F.coalesce(F.sum("weight").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"),
    )
    # Were all sources before this one capped and no other, a unit of weight would get so much.
    unit = (F.col("_all") - F.col("_capped")) / (F.col("_weights") - F.col("_before"))
    # The first source that isn't capped has the answer; after it the value only falls.
    rows = rows.withColumn("_unit", F.max(F.when(cap > unit * weight, unit)).over(everything))
    return rows.select("source", "source_size", F.when(F.col("_unit").isNull(), cap).otherwise(F.least(cap, F.col("_unit") * weight)).alias("target"))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(size), for each row by its own key: a Feistel network, walked until within range."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def slots(quotas: DataFrame, deals: int, seed: int) -> DataFrame:
    """(shard, source_no, k, block) of each slot. Quotas: (source_no, blocks, quota), one row per source.

    A deal is a run of shards with a fixed part of each quota. Its shards draw their counts one after the other from what is
    left of it. `k` numbers a source's slots through all deals.
    """
    part = lambda i: F.floor(F.col("quota") * i / deals)
    dealt = quotas.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(deals - 1)))).select(
        "deal", "source_no", "blocks", part(F.col("deal")).alias("k"), (part(F.col("deal") + 1) - part(F.col("deal"))).alias("n")
    )
    run_of = lambda pdf: _deal(pdf, seed)
    return dealt.groupBy("deal").applyInPandas(run_of, "shard bigint, source_no int, k bigint, block bigint")


def _deal(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values("source_no")
    deal = int(pdf["deal"].iat[0])
    rng = np.random.default_rng([seed, deal])
    rest = pdf["n"].to_numpy(np.int64)
    start = pdf["k"].to_numpy(np.int64)
    number, shards, sources, ks = 0, [], [], []
    while rest.sum():
        # Multinomial by the rest, given the rest's total.
        count = rng.multivariate_hypergeometric(rest, min(SHARD, int(rest.sum())), method="marginals")
        shards.append(np.full(count.sum(), deal * 2 * DEAL + number))
        sources.append(np.repeat(np.arange(len(rest)), count))
        ks.append(np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
        rest, start, number = rest - count, start + count, number + 1
    if not shards:
        return pd.DataFrame({"shard": [], "source_no": [], "k": [], "block": []})
    source, k = np.concatenate(sources), np.concatenate(ks)
    blocks, no = pdf["blocks"].to_numpy(np.int64)[source], pdf["source_no"].to_numpy(np.int64)[source]
    key = mix(mix(no.astype(np.uint64) + np.uint64(seed << 32)) + (k // blocks).astype(np.uint64))
    return pd.DataFrame({"shard": np.concatenate(shards), "source_no": no, "k": k, "block": permuted(k % blocks, blocks, key)})


class Mix:
    """The staged parts of a mix: `sources`, `spans` (which words of a document stand in which block) and `slots`."""

    def __init__(
        self, docs: DataFrame, columns: Sequence[str] = ("doc_id",), block: int = BLOCK, weights: Sequence[int] = (1, 2, 3),
        seed: int = 7, text: str = "text", source: str = "source", keep_text: bool = False,
    ):
        spark = docs.sparkSession
        n = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")
        named = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
        # Rows are placed by what they hold, not by where they lie, so that a run on other cores or files mixes the same words.
        # Rows that are equal in all of it are interchangeable.
        same = F.xxhash64(F.struct(*named), F.col(text), F.lit(seed)).alias("same")
        sized = docs.select(F.col(source).alias("source"), n.alias("size"), F.struct(*named).alias("row"), same, *([F.col(text).alias("text")] if keep_text else []))
        sized = staged(sized.withColumn("uid", F.monotonically_increasing_id()), "sizes")
        lanes = -(-sized.count() // LANE)
        rows = sized.select("source", "size", "row", "uid", "same", F.pmod("same", F.lit(max(1, lanes))).alias("lane"))
        totals = staged(rows.groupBy("source", "lane").agg(F.sum("size").alias("n")), "lanes")
        sizes = totals.groupBy("source").agg(F.sum("n").alias("source_size"))
        no = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")).cast("int")
        length = F.least(F.lit(block), F.greatest(F.lit(1), F.floor(F.col("source_size") / FINE))).cast("bigint")
        blocks = F.ceil(F.col("source_size") / F.col("block"))
        quota = F.when(F.col("source_size") > 0, F.round(blocks * F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
        self.sources = staged(source_targets(sizes, weights).withColumn("block", length).select("*", no.alias("source_no"), blocks.alias("blocks"), quota.alias("quota")), "sources")
        before = F.sum("n").over(Window.partitionBy("source").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1))
        starts = totals.select("source", "lane", F.coalesce(before, F.lit(0)).alias("lane_start"))
        starts = starts.alias("a").join(self.sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "b.source_no", F.col("b.block").alias("length"))
        inside = F.sum("size").over(Window.partitionBy("source", "lane").orderBy("row", "same", "size", "uid").rowsBetween(Window.unboundedPreceding, -1))
        placed = rows.withColumn("inside", F.coalesce(inside, F.lit(0))).alias("a").join(
            starts.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.lane") == F.col("b.lane"))
        ).select("row", "uid", "size", "source_no", "length", (F.col("lane_start") + F.col("inside")).alias("at"))
        #: A row per document: row (its columns), size, source_no, its blocks' length, and its first word's place in the source.
        self.placed = staged(placed, "placed")
        self.sized, self.columns = sized, list(columns)
        total = self.sources.agg(F.sum("quota")).first()[0] or 0
        self.slots = staged(slots(self.sources.where("quota > 0").select("source_no", "blocks", "quota"), max(1, -(-total // (SHARD * DEAL))), seed), "slots")

    def spans(self) -> DataFrame:
        """A row per document and block: `lo` and `hi`, the words of the document that stand in the block."""
        b, at, end = F.col("length"), F.col("at"), F.col("at") + F.col("size")
        per = self.placed.where("size > 0").select("*", F.explode(F.sequence(F.floor(at / b), F.floor((end - 1) / b))).alias("block"))
        return per.select(
            "row", "uid", "source_no", "block",
            (F.greatest(at, F.col("block") * b) - at).alias("lo"), (F.least(end, (F.col("block") + 1) * b) - at).alias("hi"),
        )

    def taken(self) -> DataFrame:
        """A row per document: its columns, `size`, `source_size`, `target`, `taken` (its words in the mix, repeats counted)."""
        times = self.slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
        got = self.spans().join(times, ["source_no", "block"]).groupBy("uid").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
        return (
            self.placed.join(got, "uid", "left").join(self.sources.select("source_no", "source_size", "target"), "source_no")
            .select(*self._columns(), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
        )

    def texts(self) -> DataFrame:
        """The mix itself: `shard`, `slot` (number in its source), `lo`, the document's columns, and `text`, its words in that slot."""
        # Spans and slots meet by index, without texts; a document then has at most three times its blocks.
        drawn = self.spans().join(self.slots, ["source_no", "block"]).groupBy("uid").agg(F.collect_list(F.struct("shard", "k", "lo", "hi")).alias("spans"))

        columns = self.columns

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                texts = raw(part)
                w = words(texts)
                begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
                row, shard, slot, first, own = [], [], [], [], []
                for i, (t, spans) in enumerate(zip(texts, part.column("spans").to_pylist())):
                    for s in spans:
                        a, b = w.first[i] + s["lo"], w.first[i] + s["hi"] - 1
                        row.append(i), shard.append(s["shard"]), slot.append(s["k"]), first.append(s["lo"])
                        own.append(t[w.start[a] - begin[i]:w.end[b] - begin[i]].decode())
                numbers = [pa.array(x, pa.int64()) for x in (shard, slot, first)]
                yield pa.RecordBatch.from_arrays(
                    [*numbers, *(part.column(c).take(pa.array(row, pa.int64())) for c in columns), pa.array(own, pa.string())],
                    names=["shard", "slot", "lo", *columns, "part"],
                )

        held = self.sized.select("uid", *self._columns(), F.col("text").alias("_text")).join(drawn, "uid").drop("uid").withColumnRenamed("_text", "text")
        schema = ", ".join(f"`{c}` {held.schema[c].dataType.simpleString()}" for c in self.columns)
        return held.mapInArrow(cut, f"shard bigint, slot bigint, lo bigint, {schema}, part string").withColumnRenamed("part", "text")

    def _columns(self):
        return [F.col(f"row.c{i}").alias(c) for i, c in enumerate(self.columns)]


def mixture(docs: DataFrame, **options) -> Mix:
    """Mix documents by source.

    The size of a text is its number of words `[^\\x20\\x09-\\x0D]+`; null and empty texts have none and take no part, but keep
    their row. A null source is one source, after all others. Repeated rows are documents of their own. An empty table
    gives empty parts. Columns that aren't named are ignored. A text of any length is cut where its words cross blocks. Reruns agree, on
    any number of cores and files. A block is drawn at most three times, hence no document is taken more than three times.
    """
    return Mix(docs, **options)
