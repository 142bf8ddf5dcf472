"""N-gram Jaccard join by chosen paths.

Texts are sets of word shingles; equal sets are one class. A class has a sketch of 64 minimum hashes, tokens that two sets share
with a probability of their similarity. Each run splits all classes recursively: at a node, a few positions of the sketch,
sampled by a hash of the path to it, send a class on to the child of its token there. Small buckets are compared by brute
force, as are buckets that no longer split because their members are alike; these in blocks, so no task holds more than two.
Runs repeat until a pair at the threshold is found with the target probability. Candidates are checked on the whole sets.

A pair counts in the first bucket that both its classes reach, hence once. So a bucket can report links as sums by member
and as the members' connected parts: rows grow with the classes, not with the pairs of a large group of near copies.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxloom.llm.words import grams, mix, once, raw, slices, words
from toxloom.session import staged

SHINGLE = 5
THRESHOLD = 0.8
TOKENS = 64      # of a sketch
BRANCH = 2       # sampled positions of a node
BUCKET = 512     # classes that are compared at once
DEEPEST = 6
ALIKE = 0.5      # a child with so much of its parent's members holds alike ones
RECALL = 0.9999


def runs_needed(threshold: float, recall: float, branch: int = BRANCH) -> int:
    """Runs after which a pair at the threshold has met with probability `recall`, however deep the recursion goes."""
    lost = 0.0
    for _ in range(1000):  # extinction of a branching process
        lost = (1 - threshold + threshold * lost) ** branch
    return max(1, math.ceil(math.log(1 - recall) / math.log(lost)))


def salts() -> np.ndarray:
    return once("salts", lambda: mix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64)))


def sketches(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A row of minimum hashes per set; begin has each set's first hash. No set may be empty."""
    s, out = salts(), np.empty((len(begin), TOKENS), np.int32)
    for t in range(TOKENS):
        h = (hashes ^ s[t]) * (s[TOKENS + t] | np.uint64(1))
        out[:, t] = (np.minimum.reduceat(h, begin) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all sets one after the other, each sorted and distinct, size of each set)."""
    w = words(texts)
    at, h = grams(w, k)
    owner = np.searchsorted(w.first, at, "right") - 1
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.bincount(owner[new], minlength=len(texts))


def described(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """`key`, `th` (hash of the text), `c` (digest of the shingle set; null where it is empty), `n` and `sketch`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            h, n = shingle_sets(raw(part), k)
            end = np.cumsum(n)
            full = np.flatnonzero(n)
            sketch = sketches(h, (end - n)[full]) if len(full) else np.empty((0, TOKENS), np.int32)
            rows = iter(sketch.tolist())
            data, digest, own = h.tobytes(), [], []
            for a, b in zip((end - n).tolist(), end.tolist()):
                digest.append(hashlib.blake2b(data[8 * a:8 * b], digest_size=16).digest() if b > a else None)
                own.append(next(rows) if b > a else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("th"), pa.array(digest, pa.binary()), pa.array(n, pa.int32()), pa.array(own, pa.list_(pa.int32()))],
                names=["key", "th", "c", "n", "sketch"],
            )

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, th bigint, c binary, n int, sketch array<int>")


def children(rows: DataFrame, branch: int) -> DataFrame:
    """(path, c, parent): rows (path, c, sketch, size) sent on to the children of their node."""
    place = lambda j: F.pmod(F.xxhash64("path", F.lit(j)), F.lit(TOKENS)).cast("int")
    step = lambda j: F.xxhash64("path", F.lit(j), F.element_at("sketch", place(j) + 1))
    return rows.select(F.explode(F.array_distinct(F.array(*[step(j) for j in range(branch)]))).alias("path"), "c", F.col("size").alias("parent"))


def complete(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Sorted batches as tables of whole groups, with the borders of each group."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        change = np.zeros(max(0, table.num_rows - 1), bool)
        for k in keys:
            own = table.column(k).to_numpy()
            change |= own[1:] != own[:-1]
        at = [0, *(np.flatnonzero(change) + 1).tolist()]
        if at[-1]:
            yield table.slice(0, at[-1]), list(zip(at[:-1], at[1:]))
        rest = table.slice(at[-1]) if table.num_rows else None
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), [(0, rest.num_rows)]


def here_first(path: int, paths: list[list[int]], x: int, y: int, own: np.ndarray) -> np.ndarray:
    """Which pairs of a group count here: of its two blocks, and not together in an earlier bucket."""
    earlier = sorted({p for one in paths for p in one if p < path})
    ok = np.triu(np.ones((len(paths), len(paths)), bool), 1)
    if earlier:
        place = {p: i for i, p in enumerate(earlier)}
        there = np.zeros((len(paths), len(earlier)), np.float32)
        for i, one in enumerate(paths):
            there[i, [place[p] for p in one if p < path]] = 1
        ok &= (there @ there.T) == 0
    if x != y:
        ok &= own[:, None] != own[None, :]
    return ok


def shared_items(sets: Sequence[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by slices of the items."""
    m = len(sets)
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    out, width = np.zeros((m, m)), 8192
    for lo in range(0, int(number[-1]) + 1, width):
        a, b = np.searchsorted(number, [lo, lo + width])
        held = np.zeros((m, width), np.float32)
        held[owner[a:b], number[a:b] - lo] = 1
        out += held @ held.T
    return out


GROUP = ["path", "x", "y"]


def grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)


def promising(dealt: DataFrame, threshold: float) -> DataFrame:
    """Rows of `dealt` (a member of a group, with its sketch) that have a candidate in the group, by sketches and sizes."""
    # Five standard deviations below what a pair at the threshold shares.
    least = math.floor(TOKENS * threshold - 5 * math.sqrt(TOKENS * threshold * (1 - threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in complete(batches, GROUP):
            path, x, y, own, n = (table.column(k).to_numpy() for k in (*GROUP, "own", "n"))
            sketch = np.array(table.column("sketch").combine_chunks().flatten()).reshape(-1, TOKENS)
            paths = table.column("paths").to_pylist()
            keep = np.zeros(table.num_rows, bool)
            for lo, hi in borders:
                if hi - lo < 2:
                    continue
                s, z = sketch[lo:hi], n[lo:hi]
                same = np.zeros((hi - lo, hi - lo), np.int16)
                for t in range(TOKENS):
                    same += s[:, t, None] == s[None, :, t]
                ok = (same >= least) & (np.minimum(z[:, None], z[None]) >= threshold * np.maximum(z[:, None], z[None]) - 1e-9)
                if np.triu(ok, 1).any():
                    ok &= here_first(int(path[lo]), paths[lo:hi], int(x[lo]), int(y[lo]), own[lo:hi])
                    keep[lo:hi] = ok.any(axis=0) | ok.any(axis=1)
            if keep.any():
                yield from table.select([*GROUP, "own", "c", "members", "paths"]).filter(pa.array(keep)).to_batches()

    return grouped(dealt).mapInArrow(run, "path bigint, x int, y int, own int, c binary, members bigint, paths array<bigint>")


def checked(members: DataFrame, threshold: float, pairs: bool) -> DataFrame:
    """Exact links of groups whose members have their `items`.

    As (c, far, root): for each member the documents it is linked to and the smallest class of its connected part; or as
    pairs (a, b, similarity).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, borders in complete(batches, GROUP):
            path, x, y, own, weight = (table.column(k).to_numpy() for k in (*GROUP, "own", "members"))
            items = table.column("items").combine_chunks()
            flat, ends = items.flatten().to_numpy(), items.offsets.to_numpy()
            ends = ends - ends[0]
            c, paths = table.column("c").to_pylist(), table.column("paths").to_pylist()
            left, right, value = [], [], []
            for lo, hi in borders:
                if hi - lo < 2:
                    continue
                sets = [flat[ends[i]:ends[i + 1]] for i in range(lo, hi)]
                size = np.array([len(s) for s in sets])
                both = shared_items(sets)
                alike = both / (size[:, None] + size[None] - both)
                ok = (alike >= threshold) & here_first(int(path[lo]), paths[lo:hi], int(x[lo]), int(y[lo]), own[lo:hi])
                if pairs:
                    for i, j in zip(*(k.tolist() for k in np.nonzero(ok))):
                        left.append(min(c[lo + i], c[lo + j])), right.append(max(c[lo + i], c[lo + j])), value.append(float(alike[i, j]))
                    continue
                ok |= ok.T
                rank = np.argsort(np.argsort(np.array(c[lo:hi], object)))
                root = rank.copy()
                while True:
                    near = np.minimum(root, np.where(ok, root[None], hi - lo).min(axis=1))
                    if (near == root).all():
                        break
                    root = near
                by_rank = np.argsort(rank)
                far = ok @ weight[lo:hi]
                for i in np.flatnonzero(far).tolist():
                    left.append(c[lo + i]), right.append(c[lo + by_rank[root[i]]]), value.append(int(far[i]))
            columns = [pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(value, pa.float64() if pairs else pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "similarity"] if pairs else ["c", "root", "far"])

    return grouped(members).mapInArrow(run, "a binary, b binary, similarity double" if pairs else "c binary, root binary, far bigint")


def buckets(classes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET, branch: int = BRANCH) -> DataFrame:
    """(path, x, y, own, c, members, paths): groups of classes (c, n, members, sketch) with candidates among them."""
    runs = runs_needed(threshold, recall, branch)
    rows = classes.select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(runs).cast("bigint"))).alias("path"), "c", "sketch", F.lit(2**62).alias("size"))
    ready: list[DataFrame] = []
    for level in range(DEEPEST + 1):
        sent = staged(children(rows, branch), "paths")
        sizes = sent.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        met = staged(sent.join(sizes, "path"), "buckets")
        stay = (F.col("size") <= bucket) | (F.col("size") >= ALIKE * F.col("parent")) | F.lit(level == DEEPEST)
        ready.append(met.where(stay).select("path", "c", "size"))
        if met.where(~stay).isEmpty():
            break
        rows = met.where(~stay).join(classes.select("c", "sketch"), "c").select("path", "c", "sketch", "size")
    every = ready[0]
    for x in ready[1:]:
        every = every.unionByName(x)
    # A class reaches runs * branch**(DEEPEST + 1) buckets at most. A large bucket meets block by block: each member goes to
    # the pairs of its block with every block.
    blocks = F.ceil(F.col("b.size") / bucket).cast("int")
    reached = every.groupBy("c").agg(F.collect_list(F.struct("path", "size")).alias("reached")).join(classes, "c")
    each = reached.select("c", "n", "members", "sketch", F.expr("transform(reached, x -> x.path)").alias("paths"), F.explode("reached").alias("b"))
    each = each.select("*", F.col("b.path").alias("path"), F.pmod(F.xxhash64("c"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = each.select("path", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "c", "n", "members", "sketch", "paths")
    return promising(dealt, threshold)


def components(links: DataFrame) -> DataFrame:
    """(c, root) of the ends of links (a, b): the smallest end that is connected to it.

    Each round takes the smallest label of the neighbours, then the label's own label, so long chains shrink too.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = staged(both.groupBy(F.col("a").alias("c")).agg(F.least(F.col("c"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("c").alias("b"), "root"), "b").groupBy(F.col("a").alias("c")).agg(F.min("root").alias("near"))
        step = labels.join(near, "c").select("c", "root", F.least("root", "near").alias("new"))
        jump = step.alias("s").join(labels.alias("l"), F.col("s.new") == F.col("l.c")).select("s.c", F.col("s.root").alias("was"), F.least("s.new", "l.root").alias("root"))
        after = staged(jump, "labels")
        if after.where("was <> root").isEmpty():
            return after.select("c", "root")
        labels = after.select("c", "root")


def compared(docs: DataFrame, key: str, text: str, threshold: float, k: int, recall: float, bucket: int, pairs: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their class, classes with their members, links as `checked` has them)."""
    rows = staged(described(docs, key, text, k), "sketches")
    first = F.min(F.struct("key", "th"))
    classes = staged(rows.where("c is not null").groupBy("c").agg(first.alias("first"), F.count("*").alias("members"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    met = staged(buckets(classes.select("c", "n", "members", "sketch"), threshold, recall, bucket), "candidates")
    asked = met.select("c").distinct().join(classes.select("c", "first.*"), "c").select("key", "th").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            h, n = shingle_sets(raw(part), k)
            ends = np.concatenate(([0], np.cumsum(n)))
            data = h.tobytes()
            digest = [hashlib.blake2b(data[8 * a:8 * b], digest_size=16).digest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            sets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(digest, pa.binary()), sets], names=["c", "items"])

    texts = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    same = texts["key"].eqNullSafe(asked["key"]) & (texts["th"] == asked["th"])
    sets = texts.join(asked, same, "left_semi").select("text").mapInArrow(run, "c binary, items array<bigint>").dropDuplicates(["c"])
    members = met.join(staged(sets, "sets"), "c")
    return rows.select("key", "th", "c", "n"), classes.select("c", "members"), staged(checked(members, threshold, pairs), "links")


def similar_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, k: int = SHINGLE, recall: float = RECALL, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """The join itself: pairs of classes (a, b, similarity), and the members of the classes (`key`, `class`)."""
    rows, _, links = compared(docs, key, text, threshold, k, recall, bucket, True)
    return links, rows.select(F.col("key").alias(key), F.col("c").alias("class"))


def jaccard_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, k: int = SHINGLE, recall: float = RECALL, bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: `key`, `class_id`, `n_links`, `n_shingles`, `text_hash`, `kept`.

    `class_id` is the smallest key of the documents that links connect; `n_links` counts the other documents whose similarity
    is at least the threshold, copies included. `kept` marks the class's row with the smallest key (of equal keys, the smallest hash of the text; of equal texts
    too, all). Shingles are of five words, A-Z lower-cased; a shorter text is one shingle.
    Null, empty and blank texts have none: no links, and a class of their own. Repeated rows are copies. A null key comes
    first. An empty table gives an empty one; other columns are ignored.
    """
    rows, classes, links = compared(docs, key, text, threshold, k, recall, bucket, False)
    far = links.groupBy("c").agg(F.sum("far").alias("far"))
    roots = components(links.where("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b")))
    facts = classes.join(far, "c", "left").join(roots, "c", "left").select(
        "c", F.coalesce("root", "c").alias("root"), (F.coalesce("far", F.lit(0)) + F.col("members") - 1).alias("n_links")
    )
    held = staged(rows.join(facts, "c", "left"), "facts")
    smallest = held.where("root is not null").groupBy("root").agg(F.min(F.struct("key", "th")).alias("best"))
    alone = F.col("root").isNull()
    return held.join(smallest, "root", "left").select(
        F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("best.key")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.col("n").cast("bigint").alias("n_shingles"),
        F.col("th").alias("text_hash"), (alone | (F.col("best.key").eqNullSafe(F.col("key")) & (F.col("best.th") == F.col("th")))).alias("kept"),
    )
