"""N-gram language model in an Elias-Fano trie.

Level 1 holds the hashes of all training words, in shards by hash, and the counts of those that occur twice or more, whose
places are their ids. Levels 2 and 3 hold every n-gram that occurs twice or more, in parts by a hash of its first two words:
for each context a run of successor ids, made one monotone sequence by adding the last value of the run before, with
Elias-Fano pointers to the runs, and smoothed log probabilities quantised to 8 bits. Tasks map the levels into memory. A
query looks for the successor of its word relative to its context.

Probabilities are interpolated: an n-gram's count less a discount, and the mass that is left times the shorter context's
probability. Word probabilities are (c + 1) / (N + V + 1). What occurs once stays in the shorter contexts' mass. No threshold
depends on the size of the corpus.

N-grams are counted in blocks: a task deals its distinct pairs of words, each with its distinct third words, to the parts as
packed arrays, and a part merges those of all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxloom.llm.elias_fano import EliasFano, mapped, save
from toxloom.llm.words import Words, mix, once, raw, slices, trim, words
from toxloom.session import staged, work_folder

END = np.uint64(0xE0D0F7E875)  # stands for the end of a text
TWICE = 2         # occurrences from which an n-gram is kept; one of which a part occurs once can't occur twice
DISCOUNT = 0.5
SHARD = 1 << 20   # words of a shard of level 1, about
PART = 1 << 22    # training tokens of a part of levels 2 and 3, about
CHUNK = 1 << 20   # pairs of words that a task holds before it passes their counts on
HELD = 1 << 19    # distinct words that a task counts before it passes them on


class Model(NamedTuple):
    folder: str
    tokens: int             # N
    types: int              # V
    bits: int               # level 1 has 2**bits shards
    shards: list[int]       # those that have words
    base: list[int]         # first id of each of them
    ids: int                # words that have one
    parts: int              # of levels 2 and 3
    filled: list[int]       # those that have n-grams


def sequence(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, each text followed by its end; text of each token)."""
    n = len(w.first) - 1
    return np.insert(w.hash, w.first[1:], END), np.repeat(np.arange(n), w.counts() + 1)


def tallies(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Sums by key of (keys, counts), passed on whenever too many are held."""
    def merged(some):
        keys, inverse = np.unique(np.concatenate([k for k, _ in some]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([c for _, c in some]).astype(float), len(keys)).astype(np.int64)

    def batch(k, c):
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["k", "c"])

    held, size = [], 0
    for keys, counts in parts:
        held.append((keys, counts))
        size += len(keys)
        if size > 2 * HELD:
            held = [merged(held)]
            size = len(held[0][0])
            if size > HELD:
                yield batch(*held[0])
                held, size = [], 0
    if held:
        yield batch(*merged(held))


def chains(ids: np.ndarray, text: np.ndarray, order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places of the last words of runs of `order` words with ids inside a text, ids of the run's words)."""
    n = len(ids)
    at = np.arange(order - 1, n)
    ok = text[at] == text[at - order + 1]
    for j in range(order):
        ok &= ids[at - j] >= 0
    at = at[ok]
    return at, [ids[at - j] for j in range(order - 1, -1, -1)]


def part_of(pair: np.ndarray, parts: int) -> np.ndarray:
    return (mix(pair.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers from 0, byte by byte: leading bytes that are zero everywhere are left out, and other planes compress."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, np.uint64)
        width = -(-int(a.max()).bit_length() // 8) if len(a) else 0
        out += [len(a).to_bytes(8, "little"), bytes([width]), a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return b"".join(out)


def unpack(block: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(block):
        n, width = int.from_bytes(block[at:at + 8], "little"), block[at + 8]
        a = np.zeros((n, 8), np.uint8)
        a[:, :width] = np.frombuffer(block, np.uint8, n * width, at + 9).reshape(width, n).T
        out.append(a.view(np.int64).ravel())
        at += 9 + n * width
    return out


def blocks(held: list[tuple[np.ndarray, np.ndarray]], ids: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """(part, counts) of pairs of words and the ids after them (-1: none).

    Counts are: steps between the distinct pairs in order, occurrences of each, number of distinct third words of each, those
    in order, occurrences of each.
    """
    pair, inverse = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
    third = np.concatenate([t for _, t in held])
    some = third >= 0
    k3, c3 = np.unique(inverse[some] * ids + third[some], return_counts=True)
    c2 = np.bincount(inverse, minlength=len(pair))
    node = k3 // ids
    n3, deal = np.bincount(node, minlength=len(pair)), part_of(pair, parts)
    order, order3 = np.argsort(deal, kind="stable"), np.argsort(deal[node], kind="stable")
    cut, cut3 = (np.concatenate(([0], np.cumsum(np.bincount(x, minlength=parts)))) for x in (deal, deal[node]))
    for p in np.flatnonzero(np.diff(cut)).tolist():
        two, three = order[cut[p]:cut[p + 1]], order3[cut3[p]:cut3[p + 1]]
        yield p, pack(np.diff(pair[two], prepend=0), c2[two], n3[two], k3[three] % ids, c3[three])


def merge(some: Sequence[bytes], ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, their counts, place of each triple's pair, its third word, its count) of what occurs twice or more in all blocks."""
    pairs, c2, n3, third, c3 = ([] for _ in range(5))
    for block in some:
        step, own2, own, w, own3 = unpack(block)
        pairs.append(np.cumsum(step)), c2.append(own2.astype(np.uint32)), n3.append(own.astype(np.uint32))
        third.append(w), c3.append(own3.astype(np.uint32))
    pair, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
    del pairs
    count = np.bincount(inverse, np.concatenate(c2), len(pair)).astype(np.int64)
    kept = count >= TWICE
    node = np.where(kept, np.cumsum(kept) - 1, -1)[inverse]
    del inverse
    node = np.repeat(node, np.concatenate(n3))
    on = np.flatnonzero(node >= 0)
    k3, inverse = np.unique(node[on] * ids + np.concatenate(third)[on], return_inverse=True)
    del node, third
    count3 = np.bincount(inverse, np.concatenate(c3)[on], len(k3)).astype(np.int64)
    k3, count3 = k3[count3 >= TWICE], count3[count3 >= TWICE]
    return pair[kept], count[kept], k3 // ids, k3 % ids, count3


def codebook(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(256 centres, code of each value): equal shares of the values in each code."""
    if not len(values):
        return np.zeros(1, np.float32), np.zeros(0, np.uint8)
    centre = np.unique(np.quantile(values, (np.arange(256) + 0.5) / 256).astype(np.float32))
    return centre, np.searchsorted((centre[1:] + centre[:-1]) / 2, values).astype(np.uint8)


def level(context: np.ndarray, ids: np.ndarray, contexts: int, name: str) -> dict[str, np.ndarray]:
    """Pointers and successor ids of n-grams sorted by (context, id)."""
    pointer = np.searchsorted(context, np.arange(contexts + 1))
    # Each run counts on from the last value of the one before.
    last = np.maximum.accumulate(np.where(np.append(context[1:] != context[:-1], True), np.arange(len(ids)), -1)) if len(ids) else ids
    top = np.zeros(contexts + 1, np.int64)
    full = np.flatnonzero(np.diff(pointer))
    top[1:][full] = ids[pointer[1:][full] - 1]
    base = np.cumsum(top)
    return EliasFano.arrays(pointer, f"{name}.pointer") | EliasFano.arrays(ids + base[context] if len(last) else ids, f"{name}.ids")


class Level:
    """Queries of one level."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.pointer, self.ids = EliasFano(arrays, f"{name}.pointer"), EliasFano(arrays, f"{name}.ids")
        self.code, self.centre = arrays[f"{name}.code"], arrays[f"{name}.centre"]

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of (context, word), -1 where the level has none."""
        out = np.full(len(context), -1)
        lo, hi = self.pointer.at(context).astype(np.int64), self.pointer.at(context + 1).astype(np.int64)
        some = np.flatnonzero(hi > lo)
        if len(some):
            lo, hi = lo[some], hi[some]
            base = np.zeros(len(some), np.uint64)
            later = np.flatnonzero(lo > 0)
            base[later] = self.ids.at(lo[later] - 1)
            at, equal = self.ids.successor(base + word[some].astype(np.uint64), lo, hi)
            out[some[equal]] = at[equal]
        return out

    def value(self, at: np.ndarray) -> np.ndarray:
        return self.centre[self.code[at]]


class WordLevel:
    """Queries of level 1."""

    def __init__(self, model: Model):
        self.m, self.base = model, np.array(model.base, np.int64)
        self.arrays = {s: mapped(model.folder, f"words-{s}") for s in model.shards}
        self.often = {s: EliasFano(a, "often") for s, a in self.arrays.items()}
        self.rare = {s: EliasFano(a, "rare") for s, a in self.arrays.items()}

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, training count) of distinct words."""
        bits, ids, count = self.m.bits, np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        shard = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
        for i, s in enumerate(self.m.shards):
            at = np.flatnonzero(shard == s)
            own = hashes[at] & np.uint64((1 << (64 - bits)) - 1)
            place, equal = self.often[s].successor(own, np.zeros(len(at), np.int64), np.full(len(at), self.often[s].n))
            ids[at[equal]] = place[equal] + self.m.base[i]
            count[at[equal]] = self.arrays[s]["count"][place[equal]]
            at, own = at[~equal], own[~equal]
            place, equal = self.rare[s].successor(own, np.zeros(len(at), np.int64), np.full(len(at), self.rare[s].n))
            count[at[equal]] = 1
        return ids, count

    def by_id(self, ids: np.ndarray, name: str, none: float) -> np.ndarray:
        """A number that level 1 holds for each id: `count`, or the mass `left` to words alone (a file of its own)."""
        out, which = np.full(len(ids), none), np.searchsorted(self.base, ids, "right") - 1
        for i in np.unique(which[ids >= 0]).tolist():
            at = np.flatnonzero((which == i) & (ids >= 0))
            s = self.m.shards[i]
            place = ids[at] - self.m.base[i]
            if name == "count":
                out[at] = self.arrays[s]["count"][place]
            else:
                a = mapped(self.m.folder, f"left-{s}")
                out[at] = a["left.centre"][a["left.code"][place]]
        return out


def words_of(model: Model) -> WordLevel:
    return once(("words", model.folder), lambda: WordLevel(model))


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count, smooth and store a model of order 3 over all rows of `docs`. Null texts count as empty, repeated rows each time."""
    spark = docs.sparkSession
    folder = work_folder(spark, "trie")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    rows = docs.select(F.col(text).alias("text"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from tallies(np.unique(sequence(words(raw(part)))[0], return_counts=True) for part in slices(batches))

    counts = staged(rows.mapInArrow(count_words, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c")), "words")
    size = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, types = int(size["n"] or 0), int(size["v"])

    # Level 1: shards by the leading bits of the hash.
    bits = max(0, (types // SHARD).bit_length())

    def store_words(pdf: pd.DataFrame) -> pd.DataFrame:
        key = pdf["k"].to_numpy(np.int64).view(np.uint64)
        at = np.argsort(key)
        own = key[at] & np.uint64((1 << (64 - bits)) - 1)
        count = pdf["c"].to_numpy(np.int64)[at]
        often = count >= TWICE
        shard = int(pdf["shard"].iat[0])
        kind = np.uint32 if count.max() < 1 << 32 else np.uint64
        save(folder, f"words-{shard}", EliasFano.arrays(own[often], "often") | EliasFano.arrays(own[~often], "rare") | {"count": count[often].astype(kind)})
        return pd.DataFrame({"shard": [shard], "n": [int(often.sum())]})

    shard = F.shiftrightunsigned("k", 64 - bits).cast("int") if bits else F.lit(0)
    # One row for some million words.
    shards = counts.withColumn("shard", shard).groupBy("shard").applyInPandas(store_words, "shard int, n bigint").toPandas().sort_values("shard")
    ends = np.cumsum(shards["n"].to_numpy(np.int64))
    ids = max(1, int(ends[-1]) if len(ends) else 0)
    if ids**2 >= 1 << 63:
        raise ValueError("more than three thousand million words occur twice: two of them don't fit into one key")
    parts = max(1, -(-tokens // PART))
    model = Model(folder, tokens, types, bits, shards["shard"].tolist(), [0, *ends[:-1].tolist()][:len(ends)], ids, parts, [])

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held):
            p, block = zip(*blocks(held, ids, parts))
            return pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(block, pa.binary())], names=["part", "block"])

        held, size = [], 0
        for part in slices(batches):
            token, own = sequence(words(raw(part)))
            distinct, inverse = np.unique(token, return_inverse=True)
            found = words_of(model).find(distinct)[0][inverse]
            at, (u, v) = chains(found, own, 2)
            after = np.minimum(at + 1, len(found) - 1)
            held.append((u * ids + v, np.where((after > at) & (own[after] == own[at]), found[after], -1)))
            size += len(at)
            if size >= CHUNK:
                yield batch(held)
                held, size = [], 0
        if size:
            yield batch(held)

    def store_grams(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iat[0])
        pair, c2, node, w, c3 = merge(pdf["block"].tolist(), ids)
        u, context = np.unique(pair // ids, return_inverse=True)
        # P(v | u) needs the mass that u leaves, to which other parts add: stored is the n-gram's own share, on both levels.
        share = (c2 - DISCOUNT) / words_of(model).by_id(u, "count", 1)[context]
        left = 1 - np.bincount(node, c3 - DISCOUNT, len(pair)) / c2
        arrays = EliasFano.arrays(u, "context") | level(context, pair % ids, len(u), "two") | level(node, w, len(pair), "three")
        for name, x in (("two", share), ("left2", np.maximum(left, 1e-9)), ("three", (c3 - DISCOUNT) / c2[node])):
            arrays[f"{name}.centre"], arrays[f"{name}.code"] = codebook(np.log10(x))
        save(folder, f"grams-{part}", arrays)
        trim()
        return pd.DataFrame({"part": part, "u": u, "used": np.bincount(context, share, len(u))})

    # As many shuffle partitions as parts, so that no task's share grows with the corpus.
    dealt = rows.mapInArrow(count_grams, "part int, block binary").repartition(parts, "part")
    used = staged(dealt.groupBy("part").applyInPandas(store_grams, "part int, u bigint, used double"), "used")
    filled = sorted(r["part"] for r in used.select("part").distinct().collect())  # one for some million tokens

    # The mass that each word leaves to words alone.
    def store_left(pdf: pd.DataFrame) -> pd.DataFrame:
        i = int(pdf["i"].iat[0])
        left = np.ones(int(ends[i]) - model.base[i])
        left[pdf["u"].to_numpy(np.int64) - model.base[i]] -= pdf["used"].to_numpy(float)
        centre, code = codebook(np.log10(np.maximum(left, 1e-9)))
        save(folder, f"left-{model.shards[i]}", {"left.centre": centre, "left.code": code})
        return pd.DataFrame({"i": [i]})

    def with_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = np.searchsorted(np.array(model.base, np.int64), batch.column("u").to_numpy(), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), batch.column("u"), batch.column("used")], names=["i", "u", "used"])

    mass = used.groupBy("u").agg(F.sum("used").alias("used")).mapInArrow(with_shard, "i int, u bigint, used double")
    with_left = mass.groupBy("i").applyInPandas(store_left, "i int").toPandas()["i"].tolist()
    for i in set(range(len(ends))) - set(with_left):  # no word of the shard begins a kept pair
        save(folder, f"left-{model.shards[i]}", {"left.centre": np.zeros(1, np.float32), "left.code": np.zeros(int(ends[i]) - model.base[i], np.uint8)})
    return model._replace(filled=filled)


class Reader:
    """Queries of a stored model."""

    def __init__(self, model: Model):
        self.m, self.words = model, words_of(model)
        self.parts = {p: mapped(model.folder, f"grams-{p}") for p in model.filled}
        self.context = {p: EliasFano(a, "context") for p, a in self.parts.items()}
        self.two = {p: Level(a, "two") for p, a in self.parts.items()}
        self.three = {p: Level(a, "three") for p, a in self.parts.items()}

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, base score, score) of each text."""
        token, text = sequence(words(texts))
        distinct, inverse = np.unique(token, return_inverse=True)
        word, count = self.words.find(distinct)
        alone = np.log10((count + 1) / (self.m.tokens + self.m.types + 1))
        n = len(texts)
        base = np.bincount(text, alone[inverse], n)
        logp = alone[inverse]
        ids = word[inverse]
        # Level 2: the share of the pair, and of the mass that the word before leaves.
        at, (u, v) = chains(ids, text, 2)
        key, back = np.unique(u * self.m.ids + v, return_inverse=True)
        node, p2, part = np.full(len(key), -1), np.zeros(len(key)), part_of(key, self.m.parts)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(self.m.parts + 1))
        for p in self.m.filled:
            own = order[cut[p]:cut[p + 1]]
            if not len(own):
                continue
            context, known = self.context[p].successor((key[own] // self.m.ids).astype(np.uint64), np.zeros(len(own), np.int64), np.full(len(own), self.context[p].n))
            own, context = own[known], context[known]
            node[own] = place = self.two[p].find(context, key[own] % self.m.ids)
            ok = place >= 0
            p2[own[ok]] = self.two[p].value(place[ok])
        left = self.words.by_id(word, "left", 0.0)[inverse]
        after = np.flatnonzero(text[1:] == text[:-1]) + 1
        logp[after] += left[after - 1]
        found = np.flatnonzero(node[back] >= 0)
        logp[at[found]] = np.log10(10 ** logp[at[found]] + 10 ** p2[back[found]])
        # Level 3, below the pair before.
        pair = np.full(len(ids), -1)
        pair[at[found]] = back[found]
        above = np.where(np.append(False, text[1:] == text[:-1]), np.append(-1, pair[:-1]), -1)
        at = np.flatnonzero(above >= 0)
        own_part = part[above[at]]
        order = np.argsort(own_part, kind="stable")
        cut = np.searchsorted(own_part[order], np.arange(self.m.parts + 1))
        for p in self.m.filled:
            here = at[order[cut[p]:cut[p + 1]]]
            if not len(here):
                continue
            context, a = node[above[here]], self.parts[p]
            shorter = a["left2.centre"][a["left2.code"][context]] + logp[here]
            some = np.flatnonzero(ids[here] >= 0)
            k3, back3 = np.unique(context[some] * self.m.ids + ids[here[some]], return_inverse=True)
            place = self.three[p].find(k3 // self.m.ids, k3 % self.m.ids)
            hit = place >= 0
            value = np.zeros(len(k3))
            value[hit] = self.three[p].value(place[hit])
            full = np.flatnonzero(hit[back3])
            shorter[some[full]] = np.log10(10 ** shorter[some[full]] + 10 ** value[back3[full]])
            logp[here] = np.minimum(shorter, 0)
        return np.bincount(text, minlength=n), np.bincount(text, count[inverse] > 0, n).astype(np.int64), base, np.bincount(text, logp, n)


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of each whole text.

    The end of a text is a token, so null and empty texts have one. Repeated rows are answered each, an empty table gives an
    empty one, a model without training texts gives every word the same probability. Other columns are ignored.
    """
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = once(("trie", model.folder), lambda: Reader(model))
        for part in slices(batches, text):
            n, known, base, own = reader.score(raw(part, text))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(n.astype(np.int64)), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(own)],
                names=[*keep, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{schema}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
