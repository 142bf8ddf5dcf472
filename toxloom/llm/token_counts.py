"""Exact token counts at every prefix of a text, by dynamic programming over a fixed BPE vocabulary.

The last token of a prefix's encoding is the one token that ends there and stays apart from the last token of the prefix
before it. So a table of last tokens, filled from left to right, gives the exact count at every prefix: how many tokens the
text has, where to cut it for a budget, and what any cut would cost, without encoding again.

The text falls into segments that no merge crosses: before a run of spaces, and around characters outside the vocabulary,
which become bytes. Distinct segments of a slice are solved together, one array step for each character and piece length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from toxloom.llm import pieces as P
from toxloom.llm.words import once, slices

WIDE = 48        # longer segments are solved one by one
SLICE = 2 << 20  # bytes of text solved at a time
CELLS = 1 << 20  # cells of a table of segments at a time


class Merges:
    """Which neighbouring pieces a BPE encoding leaves apart."""

    def __init__(self, path: str | None):
        self.pieces = p = P.load(path)
        real = p.ids[p.ids >= 0]
        # Single characters come before all merges.
        self.rank = {int(i): -float("inf") if len(p.text[i]) == 1 else -p.score[i] for i in real}
        self.of = {p.text[i]: int(i) for i in real}
        self.split: dict[int, tuple[int, int]] = {}
        self.reached = np.zeros(len(p.text), bool)
        for i in self.rank:
            self._learn(i)
        self.apart: dict[int, bool] = {}

    def _learn(self, i: int) -> None:
        """The last merge that makes piece i, if BPE makes it at all."""
        parts = [self.of.get(c) for c in self.pieces.text[i]]
        if None in parts:
            return
        pair = None
        while len(parts) > 1:
            ranked = [
                (self.rank[m], j, m) for j in range(len(parts) - 1)
                if (m := self.of.get(self.pieces.text[parts[j]] + self.pieces.text[parts[j + 1]])) is not None
            ]
            if not ranked:
                return
            _, j, m = min(ranked)
            pair = parts[j], parts[j + 1]
            parts[j:j + 2] = [m]
        if parts == [i]:
            self.reached[i] = True
            if pair:
                self.split[i] = pair

    def stays(self, a: int, b: int) -> bool:
        """Whether the encoding of piece a followed by piece b is those two.

        Merges are undone from the highest rank down; the pair meets at a border where some merge would have come first, or never.
        """
        rank, text = self.rank, self.pieces.text
        limit = (float("inf"), 0)  # merges at the border must not come before this one: (rank, 1 if it lies to the right)
        left, right = a, b
        while True:
            m = self.of.get(text[left] + text[right])
            if m is not None and (rank[m], 0.5) < limit:
                return False
            # Undo the later of the two sides' last merges; of equal merges the right one is later.
            if left in self.split and (right not in self.split or rank[left] > rank[right]):
                limit, left = (rank[left], 0), self.split[left][1]
            elif right in self.split:
                limit, right = (rank[right], 1), self.split[right][0]
            else:
                return True

    def keeps(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`stays` of many pairs; a of -1 is the segment's start."""
        key = a.astype(np.int64) * (1 << 32) + b
        distinct, inverse = np.unique(key, return_inverse=True)
        known = self.apart
        if len(known) > 500_000:
            known.clear()
        out = np.empty(len(distinct), bool)
        for i, k in enumerate(distinct.tolist()):
            have = known.get(k)
            if have is None:
                have = known[k] = k < 0 or self.stays(k >> 32, k & 0xFFFFFFFF)
            out[i] = have
        return out[inverse]


def merges(path: str | None = None) -> Merges:
    return once(("merges", path), lambda: Merges(path))


def segment_counts(m: Merges, flat: np.ndarray, start: np.ndarray, size: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Counts at every prefix of each segment, laid out as the segments one after the other. All characters are pieces."""
    p = m.pieces
    first = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(first[-1], np.int32)
    order = np.argsort(size, kind="stable")
    lo = 0
    while lo < len(order):
        widest = int(size[order[min(len(order) - 1, lo + CELLS // 8)]])
        hi = lo + max(1, min(CELLS // max(widest, 1), len(order) - lo)) if widest <= WIDE else lo + 1
        rows = order[lo:hi]
        lo = hi
        n = int(size[rows[-1]])
        if n > WIDE:
            out[first[rows[0]]:first[rows[0]] + n] = one_segment(m, "".join(map(chr, flat[start[rows[0]]:start[rows[0]] + n])))
            continue
        s, z = start[rows], size[rows]
        last = np.full((n + 1, len(rows)), -1, np.int32)
        count = np.zeros((n + 1, len(rows)), np.int32)
        for i in range(1, n + 1):
            here = int(np.searchsorted(z, i))  # rows are sorted by size: those from here on reach character i
            todo = np.arange(here, len(rows))
            for t in range(min(i, p.longest), 0, -1):
                if not len(todo):
                    break
                piece = P.find(p, P.window(prefix, s[todo] + i - t, t))
                ok = np.flatnonzero((piece >= 0) & m.reached[piece])
                if not len(ok):
                    continue
                cols, piece = todo[ok], piece[ok]
                kept = m.keeps(last[i - t, cols], piece)
                cols = cols[kept]
                last[i, cols] = piece[kept]
                count[i, cols] = count[i - t, cols] + 1
                rest = np.ones(len(todo), bool)
                rest[ok[kept]] = False
                todo = todo[rest]
        at = first[rows]
        for i in range(1, n + 1):
            here = int(np.searchsorted(z, i))
            out[at[here:] + i - 1] = count[i, here:]
    return out


def one_segment(m: Merges, text: str) -> list[int]:
    """The same for one long segment."""
    last, count = [-1], [0]
    for i in range(1, len(text) + 1):
        for t in range(min(i, m.pieces.longest), 0, -1):
            piece = m.of.get(text[i - t:i])
            if piece is not None and m.reached[piece]:
                before = last[i - t]
                if before < 0 and i > t:
                    continue
                if before < 0 or m.stays(before, piece):
                    last.append(piece)
                    count.append(count[i - t] + 1)
                    break
        else:
            raise AssertionError("a character without a piece")
    return count[1:]


def prefix_counts(m: Merges, texts: Sequence[str]) -> list[np.ndarray]:
    """For each text the token count of each prefix of one character or more."""
    sizes = np.array([len(t) + 1 if t else 0 for t in texts])
    flat = P.code_points("".join(" " + t for t in texts if t)).copy()
    if not len(flat):
        return [np.empty(0, np.int64) for _ in texts]
    flat[flat == 0x20] = P.MARK
    begin = np.concatenate(([0], np.cumsum(sizes)))
    bytes_of = 1 + (flat > 0x7F) + (flat > 0x7FF) + (flat > 0xFFFF)
    outside = ~np.isin(flat, m.pieces.single)
    mark = flat == P.MARK
    cut = outside.copy()
    cut[1:] |= outside[:-1] | (mark[1:] & ~mark[:-1])
    cut[begin[:-1][sizes > 0]] = True
    start = np.flatnonzero(cut)
    size = np.diff(start, append=len(flat))
    prefix = P.hashes(flat)
    # Counts inside each segment, of distinct segments only once.
    inside = np.where(outside, bytes_of, 0).astype(np.int64)
    real = np.flatnonzero(~outside[start])
    index, inverse = P.unique_rows(flat, start[real], size[real], prefix)
    if len(real):
        s, z = start[real[index]], size[real[index]]
        solved = segment_counts(m, flat, s, z, prefix)
        first = np.concatenate(([0], np.cumsum(z)))[:-1]
        z = size[real]
        local = np.arange(z.sum()) - np.repeat(np.cumsum(z) - z, z)
        inside[np.repeat(start[real], z) + local] = solved[np.repeat(first[inverse], z) + local]
    # Plus the whole segments before.
    total = inside[start + size - 1]
    before = np.cumsum(total) - total
    run = inside + np.repeat(before, size)
    out = []
    for lo, n in zip(begin[:-1], sizes):
        base = run[lo - 1] if lo else 0
        out.append(run[lo + 1:lo + n] - base if n else np.empty(0, np.int64))
    return out


def token_prefixes(docs: DataFrame, keys: Sequence[str], path: str | None = None, text: str = "text") -> DataFrame:
    """`keys` and `counts`, the token count at every prefix (by characters, from one on). Null and empty texts have an empty array."""
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys) + ", counts array<bigint>"

    def run(batches):
        m = merges(path)
        for part in slices(batches, text, SLICE):
            texts = [t or "" for t in part.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(k) for k in keys), pa.array(prefix_counts(m, texts), pa.list_(pa.int64()))], names=[*keys, "counts"]
            )

    return docs.select(*keys, text).mapInArrow(run, schema)


def token_counts(docs: DataFrame, limit: int, keys: Sequence[str] = ("doc_id",), path: str | None = None, text: str = "text") -> DataFrame:
    """Token count of each whole text and what a limit means for it: `n_bytes`, `n_tokens`, `over_limit`, `cut_chars`.

    Args:
        docs: a row per document. Rows are answered one by one: repeated rows and keys stay, a null text counts as empty
            (0 tokens), an empty table gives an empty one, and other columns are ignored.
        limit: the budget; `cut_chars` is the longest prefix, in characters, that has no more tokens.
        path: a sentencepiece BPE model with byte fallback; the public 32k one by default.
    """
    if len({*keys, text}) < len(keys) + 1:
        raise ValueError("the text column can't be a key")
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        m = merges(path)
        for part in slices(batches, text, SLICE):
            texts = [t or "" for t in part.column(text).to_pylist()]
            counts = prefix_counts(m, texts)
            n = np.array([int(c[-1]) if len(c) else 0 for c in counts], np.int64)
            # A count may fall where a longer piece completes: the cut is the last prefix within the limit.
            cut = [len(c) if c_n <= limit else int(np.flatnonzero(c <= limit)[-1:].sum() + bool((c <= limit).any())) for c, c_n in zip(counts, n)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(k) for k in keys), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n),
                    pa.array(n > limit), pa.array(cut, pa.int64()),
                ],
                names=[*keys, "n_bytes", "n_tokens", "over_limit", "cut_chars"],
            )

    return docs.select(*keys, text).mapInArrow(run, f"{schema}, n_bytes bigint, n_tokens bigint, over_limit boolean, cut_chars bigint")
