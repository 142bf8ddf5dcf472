"""Shared helpers: slices of Arrow batches bounded by bytes, and words of many texts as numpy arrays.

A word is a run of `[^\\x20\\x09-\\x0D]`; A-Z are lower-cased. Words carry 64-bit hashes, computed for a whole slice at once.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # text bytes handled at a time in a task; a longer text is a slice of its own

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15 | 1
UNBASE = pow(BASE, -1, 1 << 64)


def once(key: Any, make: Callable[[], Any]) -> Any:
    """What a worker process makes once. Task functions travel by value, so a module's own cache would start anew in each task."""
    kept = vars(sys).setdefault("_toxloom_once", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class Words(NamedTuple):
    buffer: bytes        # the lower-cased texts, one line feed after each
    start: np.ndarray    # of each word in the buffer
    end: np.ndarray
    hash: np.ndarray     # uint64
    first: np.ndarray    # of each text: its first word; one entry more than texts

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    kept = once("powers", dict)
    have = kept.get(base)
    if have is None or len(have) < n:
        out = np.empty(max(n, 1024), np.uint64)
        out[0], done = 1, 1
        while done < len(out):
            step = min(done, len(out) - done)
            out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        if len(out) > 4 * SLICE_BYTES:
            return out[:n]  # of one very long text: not kept
        have = kept[base] = out
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(texts: Sequence[bytes]) -> Words:
    buffer = (b"\n".join(texts) + b"\n").lower()
    a = np.frombuffer(buffer, np.uint8)
    blank = SPACE[a]
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    start, end = edge[0::2], edge[1::2]
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    first = np.searchsorted(start, starts)
    if not len(start):
        return Words(buffer, start, end, np.empty(0, np.uint64), first)
    value = a.astype(np.uint64)
    value[blank] = 0
    value *= powers(BASE, len(a))
    hashes = np.add.reduceat(value, start) * powers(UNBASE, len(a))[start]
    return Words(buffer, start, end, mix(hashes + (end - start).astype(np.uint64)), first)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, hash) of all runs of k words inside one text. A shorter text has one run, all its words."""
    n = len(w.hash)
    h = np.zeros(n, np.uint64)
    ends = np.repeat(w.first[1:], w.counts())
    for j in range(k):
        part = np.zeros(n, np.uint64)
        part[:max(0, n - j)] = w.hash[j:]
        part[np.arange(n) + j >= ends] = 0
        h = h * np.uint64(BASE) + part
    at = np.arange(n)
    begins = np.repeat(w.first[:-1], w.counts())
    keep = (at + k <= ends) | (at == begins)
    return at[keep], mix(h[keep])


def spread(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As `grams` for long runs, in a few passes whatever their length; a shorter text has none."""
    n = len(w.hash)
    if n < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * powers(BASE, n), dtype=np.uint64)])
    at = np.flatnonzero(np.arange(n - k + 1) + k <= np.repeat(w.first[1:], w.counts())[:n - k + 1])
    return at, mix((total[at + k] - total[at]) * powers(UNBASE, n)[at])


def trim() -> None:
    """Give freed memory back to the system: workers live on after a task, and executors have little to spare."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the text of each part stays within the limit."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        bins = np.cumsum(sizes) // limit
        cuts = np.flatnonzero(np.diff(bins)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(lo, hi - lo)
    trim()


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
