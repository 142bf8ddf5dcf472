"""Elias-Fano sequences over numpy arrays, and files of arrays that tasks map into memory."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs

from toxloom.llm.words import once

ALIGN = 64


def packed(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of `bits` bits, one after the other, in 64-bit words (and one to spare)."""
    n = len(values)
    out = np.zeros(n * bits // 64 + 2, np.uint64)
    if bits and n:
        at = np.arange(n, dtype=np.int64) * bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        np.bitwise_or.at(out, word, values << shift)
        over = np.flatnonzero((at & 63) + bits > 64)
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out


def unpacked(words: np.ndarray, bits: int, index: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(index), np.uint64)
    at = index * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    value = words[word] >> shift
    over = np.flatnonzero((at & 63) + bits > 64)
    value[over] |= words[word[over] + 1] << (np.uint64(64) - shift[over])
    return value & np.uint64((1 << bits) - 1)


def in_word() -> tuple[np.ndarray, np.ndarray]:
    """(ones of each byte, place of the k-th one of each byte)."""
    def make():
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        place = np.zeros((256, 8), np.int64)
        for b in range(256):
            on = np.flatnonzero(bits[b])
            place[b, :len(on)] = on
        return bits.sum(axis=1), place

    return once("in_word", make)


class EliasFano:
    """A sorted sequence of 64-bit numbers: low bits packed, high parts in unary, a running count of ones per word."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, self.high, self.ones = (arrays[f"{name}.{x}"] for x in ("low", "high", "ones"))
        self.n, self.bits = (int(x) for x in arrays[f"{name}.shape"])
        self.zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones

    @staticmethod
    def arrays(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        bits = max(0, (most // max(n, 1)).bit_length() - 1) if n else 0
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(at[-1]) if n else 0) // 64 + 2, np.uint64)
        np.bitwise_or.at(high, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        ones = np.cumsum(in_word()[0][high.view(np.uint8)].reshape(-1, 8).sum(axis=1))
        return {
            f"{name}.low": packed(values & np.uint64((1 << bits) - 1), bits), f"{name}.high": high,
            f"{name}.ones": np.concatenate(([0], ones[:-1])).astype(np.int64), f"{name}.shape": np.array([n, bits], np.int64),
        }

    def _select(self, index: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Places of the ones (or zeros) with these numbers."""
        word = np.searchsorted(before, index, "right") - 1
        rest = index - before[word]
        bits = self.high[word]
        if flip:
            bits = ~bits
        byte = bits.view(np.uint8).reshape(-1, 8)
        count, place = in_word()
        upto = np.cumsum(count[byte], axis=1)
        which = (upto <= rest[:, None]).sum(axis=1)
        which = np.minimum(which, 7)
        row = np.arange(len(index))
        rest = rest - np.where(which > 0, upto[row, np.maximum(which - 1, 0)], 0)
        return word * 64 + which * 8 + place[byte[row, which], np.minimum(rest, 7)]

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at these places."""
        high = (self._select(index, self.ones, False) - index).astype(np.uint64)
        return (high << np.uint64(self.bits)) | unpacked(self.low, self.bits, index)

    def _below(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part."""
        most = (int(self.at(np.array([self.n - 1]))[0]) >> self.bits) if self.n else 0
        out = np.full(len(high), self.n)
        out[high == 0] = 0
        mid = np.flatnonzero((high > 0) & (high <= most))
        out[mid] = self._select(high[mid] - 1, self.zeros, True) + 1 - high[mid]
        return out

    def successor(self, target: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value >= target within [lo, hi), whether it equals the target); hi where there is none."""
        high = (target >> np.uint64(self.bits)).astype(np.int64)
        low = target & np.uint64((1 << self.bits) - 1)
        begin, end = self._below(high), self._below(high + 1)
        a, b = np.clip(begin, lo, hi), np.clip(end, lo, hi)
        todo = np.flatnonzero(a < b)
        while len(todo):
            mid = (a[todo] + b[todo]) >> 1
            less = unpacked(self.low, self.bits, mid) < low[todo]
            a[todo], b[todo] = np.where(less, mid + 1, a[todo]), np.where(less, b[todo], mid)
            todo = todo[a[todo] < b[todo]]
        inside = np.flatnonzero((a < hi) & (a >= begin) & (a < end))
        equal = np.zeros(len(target), bool)
        equal[inside] = unpacked(self.low, self.bits, a[inside]) == low[inside]
        return a, equal


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays as one file of a folder that all executors reach. Complete or absent: a task that runs again replaces it."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = [at, str(a.dtype), len(a)]
        at += -(-a.nbytes // ALIGN) * ALIGN
    text = json.dumps(head).encode()
    text = len(text).to_bytes(8, "little") + text
    text += b" " * (-len(text) % ALIGN)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        f.write(text)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).tobytes())
            f.write(b"\0" * (-a.nbytes % ALIGN))
    system.move(part, f"{path}/{name}")


def mapped(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped into memory. From a store that isn't mounted, a worker fetches the file once."""
    def make() -> dict[str, np.ndarray]:
        system, path = fs.FileSystem.from_uri(folder)
        place = f"{path}/{name}"
        if not isinstance(system, fs.LocalFileSystem):
            own = tempfile.NamedTemporaryFile(delete=False)
            fs.copy_files(place, own.name, source_filesystem=system)
            place = own.name
        data = np.memmap(place, np.uint8, "r")
        if not isinstance(system, fs.LocalFileSystem):
            os.unlink(place)  # the mapping holds it
        size = int.from_bytes(data[:8].tobytes(), "little")
        head = json.loads(data[8:8 + size].tobytes())
        begin = -(-(8 + size) // ALIGN) * ALIGN
        return {k: data[begin + at:begin + at + n * np.dtype(kind).itemsize].view(kind) for k, (at, kind, n) in head.items()}

    return once(("mapped", folder, name), make)
