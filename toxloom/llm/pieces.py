"""A fixed public vocabulary of pieces, looked up for all places of many short strings at once."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import public_tokenizers
import sentencepiece

from toxloom.llm.words import BASE, once, powers

MARK = 0x2581  # the character that stands for a space


class Pieces(NamedTuple):
    text: list[str]         # by piece id
    score: list[float]      # by piece id; merges go from the highest down, of equal scores from left to right
    longest: int            # in code points
    slots: np.ndarray       # an open hash table: keys and ids
    ids: np.ndarray
    step: int               # most probes that a key needs
    shift: int
    single: np.ndarray      # sorted code points that are pieces by themselves


def place(key: np.ndarray, shift: int) -> np.ndarray:
    return ((key * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(shift)).astype(np.int64)


def code(text: str) -> int:
    """The hash of a string: as `windows` has it."""
    out = 0
    for c in text:
        out = (out * BASE + ord(c) + 1) & (2**64 - 1)
    return out


def load(path: str | None = None) -> Pieces:
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    return once(("pieces", path), lambda: _load(path))


def _load(path: str) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text = [model.id_to_piece(i) for i in range(n)]
    real = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    bits = int(np.ceil(np.log2(4 * len(real))))
    shift, size = 64 - bits, 1 << bits
    keys = np.array([code(text[i]) for i in real], np.uint64)
    assert len(np.unique(keys)) == len(keys)
    slots, ids, step = np.zeros(size + 64, np.uint64), np.full(size + 64, -1, np.int32), 0
    for i, k, at in zip(real, keys, place(keys, shift)):
        probe = 0
        while ids[at + probe] >= 0:
            probe += 1
        slots[at + probe], ids[at + probe], step = k, i, max(step, probe + 1)
    single = np.array(sorted(ord(text[i]) for i in real if len(text[i]) == 1), np.uint32)
    score = [model.get_score(i) for i in range(n)]
    return Pieces(text, score, max(len(text[i]) for i in real), slots, ids, step, shift, single)


def find(p: Pieces, keys: np.ndarray) -> np.ndarray:
    """Piece ids of hashes, -1 where no piece has it."""
    at = place(keys, p.shift)
    out = p.ids[at]
    todo = np.flatnonzero((p.slots[at] != keys) & (out >= 0))  # another key's slot: look on
    for probe in range(1, p.step + 1):
        if not len(todo):
            break
        there = at[todo] + probe
        out[todo] = p.ids[there]
        todo = todo[(p.slots[there] != keys[todo]) & (p.ids[there] >= 0)]
    out[todo] = -1
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def hashes(flat: np.ndarray) -> np.ndarray:
    """Hash of each prefix of one long row of code points; windows of it follow by `window`. One entry more than characters."""
    # prefix[i] = sum of (c + 1) * BASE**(-j): a window's hash is a difference, scaled.
    back = powers(pow(BASE, -1, 1 << 64), len(flat) + 1)
    out = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * back[:len(flat)], out=out[1:])
    return out


def window(prefix: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of `size` characters at `start`, equal to `code` of them."""
    end = start + size
    return (prefix[end] - prefix[start]) * powers(BASE, len(prefix))[end - 1]


def unique_rows(flat: np.ndarray, start: np.ndarray, size: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first of each distinct string, for each string the place among the distinct), by hash and length."""
    end = start + size
    key = (prefix[end] - prefix[start]) * powers(BASE, len(prefix))[end - 1] + size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    _, index, inverse = np.unique(key, return_index=True, return_inverse=True)
    return index, inverse
