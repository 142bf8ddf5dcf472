"""Language ID by unigram pieces, with all segmentations of a word summed.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over all
ways to cut it into pieces, by the forward algorithm; that of a text is the product over its words. Piece probabilities are
expected counts over the training texts (forward and backward), summed over all tasks.

Training reads the texts once: it counts their distinct words by language, and the rounds run over those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxloom.llm import pieces as P
from toxloom.llm.words import once, slices
from toxloom.session import staged

LONG = 24         # words with more letters are summed one by one, in logarithms; shorter ones many at a time
ROUNDS = 2        # of expectation and maximisation, each over all words of the training texts
AHEAD = 4096      # letters of a long word that are looked up at a time
CELLS = 1 << 16
SMOOTH = 0.1      # added to each piece's expected count
UNKNOWN = 0       # the piece that stands for any character outside the vocabulary
LANGUAGES = 1000  # a table of piece probabilities has so many rows at most


def letters() -> np.ndarray:
    """For each code point the lower-cased letter, or 0 where it is none."""
    def make() -> np.ndarray:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        return out

    return once("letters", make)


def distinct_words(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, prefix hashes, start and size of distinct words, for each word its distinct one, for each word its text).

    A word is a run of letters, lower-cased, behind the mark of a space.
    """
    flat = np.concatenate([P.code_points(t + " ") for t in texts] or [np.empty(0, np.uint32)])
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    flat = letters()[np.minimum(flat, 0x10FFFF)]
    inside = flat > 0
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    prefix = P.hashes(flat)
    if not len(start):
        none = np.empty(0, np.int64)
        return flat, prefix, none, none, none, none
    index, inverse = P.unique_rows(flat, start, end - start, prefix)
    return flat, prefix, start[index], (end - start)[index], inverse, np.searchsorted(begin, start, "right") - 1


def lattice(flat: np.ndarray, prefix: np.ndarray, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, int, list]]:
    """Blocks of words of equal length up to LONG: (their places, length, [(from, to, which words, pieces)])."""
    p = P.load()
    order = np.argsort(size, kind="stable")
    order = order[:np.searchsorted(size[order], LONG, "right")]
    borders = np.flatnonzero(np.diff(size[order], prepend=-1, append=-1))
    for lo, hi in zip(borders[:-1], borders[1:]):
        n = int(size[order[lo]])
        step = max(1, CELLS // (n + 1))
        for a in range(lo, hi, step):
            rows = order[a:min(a + step, hi)]
            s, arcs = start[rows], []
            for i in range(1, n + 1):
                single = None
                for t in range(1, min(i, p.longest) + 1):
                    found = P.find(p, P.window(prefix, s + i - t, t))
                    if t == 1:
                        single = np.where(found < 0, UNKNOWN, found)
                        arcs.append((i - 1, i, None, single))
                    else:
                        at = np.flatnonzero(found >= 0)
                        if len(at):
                            arcs.append((i - t, i, at, found[at]))
            yield rows, n, arcs


def forward(n: int, width: int, arcs: list, prob: np.ndarray) -> np.ndarray:
    """Sums over the segmentations of each prefix; prob has a column per language, or is one column."""
    alpha = np.zeros((n + 1, width, *prob.shape[1:]))
    alpha[0] = 1.0
    for a, b, at, piece in arcs:
        if at is None:
            alpha[b] += alpha[a] * prob[piece]
        else:
            alpha[b, at] += alpha[a, at] * prob[piece]
    return alpha


def expected(n: int, width: int, arcs: list, prob: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
    """Add the expected piece counts of words with these weights."""
    alpha = forward(n, width, arcs, prob)
    beta = np.zeros((n + 1, width))
    beta[n] = weight / alpha[n]
    for a, b, at, piece in reversed(arcs):
        if at is None:
            gain = beta[b] * prob[piece]
            beta[a] += gain
            np.add.at(out, piece, alpha[a] * gain)
        else:
            gain = beta[b, at] * prob[piece]
            beta[a, at] += gain
            np.add.at(out, piece, alpha[a, at] * gain)


def endings(prefix: np.ndarray, start: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of a long word, chunk by chunk: (letters before, pieces that end at each letter by their length less one, -1 for none)."""
    p = P.load()
    for lo in range(0, size, AHEAD):
        at = np.arange(lo, min(lo + AHEAD, size))
        out = np.full((len(at), p.longest), -1, np.int64)
        for t in range(1, p.longest + 1):
            fits = at[at + 1 >= t]
            out[len(at) - len(fits):, t - 1] = P.find(p, P.window(prefix, start + fits + 1 - t, t))
        out[out[:, 0] < 0, 0] = UNKNOWN
        yield lo, out


def log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


def long_forward(prefix: np.ndarray, start: int, size: int, log_prob: np.ndarray) -> np.ndarray:
    """Logarithms of the sums over all segmentations of a word of any length, by language. Holds what the longest piece reaches back to."""
    back = np.full((P.load().longest, log_prob.shape[1]), -np.inf)  # sums of the prefixes before, the nearest first
    back[0] = 0.0
    for _, pieces in endings(prefix, start, size):
        for row in pieces:
            ok = np.flatnonzero(row >= 0)
            new = log_sum(back[ok] + log_prob[row[ok]])
            back[1:] = back[:-1]
            back[0] = new
    return back[0]


def long_expected(prefix: np.ndarray, start: int, size: int, log_prob: np.ndarray, weight: float, out: np.ndarray) -> None:
    """Add the expected piece counts of one long word. Holds two numbers for each of its letters."""
    ahead, behind = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
    ahead[0] = behind[size] = 0.0
    for lo, pieces in endings(prefix, start, size):
        for i, row in enumerate(pieces, lo + 1):
            ok = np.flatnonzero(row >= 0)
            ahead[i] = log_sum(ahead[i - 1 - ok] + log_prob[row[ok]])
    for lo, pieces in reversed([(lo, x.astype(np.int32)) for lo, x in endings(prefix, start, size)]):
        for i in range(lo + len(pieces), lo, -1):
            row = pieces[i - lo - 1]
            ok = np.flatnonzero(row >= 0)
            before = i - 1 - ok
            behind[before] = np.logaddexp(behind[before], behind[i] + log_prob[row[ok]])
            np.add.at(out, row[ok], weight * np.exp(ahead[before] + log_prob[row[ok]] + behind[i] - ahead[size]))


def start_probabilities() -> np.ndarray:
    """Where training starts, the same for all languages: pieces of a length share evenly, and longer ones win over their parts."""
    p = P.load()
    size = np.array([max(1, len(t)) for t in p.text])
    out = np.zeros(len(size))
    for n in np.unique(size):
        out[size == n] = 2.0 ** -n / (size == n).sum()
    return out / out.sum()


def train(docs: DataFrame, text: str = "text", lang: str = "lang", rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, probability of each piece and language). Rows with a null text or language take no part.

    What comes to the driver are the sums by language and piece: their size is set by the vocabulary and the languages, of which
    more than LANGUAGES are an error.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            langs = part.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            flat, _, start, size, inverse, owner = distinct_words(part.column("text").to_pylist())
            key, n = np.unique(inverse * len(names) + number[owner], return_counts=True)
            whole, word = flat.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), key // len(names)
            texts = [whole[a:b] for a, b in zip(start[word].tolist(), (start + size)[word].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array([names[k] for k in key % len(names)], pa.string()), pa.array(n, pa.int64())], names=["word", "lang", "n"]
            )

    counted = rows.mapInArrow(count, "word string, lang string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    words = staged(counted, "words")
    if words.select("lang").distinct().limit(LANGUAGES + 1).count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    pieces = len(P.load().text)
    probability: dict[str, np.ndarray] = {}
    for _ in range(rounds):
        known = dict(probability)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[str, np.ndarray] = {}
            for part in slices(batches, "word"):
                add_expected(part.column("word").to_pylist(), part.column("lang").to_pylist(), part.column("n").to_numpy(), known, sums)
            for name, x in sums.items():
                at = np.flatnonzero(x > 0)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at, pa.int32()), pa.array(x[at])], names=["lang", "piece", "n"])

        got = words.mapInArrow(run, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        probability = {}
        for name, own in got.groupby("lang"):
            count_of = np.full(pieces, SMOOTH)
            count_of[own["piece"].to_numpy()] += own["n"].to_numpy()
            probability[name] = count_of / count_of.sum()
    names = sorted(probability)
    return names, np.stack([probability[x] for x in names], axis=1) if names else np.empty((pieces, 0))


def add_expected(words: Sequence[str], langs: Sequence[str], n: np.ndarray, known: dict[str, np.ndarray], sums: dict[str, np.ndarray]) -> None:
    """Add the expected piece counts of words of a language that occur n times, by language."""
    begin = start_probabilities()
    names = sorted(set(langs))
    number = np.array([names.index(x) for x in langs], int)
    flat, prefix, start, size, inverse, owner = distinct_words(words)
    count = np.zeros((len(start), len(names)))
    np.add.at(count, (inverse, number[owner]), np.asarray(n, float)[owner])
    for name in names:
        sums.setdefault(name, np.zeros(len(begin)))
    for block, length, arcs in lattice(flat, prefix, start, size):
        for k, name in enumerate(names):
            weight = count[block, k]
            at = np.flatnonzero(weight)
            if not len(at):
                continue
            if len(at) == len(block):
                own = arcs
            else:
                new = np.full(len(block), -1)
                new[at] = np.arange(len(at))
                own = []
                for a, b, w, piece in arcs:
                    if w is None:
                        own.append((a, b, None, piece[at]))
                    elif len(keep := np.flatnonzero(new[w] >= 0)):
                        own.append((a, b, new[w[keep]], piece[keep]))
            expected(length, len(at), own, known.get(name, begin), weight[at], sums[name])
    for w in np.flatnonzero(size > LONG):
        for k in np.flatnonzero(count[w]):
            long_expected(prefix, int(start[w]), int(size[w]), np.log(known.get(names[k], begin)), count[w, k], sums[names[k]])


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep`, `lang_pred` and `score`, its probability among the learned languages.

    `und` with score 0: a null text, one without letters, or a model without languages. Only the text decides; repeated rows
    are answered each, an empty table gives an empty one, and of equal probabilities the first language in order of
    names wins.
    """
    names, probability = model
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(probability.astype(np.float64))  # pieces by languages, at most LANGUAGES
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prob = shared.value
        for part in slices(batches, text):
            texts = [t or "" for t in part.column(text).to_pylist()]
            flat, prefix, start, size, inverse, owner = distinct_words(texts)
            total = np.zeros((len(texts), len(names)))
            found = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
            if len(start) and names:
                word = np.zeros((len(start), len(names)))
                for block, n, arcs in lattice(flat, prefix, start, size):
                    word[block] = np.log(forward(n, len(block), arcs, prob)[n])
                if (size > LONG).any():
                    log_prob = np.log(prob)
                    for w in np.flatnonzero(size > LONG):
                        word[w] = long_forward(prefix, int(start[w]), int(size[w]), log_prob)
                for k in range(len(names)):
                    total[:, k] = np.bincount(owner, word[inverse, k], len(texts))
            known = (found > 0) & bool(names)
            best = total.argmax(axis=1) if names else np.zeros(len(texts), int)
            score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1) if names else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array([names[b] if k else "und" for b, k in zip(best, known)], pa.string()), pa.array(np.where(known, score, 0.0))],
                names=[*keep, "lang_pred", "score"],
            )

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out(key: str, parts: int, part: int):
    """Rows that training may not see: by the checksum of the key as text. A null key belongs to no part."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))
