"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, a linear classifier.

Voters are words and word beginnings that occur with the label; each fires or stays silent on a text. The label model has a
firing rate of each voter for toxic and for clean texts, fitted by expectation and maximisation over the votes of all texts,
anchored by the labelled ones. Voters that fire together within a class share their weight. The classifier is fitted on the
model's posterior labels and scores whole texts by all lexicon entries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxloom.llm import pieces as P
from toxloom.llm.language_id import distinct_words
from toxloom.llm.words import slices
from toxloom.session import staged

SAMPLE = 20_000   # labelled rows at most that the lexicon and the classifier are fitted on, picked by a hash of the key
LEXICON = 2_000   # entries at most
VOTERS = 60       # of them, at most, that vote: the most informative ones
SUPPORT = 3       # toxic texts of the sample in which an entry occurs at least
LIFT = 4.0        # times that an entry is likelier in toxic than in clean texts at least
STARTS = (4, 5, 6)
ROUNDS = 6
ANCHOR = 1.0      # weight of a labelled text against an unlabelled one


class Model(NamedTuple):
    entries: list[str]      # words, and beginnings with a final *
    weight: np.ndarray      # of log(1 + count), by entry
    total: float            # weight of log(1 + all hits)
    bias: float
    accuracy: np.ndarray    # by voter: P(fires | toxic), P(fires | clean)
    correlation: np.ndarray # of voters within a class


class Lookup:
    """Finds lexicon entries in texts."""

    def __init__(self, entries: Sequence[str]):
        self.entries = list(entries)
        self.by_kind = {}
        for kind in (0, *STARTS):
            own = [(P.code(e.rstrip("*")), i) for i, e in enumerate(entries) if (len(e) - 1 if e.endswith("*") else 0) == kind]
            own.sort()
            self.by_kind[kind] = np.array([k for k, _ in own], np.uint64), np.array([i for _, i in own], np.int64)

    def hits(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, entry, count) of all entries that occur."""
        flat, prefix, start, size, inverse, owner = distinct_words(texts)
        n, found = max(1, len(self.entries)), []
        for kind, (keys, ids) in self.by_kind.items():
            ok = np.arange(len(start)) if not kind else np.flatnonzero(size > kind)
            if not len(keys) or not len(ok):
                continue
            key = P.window(prefix, start[ok], size[ok] if not kind else kind)
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = np.full(len(start), -1)
            hit[ok] = np.where(keys[at] == key, ids[at], -1)
            each = hit[inverse]
            on = np.flatnonzero(each >= 0)
            found.append(owner[on] * n + each[on])
        pair, count = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
        return pair // n, pair % n, count


def candidates(texts: DataFrame) -> DataFrame:
    """(entry, toxic texts, clean texts) of the words and beginnings in labelled texts (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            flat, _, start, size, inverse, owner = distinct_words([t or "" for t in part.column("text").to_pylist()])
            toxic = np.array(part.column("toxic").to_pylist())
            text = flat.astype("<u4").tobytes().decode("utf-32-le", "replace")
            word = [text[a:a + n] for a, n in zip(start, size)]
            for kind in (0, *STARTS):
                names = [w if not kind else w[:kind] + "*" if len(w) > kind else "" for w in word]
                distinct, group = np.unique(np.array(names, object).astype(str) if names else np.empty(0, str), return_inverse=True)
                pair = np.unique(group[inverse] * (part.num_rows + 1) + owner)
                g, doc = pair // (part.num_rows + 1), pair % (part.num_rows + 1)
                t = np.bincount(g, toxic[doc], len(distinct))
                c = np.bincount(g, 1 - toxic[doc], len(distinct))
                yield pa.RecordBatch.from_arrays([pa.array(distinct.tolist(), pa.string()), pa.array(t.astype(np.int64)), pa.array(c.astype(np.int64))], names=["entry", "t", "c"])

    return texts.mapInArrow(run, "entry string, t bigint, c bigint").where("entry <> ''").groupBy("entry").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def logit(p):
    return np.log(p) - np.log1p(-p)


def vote_logits(votes: np.ndarray, rates: np.ndarray, share: np.ndarray, prior: float) -> np.ndarray:
    """Log odds of toxic. Silence of a voter counts as its vote does."""
    on, off = np.log(rates[:, 0] / rates[:, 1]), np.log((1 - rates[:, 0]) / (1 - rates[:, 1]))
    return logit(prior) + (off * share).sum() + votes @ ((on - off) * share)


def unpack(mask: np.ndarray, n: int) -> np.ndarray:
    return ((mask[:, None] >> np.arange(n)) & 1).astype(float)


def label_model(patterns: DataFrame, anchored: np.ndarray, sizes: np.ndarray, voters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(rates, share of each voter, correlations, prior) from vote patterns (mask, n) of all texts.

    `anchored` has the firing counts of labelled texts by voter and class, `sizes` their number. What a round brings to the
    driver are sums by voter and pair of voters.
    """
    rates = (ANCHOR * anchored + 0.5) / (ANCHOR * sizes + 1.0)
    prior = float((sizes[0] + 0.5) / (sizes.sum() + 1.0))
    share, correlation = np.ones(voters), np.eye(voters)
    for _ in range(ROUNDS):
        now = rates, share, prior

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both, mass = np.zeros((2, voters, voters)), np.zeros(2)
            for batch in batches:
                votes = unpack(batch.column("mask").to_numpy(), voters)
                n = batch.column("n").to_numpy().astype(float)
                p = 1 / (1 + np.exp(-np.clip(vote_logits(votes, *now), -500, 500)))
                for k, w in enumerate((n * p, n * (1 - p))):
                    both[k] += (votes * w[:, None]).T @ votes
                    mass[k] += w.sum()
            yield pa.RecordBatch.from_arrays([pa.array([both.ravel().tolist() + mass.tolist()], pa.list_(pa.float64()))], names=["sums"])

        parts = patterns.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").toPandas()["x"].to_numpy()
        if not len(parts):
            break
        both, mass = parts[:-2].reshape(2, voters, voters), parts[-2:]
        fired = np.stack([np.diag(both[0]), np.diag(both[1])], axis=1)
        rates = (fired + ANCHOR * anchored + 0.5) / (mass + ANCHOR * sizes + 1.0)
        prior = float(np.clip((mass[0] + ANCHOR * sizes[0] + 0.5) / (mass.sum() + ANCHOR * sizes.sum() + 1.0), 1e-4, 1 - 1e-4))
        # Correlation within toxic texts, where the voters fire; clean texts hardly have any.
        mean = np.diag(both[0]) / max(mass[0], 1e-9)
        cov = both[0] / max(mass[0], 1e-9) - np.outer(mean, mean)
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        correlation = np.clip(cov / np.outer(sd, sd), -1, 1)
        share = 1 / np.maximum(1.0, np.maximum(correlation, 0).sum(axis=1) - np.diag(correlation) + 1)
    return rates, share, correlation, prior


def fit_linear(row: np.ndarray, entry: np.ndarray, value: np.ndarray, target: np.ndarray, entries: int, steps: int = 600) -> tuple[np.ndarray, float, float]:
    """Logistic regression on soft labels by Adam: weights of entries, of all hits together, and the bias."""
    n = len(target)
    hits = np.log1p(np.bincount(row, np.expm1(value), n))
    w, m, v = np.zeros(entries + 2), np.zeros(entries + 2), np.zeros(entries + 2)
    w[-1] = logit(np.clip(target.mean(), 1e-3, 1 - 1e-3)) if n else -3.0
    for step in range(1, steps + 1 if n else 1):
        z = w[-1] + w[-2] * hits + np.bincount(row, w[entry] * value, n)
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - target
        g = np.concatenate([np.bincount(entry, error[row] * value, entries), [error @ hits, error.sum()]]) / n
        g[:-1] += 1e-5 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-2], float(w[-2]), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit a model. `labels` are the rows that may be learned from; null labels and keys are left out, of repeated keys the larger label counts.

    Voters are fitted on the votes of all of `docs`, without labels. The lexicon and the classifier are fitted on at most
    `sample` labelled rows.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    picked = staged(known.orderBy(F.xxhash64(key), key).limit(sample), "labelled")
    # At most `sample` narrow rows: safe to send to every task.
    texts = staged(docs.select(key, F.col(text).alias("text")).join(F.broadcast(picked), key).select("text", "toxic"), "sample")
    sizes = texts.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    nt, nc = float(sizes["t"]), float(sizes["n"] - sizes["t"])
    lift = (F.col("t") + 0.1) / (nt + 1) / ((F.col("c") + 0.5) / (nc + 1))
    gain = F.col("t") / max(nt, 1.0) * F.log(lift)
    chosen = candidates(texts).where(F.col("t") >= SUPPORT).where(lift >= LIFT).orderBy(gain.desc(), "entry").limit(LEXICON).toPandas()
    entries = chosen["entry"].tolist()
    voters = min(VOTERS, len(entries))
    look = Lookup(entries)
    anchored = chosen[["t", "c"]].to_numpy(float).reshape(-1, 2)[:voters]

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for part in slices(batches):
            row, entry, _ = look.hits([t or "" for t in part.column("text").to_pylist()])
            mask = np.zeros(part.num_rows, np.int64)
            on = entry < voters
            np.bitwise_or.at(mask, row[on], np.left_shift(1, entry[on]))
            for k, n in zip(*(x.tolist() for x in np.unique(mask, return_counts=True))):
                counts[k] = counts.get(k, 0) + n
            if len(counts) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()))], names=["mask", "n"])
                counts.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["mask", "n"])

    patterns = docs.select(F.col(text).alias("text")).mapInArrow(cast, "mask bigint, n bigint").groupBy("mask").agg(F.sum("n").alias("n"))
    rates, share, correlation, prior = label_model(staged(patterns, "patterns"), anchored, np.array([nt, nc]), voters)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            row, entry, count = look.hits([t or "" for t in part.column("text").to_pylist()])
            own = [[] for _ in range(part.num_rows)]
            many = [[] for _ in range(part.num_rows)]
            for r, e, c in zip(row.tolist(), entry.tolist(), count.tolist()):
                own[r].append(e), many[r].append(c)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), pa.array(many, pa.list_(pa.int64())), part.column("toxic")], names=["entry", "n", "toxic"])

    held = texts.mapInArrow(describe, "entry array<int>, n array<bigint>, toxic int").toPandas()  # at most `sample` rows of hits
    row = np.repeat(np.arange(len(held)), held["entry"].map(len).to_numpy(int)) if len(held) else np.empty(0, int)
    entry = np.concatenate([np.empty(0, int), *held["entry"]]).astype(int)
    value = np.log1p(np.concatenate([np.empty(0), *held["n"]]).astype(float))
    votes = np.zeros((len(held), voters))
    on = entry < voters
    votes[row[on], entry[on]] = 1
    # The label is one more voter, and the best one: right but for one case in a thousand.
    odds = vote_logits(votes, rates, share, prior) + np.where(held["toxic"].to_numpy(int) > 0, 1, -1) * np.log(999.0)
    weight, total, bias = fit_linear(row, entry, value, 1 / (1 + np.exp(-np.clip(odds, -500, 500))), len(entries))
    return Model(entries, weight, total, bias, rates, correlation)


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text", threshold: float = 0.7) -> DataFrame:
    """`keep`, `score` and `predicted` of every row.

    Only the text decides. Null and empty texts have the score of a text without hits; repeated rows are answered each; an
    empty table gives an empty one; other columns are ignored.
    """
    look = Lookup(model.entries)
    weight, total, bias = model.weight, model.total, model.bias
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            row, entry, count = look.hits([t or "" for t in part.column(text).to_pylist()])
            hits = np.bincount(row, count, part.num_rows)
            z = bias + total * np.log1p(hits) + np.bincount(row, weight[entry] * np.log1p(count), part.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{schema}, score double, predicted int")
