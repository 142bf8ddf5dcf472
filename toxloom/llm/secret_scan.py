"""Secret scans: patterns that always count, and a character network over every other candidate.

A candidate is a run of characters that secrets are written in, long enough and with a digit. A small convolutional network reads
it with the text around it, whole, however long it is: characters become vectors, a convolution over neighbouring ones gives features, the
largest of each feature over the run decides. It is trained on all labelled findings, which the patterns give: candidates inside a match
are secrets, the others are not. Each example is shown a second time without the words before the run, so that the form of a value counts as well as
its name. Findings are dealt over shards; in every round each shard trains on from the same numbers, and the mean of the shards is where the next round begins.
Scores are calibrated on all findings held back, and each kind's threshold is the highest that keeps the required recall.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxloom.llm.words import slices
from toxloom.session import staged

# The patterns of the base kinds, and the least length of what they must match.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE = tuple(LEAST)

KINDS = ("mixed", "digits", "lower", "upper")  # of candidates, by the characters they hold; each has a threshold
RUN = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")  # a name and its = sign stay outside
AROUND = 24         # characters of context on each side
SHARD = 20_000      # labelled findings of each label that a task trains on, about; more findings make more shards
BINS = 1024         # of scores that are counted at a time
RECALL = 0.99
WIDTH, DEPTH, FEATURES = 5, 12, 24
PIECE = 4096        # characters of a candidate that are read at a time
ROUNDS, BATCH, RATE = 12, 128, 0.02
SCHEMA = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
_FOUND = {"assign": re.compile(ASSIGN), "access": re.compile(ACCESS), "hex": re.compile(HEX)}
_LONG_HEX = re.compile(rf"[0-9a-f]{{{LEAST['hex']},}}")


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, in order; leftmost and non-overlapping within a kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in _FOUND["assign"].finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _FOUND["access"].finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # A run of hex digits lies inside a run of candidate characters, and is maximal in both.
    for r in RUN.finditer(text):
        if r.end() - r.start() >= LEAST["hex"]:
            out += [(*m.span(), "hex") for m in _LONG_HEX.finditer(text, r.start(), r.end())]
    return sorted(out, key=lambda f: (f[0], BASE.index(f[2]), f[1]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that the network reads."""
    return [m.span() for m in RUN.finditer(text) if any(c in "0123456789" for c in m.group())]


def kind_of(run: str) -> str:
    lower, upper = any("a" <= c <= "z" for c in run), any("A" <= c <= "Z" for c in run)
    return "mixed" if lower and upper else "lower" if lower else "upper" if upper else "digits"


def covered(spans: Sequence[tuple[int, int]], by: Sequence[tuple[int, int, str]]) -> list[bool]:
    """Which spans a finding overlaps. Both come in order of their starts."""
    out, i, reach = [], 0, -1
    for start, end in spans:
        while i < len(by) and by[i][0] < end:
            reach, i = max(reach, by[i][1]), i + 1
        out.append(reach > start)
    return out


# The network --------------------------------------------------------------------------------------------------------

def codes(text: str) -> np.ndarray:
    """Characters as numbers below 128: ASCII as it is, letters beyond as one, other characters as another."""
    flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = flat.copy()
    for i in np.flatnonzero(flat > 126):
        out[i] = 1 if chr(flat[i]).isalpha() else 2
    return out.astype(np.int16)


INSIDE = 128  # added to the codes of the run itself, so that it differs from its surroundings


class Network(NamedTuple):
    letter: np.ndarray  # 2 * 128 codes by DEPTH
    turn: np.ndarray    # WIDTH * DEPTH by FEATURES
    shift: np.ndarray
    out: np.ndarray     # FEATURES
    bias: float
    slope: float        # calibration of the raw score
    offset: float
    least: dict[str, float]  # threshold of each kind


def reading(text: str, start: int, end: int, blank: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes before, in and after a run. Blanked ones lose the words before."""
    before = codes(text[max(0, start - AROUND):start])
    return np.full_like(before, 32) if blank else before, codes(text[start:end]) + INSIDE, codes(text[end:end + AROUND])


def pooled(net: Network, parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The largest value of each feature. Long runs are read piece by piece, neighbouring pieces sharing a window."""
    whole = np.concatenate([np.zeros(WIDTH - 1, np.int64), *parts, np.zeros(WIDTH - 1, np.int64)])
    best = np.full(net.turn.shape[1], -np.inf)
    for lo in range(0, len(whole) - WIDTH + 1, PIECE):
        part = net.letter[whole[lo:lo + PIECE + WIDTH - 1]]
        windows = np.lib.stride_tricks.sliding_window_view(part, WIDTH, axis=0).transpose(0, 2, 1).reshape(len(part) - WIDTH + 1, -1)
        best = np.maximum(best, (windows @ net.turn).max(axis=0))
    return np.maximum(best + net.shift, 0)


def raw_scores(net: Network, readings: Sequence[tuple]) -> np.ndarray:
    return np.array([pooled(net, r) @ net.out + net.bias for r in readings]) if len(readings) else np.empty(0)


def probability(net: Network, raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(net.slope * raw + net.offset, -50, 50)))


def gradients(net: Network, parts: tuple, label: float) -> tuple[float, list[np.ndarray]]:
    """Loss of one example and its derivatives by letter, turn, shift, out and bias."""
    whole = np.concatenate([np.zeros(WIDTH - 1, np.int64), *parts, np.zeros(WIDTH - 1, np.int64)])
    at = np.arange(len(whole) - WIDTH + 1)[:, None] + np.arange(WIDTH)
    windows = net.letter[whole[at]].reshape(len(at), -1)
    values = windows @ net.turn
    where = values.argmax(axis=0)
    largest = values[where, np.arange(values.shape[1])] + net.shift
    active = np.maximum(largest, 0)
    raw = active @ net.out + net.bias
    p = 1 / (1 + np.exp(-np.clip(raw, -50, 50)))
    loss = -np.log(max(p if label else 1 - p, 1e-12))
    back = (p - label) * net.out * (largest > 0)
    turn = windows[where].T * back
    letter = np.zeros_like(net.letter)
    np.add.at(letter, whole[at[where]].ravel(), (net.turn.T * back[:, None]).reshape(-1, net.letter.shape[1]))
    return loss, [letter, turn, back, (p - label) * active, np.array(p - label)]


SHAPES = ((2 * INSIDE, DEPTH), (WIDTH * DEPTH, FEATURES), (FEATURES,), (FEATURES,), ())


class Learning(NamedTuple):
    values: list[np.ndarray]  # letter, turn, shift, out and bias
    first: list[np.ndarray]   # Adam's moments
    second: list[np.ndarray]
    step: float

    def network(self) -> Network:
        return Network(*self.values[:4], float(self.values[4]), 1.0, 0.0, {})

    def flat(self) -> np.ndarray:
        return np.concatenate([*(np.ravel(x) for part in self[:3] for x in part), [self.step]])


def unflat(numbers: np.ndarray) -> Learning:
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES] * 3)
    parts = [x.reshape(shape) for x, shape in zip(np.split(numbers[:ends[-1]], ends[:-1]), SHAPES * 3)]
    return Learning(parts[:5], parts[5:10], parts[10:], float(numbers[-1]))


def begun(rng: np.random.Generator) -> Learning:
    values = [
        rng.normal(0, 0.3, SHAPES[0]), rng.normal(0, 1 / np.sqrt(WIDTH * DEPTH), SHAPES[1]), np.zeros(FEATURES), rng.normal(0, 0.3, FEATURES), np.array(0.0),
    ]
    return Learning(values, [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values], 0)


def learn_round(now: Learning, examples: Sequence[tuple[tuple, float]], rng: np.random.Generator) -> Learning:
    """Adam over mini-batches, each example once."""
    state, first, second, step = list(now.values), list(now.first), list(now.second), now.step
    order = rng.permutation(len(examples))
    for lo in range(0, len(order), BATCH):
        step += 1
        total = [np.zeros_like(x) for x in state]
        net = Learning(state, first, second, step).network()
        for i in order[lo:lo + BATCH]:
            for t, g in zip(total, gradients(net, *examples[i])[1]):
                t += g
        for j, g in enumerate(total):
            g /= len(order[lo:lo + BATCH])
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.999 * second[j] + 0.001 * g * g
            state[j] = state[j] - RATE * (first[j] / (1 - 0.9**step)) / (np.sqrt(second[j] / (1 - 0.999**step)) + 1e-8)
    return Learning(state, first, second, step)


def learned(examples: Sequence[tuple[tuple, float]], seed: int = 7) -> Learning:
    """All rounds over one set of examples, in a fixed order."""
    rng = np.random.default_rng(seed)
    now = begun(rng)
    for _ in range(ROUNDS):
        now = learn_round(now, examples, rng)
    return now


def learn(examples: Sequence[tuple[tuple, float]], seed: int = 7) -> Network:
    return learned(examples, seed).network()


def newton(moments: Callable[[np.ndarray, float, float], Sequence[float]], good: float, bad: float) -> tuple[float, float]:
    """Slope and offset of a logistic fit with softened labels. `moments` sums p(1 - p) times x², x and 1, then the errors of p times x and 1."""
    w = np.array([1.0, 0.0])
    for _ in range(50):
        xx, x, n, gx, g = moments(w, (good + 1) / (good + 2), 1 / (bad + 2))
        hess = np.array([[xx, x], [x, n]]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, np.array([gx, g]) + 1e-6 * (w - [1.0, 0.0]))
        w = w - move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-12:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def calibrate(raw: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """`newton` over scores at hand."""
    def moments(w: np.ndarray, high: float, low: float) -> Sequence[float]:
        p = 1 / (1 + np.exp(-np.clip(w[0] * raw + w[1], -30, 30)))
        q, error = p * (1 - p), p - np.where(label > 0, high, low)
        return [(q * raw * raw).sum(), (q * raw).sum(), q.sum(), (error * raw).sum(), error.sum()]

    return newton(moments, label.sum(), len(label) - label.sum())


def calibrate_rows(scores: DataFrame, good: int, bad: int) -> tuple[float, float]:
    """`newton` over a table of scores (raw, label): five sums a step come to the driver."""
    def moments(w: np.ndarray, high: float, low: float) -> Sequence[float]:
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(w[0])) * F.col("raw") + F.lit(float(w[1]))))
        rows = scores.select("raw", "label", (1 / (1 + F.exp(-z))).alias("p"))
        q, error = F.col("p") * (1 - F.col("p")), F.col("p") - F.when(F.col("label") > 0, high).otherwise(low)
        return rows.agg(*[F.sum(c).alias(n) for n, c in zip("abcde", (q * F.col("raw") * F.col("raw"), q * F.col("raw"), q, error * F.col("raw"), error))]).first()

    return newton(moments, good, bad)


def ranked(scores: DataFrame, recall: float) -> dict[str, float]:
    """Of each kind's secrets (kind, raw) the score that at least `recall` of them reach: counts by bins, then by bins of the bin it lies in."""
    ends = scores.groupBy("kind").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), F.count("*").alias("n")).collect()
    at = {r.kind: (r.lo, r.hi, int(np.floor((1 - recall) * r.n))) for r in ends}
    while wide := {k: v for k, v in at.items() if v[0] < v[1]}:
        own = lambda f: F.coalesce(*[F.when(F.col("kind") == k, f(*v)) for k, v in wide.items()])
        inside = scores.where(own(lambda lo, hi, _: F.col("raw").between(lo, hi)))
        place = own(lambda lo, hi, _: F.floor((F.col("raw") - lo) / (hi - lo) * BINS))
        counts = inside.groupBy("kind", place.alias("bin")).agg(F.count("*").alias("n"), F.min("raw").alias("lo"), F.max("raw").alias("hi")).collect()
        for k, (*_, rank) in wide.items():
            for r in sorted((r for r in counts if r.kind == k), key=lambda r: r.bin):
                if rank < r.n:
                    at[k] = (r.lo, r.hi, rank)
                    break
                rank -= r.n
    return {k: lo for k, (lo, _, _) in at.items()}


def threshold(p: np.ndarray, label: np.ndarray, recall: float) -> float:
    """The highest score that at least `recall` of the secrets reach; never below one half. Without secrets: one half."""
    secrets = np.sort(p[label > 0])
    return max(0.5, float(secrets[int(np.floor((1 - recall) * len(secrets)))])) if len(secrets) else 0.5


# Over documents -----------------------------------------------------------------------------------------------------

def labelled_findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, before, run, after, label, h): the distinct candidates of all texts with their surroundings, and a hash of those.

    Long runs are shown by their first PIECE characters here; scans read them whole.
    """
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            out = []
            for t in part.column("text").to_pylist():
                if not t:
                    continue
                base, spans = base_findings(t), candidates(t)
                for (a, b), hit in zip(spans, covered(spans, base)):
                    out.append((kind_of(t[a:b]), t[max(0, a - AROUND):a], t[a:min(b, a + PIECE)], t[b:b + AROUND], int(hit)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["kind", "before", "run", "after", "label"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(find, "kind string, before string, run string, after string, label bigint")
    return staged(rows.withColumn("h", F.xxhash64("before", "run", "after")).dropDuplicates(["label", "h", "run"]), "findings")


def shown(r: Any) -> tuple[bool, list[tuple]]:
    """Whether a finding is held back, and its readings: both views to train on, one to calibrate with.

    A fifth of the findings, by hash, is held back for calibration and thresholds. Secrets among them are shown without the words before
    them: named ones are base findings already, so that is what a scan asks the network about.
    """
    whole = r.before + r.run + r.after
    a, b = len(r.before), len(r.before) + len(r.run)
    if r.h % 5 == 0:
        return True, [reading(whole, a, b, bool(r.label))]
    return False, [reading(whole, a, b, blank) for blank in (False, True)]


def shard_examples(got: pd.DataFrame, every: bool) -> list[tuple[tuple, float]]:
    """What a shard trains on, with `every` the findings held back too. The rarer label weighs as much as the other."""
    fit_on, held = [], []
    for r in got.sort_values(["label", "h", "run"]).itertuples():
        is_held, views = shown(r)
        (held if is_held else fit_on).extend((x, float(r.label)) for x in views)
    if every:
        fit_on += held
    by = {y: [e for e in fit_on if e[1] == y] for y in (0.0, 1.0)}
    most = max(map(len, by.values()))
    return [e for y in by if by[y] for e in (by[y] * -(-most // len(by[y])))[:most]]


def learn_shards(found: DataFrame, of: dict[int, int], shards: int, every: bool, seed: int = 7) -> Network:
    """The network over all findings, dealt over shards by hash. Of the rarer label each shard has its part of a number like the other's.

    One shard learns all rounds at once. Of more, each learns a round on from the mean of all: as many numbers as the network has come to the driver.
    """
    spark, most = found.sparkSession, max(of.values())
    copies = F.when(F.col("label") == 1, min(shards, -(-most // of[1]))).otherwise(min(shards, -(-most // of[0])))
    first = F.pmod(F.xxhash64("h", F.lit(seed)), F.lit(shards))
    dealt = found.select("before", "run", "after", "label", "h", first.alias("_first"), F.explode(F.sequence(F.lit(0), copies - 1)).alias("_copy"))
    dealt = dealt.select("before", "run", "after", "label", "h", F.pmod(F.col("_first") + F.col("_copy"), F.lit(shards)).cast("int").alias("shard"))
    dealt = staged(dealt.repartition(shards, "shard"), "shards") if shards > 1 else dealt

    def learned_on(now: np.ndarray | None, turn: int) -> np.ndarray:
        shared = spark.sparkContext.broadcast(now)  # some ten thousand numbers

        def fit(got: pd.DataFrame) -> pd.DataFrame:
            examples, shard = shard_examples(got, every), int(got["shard"].iloc[0])
            if shared.value is None:
                numbers = learned(examples, seed).flat()
            else:
                numbers = learn_round(unflat(shared.value), examples, np.random.default_rng([seed, turn, shard])).flat()
            return pd.DataFrame({"i": np.arange(len(numbers), dtype=np.int32), "shard": np.int32(shard), "v": numbers})

        each = dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(fit, "i int, shard int, v double")
        # Summed in the order of the shards, so that reruns agree.
        every_one = each.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("shard", "v"))).alias("all"))
        mean = F.aggregate("all", F.lit(0.0), lambda total, x: total + x["v"]) / F.size("all")
        return every_one.select("i", mean.alias("v")).toPandas().sort_values("i")["v"].to_numpy()

    if shards == 1:
        return unflat(learned_on(None, 0)).network()
    now = begun(np.random.default_rng(seed)).flat()
    for turn in range(ROUNDS):
        now = learned_on(now, turn)
    return unflat(now).network()


def held_scores(found: DataFrame, net: Network, every: bool) -> DataFrame:
    """(kind, raw, label) of the findings held back; with `every` of all, of no kind."""
    shared = found.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            out = []
            for r in part.to_pandas().itertuples():
                for raw in raw_scores(shared.value, shown(r)[1]):
                    out.append(("" if every else r.kind, float(raw), r.label))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["kind", "raw", "label"])

    rows = found if every else found.where(F.pmod("h", F.lit(5)) == 0)
    return rows.mapInArrow(run, "kind string, raw double, label bigint")


def train(docs: DataFrame, recall: float = RECALL, shard: int = SHARD, text: str = "text") -> Network | None:
    """The network, calibrated, with a threshold for each kind. None where the findings lack secrets or others.

    It learns from all findings but a fifth, which gives the calibration and the thresholds. `shard`: findings of a label that a task learns from, about.
    """
    found = labelled_findings(docs, text)
    counts = {(r.label, r.held): r["count"] for r in found.groupBy("label", (F.pmod("h", F.lit(5)) == 0).alias("held")).count().collect()}
    of = {y: counts.get((y, False), 0) + counts.get((y, True), 0) for y in (0, 1)}
    if not all(of.values()):
        return None
    held = [counts.get((y, True), 0) for y in (0, 1)]
    every = not all(counts.get((y, False), 0) for y in (0, 1)) or not sum(held)
    shards = -(-max(of.values()) // shard)
    net = learn_shards(found, of, shards, every)
    scores = held_scores(found, net, every)
    if shards == 1:  # few
        got = scores.toPandas()
        raw, label, kinds = got["raw"].to_numpy(), got["label"].to_numpy().astype(float), got["kind"].to_numpy()
        slope, offset = calibrate(raw, label)
        net = net._replace(slope=slope, offset=offset)
        p = probability(net, raw)
        return net._replace(least={k: threshold(p[kinds == k], label[kinds == k], recall) for k in KINDS})
    scores = staged(scores, "scores")
    good = [2 * counts.get((y, False), 0) + held[y] for y in (0, 1)] if every else held
    slope, offset = calibrate_rows(scores, good[1], good[0])
    net = net._replace(slope=slope, offset=offset)
    lowest = ranked(scores.where("label > 0").select("kind", "raw"), recall)
    return net._replace(least={k: max(0.5, float(probability(net, lowest[k]))) if k in lowest else 0.5 for k in KINDS})


def scan(docs: DataFrame, net: Network | None, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` and `findings` of each document: kind, start, end (code points, end exclusive) and score, by start, then kind.

    Base kinds come first in order and have no score; what the network adds is of kind `model`, overlaps no base finding and
    reaches the threshold of its characters. A null or empty text has no findings, repeated rows are answered each, an empty
    table gives an empty one. Texts and candidates of any length are read whole. Without a network only base findings are given.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(net)  # a few thousand numbers
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    place = {k: n for n, k in enumerate((*BASE, "model"))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for part in slices(batches, text):
            out = []
            for t in part.column(text).to_pylist():
                base = base_findings(t) if t else []
                found = [(a, b, k, None) for a, b, k in base]
                if t and net is not None:
                    spans = candidates(t)
                    free = [s for s, hit in zip(spans, covered(spans, base)) if not hit]
                    scores = probability(net, raw_scores(net, [reading(t, *s) for s in free]))
                    found += [(a, b, "model", float(p)) for (a, b), p in zip(free, scores) if p >= net.least[kind_of(t[a:b])]]
                found.sort(key=lambda f: (f[0], place[f[2]], f[1]))
                out.append([{"kind": k, "start": a, "end": b, "score": p} for a, b, k, p in found])
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(out, kind)], names=[*keep, "findings"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, f"{kept}, findings {SCHEMA}")
