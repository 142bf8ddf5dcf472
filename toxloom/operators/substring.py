"""Links between texts where one contains the other, without comparing all pairs.

A text that lies inside another brings its grams along. So every contained side ("needle") gives up one gram as its
anchor, the containing side ("hay") lists its grams, an equi join on the gram finds candidates and `contains`
settles them. Grams that start at a word start are preferred: they are six times fewer than all grams.

An anchor should be rare on both sides. Grams that many containing texts hold, such as those of a line they all share, are found by a
mergeable frequency sketch over a part of them and avoided. A needle that has no other grams gives a phrase, two grams and the words
between them, which tells where lines that are common each meet. All this decides the number of candidates, never the links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxloom.functions.cells import each, named
from toxloom.llm.words import BASE, UNBASE, mix, powers, raw, slices
from toxloom.operators.joins import broadcastable, lookup_join
from toxloom.session import staged

# Texts of one side with no more characters than this in all may be broadcast: nine grams a character at most, each a
# row of two numbers. A wiki's titles take about half of it.
SMALL_CHARS = 1 << 19
OFFERED = 32
ANCHOR_BYTES = 96  # of an anchor in a hash table: a hash, an id, a length, and the row's own
SMALL_ANCHORS = (96 << 20) // ANCHOR_BYTES  # counted anchors, over all classes, that may be broadcast

SKETCHED = 16       # one containing text in so many is sketched, where there are more than FULLY
FULLY = 1 << 14
HEAVY = 4096        # grams that the sketch gives at most; it tracks 16 times as many
HEAVY_SHARE = 0.01  # of the sketched texts that hold a gram to be avoided
PHRASE = 4          # words in a phrase before the gram that ends it
PHRASE_GRAM = 16    # characters of that gram
PICK = 16           # one hash in so many picks a gram; texts that have such grams are found by them alone

# (starts after a blank, length), in order of preference. The last one fits every text.
# Texts too short for a gram of six give themselves, as two characters of them would lie in nearly every containing text.
CLASSES = [(True, 16), (True, 8), (False, 6), (False, 5), (False, 4), (False, 3), (False, 2), (False, 1), (False, 0)]
MARKS = 1 << 25     # remainders of hashes that tell which grams may be anchors, a bit each, of classes with few of them
MARKED = 1 << 20    # remainders that the anchors of a class have at most for this
PICKED = (*CLASSES[0], True)  # those of the first class that are picked by their hashes


class Codes(NamedTuple):
    code: np.ndarray   # of the characters of all texts, one text after the other
    first: np.ndarray  # of each text: its first character; one entry more than texts


def _codes(texts: Sequence[bytes]) -> Codes:
    read = [t.decode("utf-8", "surrogateescape") for t in texts]
    code = np.frombuffer("".join(read).encode("utf-32-le", "surrogatepass"), np.uint32)
    return Codes(code, np.concatenate(([0], np.cumsum([len(t) for t in read], dtype=np.int64))))


def _grams(t: Codes, kind: tuple, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the grams of a class, of the `asked` texts or of all."""
    at_word, length, *picked = kind
    n = len(t.first) - 1
    if length == 0:
        text = np.arange(n) if asked is None else np.flatnonzero(asked)
        return text, np.zeros(len(text), np.int64)
    if at_word:
        at = np.flatnonzero(t.code == 32)
        text = np.searchsorted(t.first, at, "right") - 1
        at += 1
        fits = at + length <= t.first[text + 1]
        if asked is not None:
            fits &= asked[text]
        at, text = at[fits], text[fits]
        h = np.full(len(at), length, np.uint64)
        for j in range(length):
            h *= np.uint64(BASE)
            h += t.code[at + j]
    else:
        size = np.diff(t.first) - (length - 1)
        if asked is not None:
            size[~asked] = 0
        size = np.maximum(size, 0)
        h = np.full(len(t.code), length, np.uint64)
        for j in range(min(length, len(h))):
            h *= np.uint64(BASE)
            h[:len(h) - j] += t.code[j:]
        text = np.repeat(np.arange(n), size)
        h = h[np.arange(len(text)) + np.repeat(t.first[:-1] - (np.cumsum(size) - size), size)]
    h = mix(h).view(np.int64)
    keep = h % PICK == 0 if picked else slice(None)
    return text[keep], h[keep]


def _phrases(t: Codes, asked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the phrases: from a word start over `PHRASE` words to a gram behind them."""
    blank = np.flatnonzero(t.code == 32)
    text = np.searchsorted(t.first, blank, "right") - 1
    start, end, text = blank[:-PHRASE] + 1, blank[PHRASE:] + 1 + PHRASE_GRAM, text[:-PHRASE]
    fits = end <= t.first[text + 1]
    if asked is not None:
        fits &= asked[text]
    start, end, text = start[fits], end[fits], text[fits]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(t.code * powers(BASE, len(t.code)), dtype=np.uint64)])
    h = (total[end] - total[start]) * powers(UNBASE, len(t.code) + 1)[start]
    return text, mix(h + (end - start).astype(np.uint64)).view(np.int64)


def _distinct(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each hash once a text, by text and hash."""
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.append(True, (text[1:] != text[:-1]) | (h[1:] != h[:-1]))[:len(h)]
    return text[new], h[new]


def _needle_grams(t: Codes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each text, text, hash): the distinct grams of each text's first class."""
    kind, found = np.full(len(t.first) - 1, -1), []
    for i, k in enumerate(CLASSES):
        if (asked := kind < 0).any():
            found.append(_grams(t, k, asked))
            kind[found[-1][0]] = i
    return kind, *_distinct(*map(np.concatenate, zip(*found)))


def _lists(text: np.ndarray, h: np.ndarray, n: int, most: int | None = None) -> pa.Array:
    """The hashes of each of n texts, the first `most`. They are in order of their texts."""
    if most:
        keep = np.arange(len(text)) - np.searchsorted(text, text) < most
        text, h = text[keep], h[keep]
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32)), pa.array(h))


def _listed(texts: DataFrame, cols: Sequence[str], lists: Callable[[Codes], dict[str, pa.Array]], added: str) -> DataFrame:
    """The columns of each text, and what `lists` makes of the texts of some rows (`added`: its schema)."""
    read = texts.select("text", *[F.col(c).alias(f"_{c}") for c in cols])
    schema = ", ".join([*(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in cols), added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = lists(_codes(raw(part)))
            yield pa.RecordBatch.from_arrays([*(part.column(f"_{c}") for c in cols), *made.values()], names=[*cols, *made])

    return read.mapInArrow(run, schema)


def _has_gram(text: Column, kind: tuple[bool, int]) -> Column:
    at_word, length = kind
    return F.rlike(text, F.lit(f"(?s){' ' if at_word else ''}.{{{length}}}"))


def _kind(text: Column) -> Column:
    """Index of the first class the text has a gram of."""
    return F.coalesce(*[F.when(_has_gram(text, k), F.lit(i)) for i, k in enumerate(CLASSES)])


def _kinds_of(needles: DataFrame) -> dict[tuple[bool, int], int]:
    """The classes the needles use, with their counts: at most nine rows come to the driver."""
    counts = needles.groupBy(_kind(F.col("text")).alias("kind")).count().collect()
    return {CLASSES[r[0]]: r[1] for r in sorted(counts)}


def _hay_grams(hay: DataFrame, kinds: Sequence[tuple], *cols: str, marks: dict[tuple, np.ndarray] | None = None) -> DataFrame:
    """A row for each distinct gram of each text, as its hash. Of classes in `marks` those that are marked."""
    def some(t: Codes, kind: tuple) -> tuple[np.ndarray, np.ndarray]:
        text, h = _grams(t, kind)
        if not marks or kind not in marks:
            return text, h
        at = h % MARKS
        keep = (marks[kind][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return text[keep], h[keep]

    def lists(t: Codes) -> dict[str, pa.Array]:
        return {"grams": _lists(*_distinct(*map(np.concatenate, zip(*(some(t, k) for k in kinds)))), len(t.first) - 1)}

    rows = _listed(hay, cols, lists, "grams array<bigint>").select(*cols, each(F.col("grams")).alias("gram"))
    return rows.where(F.col("gram").isNotNull())


def _hay_phrases(hay: DataFrame, *cols: str) -> DataFrame:
    def lists(t: Codes) -> dict[str, pa.Array]:
        return {"grams": _lists(*_distinct(*_phrases(t)), len(t.first) - 1)}

    rows = _listed(hay, cols, lists, "grams array<bigint>").select(*cols, each(F.col("grams")).alias("gram"))
    return rows.where(F.col("gram").isNotNull())


def _marks(anchors: DataFrame, counts: dict[int, int]) -> dict[tuple, np.ndarray]:
    """Remainders of the anchors' hashes, as bits, of the counted classes that have `MARKED` of them at most: that many numbers a class come to the driver."""
    rows = anchors.where(F.col("kind").isin(list(counts))).select("kind", F.pmod("gram", F.lit(MARKS)).cast("int").alias("mark")).distinct()
    few = [r["kind"] for r in rows.groupBy("kind").count().collect() if r["count"] <= MARKED]
    marks: dict[tuple, np.ndarray] = {}
    for kind in few:
        bits = np.zeros(MARKS, bool)
        bits[rows.where(F.col("kind") == kind).select("mark").toArrow().column(0).to_numpy()] = True
        marks[_listed_as(kind)] = np.packbits(bits, bitorder="little")
    return marks


def _listed_as(kind: int) -> tuple:
    return PICKED if kind < 0 else CLASSES[kind]


def _offers(needles: DataFrame, cols: Sequence[str], heavy: Sequence[int] = ()) -> DataFrame:
    """The columns, kind, common, grams, phrases: what each needle may be found by.

    Of its grams outside `heavy`; `common` is true where all are heavy, and only then there are phrases. Where some of the grams of the first
    class are of those that one hash in `PICK` tells, only they are offered, and the kind is -1: containing texts then list no others.

    Any gram of a needle is an exact anchor, so a text without picked grams only offers the `OFFERED` grams of lowest hash. All picked grams
    are offered, so that a gram's count does not depend on the lengths of the texts that hold it.
    """
    avoided = np.array(heavy, np.int64)

    def lists(t: Codes) -> dict[str, pa.Array]:
        n = len(t.first) - 1
        kind, text, h = _needle_grams(t)
        rare = ~np.isin(h, avoided)
        common = np.bincount(text[rare], minlength=n) == 0
        picked = rare & (kind[text] == 0) & (h % PICK == 0)
        some = np.bincount(text[picked], minlength=n) > 0
        kind[some] = -1
        keep = np.where(some[text], picked, rare | common[text])
        text, h = text[keep], h[keep]
        keep = some[text] | (np.arange(len(text)) - np.searchsorted(text, text) < OFFERED)
        phrases = _distinct(*_phrases(t, common)) if common.any() else (text[:0], h[:0])
        return {"kind": pa.array(kind.astype(np.int8)), "common": pa.array(common), "grams": _lists(text[keep], h[keep], n), "phrases": _lists(*phrases, n, OFFERED)}

    return _listed(needles, cols, lists, "kind tinyint, common boolean, grams array<bigint>, phrases array<bigint>")


def _rare_anchors(offers: DataFrame, grams: str = "grams") -> DataFrame:
    """(id, gram): one anchor per needle, the offered gram that fewest needles share, so common phrases do not pair everything.

    The counts come out of an explode, which Spark's size estimate does not see, so the join is told not to
    broadcast them.
    """
    one = offers.select("id", each(F.col(grams)).alias("gram")).where(F.col("gram").isNotNull())
    counts = one.groupBy("gram").agg(F.count("*").alias("n"))
    ranked = lookup_join(one, counts.hint("merge"), "gram", "inner", ["id"])
    return ranked.groupBy("id").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))


def _heavy(hay: DataFrame, kinds: list[tuple[bool, int]]) -> list[int]:
    """Hashes of the grams that many containing texts hold, `HEAVY` at most. Where there are many texts a fixed part of them tells."""
    part, n = hay.select(F.xxhash64("text").alias("h"), "text"), hay.count()
    if n > FULLY:
        part, n = part.where(F.pmod("h", F.lit(SKETCHED)) == 0), n / SKETCHED
    top = _hay_grams(part, kinds, "h").agg(F.expr(f"approx_top_k(gram, {HEAVY}, {16 * HEAVY})").alias("top")).first()["top"]
    return [t["item"] for t in top or [] if t["count"] > max(2, HEAVY_SHARE * n)]


def _side(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(named(key).alias("id"), named(text).alias("text")).where(F.col("text").isNotNull())


def _longest(df: DataFrame) -> Column:
    return df.agg(F.coalesce(F.max(F.length("text")), F.lit(-1)).alias("n")).scalar()


def _is_small(texts: DataFrame) -> bool:
    """Measured, not estimated: Spark's estimate knows nothing of the grams a text breaks into."""
    if not broadcastable(texts):
        return False
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    return max(size.n, size.chars) <= SMALL_CHARS


def _links_small(left: DataFrame, right: DataFrame) -> DataFrame:
    """The right side is within `SMALL_CHARS`: the left side is never shuffled."""
    kinds = list(_kinds_of(right)) or CLASSES[-1:]
    anchors = _rare_anchors(_offers(right, ["id"], _heavy(left, kinds))).join(right, "id")  # one row per right row
    down = (
        _hay_grams(left, kinds, "id", "text")
        .join(F.broadcast(anchors.select(F.col("id").alias("r"), F.col("text").alias("needle"), "gram")), "gram")
        .where(F.contains("text", "needle"))
        .select(F.col("id").alias("l"), "r")
    )
    shorter = left.where(F.length("text") <= _longest(right))
    grams = _hay_grams(right, CLASSES, "id").withColumnRenamed("id", "r")  # at most 9 * SMALL_CHARS rows, no texts
    hay = right.select(F.col("id").alias("r"), F.col("text").alias("hay"))
    up = (
        _offers(shorter, ["id", "text"]).select("id", "text", F.get("grams", 0).alias("gram"))
        .join(F.broadcast(grams), "gram")
        .join(F.broadcast(hay), "r")
        .where(F.contains("hay", "text") & (F.col("hay") != F.col("text")))
        .select(F.col("id").alias("l"), "r")
    )
    return down.unionByName(up)


def _candidates(hay: DataFrame, needles: DataFrame, small: int) -> DataFrame:
    """(hay id, needle id) of texts that share the needle's anchor; every pair of which hay contains needle is among them.

    Texts offer their grams once, in a table. Anchors of the rarest classes, up to `small` in all, are broadcast and meet the grams where those arise; the
    grams of other classes shuffle. Only ids and lengths travel.
    """
    if needles is not hay:
        needles = needles.where(F.length("text") <= _longest(hay))
    kinds = _kinds_of(needles)
    if not kinds:
        return hay.select(F.col("id").alias("h"), F.col("id").alias("n")).limit(0)
    heavy = _heavy(hay, list(kinds))
    offers = staged(_offers(needles.withColumn("n_len", F.length("text")), ["id", "n_len"], heavy), "offers")
    anchors = _rare_anchors(offers).join(offers.select("id", "kind", "n_len").hint("merge"), "id")
    hay_sized = hay.select(F.col("id").alias("h"), "text", F.length("text").alias("h_len"))
    found = []

    def meet(grams: DataFrame, own: DataFrame, few: bool) -> None:
        own = own.select(F.col("id").alias("n"), "gram", "n_len")
        hits = lookup_join(grams, F.broadcast(own) if few else own.hint("merge"), "gram", "inner", ["h"])
        found.append(hits.where(F.col("n_len") <= F.col("h_len")).select("h", "n"))

    worded = offers.where("common and size(phrases) > 0")
    if heavy and (n := worded.count()):
        anchors = anchors.join(worded.select("id"), "id", "left_anti")
        phrased = staged(_rare_anchors(worded, "phrases").join(worded.select("id", "n_len").hint("merge"), "id"), "phrases")
        meet(_hay_phrases(hay_sized, "h", "h_len"), phrased, n <= small)
    anchors = staged(anchors, "anchors")
    few, total, kinds = [], 0, dict(anchors.groupBy("kind").count().collect())
    for k, n in sorted(kinds.items(), key=lambda x: x[1]):
        total += n
        if total <= small:
            few.append(k)
    marks = _marks(anchors, kinds)
    for group in (few, [k for k in kinds if k not in few]):
        if group:
            meet(_hay_grams(hay_sized, [*map(_listed_as, sorted(group))], "h", "h_len", marks=marks), anchors.where(F.col("kind").isin(group)), group is few)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _contained(hay: DataFrame, needles: DataFrame, small: int, equal: bool = True) -> DataFrame:
    """(hay id, needle id) where hay contains needle, or is equal to it, if asked; both sides may be of any size. Texts are distinct."""
    needle_texts = needles.select(F.col("id").alias("n"), F.col("text").alias("needle"))
    checked = lookup_join(_candidates(hay, needles, small).hint("merge"), needle_texts, "n", "inner", ["h"])
    checked = lookup_join(checked.hint("merge"), hay.select(F.col("id").alias("h"), "text"), "h", "inner", ["n"])
    return checked.where(F.contains("text", "needle") & (F.lit(equal) | (F.col("text") != F.col("needle")))).select("h", "n")


def _distinct_texts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, t) of the rows, and the distinct texts by t, a number. They are read several times, so they are written once, with their numbers."""
    rows = df.withColumn("digest", F.substring(F.unhex(F.sha2("text", 256)), 1, 16))  # 128 bits tell texts apart
    texts = rows.groupBy("digest").agg(F.any_value("text").alias("text"))
    texts = staged(texts.select(F.monotonically_increasing_id().alias("id"), "digest", "text"), "texts")
    numbers = texts.select("digest", F.col("id").alias("t"))
    return lookup_join(rows.select("id", "digest"), numbers, "digest", "inner", ["id"]).select("id", "t"), texts.select("id", "text")


def _ids_back(left_ids: DataFrame, right_ids: DataFrame, links: DataFrame) -> DataFrame:
    """(l, r) of links between texts (lt, rt)."""
    lefts = lookup_join(left_ids.select(F.col("id").alias("l"), F.col("t").alias("lt")), links, "lt", "inner", ["l"])
    both = lookup_join(
        lefts.select("l", "rt"), right_ids.select(F.col("id").alias("r"), F.col("t").alias("rt")), "rt", "inner", ["l"]
    )
    return both.select("l", "r")


def _links_large(left: DataFrame, right: DataFrame, small: int) -> DataFrame:
    """Copies of a text count once until the links are known, then ids are put back."""
    left_ids, left_texts = _distinct_texts(left)
    right_ids, right_texts = _distinct_texts(right)
    down = _contained(left_texts, right_texts, small).select(F.col("h").alias("lt"), F.col("n").alias("rt"))
    up = _contained(right_texts, left_texts, small, equal=False).select(F.col("n").alias("lt"), F.col("h").alias("rt"))  # numbers of two tables
    return _ids_back(left_ids, right_ids, down.unionByName(up))


def substring_self_link(df: DataFrame, key: str, text: str, other: str, small_anchors: int | None = None) -> DataFrame:
    """(key, other) of all pairs of a table's rows where either text contains the other, each row with itself too.

    One direction is searched; the other is its mirror image. Keys are unique, null texts never match.
    """
    ids, texts = _distinct_texts(_side(df, key, text))
    found = staged(_contained(texts, texts, SMALL_ANCHORS if small_anchors is None else small_anchors), "links")
    down = found.select(F.col("h").alias("lt"), F.col("n").alias("rt"))
    up = found.where(F.col("h") != F.col("n")).select(F.col("n").alias("lt"), F.col("h").alias("rt"))
    return _ids_back(ids, ids, down.unionByName(up)).select(F.col("l").alias(key), F.col("r").alias(other))


def substring_link(
    left: DataFrame, left_key: str, left_text: str, right: DataFrame, right_key: str, right_text: str,
    small_anchors: int | None = None,
) -> DataFrame:
    """(left_key, right_key) where either text contains the other, case kept. Null texts never match.

    Keys are unique on each side, and so are the pairs. `right` is the side expected to be small (titles);
    its size decides the plan, not the result. It is written once, so what it comes from is computed once.
    `small_anchors` bounds the anchors that may be broadcast where both sides are large.
    """
    l, r = _side(left, left_key, left_text), staged(_side(right, right_key, right_text), "titles")
    small = SMALL_ANCHORS if small_anchors is None else small_anchors
    links = _links_small(l, r) if _is_small(r) else _links_large(l, r, small)
    return links.select(F.col("l").alias(left_key), F.col("r").alias(right_key))
