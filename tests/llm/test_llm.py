import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from toxloom.llm import elias_fano, exact_dedup, jaccard_join, language_id, mixing, ngram_trie, packing, passages, token_counts, toxicity, vector_search
from toxloom.llm.words import grams, words

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size bigint"
VOICES = {"en": "the of and to in that with from are this", "fr": "le des une pour dans avec sur les est qui"}


def prose(rng, n, lang="en"):
    common = VOICES[lang].split()
    return " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("aeioulrnst") for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Documents with nulls, empty, blank and long texts, copies, near copies, ties and repeated rows."""
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(5, 300), "en" if i % 2 else "fr"), "en" if i % 2 else "fr", f"s{i % 4}" if i % 7 else None, i) for i in range(60)]
    base = prose(rng, 120)
    for i in range(12):  # near copies: one word changed
        w = base.split()
        w[(i * 9) % 120] = f"zz{i}"
        rows.append((100 + i, " ".join(w), "en", "s0", 1))
    rows += [(200 + i, rows[3][1].upper() if i % 2 else rows[3][1], "en", "s1", 2) for i in range(5)]
    rows += [(300, None, None, None, None), (301, "", "en", "s2", 0), (302, " \n\t ", None, "s2", 3), (303, "one", "en", "s3", 3), (None, "no key here at all", "en", "s3", 3)]
    rows += [rows[10], rows[10]]
    rows.append((304, prose(rng, 6000), "en", "s0", 9))
    rows.append((305, "12 34 !! 56", None, "s0", 9))
    return [(*r, None, None) for r in rows]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


# Words and sequences ----------------------------------------------------------------------------------------------

def test_words_and_grams():
    texts = ["A b\tC", "", "  ", "x", "é à\x0b\x0cÉ b c d"]
    w = words([t.encode() for t in texts])
    assert w.counts().tolist() == [3, 0, 0, 1, 6]
    assert [w.buffer[a:b].decode() for a, b in zip(w.start, w.end)] == ["a", "b", "c", "x", "é", "à", "É", "b", "c", "d"]
    assert w.hash[1] == w.hash[7] and len(set(w.hash.tolist())) == 8
    at, h = grams(w, 5)
    assert at.tolist() == [0, 3, 4, 5]


def test_elias_fano_against_lists():
    rng = np.random.default_rng(1)
    for n, top in ((1, 5), (2, 1 << 62), (500, 600), (3000, 1 << 40), (4000, 50)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        ef = elias_fano.EliasFano(elias_fano.EliasFano.arrays(values, "x"), "x")
        assert (ef.at(np.arange(n)) == values).all()
        lo = rng.integers(0, n, 300)
        hi = np.minimum(n, lo + rng.integers(0, 50, 300))
        target = np.where(rng.random(300) < 0.5, values[rng.integers(0, n, 300)], rng.integers(0, top, 300).astype(np.uint64))
        place, equal = ef.successor(target, lo, hi)
        for t, a, b, p, e in zip(target, lo, hi, place, equal):
            want = a + np.searchsorted(values[a:b], t)
            assert (p, e) == (want, bool(want < b and values[want] == t))


# 1 Mixing ---------------------------------------------------------------------------------------------------------

def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, out = {}, {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        out = dict(fixed) | {s: rest * weight[s] / total for s in free}
        over = [s for s in free if out[s] > most * sizes[s] + 1e-9]
        if not over:
            return out
        fixed |= {s: most * sizes[s] for s in over}


def test_mix(docs, corpus):
    runs = [mixing.mixture(docs, block=8) for _ in range(2)]
    got = [m.taken().toPandas() for m in runs]
    key = lambda d: sorted(map(tuple, d.fillna(-1).values.tolist()))
    assert key(got[0]) == key(got[1]) and len(got[0]) == len(corpus)
    d = got[0]
    assert (d["taken"] <= 3 * d["size"]).all()
    sizes = {}
    for r in corpus:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    targets = brute_targets(sizes)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    sources = {r["source"]: r for r in runs[0].sources.collect()}
    for s, t in targets.items():
        assert sources[s]["target"] == pytest.approx(t) and sources[s]["source_size"] == sizes[s]
        assert abs(sources[s]["quota"] * sources[s]["block"] - t) <= 3 * sources[s]["block"] <= 24  # the last block may be short


def test_the_mix_does_not_hang_on_the_layout(spark, corpus, tmp_path):
    """Rows in one file or in many, in any order."""
    got = []
    for n, order in ((1, 1), (9, -1), (3, 1)):
        path = f"{tmp_path}/{n}"
        spark.createDataFrame(corpus[::order], SCHEMA).repartition(n).write.parquet(path)
        taken = mixing.mixture(spark.read.parquet(path), block=8).taken().toPandas().fillna(-1)
        got.append(sorted(map(tuple, taken.values.tolist())))
    assert got[0] == got[1] == got[2]


def test_what_is_taken_by_counting_slots(docs):
    """`taken` against a plain count: each document's words, laid out by place, in each block as often as slots draw it."""
    m = mixing.mixture(docs, block=8)
    sources = {r["source_no"]: r for r in m.sources.collect()}
    times = {}
    for r in m.slots.collect():
        times[r["source_no"], r["block"]] = times.get((r["source_no"], r["block"]), 0) + 1
    want = sorted((r["row"]["c0"] or -1, sum(times.get((r["source_no"], w // r["length"]), 0) for w in range(r["at"], r["at"] + r["size"]))) for r in m.placed.collect())
    got = sorted((r["doc_id"] or -1, r["taken"]) for r in m.taken().collect())
    assert got == want
    for no, s in sources.items():  # places are dense, and the words taken come near the targets
        places = sorted((r["at"], r["size"]) for r in m.placed.collect() if r["source_no"] == no and r["size"])
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(n for _, n in places) == s["source_size"]
        words_taken = sum(n * min(s["block"], s["source_size"] - b * s["block"]) for (k, b), n in times.items() if k == no)
        assert abs(words_taken - s["target"]) <= 2 * s["block"]


def test_small_sources_meet_their_targets(spark):
    rows = [(1, "a b c d e f g h i j", "x"), (2, " ".join(["w"] * 129), "y"), (3, " ".join(["v"] * 40), "z")]
    got = {r["doc_id"]: r for r in mixing.mixture(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).taken().collect()}
    assert all(abs(r["taken"] - r["target"]) <= 1 for r in got.values())
    none = mixing.mixture(spark.createDataFrame([], "doc_id bigint, text string, source string"))
    assert none.taken().count() == 0


def test_mixed_texts_are_the_words_taken(docs):
    m = mixing.mixture(docs, columns=["doc_id", "source"], block=8, keep_text=True)
    parts = m.texts().toPandas()
    own = parts.assign(n=parts["text"].map(lambda t: len(t.split()))).groupby("doc_id")["n"].sum()
    want = m.taken().toPandas().groupby("doc_id")["taken"].sum()
    assert {k: v for k, v in want.items() if v} == own.to_dict()
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(t in whole[i] for i, t in zip(parts["doc_id"], parts["text"]) if i == i)


def test_permutation_and_caps():
    for n in (1, 2, 7, 100, 1025):
        assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9, np.uint64)).tolist()) == list(range(n))
    assert brute_targets({"a": 1, "b": 100, "c": 100})["a"] == pytest.approx(3)


# 2 Exact dedup ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("width", [16, 1])
def test_exact_groups(docs, corpus, width):
    """With one byte of hash almost all chunks collide, and their bytes tell them apart."""
    got = exact_dedup.exact_groups(docs, width=width).toPandas()
    groups = {}
    for r in corpus:
        groups.setdefault((r[1] or "").encode().lower(), []).append(r[0])
    assert len(got) == len(corpus) and got["kept"].sum() == len(groups)
    by_sha = {hashlib.sha256(t).hexdigest(): ids for t, ids in groups.items()}
    for r in got.itertuples():
        ids = by_sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and (r.keep_id == max(known) if known else pd.isna(r.keep_id))
        if r.kept and known:
            assert r.doc_id == max(known)


def test_cuts_follow_content():
    rng = random.Random(5)
    text = bytes(rng.randrange(256) for _ in range(60_000))
    ends = set(exact_dedup.cuts(text))
    moved = {e - 1000 for e in exact_dedup.cuts(bytes(1000) + text)}
    assert len(ends & moved) > 0.8 * len(ends)
    assert max(b - a for a, b in itertools.pairwise([0, *exact_dedup.cuts(b"a" * 200_000)])) <= exact_dedup.MOST
    assert exact_dedup.cuts(b"") == []


# 3 Passages -------------------------------------------------------------------------------------------------------

def test_passages(spark, corpus):
    rng = random.Random(8)
    shared = prose(rng, 80).split()
    rows = []
    for i in range(10):
        own = list(shared)
        own[(7 * i + 20) % 80] = f"odd{i}"
        rows.append((500 + i, " ".join([prose(rng, 60), *own, prose(rng, 30)])))
    short = prose(rng, 45)
    rows += [(600, f"{prose(rng, 40)} {short} {prose(rng, 40)}"), (601, f"{prose(rng, 10)} {short} {prose(rng, 20)}")]
    rows += [(602, prose(rng, 200)), (603, None), (604, ""), (605, prose(rng, 55) * 2)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, other_id string")
    got = passages.shared_passages(df).toPandas()
    assert set(got["doc_id"]) == {500 + i for i in range(10)}
    for r in got.itertuples():
        # An edit within the last words of a passage ends it there.
        assert r.start_word <= 65 and r.end_word >= 135 and r.identity >= 0.9 and r.other_id != r.doc_id


def test_chain_and_edits_against_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(150):
        a, b = rng.integers(0, 5, rng.integers(0, 25)), rng.integers(0, 5, rng.integers(0, 25))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        table[0], table[:, 0] = np.arange(len(b) + 1), np.arange(len(a) + 1)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            table[i, j] = min(table[i - 1, j] + 1, table[i, j - 1] + 1, table[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        assert passages.edits(a, b) == table[-1, -1]
    # Two diagonals in order are one chain; one that goes back is another.
    x = np.array([0, 5, 10, 30, 35, 60])
    y = np.array([100, 105, 110, 133, 138, 20])
    assert sorted(passages.chain(x, y)) == [(0, 40, 100, 143), (60, 65, 20, 25)]


# 4 Vector search --------------------------------------------------------------------------------------------------

def test_vector_search(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 32)).astype(np.float32)
    x[300:380] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(700, None), (800, [0.0] * 32), (900, [float("nan")] * 32), (1000, [float("inf")] + [1.0] * 31), (1001, [None] * 32), (1100, [1.0] * 5), (None, [1.0] * 32)]
    df = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "vec_id bigint, embedding array<float>, score double, rank int").repartition(3)
    got = vector_search.search(df, df.where("vec_id % 100 = 0")).toPandas()
    hit = 0
    assert set(got["query_id"]) == set(range(0, 700, 100))
    for q, own in got.sort_values("rank").groupby("query_id"):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        assert own["rank"].tolist() == list(range(1, 11)) and np.allclose(own["score"], d[own["vec_id"]], rtol=0, atol=1e-12)
        assert own["score"].is_monotonic_increasing
        hit += len(set(own["vec_id"]) & set(np.lexsort((np.arange(700), d))[:10].tolist()))
    assert hit >= 0.9 * 70
    assert got[got["query_id"] == 300].sort_values("rank")["vec_id"].tolist() == list(range(301, 311))  # ties to the smaller id
    few = vector_search.search(df.where("vec_id < 4"), df.where("vec_id = 0"))
    assert few.count() == 3
    assert vector_search.search(df.where("vec_id > 5000"), df).count() == 0


# 5 Language model -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("part", [ngram_trie.PART, 300])
def test_ngram_trie(spark, docs, corpus, none, monkeypatch, part):
    monkeypatch.setattr(ngram_trie, "PART", part)  # small ones: the pairs of a word lie in several parts
    model = ngram_trie.train(docs.where("doc_id % 3 <> 0"))
    assert (len(model.filled) > 4) == (part == 300)
    got = ngram_trie.score(docs, model, ["doc_id", "kept"]).toPandas()
    assert len(got) == len(corpus)
    learned = [(r[1] or "").encode().lower().split() + [None] for r in corpus if r[0] is not None and r[0] % 3]
    c1, c2, c3 = {}, {}, {}
    for t in learned:
        for c, n in ((c1, 1), (c2, 2), (c3, 3)):
            for i in range(len(t) - n + 1):
                g = tuple(t[i:i + n])
                c[g] = c.get(g, 0) + 1
    total, types = sum(c1.values()), len(c1)
    often = {g[0] for g, n in c1.items() if n >= 2}
    k2 = {g: n for g, n in c2.items() if n >= 2 and set(g) <= often}
    k3 = {g: n for g, n in c3.items() if n >= 2 and set(g) <= often}
    d = ngram_trie.DISCOUNT
    left1, left2 = {}, {}
    for g, n in k2.items():
        left1[g[0]] = left1.get(g[0], 1.0) - (n - d) / c1[g[:1]]
    for g, n in k3.items():
        left2[g[:2]] = left2.get(g[:2], 1.0) - (n - d) / k2[g[:2]]

    def p(t, i):
        out = (c1.get((t[i],), 0) + 1) / (total + types + 1)
        if i and t[i - 1] in often:
            out = left1.get(t[i - 1], 1.0) * out + max(0, k2.get(tuple(t[i - 1:i + 1]), 0) - d) / c1[(t[i - 1],)]
        if i > 1 and tuple(t[i - 2:i]) in k2:
            out = left2.get(tuple(t[i - 2:i]), 1.0) * out + max(0, k3.get(tuple(t[i - 2:i + 1]), 0) - d) / k2[tuple(t[i - 2:i])]
        return out

    texts = {r[0]: (r[1] or "").encode().lower().split() + [None] for r in corpus}
    for r in got.dropna(subset=["doc_id"]).itertuples():
        t = texts[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum((w,) in c1 for w in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((c1.get((w,), 0) + 1) / (total + types + 1)) for w in t))
        assert r.score == pytest.approx(sum(math.log10(p(t, i)) for i in range(len(t))), abs=0.02 * len(t) + 0.05)
    empty = ngram_trie.train(none)
    assert ngram_trie.score(docs.limit(3), empty).count() == 3 and ngram_trie.score(none, model).count() == 0


# 6 Token counts ---------------------------------------------------------------------------------------------------

def test_token_counts_at_every_prefix():
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(1)
    texts = ["", " ", "  a  b\n\tc ", "<s>x</s>", "ﬁ Ａ é", "a\x00b▁c", "x" * 200, "=-" * 90, "日本語 テスト", "aaaa" * 20 + " " * 40 + "b", "👍🏽 ok"]
    texts += ["".join(rng.choice("ab c  e the▁ing日é\n.=0") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    for t, counts in zip(texts, token_counts.prefix_counts(token_counts.merges(), texts)):
        assert counts.tolist() == [len(sp.encode(t[:i])) for i in range(1, len(t) + 1)]


def test_token_counts_of_documents(docs, corpus, none):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.token_counts(docs, 100, ["doc_id", "n_chars"]).toPandas()
    assert len(got) == len(corpus)
    texts = {r[0]: r[1] or "" for r in corpus}
    for r in got.dropna(subset=["doc_id"]).itertuples():
        t = texts[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 100)
        assert len(sp.encode(t[:r.cut_chars])) <= 100 and (r.cut_chars == len(t)) == (r.n_tokens <= 100)
    assert token_counts.token_counts(none, 100).count() == 0
    sizes = token_counts.token_prefixes(docs, ["doc_id"]).select("doc_id", F.size("counts").alias("n")).dropna().collect()
    assert {r["doc_id"]: r["n"] for r in sizes} == {k: len(v) for k, v in texts.items() if k is not None}


# 7 Language ID ----------------------------------------------------------------------------------------------------

def test_language_id(docs, corpus, none):
    model = language_id.train(docs.where(~language_id.held_out("doc_id", 4, 2)))
    assert model[0] == ["en", "fr"] and np.allclose(model[1].sum(axis=0), 1)
    got = language_id.identify(docs, model, ["doc_id", "lang"]).toPandas()
    assert len(got) == len(corpus)
    und = got["doc_id"].isin([300, 301, 302, 305])
    assert (got[und]["lang_pred"] == "und").all() and (got[und]["score"] == 0).all() and (got[~und]["lang_pred"] != "und").all()
    held = got[got["doc_id"].map(lambda i: i == i and i < 60 and zlib.crc32(str(int(i)).encode()) % 4 == 2)]
    assert (held["lang"] == held["lang_pred"]).all() and got["score"].between(0, 1).all()
    assert (language_id.identify(docs, language_id.train(none)).toPandas()["lang_pred"] == "und").all()


def test_forward_sums_all_segmentations():
    from toxloom.llm import pieces as P

    p = P.load()
    flat, prefix, start, size, inverse, _ = language_id.distinct_words(["Ab abc"])
    prob = np.random.default_rng(0).random(len(p.text))
    of = {t: i for i, t in enumerate(p.text)}

    def total(w):
        return sum(prob[of[w[:n]]] * total(w[n:]) for n in range(1, len(w) + 1) if w[:n] in of) if w else 1.0

    for block, n, arcs in language_id.lattice(flat, prefix, start, size):
        for r, value in zip(block, language_id.forward(n, len(block), arcs, prob)[n]):
            assert value == pytest.approx(total("".join(map(chr, flat[start[r]:start[r] + size[r]]))))


# 8 Jaccard join ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("bucket", [256, 3])
def test_jaccard_groups(docs, corpus, bucket):
    """With buckets of three, groups are split and compared block by block."""
    got = jaccard_join.jaccard_groups(docs, bucket=bucket).toPandas()
    assert len(got) == len(corpus)
    sets = [shingles(r[1]) for r in corpus]
    links = {i: set() for i in range(len(corpus))}
    for i, j in itertools.combinations(range(len(corpus)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
            links[i].add(j), links[j].add(i)
    root = {}
    for i in range(len(corpus)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j), todo.append(j)
        root[i] = min((corpus[j][0] for j in seen if corpus[j][0] is not None), default=None)
    want = sorted((corpus[i][0] or -1, root[i] or (0 if root[i] == 0 else -1), len(links[i])) for i in range(len(corpus)))
    own = got.fillna({"doc_id": -1, "class_id": -1})
    assert sorted((int(a) or -1, int(b), int(n)) for a, b, n in zip(own["doc_id"], own["class_id"], own["n_links"])) == want
    pairs, members = jaccard_join.similar_pairs(docs, bucket=bucket)
    sizes = members.groupBy("class").count().toPandas().set_index("class")["count"]
    p = pairs.toPandas()
    assert not p.duplicated(["a", "b"]).any()
    assert sum(sizes[bytes(a)] * sizes[bytes(b)] for a, b in zip(p["a"], p["b"])) * 2 + sum(n * (n - 1) for k, n in sizes.items() if k == k and k is not None) == sum(map(len, links.values()))


def test_jaccard_of_nothing(none):
    assert jaccard_join.jaccard_groups(none).count() == 0
    assert jaccard_join.runs_needed(0.8, 0.9999) >= 3


# 9 Toxicity -------------------------------------------------------------------------------------------------------

def test_toxicity(spark, none):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        t, bad = prose(rng, rng.randint(20, 80)), i % 4 == 0
        if bad:
            w = t.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["vileness", "grimly", "grimness", "grimmer", "nasty"]))
            t = " ".join(w)
        rows.append((i, t, None)), labels.append((i, int(bad)))
    rows += [(900, None, 1), (901, "", 1), (902, "12 !!", 1), (None, "nasty", 1)]
    labels += [(902, None), (None, 1), (3, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = language_id.held_out("doc_id", 3, 1)
    got = toxicity.score(docs, toxicity.train(docs, marks.where(~out)), ["doc_id"]).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    held = got[got["doc_id"].map(lambda i: i == i and i < 400 and zlib.crc32(str(int(i)).encode()) % 3 == 1)]
    assert (held["predicted"] == (held["doc_id"] % 4 == 0)).mean() > 0.97
    assert (got[got["doc_id"].isin([900, 901, 902])]["predicted"] == 0).all()
    model = toxicity.train(none, marks.limit(0))
    assert toxicity.score(docs.limit(5), model).count() == 5


# 10 Packing -------------------------------------------------------------------------------------------------------

def check_sequences(got, size):
    got = got.sort_values(["sequence_id", "offset"])
    assert ((got.groupby("sequence_id")["length"].cumsum() - got["length"]) == got["offset"]).all()
    assert got.groupby("sequence_id")["length"].sum().max() <= size


def test_pack_documents(docs, corpus, none):
    got = packing.pack_documents(docs, 128).toPandas()
    check_sequences(got, 128)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total, want = 0, []
    for r in corpus:
        ids = np.array(own.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        total += len(ids)
        cut = len(ids) % 128 or 128
        for k, lo in enumerate([0, *range(cut, len(ids), 128)]):
            part = ids[lo:cut] if not lo else ids[lo:lo + 128]
            want.append((-1 if r[0] is None else r[0], k, lo, len(part), zlib.crc32(part.tobytes())))
    rows = got.fillna(-1)[["doc_id", "piece", "start", "length", "ids_crc32"]].astype(int)
    assert sorted(map(tuple, rows.values.tolist())) == sorted(want)
    assert got["sequence_id"].nunique() <= 1.05 * total / 128 + 1
    assert packing.pack_documents(none, 128).count() == 0


def test_pack_in_rounds(spark):
    """Small groups need several rounds; pieces longer than half a sequence can't be joined, and the rounds end."""
    rng = random.Random(2)
    items = spark.createDataFrame([(i, rng.randint(1, 60)) for i in range(3000)], "id int, length bigint")
    got = packing.pack(items, 64, group=100).toPandas()
    check_sequences(got, 64)
    assert len(got) == 3000 and got["id"].nunique() == 3000
    # Groups of a hundred and sequences of 64 lose a few per cent against best fit over all at once.
    assert got["sequence_id"].nunique() <= 1.05 * len(packing.best_fit(items.toPandas()["length"].tolist(), 64))
    long = spark.createDataFrame([(i, 40) for i in range(500)], "id int, length bigint")
    assert packing.pack(long, 64, group=50).select("sequence_id").distinct().count() == 500


def test_encode_equals_the_tokenizer():
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    texts = ["", "a<|endoftext|>b", "naïve  façade\n\n\tx 12,000's", "日本", "x" * 3000, "\x85\xa0  x"]
    texts += ["".join(rng.choice("ab ñß'st 1\n.\tÉ|<>") for _ in range(80)) for _ in range(200)]
    for t in texts:
        assert packing.encode("byte_bpe_50k", t) == own.encode(t, add_special_tokens=False).ids


# Registration -----------------------------------------------------------------------------------------------------

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_pipeline(spark):
    import os

    if not os.path.isdir(SF):
        pytest.skip("driver tables are not here")
    import corpus_pipeline

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    stage, table = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{SF}/documents.parquet")
    kept = stage["language_id"](spark, table, SF)
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for t in docs.values())
    once = stage["exact_dedup"](spark, kept, SF)
    assert {(r["doc_id"]) for r in once.collect()} == {max(i for i, t in docs.items() if t.encode().lower() == x) for x in {t.encode().lower() for t in docs.values()}}
    got = corpus_pipeline.run(spark, SF).toPandas()
    check_sequences(got, 1024)
    assert set(got["doc_id"]) <= set(docs)


def test_the_pipeline_imports_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[2]
    subprocess.run([sys.executable, "-c", "import corpus_pipeline, toxloom.llm.queries"], cwd=root, check=True)


def test_long_runs_of_one_kind(spark):
    """A million blanks, line feeds, letters or digits in one text."""
    texts = [" " * 1_000_000, "\n" * 1_000_000, "ab " + " \n\t" * 300_000 + " cd", "x" * 1_000_000, "7" * 1_000_000, "!" * 1_000_000, "ab" * 500_000 + " " * 9_999 + "z"]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for t in texts:
        assert packing.encode("byte_bpe_50k", t) == own.encode(t, add_special_tokens=False).ids
    got = packing.pack_documents(spark.createDataFrame(list(enumerate(texts[:2])), "doc_id bigint, text string"))
    sizes = {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert sizes == {0: 1_000_001, 1: 500_001}
