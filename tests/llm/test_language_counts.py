import numpy as np
import pytest

from toxloom.llm import language_id as L
from toxloom.llm import pieces as P


def cuts(word, of):
    """All segmentations into pieces; a character that is no piece stands alone as the unknown one."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        piece = of.get(word[:n], L.UNKNOWN if n == 1 else None)
        if piece is not None:
            for rest in cuts(word[n:], of):
                yield [piece, *rest]


def brute(words, prob, of, size):
    """Expected counts by listing all segmentations."""
    out = np.zeros(size)
    for word, n in words:
        ways = list(cuts(word, of))
        weight = np.array([np.prod(prob[w]) for w in ways])
        for w, x in zip(ways, weight / weight.sum()):
            np.add.at(out, w, n * x)
    return out


@pytest.mark.parametrize("long", [24, 3])
def test_expected_counts_against_all_segmentations(monkeypatch, long):
    monkeypatch.setattr(L, "LONG", long)
    monkeypatch.setattr(L, "AHEAD", 4)
    p = P.load()
    of = {t: i for i, t in enumerate(p.text) if p.ids[p.ids == i].size}
    words = [("the", 3), ("ention", 2), ("zzquw", 1), ("étreßé", 4), ("intthe", 2), ("字字ab", 1)]
    sums = {}
    L.add_expected([w for w, _ in words] + ["the"], ["en"] * len(words) + ["fr"], np.array([n for _, n in words] + [5]), {}, sums)
    begin = L.start_probabilities()
    assert np.allclose(sums["en"], brute(words, begin, of, len(begin))) and np.allclose(sums["fr"], brute([("the", 5)], begin, of, len(begin)))


def test_two_rounds_over_texts(spark):
    """Training over counted words equals expectation and maximisation over the words as they stand in the texts."""
    docs = [("The ention, the intthe étre", "en"), ("the THE x", "en"), ("le entre étre le", "fr"), (None, "fr"), ("und", None), ("12 !", "en")]
    names, got = L.train(spark.createDataFrame(docs, "text string, lang string").repartition(3))
    p = P.load()
    of = {t: i for i, t in enumerate(p.text) if p.ids[p.ids == i].size}
    assert names == ["en", "fr"]
    for k, name in enumerate(names):
        words = [(w, 1) for t, lang in docs if t and lang == name for w in "".join(c if c.isalpha() else " " for c in t.lower()).split()]
        prob = L.start_probabilities()
        for _ in range(L.ROUNDS):
            count = brute(words, prob, of, len(prob)) + L.SMOOTH
            prob = count / count.sum()
        assert np.allclose(got[:, k], prob)


def test_words_of_any_length():
    p, rng = P.load(), np.random.default_rng(2)
    prob = rng.random((len(p.text), 2)) + 0.01
    prob /= prob.sum(axis=0)
    word = "".join(rng.choice(list("abcdetionrsl"), 3000))
    flat, prefix, start, size, _, _ = L.distinct_words([word, "ab"])
    w = int(np.argmax(size))
    got = L.long_forward(prefix, int(start[w]), int(size[w]), np.log(prob))
    # The sums of halves can't exceed the whole's, and a plain recursion in logarithms agrees.
    of = {t: i for i, t in enumerate(p.text) if p.ids[p.ids == i].size}
    sums = [np.zeros(2)]
    for i in range(1, len(word) + 1):
        terms = [sums[i - t] + np.log(prob[of[word[i - t:i]]]) for t in range(1, min(i, p.longest) + 1) if word[i - t:i] in of]
        sums.append(np.logaddexp.reduce(terms))
    assert np.allclose(got, sums[-1])
