import math
from collections import Counter

import pytest

from moodtick.llm import ngrams as N

TRAIN = ["the cat sat on the mat", "the cat ran", "a dog sat on a log", "The dog ran\tto the cat", "", None, "the cat sat on the mat", "x"] * 3 + ["rare words here", "on the other hand"]
HELD = ["the cat sat on a mat", "unseen token the dog", "", None, "the", "the the the"]


def words(t):
    return [*(t or "").encode().lower().split(), b""]


class Plain:
    def __init__(self, texts):
        self.uni, self.bi = Counter(), Counter()
        for t in texts:
            w = words(t)
            self.uni.update(w)
            self.bi.update(zip([None, *w], w))
        few = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        self.next = Counter(w for _, w in self.bi)
        self.d, self.e = N.discounts(few(self.bi)), N.discounts(few(self.next))
        self.total, self.mass = Counter(), Counter()
        for (h, _), c in self.bi.items():
            self.total[h] += c
            self.mass[h] += self.d[min(c, 3) - 1]
        self.left = sum(self.e[min(c, 3) - 1] for c in self.next.values()) / len(self.bi)

    def lower(self, w):
        c = self.next[w]
        return (c - self.e[min(c, 3) - 1] if c else 0) / len(self.bi) + self.left / (len(self.uni) + 1)

    def p(self, h, w):
        if not self.total[h]:
            return self.lower(w)
        c = self.bi[h, w]
        return ((c - self.d[min(c, 3) - 1] if c else 0) + self.mass[h] * self.lower(w)) / self.total[h]


@pytest.mark.parametrize("portion,shards", [(2_000_000, 3), (7, 5)])
def test_scores_against_brute_force(spark, monkeypatch, portion, shards):
    monkeypatch.setattr(N, "TOKENS", portion)
    train = spark.createDataFrame([(t,) for t in TRAIN], "text string")
    meta = N.train(train, shards=shards)
    plain = Plain(TRAIN)
    total, distinct = sum(plain.uni.values()), len(plain.uni)
    assert (meta.tokens, meta.vocabulary, meta.pairs) == (total, distinct, len(plain.bi))
    held = spark.createDataFrame([(i, t, "k") for i, t in enumerate([*HELD, *TRAIN[:8]])], "doc_id long, text string, tag string")
    for r in N.scored(held, meta).collect():
        w = words([*HELD, *TRAIN[:8]][r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens, r.tag) == (len(w), sum(plain.uni[x] > 0 for x in w), total, "k")
        assert r.base_score == pytest.approx(sum(math.log10((plain.uni[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w))
        assert r.score == pytest.approx(sum(math.log10(plain.p(h, x)) for h, x in zip([None, *w], w)))
    assert sum(plain.p(b"the", w) for w in plain.uni) + plain.p(b"the", b"?") == pytest.approx(1)


def test_hot_words_are_dealt_by_pair(spark):
    """One word before a third of all tokens, with many words after it."""
    texts = [" ".join(f"hot w{i * 50 + j}" for j in range(50)) for i in range(20)]
    meta = N.train(spark.createDataFrame([(t,) for t in texts], "text string"), shards=4)
    import numpy as np

    assert len(np.load(f"{meta.folder}/heads-hot.npy")) == 2  # the word and the start
    plain = Plain(texts)
    held = ["hot w3 hot w999 w5", "w7 hot unknown"]
    for r in N.scored(spark.createDataFrame([(i, t) for i, t in enumerate(held)], "doc_id long, text string"), meta).collect():
        w = words(held[r.doc_id])
        assert r.score == pytest.approx(sum(math.log10(plain.p(h, x)) for h, x in zip([None, *w], w)))


def test_no_rows(spark, edge, no_rows):
    meta = N.train(no_rows, shards=2)
    assert meta.tokens == meta.vocabulary == 0
    assert N.scored(edge.select("doc_id", "text"), meta).where("score <= 0").count() == edge.count()
    meta = N.train(edge, shards=2)
    assert N.scored(no_rows.select("doc_id", "text"), meta).count() == 0
    assert N.scored(edge.select("doc_id", "text"), meta).where("n_tokens = n_known").count() == edge.count()
    clash = N.scored(edge.selectExpr("doc_id", "text", "1 AS score", "'x' AS N_TOKENS"), meta)
    assert clash.columns == ["doc_id", "score", "N_TOKENS", "_n_tokens", "n_known", "train_tokens", "base_score", "_score"]
    assert clash.where("score = 1 AND _score <= 0").count() == edge.count()
