"""Position rules of the scorer against a plain loop."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from moodtick.config import Config
from moodtick.functions.rules import Rules, rule_sum, score_rules

LEX = {"good": 2.0, "bad": -1.5, "great": 3.0, "can't": -1.0}
RULES = Rules(negations=frozenset({"not", "no"}), boosters={"very": 1, "barely": -1, "good": 1}, contrast=frozenset({"but", "yet"}))


def plain(text, r=RULES):
    words = [w for w in re.split("[^a-z]+", text) if w]
    turns = [i for i, w in enumerate(words) if w in r.contrast]
    total = 0.0
    for i, w in enumerate(words):
        v = LEX.get(w, 0.0)
        if not v:
            continue
        before = words[max(0, i - 3) : i][::-1]
        push = sum(r.boosters.get(x, 0) * r.boost * f for x, f in zip(before, r.fading) if not LEX.get(x))
        v += math.copysign(1, v) * push
        if any(x in r.negations for x in before):
            v *= r.negated
        if turns and i != turns[0]:
            v *= r.before_contrast if i < turns[0] else r.behind_contrast
        total += v
    marks, asks = min(text.count("!"), 4) * r.exclamation, text.count("?")
    marks += 0 if asks < 2 else asks * r.question if asks <= 3 else r.most_questions
    return total + (math.copysign(marks, total) if total else 0.0)


def test_rules_against_a_plain_loop(spark):
    rng = random.Random(9)
    words = ["good", "bad", "great", "not", "no", "very", "barely", "but", "yet", "x", "can't", "y"]
    texts = ["", "!!!", "good", "very", "not very good", "good but bad!", "bad????"]
    texts += [" ".join(rng.choice(words) + rng.choice(["", "", "!", "?", ",", " -"]) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", rule_sum(F.col("t"), LEX, RULES).alias("m"), score_rules("t", LEX, RULES).alias("s")).collect():
        m = plain(texts[r.i])
        assert r.m == pytest.approx(m, abs=1e-12), texts[r.i]
        assert r.s == pytest.approx(m / math.sqrt(m * m + 15), abs=6e-5)


def test_null_texts_and_empty_lists(spark):
    df = spark.createDataFrame([(None,), ("good not good",)], "t string")
    none = Rules(negations=frozenset(), boosters={}, contrast=frozenset())
    assert [r[0] for r in df.select(rule_sum(F.col("t"), {"good": 1.0, "none": 5.0}, none)).collect()] == [5.0, 2.0]
    assert df.select(score_rules("t", LEX, RULES, Config(null_policy="skip"))).first()[0] is None
