"""Goldens for cleaning, scoring, labels, correlation, rounding."""

import math

import pytest
from pyspark.sql import functions as F

from moodtick.config import Config
from moodtick.functions import labels as L
from moodtick.functions import sentiment as S
from moodtick.functions.sentiment import TEST_LEXICON, score_column, valence_sum
from moodtick.functions.stats import safe_corr
from moodtick.functions.text import clean_text


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_collapses_whitespace_without_trim(spark):
    assert one(spark, clean_text("x"), "A  B\t c ") == "a b c "
    assert one(spark, clean_text("x"), "Line\none\r\n\ttwo") == "line one two"
    assert one(spark, clean_text("x"), None) is None


def test_score_sum_and_normalisation(spark):
    # 'this' 2.0 + 'that' 1.5 + 'from' -2.5 = 1.0  ->  1/sqrt(16) = 0.25
    assert one(spark, score_column(F.col("x"), TEST_LEXICON), "this, that... from!") == 0.25
    # unknown words and punctuation score 0
    assert one(spark, score_column(F.col("x"), TEST_LEXICON), "nothing here") == 0.0
    m = 2.0 * 3
    assert one(spark, score_column(F.col("x"), TEST_LEXICON), "this this this") == round(m / math.sqrt(m * m + 15), 4)


def test_caps_rule_cannot_fire_after_lowercasing(spark):
    a = one(spark, score_column(clean_text("x"), TEST_LEXICON), "THIS")
    b = one(spark, score_column(clean_text("x"), TEST_LEXICON), "this")
    assert a == b


def test_null_headline_policy(spark):
    # default: NULL is scored as the text 'none' -> 0.0, and enters averages
    assert one(spark, score_column(clean_text("x"), TEST_LEXICON), None) == 0.0
    lex = dict(TEST_LEXICON, none=-1.0)
    assert one(spark, score_column(clean_text("x"), lex), None) == round(-1 / math.sqrt(16), 4)
    # skip: NULL stays NULL
    assert one(spark, score_column(clean_text("x"), TEST_LEXICON, Config(null_policy="skip")), None) is None


def test_null_headline_enters_average_not_count(spark):
    from moodtick.operators.windows import clean_and_score, sentiment_window_metrics

    rows = [("A", "this", "2024-01-01 10:00:01"), ("A", None, "2024-01-01 10:00:02")]
    df = spark.createDataFrame(rows, "ticker string, headline string, ts string").select(
        "ticker", "headline", F.to_timestamp("ts").alias("timestamp")
    )
    out = sentiment_window_metrics(clean_and_score(df, TEST_LEXICON), Config()).first()
    assert out["headline_count"] == 1
    assert out["avg_sentiment"] == pytest.approx((round(2 / math.sqrt(19), 4) + 0.0) / 2)


def test_valence_sum_map_is_literal(spark):
    df = spark.createDataFrame([("this",)], "x string").select(valence_sum(F.col("x"), TEST_LEXICON).alias("m"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize(
    "score,label5,label3",
    [
        (0.05, "Neutral", "neutral"),
        (0.0501, "Positive", "positive"),
        (0.1, "Positive", "positive"),
        (0.1001, "Very Positive", "positive"),
        (-0.05, "Neutral", "neutral"),
        (-0.0501, "Negative", "negative"),
        (-0.1, "Negative", "negative"),
        (-0.1001, "Very Negative", "negative"),
        (None, "Neutral", "neutral"),
    ],
)
def test_sentiment_label_boundaries(spark, score, label5, label3):
    assert one(spark, L.sentiment5("x"), score, "x double") == label5
    assert one(spark, L.sentiment3("x"), score, "x double") == label3


@pytest.mark.parametrize(
    "r,label",
    [(0.5, "Weak"), (0.51, "Strong positive"), (-0.5, "Weak"), (-0.51, "Strong negative"), (None, "Weak")],
)
def test_correlation_label_boundaries(spark, r, label):
    assert one(spark, L.correlation_label("x"), r, "x double") == label


def corr_of(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    return df.agg(safe_corr("a", "b").alias("c")).first()["c"]


def test_safe_corr_ignores_incomplete_pairs(spark):
    c = corr_of(spark, [(1.0, 2.0), (3.0, 4.0), (4.0, 1.0), (2.0, None)])
    assert c == pytest.approx(-0.142857, abs=1e-6)


def test_safe_corr_constant_series_is_null(spark):
    assert corr_of(spark, [(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)]) is None
    assert corr_of(spark, [(1.0, 2.0)]) is None


def test_round_ties_follow_half_up(spark):
    # Spark's round is HALF_UP on the decimal form (Python's round would give 2.67 / 0.12)
    assert one(spark, F.round("x", 2), 2.675, "x double") == 2.68
    assert one(spark, F.round("x", 2), 0.125, "x double") == 0.13


def big_lexicon(n=3000, seed=3):
    import random
    import string

    rnd = random.Random(seed)
    lex = {"".join(rnd.choice(string.ascii_lowercase) for _ in range(rnd.randint(2, 6))): round(rnd.uniform(-3, 3), 1)
           for _ in range(n)}
    lex.update(TEST_LEXICON)
    return lex


def test_three_scoring_forms_agree_on_large_lexicon(spark):
    from conftest import SF001
    from moodtick.functions import sentiment as S
    from moodtick.sources import tables

    lex = big_lexicon()
    h = tables.headlines(spark, SF001).select("doc_id", clean_text("headline").alias("c"))
    h = h.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, c string"))
    a = h.select("doc_id", S.score_column(F.col("c"), lex).alias("a"))
    b = h.select("doc_id", S.scorer(spark, lex)(F.col("c")).alias("b"))
    c = S.score_by_join(h, ["doc_id"], "c", S.lexicon_frame(spark, lex)).withColumnRenamed("sentiment_score", "c")
    j = a.join(b, "doc_id").join(c, "doc_id")
    assert j.count() == 202
    assert j.where(~F.col("a").eqNullSafe(F.col("b")) | ~F.col("a").eqNullSafe(F.col("c"))).count() == 0
    assert j.where("a != 0").count() > 50
    # the large lexicon takes the vectorised path, the small one the map path
    assert "ArrowEvalPython" in h.select(S.scorer(spark, lex)(F.col("c")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in h.select(S.scorer(spark, TEST_LEXICON)(F.col("c")))._jdf.queryExecution().executedPlan().toString()


def test_vectorised_skip_policy_keeps_null(spark):
    from moodtick.functions import sentiment as S

    lex = big_lexicon()
    cfg = Config(null_policy="skip")
    df = spark.createDataFrame([(None,), ("this",)], "c string")
    got = [r.s for r in df.select(S.scorer(spark, lex, cfg)(F.col("c")).alias("s")).collect()]
    assert got[0] is None and got[1] == round(2 / math.sqrt(19), 4)


def test_join_form_shuffle_path_equals_broadcast_path(spark):
    from conftest import SF001
    from moodtick.functions import sentiment as S
    from moodtick.sources import tables

    lex = big_lexicon(500)
    h = tables.headlines(spark, SF001).select("doc_id", clean_text("headline").alias("c"))
    h = h.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, c string"))
    lf = S.lexicon_frame(spark, lex)
    for cfg in (Config(), Config(null_policy="skip")):
        a = S.score_by_join(h, ["doc_id"], "c", lf, cfg).withColumnRenamed("sentiment_score", "a")
        b = S.score_by_join(h, ["doc_id"], "c", lf, cfg, max_broadcast_rows=0 if cfg.null_policy == "skip" else 1000, max_broadcast_bytes=0).withColumnRenamed("sentiment_score", "b")
        j = a.join(b, "doc_id", "full")
        assert j.count() == 202 and j.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
        null_row = j.where("doc_id = -1").first()
        assert (null_row.a is None) == (cfg.null_policy == "skip")


def test_vectorised_chunks_bound_text_per_step(spark, monkeypatch):
    import pandas as pd

    from moodtick.functions import sentiment as S

    assert list(S._chunks(pd.Series([3, 3, 3, 10, 1]), 6)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert list(S._chunks(pd.Series([], dtype="int64"), 6)) == []
    # a tiny chunk limit must give the same scores as one chunk per batch
    lex = big_lexicon(200)
    df = spark.createDataFrame([("this that " * 50,), ("from with",), (None,), ("",)], "c string")
    want = [r.s for r in df.select(S.scorer(spark, lex)(F.col("c")).alias("s")).collect()]
    monkeypatch.setattr(S, "VECTOR_CHUNK_CHARS", 5)
    got = [r.s for r in df.select(S.scorer(spark, lex)(F.col("c")).alias("s")).collect()]
    assert got == want and want[0] == round((3.5 * 50) / math.sqrt((3.5 * 50) ** 2 + 15), 4)


def test_trie_pattern_matches_whole_tokens_only():
    import re

    from moodtick.functions.sentiment import _word_pattern

    words = ["a", "an", "and", "the", "then", "th", "with"]
    pat = re.compile(_word_pattern(words))
    text = "a an and andy the then th thx xthe with2with-with"
    expect = [t for t in re.split("[^a-z]+", text) if t in words]
    assert [m.group(1) for m in pat.finditer(text)] == expect


def test_every_scoring_form_checks_the_lexicon_alike(spark):
    import pytest

    for form in (lambda x: S.valence_sum(F.col("c"), x), lambda x: S.lexicon_frame(spark, x), lambda x: S.vectorised_valence_sum(spark, x)):
        with pytest.raises(ValueError):
            form({"Good": 1, "good": 2})
        form({"": 1, "don't": -1, ":)": 2, "w00t": 1})  # no token can match these: loaded, without effect
    df = spark.createDataFrame([(1, "!good bad!"), (2, "the good, good"), (3, None)], "id long, c string")
    upper = {"Good": 1.0, "BAD": -3.0}
    a = df.select("id", S.score_column("c", upper).alias("s"))
    b = S.score_by_join(df, ["id"], "c", S.lexicon_frame(spark, upper)).select("id", F.col("sentiment_score").alias("s"))
    c = df.select("id", S.compound(S.vectorised_valence_sum(spark, upper)(F.col("c"))).alias("s"))
    got = [{r.id: r.s for r in x.collect()} for x in (a, b, c)]
    assert got[0] == got[1] == got[2] and got[0][1] < 0 < got[0][2]


def test_a_published_lexicon_loads(spark, scratch):
    """token<TAB>valence lines with apostrophes, emoticons and digits, and a line without a number."""
    lines = ["good\t1.9\t0.9\t[2, 1]", "can't\t-1.1", ":)\t2.0\t0.8", "w00t\t2.2", "BAD\t-2.5\t0.6", "no number\tx", ""]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/lexicon")
    lex = S.read_lexicon(spark, f"{scratch}/lexicon")
    assert lex == {"good": 1.9, "bad": -2.5} and sorted(lex.unmatched) == [":)", "can't", "w00t"]
    df = spark.createDataFrame([("can't be good :)",)], "c string")
    assert df.select(S.valence_sum(F.col("c"), lex)).first()[0] == 1.9
