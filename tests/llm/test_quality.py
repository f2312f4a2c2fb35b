import math
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from moodtick.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = list(zip(words, words[1:], words[2:]))
    count, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            hit |= {i, i + 1, i + 2}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
        n < 50 or 100 * len(hit) > 50 * n,
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts(spark, edge):
    docs = edge.drop("fp", "IDS").unionByName(
        spark.createDataFrame([(9, "a b c a b c a b\n#*\n\n#*\n \n", "en"), (10, "x " * 60, "en")], "doc_id long, text string, lang string")
    )
    rows = quality.base(docs).select("text", *COLUMNS).collect()
    assert len(rows) == 11
    for r in rows:
        assert tuple(r)[1:] == plain(r.text)


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (10, 3, 0.25), (500, 2, 0.0125), (90_000, 900, 0.0125), (1000, 1000, 0.5)])
def test_binomial_tail_is_exact(spark, n, k, p):
    q = Fraction(p)
    if n <= 1000:
        want = float(sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
    else:
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        want = math.fsum(map(math.exp, terms))
    got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    assert got == pytest.approx(want, rel=1e-6)


def labelled(spark, n=4000):
    """Good texts with few symbols, one in a hundred with many; bad ones full of them; a small stratum."""
    symbols = F.when(F.col("id") % 5 == 0, 30).when(F.col("id") % 400 == 1, 20).otherwise(0)
    text = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), (F.col("id") * 61 + i).cast("string"))), " "), F.repeat(F.lit(" #"), symbols))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") % 97 == 0, "xx").otherwise("en").alias("lang"))
    return docs, docs.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality"))


def test_cutoffs_keep_their_risk(spark):
    docs, labels = labelled(spark)
    measured = quality._measured(docs, "doc_id", "lang", "text")
    rows = quality.calibrate(measured, labels, "stratum").collect()
    assert {r.stratum for r in rows} == {"en"}  # too few labels for the other stratum
    assert "symbols" in {r.rule for r in rows}
    assert all(r.n_rejected <= r.n_good * quality.RISK / len(quality.RULES) for r in rows)
    found = quality.judged(docs, labels)
    kept = {x.doc_id for x in found.where("kept").collect()}
    bad = {i for i in range(4000) if i % 5 == 0 and i % 97}
    assert not kept & bad and {i for i in range(4000) if i % 97 == 0} <= kept
    assert {x.doc_id for x in quality.accepted(docs, labels).collect()} == kept
    p = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in p and "Arrow" not in p


def test_no_labels_and_conflicting_labels(spark, edge, no_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judged(edge, none).where("kept <> (NOT base_failed)").count() == 0
    twice = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], "doc_id long, quality int")
    assert quality.judged(edge, twice).count() == edge.count()
    assert quality.accepted(edge, twice).columns == edge.columns
    assert quality.judged(no_rows, twice).count() == 0
