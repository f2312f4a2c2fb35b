"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose share of something is above a cutoff. For every
stratum (language) the cutoffs come from labelled documents: a cutoff may be used only
if the exact binomial test says that it rejects at most ``risk / number of rules`` of
the good documents of that stratum, at level ``error`` divided by the number of all
tests made (rules x cutoffs x strata). Of those allowed, the cutoff with the largest
gain (share of bad documents rejected minus share of good ones) is taken, the laxest
of equals; a rule without an allowed cutoff of positive gain stays off there. All
rules of a stratum together then reject at most ``risk`` of its good documents, in all
strata at once, with probability 1 - ``error``. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, checkpoint, clean_name

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
#: The rules: a share of 0 to 1 in per mille, out of the columns of ``base``.
RULES = {
    "symbols": "least(1000, 1000 * n_symbols div greatest(n_words, 1))",
    "duplicate_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeated_words": "1000 * n_repeat_words div greatest(n_words, 1)",
    "capitals": "1000 * n_capitals div greatest(word_chars, 1)",
}
CUTOFFS = tuple(range(25, 1000, 25))  # per mille
RISK, ERROR = 0.05, 0.05


def base(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the counts the rules use: n_words, word_chars, n_symbols,
    n_lines, n_dup_lines, n_repeat_words, n_capitals, base_failed.

    Words are runs of anything but ASCII white space; a null or empty text has none (all
    counts 0, base_failed true). Every row is counted by itself. A count whose name
    ``docs`` has already gets leading underscores."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(F.translate(t, SPACE, " " * len(SPACE)), " "), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACE, "") != "")
    w, ls, h, o, r = (clean_name(docs, x) for x in ("words", "lines", "windows", "ordered", "repeats"))
    new = {w: words, ls: lines}
    out = docs.withColumns(new)
    # windows of three words as (hash, position); equal hashes stand side by side once sorted
    n = F.size(w)
    windows = F.transform(
        F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(
            F.xxhash64(F.col(w)[i], F.col(w)[i + 1], F.col(w)[i + 2]).alias("h"), i.alias("i")
        ),
    )
    out = out.withColumn(o, F.sort_array(windows))
    size = F.size(o)
    again = F.filter(
        F.col(o),
        lambda x, i: ((i > 0) & (F.col(o)[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]))
        | ((i < size - 1) & (F.col(o)[F.least(i + 1, size - 1)]["h"] == x["h"])),
    )
    out = out.withColumn(r, F.sort_array(F.transform(again, lambda x: x["i"])))
    last = F.size(r) - 1
    covered = F.aggregate(
        F.transform(
            F.col(r),
            lambda x, i: F.when(i == last, F.lit(3)).otherwise(F.least(F.lit(3), F.col(r)[F.least(i + 1, last)] - x)),
        ),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    counts = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.translate(t, SPACE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size(ls).cast("long"),
        "n_dup_lines": (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        "n_repeat_words": covered,
        "n_capitals": (F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"),
    }
    names = {k: clean_name(docs, k) for k in counts}
    out = out.select(*docs.columns, *(v.alias(names[k]) for k, v in counts.items()))
    failed = (F.col(names["n_words"]) < MIN_WORDS) | (
        100 * F.col(names["n_repeat_words"]) > MAX_REPEATED * F.col(names["n_words"])
    )
    return out.withColumn(clean_name(docs, "base_failed"), failed)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p), exactly: the terms from one to the next by their
    ratio, kept as logarithms so that large n do not underflow."""
    import math

    odds, none = math.log(p) - math.log1p(-p), math.log1p(-p)
    start = F.struct((n * none).alias("term"), (n * none).alias("sum"))

    def add(s, i):
        term = s["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(s["sum"], term), F.least(s["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), start, add)
    return F.when(k <= 0, F.exp(n * none)).otherwise(F.exp(total["sum"]))


def calibrate(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, error: float = ERROR, cutoffs=CUTOFFS, doc_id: str = "doc_id", good: str = "quality") -> DataFrame:
    """The cutoff of each stratum and rule: stratum, rule, cutoff (a document above it is
    rejected), n_good, n_rejected, p_value. ``measured`` has a column per rule.

    Only documents with one undisputed label count; a document whose labels differ, a
    null label and a null doc_id are left out. A null stratum is a stratum of its own.
    Without labels there are no cutoffs."""
    label = labels.where(F.col(doc_id).isNotNull() & F.col(good).isNotNull()).groupBy(doc_id).agg(
        F.min(good).alias("low"), F.max(good).alias("high")
    ).where("low = high").select(F.col(doc_id).alias("id"), (F.col("low") > 0).alias("good"))
    held = measured.join(label, measured[doc_id] == label["id"]).select(
        F.col(stratum).alias("stratum"), "good", F.explode(F.create_map(*(x for r in RULES for x in (F.lit(r), F.col(r))))).alias("rule", "share")
    )
    # the number of cutoffs below a share, then how many documents are above each cutoff
    step = held.withColumn("above", F.lit(0) + sum((F.col("share") > c).cast("int") for c in cutoffs))
    counts = step.groupBy("stratum", "rule", "above").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    hist = counts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), F.collect_list(F.struct("above", "good", "bad")).alias("hist")
    )  # at most one entry for each cutoff and one
    hist = checkpoint(hist)  # a row for each stratum and rule
    tests = max(1, hist.count() * len(cutoffs))

    def above(kind):
        return F.aggregate(
            "hist",
            F.lit(0).cast("long"),
            lambda a, x: a + F.when(x["above"] > F.col("at"), x[kind]).otherwise(F.lit(0)),
        )

    table = hist.select("*", F.posexplode(F.array(*map(F.lit, cutoffs))).alias("at", "cutoff")).select(
        "stratum", "rule", "cutoff", "n_good", "n_bad", above("good").alias("n_rejected"), above("bad").alias("n_caught")
    )
    allowed = risk / len(RULES)
    gain = F.coalesce(F.try_divide("n_caught", "n_bad"), F.lit(0.0)) - F.coalesce(F.try_divide("n_rejected", "n_good"), F.lit(0.0))
    # more than n * p rejected can't pass (the tail is then about a half or more)
    p = F.when(F.col("n_rejected") > F.col("n_good") * allowed, F.lit(1.0)).otherwise(binomial_tail(F.col("n_rejected"), F.col("n_good"), allowed))
    passed = table.withColumn("p_value", p).withColumn("gain", gain).where(
        (F.col("p_value") <= error / tests) & (F.col("gain") > 0)
    )
    best = passed.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "cutoff", "n_good", "n_rejected", "p_value")).alias("b"))
    return best.select("stratum", "rule", "b.cutoff", "b.n_good", "b.n_rejected", "b.p_value")


def _verdict(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``measured`` with ``kept``."""
    wide = cutoffs.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    wide = wide.select(F.col("stratum").alias("s"), *(F.col(r).alias(f"max_{r}") for r in RULES))
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(r) > F.col(f"max_{r}"), F.lit(False))
    # one row per stratum that has a cutoff: Spark sees the size and broadcasts it
    return (
        measured.join(wide, F.col("stratum").eqNullSafe(F.col("s")), "left")
        .withColumn("kept", ~F.col("base_failed") & ~over)
        .drop("s", *(f"max_{r}" for r in RULES))
    )


def _measured(docs: DataFrame, doc_id: str, stratum: str, text: str, *more: Column) -> DataFrame:
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.col(text).alias("text"), *more)
    return base(own).withColumns({k: F.expr(v) for k, v in RULES.items()})


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, stratum, the counts of ``base``, the shares of
    the rules, and ``kept``: false if base_failed or a rule of the row's stratum rejects it.

    ``labels`` has doc_id and quality (above 0: good). Extra columns are not read. Empty
    documents give no rows; without labels only the base rules reject. Rows with a null
    doc_id, and repeated rows, are judged like any other."""
    measured = checkpoint(_measured(docs, doc_id, stratum, text).drop("text"))
    return _verdict(measured, calibrate(measured, labels, "stratum", **limits))


def accepted(docs: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with their columns. The texts are
    measured twice (for the cutoffs, then to judge them) and never shuffled."""
    cutoffs = checkpoint(calibrate(_measured(docs, doc_id, stratum, text), labels, "stratum", **limits))
    whole = _measured(docs, doc_id, stratum, text, F.struct(*docs.columns).alias("row"))
    # not where(): a filter would be pushed below the counts and make them anew for each use
    return _verdict(whole, cutoffs).select(F.inline(F.when(F.col("kept"), F.array("row"))))
