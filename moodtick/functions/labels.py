"""Threshold labels of the dashboard, as CASE expressions.

All comparisons are strict; a NULL input falls through to the last branch
(as a NaN did in the original pandas code).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and label texts.
SENTIMENT3_THRESHOLD = 0.05
SENTIMENT3 = ("positive", "negative", "neutral")
SENTIMENT5_STRONG = 0.1
SENTIMENT5_WEAK = 0.05
SENTIMENT5 = ("Very Positive", "Positive", "Very Negative", "Negative", "Neutral")
CORRELATION_THRESHOLD = 0.5
CORRELATION = ("Strong positive", "Strong negative", "Weak")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentiment3(score: Column | str) -> Column:
    s = _c(score)
    pos, neg, neu = SENTIMENT3
    return (
        F.when(s > SENTIMENT3_THRESHOLD, F.lit(pos))
        .when(s < -SENTIMENT3_THRESHOLD, F.lit(neg))
        .otherwise(F.lit(neu))
    )


def sentiment5(score: Column | str) -> Column:
    s = _c(score)
    vpos, pos, vneg, neg, neu = SENTIMENT5
    return (
        F.when(s > SENTIMENT5_STRONG, F.lit(vpos))
        .when(s > SENTIMENT5_WEAK, F.lit(pos))
        .when(s < -SENTIMENT5_STRONG, F.lit(vneg))
        .when(s < -SENTIMENT5_WEAK, F.lit(neg))
        .otherwise(F.lit(neu))
    )


def correlation_label(r: Column | str) -> Column:
    c = _c(r)
    spos, sneg, weak = CORRELATION
    return (
        F.when(c > CORRELATION_THRESHOLD, F.lit(spos))
        .when(c < -CORRELATION_THRESHOLD, F.lit(sneg))
        .otherwise(F.lit(weak))
    )
