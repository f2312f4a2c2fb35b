"""Analyses over the metrics table (questions the result table is meant to answer).

"Previous" and "next" mean the calendar-adjacent window of the same ticker
(``window_start ∓ window length``), not the adjacent row: a gap in the series is
not mistaken for one step. ``align`` lines neighbours up in one pass: every row
is emitted under its own key and under the keys of the windows that need it,
and one ``groupBy(ticker, key)`` collects each window with its neighbours
(at most 1 + len(offsets) rows per group). Unlike ``lag`` over
``partitionBy(ticker)`` this spreads by (ticker, time), so a ticker holding a
third of all rows never lands in one task; unlike a self-join it reads the
input once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.stats import safe_corr, zscore

def step(cfg: Config) -> Column:
    return F.expr(f"INTERVAL {cfg.window}")


def nb_name(o: int) -> str:
    """Prefix of the neighbour ``o`` steps away: prev1, next2, ..."""
    return f"prev{-o}" if o < 0 else f"next{o}"


def align(metrics: DataFrame, cfg: Config, offsets, cols: list[str], keep: list[str]) -> DataFrame:
    """Rows of ``metrics`` (columns ``ticker``, ``window_start`` and ``keep``) with,
    for each offset ``o`` (non-zero, may be negative), ``<nb>_<col>`` = ``col`` of
    the window ``o`` steps away and ``has_<nb>`` = whether that window exists,
    where ``<nb>`` is ``nb_name(o)``."""
    offsets = [int(o) for o in offsets]
    tags = [0] + offsets
    shifted = F.array(
        *[
            F.struct(F.lit(t).alias("tag"), (F.col("window_start") - step(cfg) * t).alias("key"))
            for t in tags
        ]
    )
    e = metrics.select("ticker", "window_start", *sorted(set(keep) | set(cols)), F.explode(shifted).alias("_s"))
    e = e.select("*", F.col("_s.tag").alias("_tag"), F.col("_s.key").alias("_key")).drop("_s")
    own = [F.max(F.when(F.col("_tag") == 0, F.col(c))).alias(c) for c in keep]
    nb = []
    for o in offsets:
        nb.append(F.max(F.col("_tag") == o).alias(f"has_{nb_name(o)}"))
        nb += [F.max(F.when(F.col("_tag") == o, F.col(c))).alias(f"{nb_name(o)}_{c}") for c in cols]
    g = e.groupBy("ticker", "_key").agg(F.max(F.col("_tag") == 0).alias("_own"), *own, *nb)
    return g.where("_own").withColumnRenamed("_key", "window_start").drop("_own")


def direction_agreement(metrics: DataFrame, cfg: Config = DEFAULT, threshold: float = 0.05) -> DataFrame:
    """Does positive sentiment coincide with a price rise? Per ticker: windows
    with a previous window, those with a sentiment signal (|s| > threshold), and
    those where the signal's sign matches the price move."""
    m = align(metrics, cfg, [-1], ["avg_price"], ["avg_price", "avg_sentiment"]).where("has_prev1")
    move = F.signum(F.col("avg_price") - F.col("prev1_avg_price"))
    signal = F.when(F.col("avg_sentiment") > threshold, 1.0).when(F.col("avg_sentiment") < -threshold, -1.0)
    a = m.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count(signal).alias("n_signal"),
        F.sum(F.when(signal == move, 1).otherwise(0)).alias("n_agree"),
    )
    return a.select("*", F.try_divide(F.col("n_agree"), F.col("n_signal")).alias("agreement_rate"))


def negative_spikes(metrics: DataFrame, cfg: Config = DEFAULT, z: float = 2.0) -> DataFrame:
    """Windows whose sentiment lies more than ``z`` sample deviations below the
    ticker's mean, with the next window's price and whether it declined."""
    stats = metrics.groupBy("ticker").agg(
        F.avg("avg_sentiment").alias("_mean"), F.stddev_samp("avg_sentiment").alias("_sd")
    )
    m = align(metrics, cfg, [1], ["avg_price"], ["avg_price", "avg_sentiment"])
    m = m.join(stats, "ticker").withColumn("z", zscore("avg_sentiment", "_mean", "_sd"))
    spikes = m.where(F.col("z") < -z)
    return spikes.select(
        "ticker",
        "window_start",
        "avg_sentiment",
        "z",
        "avg_price",
        F.col("next1_avg_price").alias("next_price"),
        (F.col("next1_avg_price") - F.col("avg_price")).alias("price_change"),
        (F.col("next1_avg_price") < F.col("avg_price")).alias("declined"),
    )


def lag_correlation(metrics: DataFrame, cfg: Config = DEFAULT, max_lag: int = 3) -> DataFrame:
    """corr(sentiment at t, price at t + k) per ticker for k = 0..max_lag."""
    lags = list(range(1, max_lag + 1))
    m = align(metrics, cfg, lags, ["avg_price"], ["avg_price", "avg_sentiment"])
    pairs = F.array(
        F.struct(F.lit(0).alias("lag"), F.lit(True).alias("has"), F.col("avg_price").alias("future_price")),
        *[
            F.struct(F.lit(k).alias("lag"), F.col(f"has_next{k}").alias("has"), F.col(f"next{k}_avg_price").alias("future_price"))
            for k in lags
        ],
    )
    p = m.select("ticker", "avg_sentiment", F.explode(pairs).alias("_p")).select(
        "ticker", "avg_sentiment", "_p.lag", "_p.has", "_p.future_price"
    ).where("has")
    return p.groupBy("ticker", "lag").agg(
        F.count(F.lit(1)).alias("n_pairs"), safe_corr("avg_sentiment", "future_price").alias("correlation")
    )


def largest_changes(metrics: DataFrame, cfg: Config = DEFAULT, n: int = 10) -> DataFrame:
    """The ``n`` largest absolute sentiment changes between adjacent windows."""
    m = align(metrics, cfg, [-1], ["avg_sentiment"], ["avg_sentiment"]).where("has_prev1")
    ch = m.select(
        "ticker",
        "window_start",
        F.col("prev1_avg_sentiment").alias("prev_avg_sentiment"),
        "avg_sentiment",
        (F.col("avg_sentiment") - F.col("prev1_avg_sentiment")).alias("change"),
    ).withColumn("abs_change", F.abs("change"))
    return ch.orderBy(F.col("abs_change").desc(), F.col("ticker"), F.col("window_start")).limit(n)


def sentiment_by_hour(metrics: DataFrame) -> DataFrame:
    """Average sentiment by hour of day (UTC): plain mean of windows and the
    headline-weighted mean."""
    return metrics.groupBy(F.hour("window_start").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.avg("avg_sentiment").alias("avg_sentiment"),
        F.try_divide(F.sum(F.col("avg_sentiment") * F.col("headline_count")), F.sum("headline_count")).alias(
            "weighted_sentiment"
        ),
        F.sum("headline_count").alias("headlines"),
    )


def volatility(metrics: DataFrame, bucket: str = "1 day") -> DataFrame:
    """Per ticker: correlation between price volatility and sentiment volatility,
    both measured as the sample deviation within each time bucket."""
    per_bucket = metrics.groupBy("ticker", F.window("window_start", bucket).alias("bucket")).agg(
        F.stddev_samp("avg_price").alias("price_vol"),
        F.stddev_samp("avg_sentiment").alias("sentiment_vol"),
    )
    return per_bucket.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_buckets"),
        F.avg("price_vol").alias("mean_price_vol"),
        F.avg("sentiment_vol").alias("mean_sentiment_vol"),
        safe_corr("price_vol", "sentiment_vol").alias("vol_correlation"),
    )


def watchlist_compare(metrics: DataFrame, watchlist) -> DataFrame:
    """Per-ticker comparison restricted to a watchlist.

    ``watchlist`` is a list of tickers (an IN filter that Catalyst pushes down
    to the scan) or a DataFrame with a ``ticker`` column (a semi-join; the
    planner broadcasts it when AQE measures it small)."""
    if isinstance(watchlist, DataFrame):
        m = metrics.join(watchlist.select("ticker").distinct(), "ticker", "left_semi")
    else:
        m = metrics.where(F.col("ticker").isin(list(watchlist)))
    a = m.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.avg("avg_price").alias("mean_price"),
        F.avg("avg_sentiment").alias("mean_sentiment"),
        F.sum("headline_count").alias("headlines"),
        F.min_by("avg_price", "window_start").alias("_first"),
        F.max_by("avg_price", "window_start").alias("_last"),
        safe_corr("avg_price", "avg_sentiment").alias("correlation"),
    )
    return a.select(
        "ticker",
        "n_windows",
        "mean_price",
        "mean_sentiment",
        "headlines",
        F.try_divide(F.col("_last") - F.col("_first"), F.col("_first")).alias("price_return"),
        "correlation",
    )
