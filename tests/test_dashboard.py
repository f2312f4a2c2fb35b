"""Dashboard analytics: scopes, KPIs on 0..3-row selections, overlay."""

import datetime as dt

import pytest

from moodtick.config import Config
from moodtick.operators import dashboard as D
from moodtick.schemas import METRICS


def series_rows(ticker, n, price=lambda i: 100.0 + i, sent=lambda i: 0.01 * i, start=dt.datetime(2024, 1, 1)):
    out = []
    for i in range(n):
        s = start + dt.timedelta(minutes=i)
        out.append((ticker, s, s + dt.timedelta(minutes=1), price(i), price(i), price(i), 1, sent(i), 2 + i))
    return out


def test_global_scope_keeps_50_in_total_per_ticker_50_each(spark):
    df = spark.createDataFrame(series_rows("A", 60) + series_rows("B", 60), METRICS)
    g = D.latest(df, Config(scope="global"))
    assert g.count() == 50
    # newest 25 minutes of both tickers (ties on window_start broken by ticker)
    assert {r.window_start for r in g.collect()} == {dt.datetime(2024, 1, 1, 0, i) for i in range(35, 60)}
    p = D.latest(df, Config(scope="per_ticker"))
    assert {r.ticker: r.n for r in p.groupBy("ticker").count().withColumnRenamed("count", "n").collect()} == {
        "A": 50,
        "B": 50,
    }


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_kpis_by_selection_size(spark, n):
    df = spark.createDataFrame(series_rows("A", n), METRICS)
    k = D.kpis_for(df, "A").first()
    assert k.total_windows == n
    if n == 0:
        assert (k.latest_price, k.latest_sentiment, k.price_delta) == (0.0, 0.0, 0.0)
        assert k.avg_volume is None
    else:
        assert k.latest_price == 100.0 + n - 1
        assert k.price_delta == (float(n - 1) if n > 1 else 0.0)
    if n:
        c = D.kpis(df).first()
        if n <= 2:
            assert c.correlation is None and c.correlation_label is None
        else:
            assert c.correlation == pytest.approx(1.0) and c.correlation_label == "Strong positive"


def test_constant_price_series_has_null_correlation(spark):
    df = spark.createDataFrame(series_rows("A", 5, price=lambda i: 7.0), METRICS)
    c = D.correlation(df).first()
    assert c.correlation is None and c.correlation_label == "Weak"


def test_overlay_scaling(spark):
    df = spark.createDataFrame(series_rows("A", 3, price=lambda i: [10.0, 20.0, 30.0][i], sent=lambda i: 0.5), METRICS)
    r = D.overlay(df).first()
    assert r.price_range == 20.0 and r.sentiment_scaled == pytest.approx(0.5 * 20 / 2 + 40 / 2)


def test_recent_keeps_last_rows_per_ticker(spark):
    df = spark.createDataFrame(series_rows("A", 15) + series_rows("B", 4), METRICS)
    r = D.recent(df, Config(recent_rows=10))
    counts = {x.ticker: x["count"] for x in r.groupBy("ticker").count().collect()}
    assert counts == {"A": 10, "B": 4}
    assert min(x.window_start for x in r.where("ticker = 'A'").collect()) == dt.datetime(2024, 1, 1, 0, 5)


def test_dashboard_view_for_one_ticker(spark):
    from moodtick.plans.dashboard import dashboard_view

    df = spark.createDataFrame(series_rows("A", 60) + series_rows("B", 60), METRICS)
    v = dashboard_view(df, "A", Config(scope="global"))
    assert [r.ticker for r in v["tickers"].collect()] == ["A", "B"]
    assert v["selected"].count() == 25  # A's share of the newest 50 (ties broken by ticker)
    k = v["kpis"].first()
    assert (k.ticker, k.total_windows, k.latest_price, k.price_delta) == ("A", 25, 159.0, 24.0)
    assert v["recent"].count() == 10 and v["correlation"].first().correlation_label == "Strong positive"


def test_dashboard_view_all_tickers(spark):
    from moodtick.plans.dashboard import dashboard_view
    from moodtick.sources.metrics import read_metrics_parquet  # noqa: F401  (reader of the stored table)

    df = spark.createDataFrame(series_rows("A", 3) + series_rows("B", 2), METRICS)
    v = dashboard_view(df, None, Config(scope="per_ticker"))
    k = {r.ticker: r for r in v["kpis"].collect()}
    assert (k["A"].total_windows, k["B"].total_windows) == (3, 2)
    assert k["B"].correlation is None and k["A"].correlation_label == "Strong positive"
