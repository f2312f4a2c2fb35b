"""Neighbour alignment and the analyses built on it, against hand-worked rows."""

import datetime as dt

import pytest

from moodtick.config import Config
from moodtick.operators import analyses as A
from moodtick.schemas import METRICS

CFG = Config(window="1 hour")


def rows(ticker, hours, prices, sents):
    out = []
    for h, p, s in zip(hours, prices, sents):
        start = dt.datetime(2024, 1, 1, h)
        out.append((ticker, start, start + dt.timedelta(hours=1), p, p, p, 1, s, 1))
    return out


def test_align_uses_calendar_neighbours_not_rows(spark):
    # hours 0, 1, 3: hour 3 has no previous window (hour 2 missing)
    df = spark.createDataFrame(rows("A", [0, 1, 3], [1.0, 2.0, 4.0], [0.1, 0.2, 0.3]) + rows("B", [1], [9.0], [0.0]), METRICS)
    got = {(r.ticker, r.window_start.hour): r for r in A.align(df, CFG, [-1, 1], ["avg_price"], ["avg_price"]).collect()}
    assert len(got) == 4
    a0, a1, a3 = got[("A", 0)], got[("A", 1)], got[("A", 3)]
    assert (a0.has_prev1, a0.has_next1, a0.next1_avg_price) == (False, True, 2.0)
    assert (a1.prev1_avg_price, a1.next1_avg_price, a1.has_next1) == (1.0, None, False)
    assert (a3.has_prev1, a3.prev1_avg_price) == (False, None)
    assert got[("B", 1)].has_prev1 is False  # other tickers never mix


def test_direction_agreement_and_largest_changes(spark):
    df = spark.createDataFrame(rows("A", [0, 1, 2, 3], [1.0, 2.0, 1.5, 1.5], [0.0, 0.2, -0.3, 0.01]), METRICS)
    d = A.direction_agreement(df, CFG).first()
    # pairs at hours 1,2,3; signals at 1 (+, price up: agree) and 2 (-, price down: agree); hour 3 no signal
    assert (d.n_pairs, d.n_signal, d.n_agree, d.agreement_rate) == (3, 2, 2, 1.0)
    ch = A.largest_changes(df, CFG, n=2).collect()
    assert [(r.window_start.hour, round(r.change, 6)) for r in ch] == [(2, -0.5), (3, 0.31)]


def test_lag_correlation_counts_only_existing_targets(spark):
    df = spark.createDataFrame(rows("A", [0, 1, 2, 4], [1.0, 2.0, 3.0, 5.0], [0.1, 0.2, 0.3, 0.5]), METRICS)
    got = {r.lag: r for r in A.lag_correlation(df, CFG, max_lag=2).collect()}
    assert {k: v.n_pairs for k, v in got.items()} == {0: 4, 1: 2, 2: 2}
    assert got[0].correlation == pytest.approx(1.0)
