"""Property tests against brute-force Python models."""

import datetime as dt
import math
import re
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodtick.functions.sentiment import TEST_LEXICON, scorer, score_column
from moodtick.functions.text import clean_text
from moodtick.schemas import METRICS
from moodtick.sinks.merge import merge_frames

WORDS = list(TEST_LEXICON) + ["thatx", "xthis", "from2", "with", "THIS", "Over", "none"]
SEPS = [" ", "  ", "\t", "\n", ",", "-", "é", "2", "!", ""]

texts = st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from(SEPS)), max_size=12).map(
    lambda parts: "".join(w + s for w, s in parts)
)


def brute_score(text, lexicon, alpha=15.0):
    t = "none" if text is None else text
    toks = re.split("[^a-z]+", re.sub(r"\s+", " ", t.lower()))
    m = sum(lexicon.get(x, 0.0) for x in toks)
    v = m / math.sqrt(m * m + alpha)
    return float(Decimal(repr(v)).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=25))
def test_scorer_equals_brute_force(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    big = {**TEST_LEXICON, **{f"w{k}": 0.1 for k in range(100)}}
    out = df.select(
        "i",
        score_column(clean_text("t"), TEST_LEXICON).alias("small"),
        scorer(spark, big)(F.lower("t")).alias("large"),
    ).collect()
    for r in out:
        expect = brute_score(batch[r.i], TEST_LEXICON)
        assert r.small == expect and r.large == expect, (batch[r.i], r.small, r.large, expect)


keys = st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 5))
batches = st.lists(st.lists(st.tuples(keys, st.floats(0, 100, allow_nan=False)), max_size=8), min_size=1, max_size=4)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(batches)
def test_merge_sequence_equals_dict_model(spark, seq):
    def frame(rows):
        data = []
        for (t, h), p in rows:
            s = dt.datetime(2024, 1, 1, h)
            data.append((t, s, s + dt.timedelta(hours=1), p, p, p, 1, 0.0, 1))
        return spark.createDataFrame(data, METRICS)

    model: dict = {}
    table = frame([])
    for rows in seq:
        per_key: dict = {}
        for (t, h), p in rows:  # within a batch the greatest row wins
            per_key[(t, h)] = max(per_key.get((t, h), p), p)
        model.update(per_key)
        table = frame([((t, s.hour), r) for (t, s, r) in
                       [(x.ticker, x.window_start, x.avg_price) for x in merge_frames(table, frame(rows)).collect()]])
    got = {(r.ticker, r.window_start.hour): r.avg_price for r in table.collect()}
    assert got == model


events = st.lists(
    st.tuples(
        st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40),
        st.floats(-1e6, 1e6, allow_nan=False),
        st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2100, 1, 1)),
    ),
    min_size=1,
    max_size=20,
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(events)
def test_encode_decode_round_trip(spark, rows):
    from decimal import Decimal

    from moodtick.operators.parse import encode_price_event, encode_text_event, parse_prices, parse_texts, to_envelope

    data = [(i, f"T{i}", text, price, ts) for i, (text, price, ts) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, ticker string, headline string, price double, timestamp timestamp")
    texts = parse_texts(to_envelope(encode_text_event(df.withColumn("source", F.lit("s")), "t"))).collect()
    assert sorted((r.ticker, r.headline, r.timestamp) for r in texts) == sorted((t, h, ts) for _, t, h, _, ts in data)
    prices = {r.ticker: r.price for r in parse_prices(to_envelope(encode_price_event(df, "p"))).collect()}
    for _, t, _, p, _ in data:
        assert prices[t] == float(Decimal(repr(p)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


series = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 30), st.floats(0, 100, allow_nan=False)),
                  max_size=40)


def metrics_frame(spark, rows):
    data, seen = [], set()
    for t, h, p in rows:
        if (t, h) in seen:
            continue
        seen.add((t, h))
        s = dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
        data.append((t, s, s + dt.timedelta(hours=1), p, p, p, 1, p / 100, 1))
    return spark.createDataFrame(data, METRICS), {(t, s.hour + 24 * (s.day - 1)): p for t, s, _, p, *_ in data}


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(series)
def test_align_equals_dict_lookup(spark, rows):
    from moodtick.config import Config
    from moodtick.operators.analyses import align

    df, model = metrics_frame(spark, rows)
    got = {(r.ticker, int((r.window_start - dt.datetime(2024, 1, 1)).total_seconds() // 3600)): r
           for r in align(df, Config(window="1 hour"), [-2, 1], ["avg_price"], ["avg_price"]).collect()}
    assert set(got) == set(model)
    for (t, h), r in got.items():
        assert r.avg_price == model[(t, h)]
        assert (r.has_prev2, r.prev2_avg_price) == (((t, h - 2) in model), model.get((t, h - 2)))
        assert (r.has_next1, r.next1_avg_price) == (((t, h + 1) in model), model.get((t, h + 1)))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(series, st.integers(1, 6))
def test_latest_per_ticker_equals_sort(spark, rows, n):
    from moodtick.config import Config
    from moodtick.operators.dashboard import latest

    df, model = metrics_frame(spark, rows)
    got = sorted((r.ticker, r.window_start) for r in latest(df, Config(scope="per_ticker", latest_limit=n)).collect())
    want = []
    for t in {t for t, _ in model}:
        hours = sorted((h for tt, h in model if tt == t), reverse=True)[:n]
        want += [(t, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)) for h in hours]
    assert got == sorted(want)
    g = sorted((r.window_start, r.ticker) for r in latest(df, Config(scope="global", latest_limit=n)).collect())
    allk = sorted(((dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), t) for t, h in model),
                  key=lambda x: (-x[0].timestamp(), x[1]))[:n]
    assert g == sorted(allk)


pairs = st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5).map(float)),
                           st.one_of(st.none(), st.integers(-5, 5).map(float))), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs)
def test_safe_corr_equals_brute_force(spark, rows):
    from moodtick.functions.stats import safe_corr

    df = spark.createDataFrame(rows, "a double, b double") if rows else spark.createDataFrame([], "a double, b double")
    got = df.agg(safe_corr("a", "b").alias("c")).first().c
    full = [(a, b) for a, b in rows if a is not None and b is not None]
    n = len(full)
    want = None
    if n:
        ma, mb = sum(a for a, _ in full) / n, sum(b for _, b in full) / n
        cov = sum((a - ma) * (b - mb) for a, b in full) / n
        sa = math.sqrt(sum((a - ma) ** 2 for a, _ in full) / n)
        sb = math.sqrt(sum((b - mb) ** 2 for _, b in full) / n)
        want = cov / (sa * sb) if sa * sb else None
    if want is None:
        assert got is None
    else:
        assert got == pytest.approx(want, abs=1e-9)
