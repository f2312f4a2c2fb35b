"""Blocked running maximum (late rows) against a brute-force loop."""

import datetime as dt
import random

from moodtick.operators.quality import late_rows, stream_quality


def brute(rows, delay_s):
    out, hw = {}, None
    for seq, t in sorted(rows):
        out[seq] = (hw, t is not None and hw is not None and t < hw - dt.timedelta(seconds=delay_s))
        if t is not None:
            hw = t if hw is None else max(hw, t)
    return out


def test_late_rows_match_brute_force_across_blocks(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for seq in rnd.sample(range(5000), 600):
        t = None if rnd.random() < 0.05 else base + dt.timedelta(seconds=seq * 3 + rnd.randint(-300, 60))
        rows.append((seq, t))
    df = spark.createDataFrame(rows, "seq long, timestamp timestamp")
    expect = brute(rows, 60)
    for block, fanout in ((7, 3), (7, 1024), (64, 2), (1 << 20, 1024)):
        got = {r.seq: (r.high_water, r.is_late)
               for r in late_rows(df, "seq", "timestamp", "1 minute", block, fanout).collect()}
        assert got == expect, (block, fanout)


def test_stream_quality_counts(spark):
    rows = [(1, "A", 1.0, dt.datetime(2024, 1, 1, 10, 5)), (2, None, None, dt.datetime(2024, 1, 1, 10, 0)),
            (3, "A", 2.0, None)]
    df = spark.createDataFrame(rows, "seq long, ticker string, price double, timestamp timestamp")
    r = stream_quality(df, "prices", "price", "seq").first()
    assert (r.n_rows, r.null_ticker, r.null_time, r.null_value, r.late_rows) == (3, 1, 1, 1, 1)
