"""Stream behaviour: closed windows only, late data, bounded join state,
silent stream, restart and failure recovery. Each input file is one micro-batch
(maxFilesPerTrigger=1, files written in order)."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from moodtick.config import Config
from moodtick.functions.sentiment import TEST_LEXICON
from moodtick.operators.windows import price_window_metrics
from moodtick.plans.pipeline import correlate
from moodtick.operators.shape import shape_metrics
from moodtick.sinks.parquet_table import KeyedParquetTable
from moodtick.streaming import pipeline as SP
from moodtick.streaming.progress import dropped_by_watermark, state_rows, watermark

CFG = Config()  # 1 minute window, 1 minute delay
TICK_SCHEMA = "ticker string, price double, timestamp timestamp"
TEXT_SCHEMA = "ticker string, headline string, source string, timestamp timestamp"


def ts(s):
    return dt.datetime.fromisoformat(f"2026-09-10 {s}")


def write_batches(spark, root, batches, schema):
    """One Parquet file per batch, written in order (modification time = read order)."""
    os.makedirs(root, exist_ok=True)
    for i, rows in enumerate(batches):
        d = f"{root}/_b{i:03d}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(d)
        f = [x for x in os.listdir(d) if x.endswith(".parquet")][0]
        os.rename(f"{d}/{f}", f"{root}/b{i:03d}.parquet")
        time.sleep(0.05)


def stream_of(spark, root, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(root)


def run_to_memory(df, name, checkpoint):
    q = (
        df.writeStream.outputMode("append").format("memory").queryName(name)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    assert q.exception() is None
    return q


def flat(df):
    return df.select("ticker", F.col("time_window.start").alias("start"), "price_count")


def test_window_alignment(spark):
    rows = [("A", 1.0, ts("10:00:59.999999")), ("A", 2.0, ts("10:01:00"))]
    out = flat(price_window_metrics(spark.createDataFrame(rows, TICK_SCHEMA), CFG)).orderBy("start").collect()
    assert [(r.start, r.price_count) for r in out] == [(ts("10:00:00"), 1), (ts("10:01:00"), 1)]


def test_null_time_dropped_null_ticker_grouped(spark):
    rows = [("A", 1.0, ts("10:00:01")), ("A", 2.0, None), (None, 3.0, ts("10:00:02"))]
    out = flat(price_window_metrics(spark.createDataFrame(rows, TICK_SCHEMA), CFG)).collect()
    assert sorted((r.ticker or "", r.price_count) for r in out) == [("", 1), ("A", 1)]


def test_late_row_dropped_after_extra_batch(spark, scratch):
    batches = [
        [("A", 1.0, ts("10:00:05"))],
        [("A", 1.0, ts("10:05:00"))],
        [("A", 1.0, ts("10:05:10"))],
        [("A", 1.0, ts("10:00:30")), ("A", 1.0, ts("10:04:30"))],
        [("A", 1.0, ts("10:20:00"))],
    ]
    write_batches(spark, f"{scratch}/in", batches, TICK_SCHEMA)
    q = run_to_memory(flat(price_window_metrics(stream_of(spark, f"{scratch}/in", TICK_SCHEMA), CFG)),
                      "late1", f"{scratch}/ck")
    got = sorted((r.start, r.price_count) for r in spark.table("late1").collect())
    assert got == [(ts("10:00:00"), 1), (ts("10:04:00"), 1), (ts("10:05:00"), 2)]
    assert sum(dropped_by_watermark(p) for p in q.recentProgress) == 1


def test_late_row_kept_when_watermark_is_fresh(spark, scratch):
    batches = [
        [("A", 1.0, ts("10:00:05"))],
        [("A", 1.0, ts("10:05:00"))],
        [("A", 1.0, ts("10:00:30"))],
        [("A", 1.0, ts("10:20:00"))],
    ]
    write_batches(spark, f"{scratch}/in", batches, TICK_SCHEMA)
    run_to_memory(flat(price_window_metrics(stream_of(spark, f"{scratch}/in", TICK_SCHEMA), CFG)),
                  "late2", f"{scratch}/ck")
    got = dict((r.start, r.price_count) for r in spark.table("late2").collect())
    assert got[ts("10:00:00")] == 2


def minute_batches(tickers=("A", "B", "C"), minutes=range(8)):
    prices, texts = [], []
    for m in minutes:
        p, t = [], []
        for tk in tickers:
            for s in (5, 35):
                at = ts(f"10:{m:02d}:{s:02d}")
                p.append((tk, 100.0 + m, at))
                t.append((tk, "this is good" if m % 2 else "from bad", "src", at))
        prices.append(p)
        texts.append(t)
    return prices, texts


def test_join_emits_closed_windows_and_keeps_no_join_state(spark, scratch):
    prices, texts = minute_batches()
    write_batches(spark, f"{scratch}/p", prices, TICK_SCHEMA)
    write_batches(spark, f"{scratch}/t", texts, TEXT_SCHEMA)
    joined = shape_metrics(correlate(stream_of(spark, f"{scratch}/p", TICK_SCHEMA),
                                     stream_of(spark, f"{scratch}/t", TEXT_SCHEMA), TEST_LEXICON, CFG))
    q = run_to_memory(joined, "joined1", f"{scratch}/ck")
    got = spark.table("joined1")
    starts = sorted({r.window_start for r in got.select("window_start").collect()})
    assert starts == [dt.datetime(2026, 9, 10, 10, m) for m in range(6)]
    assert got.count() == 18 and got.where("price_count != 2 OR headline_count != 2").count() == 0
    progress = q.recentProgress
    assert watermark(progress[-1]).startswith("2026-09-10T10:06:35")
    assert max(state_rows(p, "symmetricHashJoin") for p in progress) == 0


def test_silent_stream_emits_nothing(spark, scratch):
    prices, _ = minute_batches()
    write_batches(spark, f"{scratch}/p", prices, TICK_SCHEMA)
    os.makedirs(f"{scratch}/t")
    joined = correlate(stream_of(spark, f"{scratch}/p", TICK_SCHEMA), stream_of(spark, f"{scratch}/t", TEXT_SCHEMA),
                       TEST_LEXICON, CFG)
    run_to_memory(flat(joined), "silent1", f"{scratch}/ck")
    assert spark.table("silent1").count() == 0


def test_restart_and_failed_batch_lose_nothing(spark, scratch):
    prices, texts = minute_batches()
    # first half of the input, with a sink that fails on its first call
    write_batches(spark, f"{scratch}/p", prices[:4], TICK_SCHEMA)
    write_batches(spark, f"{scratch}/t", texts[:4], TEXT_SCHEMA)
    table = KeyedParquetTable(spark, f"{scratch}/table", granularity="hour")
    failed = {"done": False}

    def flaky(df, epoch):
        if not failed["done"] and not df.isEmpty():
            failed["done"] = True
            raise RuntimeError("sink unavailable")
        table.merge(df, epoch)

    def build():
        return shape_metrics(correlate(stream_of(spark, f"{scratch}/p", TICK_SCHEMA),
                                       stream_of(spark, f"{scratch}/t", TEXT_SCHEMA), TEST_LEXICON, CFG))

    q = SP.start(build(), flaky, f"{scratch}/ck", name="flaky", trigger={"availableNow": True})
    with pytest.raises(Exception):
        q.awaitTermination()
    assert failed["done"] and table.current() is None
    # restart after the failure: the failed batch is replayed
    q = SP.start(build(), table.foreach_batch(), f"{scratch}/ck", name="again", trigger={"availableNow": True})
    q.awaitTermination()
    # more input arrives; restart from the same checkpoint
    write_batches(spark, f"{scratch}/p2", prices[4:], TICK_SCHEMA)
    for i, f in enumerate(sorted(os.listdir(f"{scratch}/p2"))):
        if f.endswith(".parquet"):
            os.rename(f"{scratch}/p2/{f}", f"{scratch}/p/c{i:03d}.parquet")
    write_batches(spark, f"{scratch}/t2", texts[4:], TEXT_SCHEMA)
    for i, f in enumerate(sorted(os.listdir(f"{scratch}/t2"))):
        if f.endswith(".parquet"):
            os.rename(f"{scratch}/t2/{f}", f"{scratch}/t/c{i:03d}.parquet")
    q = SP.start(build(), table.foreach_batch(vacuum_every=1), f"{scratch}/ck", name="again2",
                 trigger={"availableNow": True})
    q.awaitTermination()
    got = table.read()
    starts = sorted({r.window_start for r in got.select("window_start").collect()})
    assert starts == [dt.datetime(2026, 9, 10, 10, m) for m in range(6)]
    assert got.count() == 18


def test_progress_listener_counts_late_rows(spark, scratch):
    from moodtick.streaming.progress import ProgressLog

    batches = [
        [("A", 1.0, ts("10:00:05"))],
        [("A", 1.0, ts("10:05:00"))],
        [("A", 1.0, ts("10:05:10"))],
        [("A", 1.0, ts("10:00:30"))],
    ]
    write_batches(spark, f"{scratch}/in", batches, TICK_SCHEMA)
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        q = run_to_memory(flat(price_window_metrics(stream_of(spark, f"{scratch}/in", TICK_SCHEMA), CFG)),
                          "late3", f"{scratch}/ck")
        deadline = time.time() + 20
        while len([r for r in log.records if r["id"] == str(q.id)]) < len(q.recentProgress) and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert log.late_rows() == 1


def test_join_with_rocksdb_state_store(spark, scratch):
    prices, texts = minute_batches(minutes=range(4))
    write_batches(spark, f"{scratch}/p", prices, TICK_SCHEMA)
    write_batches(spark, f"{scratch}/t", texts, TEXT_SCHEMA)
    key = "spark.sql.streaming.stateStore.providerClass"
    prev = spark.conf.get(key)
    SP.use_rocksdb_state(spark)
    try:
        joined = shape_metrics(correlate(stream_of(spark, f"{scratch}/p", TICK_SCHEMA),
                                         stream_of(spark, f"{scratch}/t", TEXT_SCHEMA), TEST_LEXICON, CFG))
        q = run_to_memory(joined, "rocks1", f"{scratch}/ck")
    finally:
        spark.conf.set(key, prev)
    assert spark.table("rocks1").count() == 6  # windows 10:00, 10:01 for 3 tickers
    metrics = [k for p in q.recentProgress for op in p["stateOperators"] for k in (op.get("customMetrics") or {})]
    assert any(k.startswith("rocksdb") for k in metrics), metrics


def test_topic_files_round_trip(spark, scratch):
    from moodtick.operators.parse import encode_price_event, parse_prices
    from moodtick.sinks.topic import write_topic
    from moodtick.sources.envelope import read_envelope

    prices, _ = minute_batches(minutes=range(2))
    ticks = spark.createDataFrame([r for b in prices for r in b], TICK_SCHEMA)
    write_topic(encode_price_event(ticks, "stock_prices"), fmt="files", path=f"{scratch}/topic")
    back = parse_prices(read_envelope(spark, "stock_prices", fmt="files", path=f"{scratch}/topic", stream=False))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ticks.collect()))


def test_two_named_console_queries_and_await_all(spark, scratch):
    from moodtick.operators.parse import parse_prices, parse_texts, to_envelope, encode_price_event, encode_text_event

    prices, texts = minute_batches(minutes=range(2))
    pt = spark.createDataFrame([r for b in prices for r in b], TICK_SCHEMA)
    tt = spark.createDataFrame([r for b in texts for r in b], TEXT_SCHEMA)
    to_envelope(encode_price_event(pt, "stock_prices")).write.parquet(f"{scratch}/p")
    to_envelope(encode_text_event(tt, "stock_texts")).write.parquet(f"{scratch}/t")
    from moodtick.sources.envelope import read_envelope

    qp = SP.to_console(parse_prices(read_envelope(spark, "stock_prices", fmt="files", path=f"{scratch}/p")),
                       "prices_stream", 5, f"{scratch}/ckp", trigger={"availableNow": True})
    qt = SP.to_console(parse_texts(read_envelope(spark, "stock_texts", fmt="files", path=f"{scratch}/t")),
                       "texts_stream", 5, f"{scratch}/ckt", trigger={"availableNow": True})
    SP.await_all(spark, [qp, qt])
    qp.awaitTermination()
    qt.awaitTermination()
    assert qp.name == "prices_stream" and qt.name == "texts_stream"
    assert sum(p["numInputRows"] for p in qp.recentProgress) == 12
    assert sum(p["numInputRows"] for p in qt.recentProgress) == 12


@pytest.mark.parametrize("stage", ["parsed", "scored", "joined"])
def test_console_verification_stages(spark, scratch, stage):
    from moodtick.operators.parse import encode_price_event, encode_text_event, to_envelope
    from moodtick.plans.verify import start_verification
    from moodtick.sources.envelope import read_envelope

    prices, texts = minute_batches(minutes=range(3))
    pt = spark.createDataFrame([r for b in prices for r in b], TICK_SCHEMA)
    tt = spark.createDataFrame([r for b in texts for r in b], TEXT_SCHEMA)
    to_envelope(encode_price_event(pt, "stock_prices")).write.parquet(f"{scratch}/p")
    to_envelope(encode_text_event(tt, "stock_texts")).write.parquet(f"{scratch}/t")
    qs = start_verification(read_envelope(spark, "stock_prices", fmt="files", path=f"{scratch}/p"),
                            read_envelope(spark, "stock_texts", fmt="files", path=f"{scratch}/t"),
                            TEST_LEXICON, stage, CFG, f"{scratch}/ck", trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None and q.recentProgress
    assert len(qs) == (1 if stage == "joined" else 2)
