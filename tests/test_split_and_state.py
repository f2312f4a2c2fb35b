"""Rejects as a second output, replay by steps, state read back, layers, a user's scorer in the stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from moodtick.config import PRICE_TOPIC, TEXT_TOPIC, Config
from moodtick.functions.sentiment import TEST_LEXICON, model_scorer
from moodtick.operators.parse import accepted, parse_prices, parse_split, rejected, to_envelope
from moodtick.operators.windows import price_window_metrics
from moodtick.plans import catalog
from moodtick.sinks.parquet_table import KeyedParquetTable
from moodtick.sources.envelope import read_envelope
from moodtick.sources.lexicon import LexiconTable
from moodtick.sources.replay import read_steps, write_steps
from moodtick.sources.tables import ticks
from moodtick.streaming import pipeline as SP
from moodtick.streaming import split, state

NOW = {"availableNow": True}


def envelope(spark, values, topic=PRICE_TOPIC, keys=None):
    rows = [((keys or ["A"] * len(values))[i], v, topic, dt.datetime(2024, 1, 1, 10, 0, i % 60)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, timestamp timestamp")
    return to_envelope(df.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "timestamp"))


VALUES = ['{"ticker":"A","price":1.5,"timestamp":"2024-01-01T10:00:00+00:00"}', "not json", None, '{"price":2.0}', '{"k": 1}',
          '{"ticker":null,"price":3.0,"timestamp":"junk"}', "", '{"ticker":"B","price":"x","timestamp":"2024-01-01T10:00:01+00:00"}']


def test_one_parse_gives_both_outputs(spark):
    both = parse_split(envelope(spark, VALUES, keys=["A", None] * 4), "price")
    good, bad = accepted(both, "price"), rejected(both)
    assert good.exceptAll(parse_prices(envelope(spark, VALUES))).count() == 0 and good.count() == 4
    assert sorted((r.raw_value or "", r.reason) for r in bad.collect()) == [
        ("", "not an event"), ("", "null value"), ("not json", "not an event"), ('{"k": 1}', "not an event")]


def test_outputs_survive_a_failed_batch(spark, scratch, monkeypatch):
    """The second output fails once after the first is published; after the restart both
    hold every message once."""
    for k in range(3):
        envelope(spark, VALUES, keys=[None, "A"] * 4).coalesce(1).write.mode("append").parquet(f"{scratch}/topic")
    topic = read_envelope(spark, PRICE_TOPIC, fmt="files", path=f"{scratch}/topic", max_files_per_trigger=1)
    publish, calls = split.publish_batch, []

    def failing(df, folder, batch_id):
        calls.append((folder, batch_id))
        if folder.endswith("rejected") and batch_id == 1 and calls.count((folder, batch_id)) == 1:
            raise OSError("disk full")
        return publish(df, folder, batch_id)

    monkeypatch.setattr(split, "publish_batch", failing)
    q = split.start_split(topic, "price", f"{scratch}/out", f"{scratch}/checkpoint", trigger=NOW)
    with pytest.raises(Exception):
        q.awaitTermination()
    good = split.read_output(spark, f"{scratch}/out", "accepted", "price")
    assert good.count() == 8
    split.start_split(topic, "price", f"{scratch}/out", f"{scratch}/checkpoint", trigger=NOW).awaitTermination()
    assert split.read_output(spark, f"{scratch}/out", "accepted", "price").count() == 12
    assert split.read_output(spark, f"{scratch}/out", "rejected", "price").count() == 12
    assert split.read_output(spark, f"{scratch}/none", "rejected", "price").count() == 0


def test_windows_over_the_accepted_output(spark, scratch):
    envelope(spark, VALUES).write.parquet(f"{scratch}/topic")
    topic = read_envelope(spark, PRICE_TOPIC, fmt="files", path=f"{scratch}/topic")
    split.start_split(topic, "price", f"{scratch}/out", f"{scratch}/checkpoint", trigger=NOW).awaitTermination()
    stream = split.read_output(spark, f"{scratch}/out", "accepted", "price", stream=True)
    q = price_window_metrics(stream, Config()).writeStream.outputMode("complete").format("memory").queryName("accepted_windows").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("accepted_windows").agg(F.sum("price_count")).first()[0] == 1


def test_replay_takes_every_key_a_step_at_a_time(spark, scratch):
    """Six keys and none at all; a step is one micro-batch, over several files."""
    keys = ["e", "b", None, "a", "f", "c", "d"]
    env = envelope(spark, VALUES[:1] * 70, keys=[k for k in keys for _ in range(10)])
    assert write_steps(env, f"{scratch}/steps", files=3) == 7
    seen = []
    q = read_steps(spark, f"{scratch}/steps", PRICE_TOPIC, files=3).writeStream.foreachBatch(
        lambda df, i: seen.append((i, {bytes(r.key).decode() if r.key else None for r in df.collect()}, df.count()))
    ).option("checkpointLocation", f"{scratch}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    assert seen == [(i, {k}, 10) for i, k in enumerate(["a", "b", "c", "d", "e", "f", None])]


def test_state_read_back(spark, scratch):
    catalog._run_join_stream(spark, SF001, scratch)
    ops = {(r.operator, r.store) for r in state.operators(spark, f"{scratch}/checkpoint").collect()}
    assert ("stateStoreSave", "default") in ops and any(o == "symmetricHashJoin" for o, _ in ops)
    assert state.join_rows(spark, f"{scratch}/checkpoint") == 0
    from moodtick.sources.tables import headlines

    own = {"price": ticks(spark, SF001), "sentiment": headlines(spark, SF001)}
    closed = min(df.agg(F.max("timestamp")).first()[0] for df in own.values()) - dt.timedelta(minutes=1)
    open_ = state.open_windows(spark, f"{scratch}/checkpoint")
    for side, df in own.items():
        windows = df.select("ticker", F.window("timestamp", "1 minute").alias("w")).distinct().where(F.col("w.end") > F.lit(closed))
        assert open_.where(F.col("side") == side).count() == windows.count() > 0


def test_lake_reads_each_file_once_and_restarts(spark, scratch):
    """A second increment and an empty third one: rows are neither lost nor doubled."""
    from moodtick.sinks.lake import Lake

    prices, texts = catalog.price_envelope(spark, SF001), catalog.text_envelope(spark, SF001)
    lake = Lake(spark, f"{scratch}/lake", TEST_LEXICON, catalog.HOURLY)
    for half in (0, 1, None):
        for env, name in ((prices, "prices"), (texts, "texts")):
            if half is not None:
                env.where(F.pmod(F.dayofmonth("timestamp"), F.lit(2)) == half).coalesce(2).write.mode("append").parquet(f"{scratch}/{name}")
        lake.advance(*[read_envelope(spark, t, fmt="files", path=f"{scratch}/{n}") for t, n in ((PRICE_TOPIC, "prices"), (TEXT_TOPIC, "texts"))])
    layers = lake.read()
    assert layers["bronze"].count() == prices.count() + texts.count()
    assert layers["silver_prices"].count() == prices.count() and layers["silver_texts"].count() == texts.count()
    want = catalog.round_doubles(catalog.metrics_view(spark, SF001, catalog.HOURLY))
    got = catalog.round_doubles(lake.gold.read())
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_a_users_model_in_the_stream_join(spark, scratch):
    """``score=`` through both aggregates and the join, over a restart from the checkpoint."""

    def load():
        return lambda s: s.str.len().astype("float64")

    model = model_scorer(load)
    cfg = catalog.MINUTE
    write_steps(catalog.price_envelope(spark, SF001).withColumn("k", F.lit(1)), f"{scratch}/prices", key="k")
    write_steps(catalog.text_envelope(spark, SF001).withColumn("k", F.lit(1)), f"{scratch}/texts", key="k")
    table = KeyedParquetTable(spark, f"{scratch}/table")
    for _ in range(2):
        streams = read_steps(spark, f"{scratch}/prices", PRICE_TOPIC), read_steps(spark, f"{scratch}/texts", TEXT_TOPIC)
        q = SP.start(SP.correlation_stream(*streams, None, cfg, score=model), table.foreach_batch(), f"{scratch}/checkpoint",
                     name=None, trigger=NOW, cfg=cfg)
        q.awaitTermination()
        assert q.exception() is None
    from moodtick.plans import pipeline
    from moodtick.sources import tables

    whole = pipeline.metrics(ticks(spark, SF001), tables.headlines(spark, SF001), None, cfg, score=lambda c: F.length(c).cast("double"))
    keys = ["ticker", "window_start"]
    both = table.read().join(whole.select(*keys, F.col("avg_sentiment").alias("want")), keys)
    assert both.count() == table.read().count() and both.where(F.abs(F.col("avg_sentiment") - F.col("want")) > 1e-9).count() == 0


def test_lexicon_table(spark, scratch):
    t = LexiconTable(spark, f"{scratch}/lexicon")
    assert t.versions() == []
    entries = spark.createDataFrame([("Good ", 1.0), ("good", 3.0), ("can't", -1.0), (":)", 2.0), ("x", None)], "token string, valence double")
    assert t.publish(entries) == 0 and t.publish(entries.limit(0)) == 1 and t.versions() == [0, 1]
    assert {r.token: r.valence for r in t.read(0).collect()} == {"good": 2.0, "can't": -1.0, ":)": 2.0} and t.read(1).count() == 0
    assert {r.token for r in t.unmatched(0).collect()} == {"can't", ":)"}


def test_late_rows_window_groups_are_bounded(spark):
    from moodtick.operators.quality import late_rows

    df = spark.range(3000).select("id", (F.timestamp_seconds(F.lit(1_700_000_000) - F.col("id"))).alias("t"))
    marked = late_rows(df, "id", "t", "1 minute", block=8, fanout=2)
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_blk") > 8 and "Window [" in plan and not [x for x in plan.splitlines() if "Window [" in x and "_blk" not in x]
    assert marked.where("is_late").count() == 3000 - 61
