"""Envelope decoding / encoding cases (PERMISSIVE JSON, safe timestamps)."""

import datetime as dt

from pyspark.sql import functions as F

from moodtick.operators import parse as P
from moodtick.schemas import ENVELOPE


def envelope(spark, values, topic="stock_prices"):
    rows = [(None, v.encode() if v is not None else None, topic, 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ENVELOPE)


def test_price_cases(spark):
    env = envelope(
        spark,
        [
            '{"ticker":"AAPL","price":1.25,"timestamp":"2026-09-10T10:00:05.123456+00:00"}',
            "not json",
            None,
            '{"ticker":"AAPL","price":"x","timestamp":"2026-09-10T10:00:06+00:00"}',
            '{"ticker":"AAPL","price":2.0}',
            '{"ticker":"AAPL","price":3.0,"timestamp":"junk"}',
            '{"price":4.0,"timestamp":"2026-09-10T10:00:07Z"}',
        ],
    )
    rows = [tuple(r) for r in P.parse_prices(env).collect()]
    assert rows == [
        ("AAPL", 1.25, dt.datetime(2026, 9, 10, 10, 0, 5, 123456)),
        ("AAPL", None, dt.datetime(2026, 9, 10, 10, 0, 6)),
        ("AAPL", 2.0, None),
        ("AAPL", 3.0, None),
        (None, 4.0, dt.datetime(2026, 9, 10, 10, 0, 7)),
    ]
    rej = P.rejects(env, "price").select("offset", "raw_value").collect()
    assert [(r.offset, r.raw_value) for r in rej] == [(1, "not json"), (2, None)]


def test_round_trip_price_and_text(spark):
    ticks = spark.createDataFrame(
        [("AAPL", 187.123, "2026-09-10 10:00:05.123456"), ("MSFT", 2.675, "2026-09-10 10:00:00")],
        "ticker string, price double, ts string",
    ).select("ticker", "price", F.to_timestamp("ts").alias("timestamp"))
    env = P.to_envelope(P.encode_price_event(ticks, "stock_prices"))
    assert [(f.name, f.dataType) for f in env.schema] == [(f.name, f.dataType) for f in ENVELOPE]
    wire = [r.v for r in env.select(F.col("value").cast("string").alias("v")).orderBy("v").collect()]
    assert wire[0] == '{"ticker":"AAPL","price":187.12,"timestamp":"2026-09-10T10:00:05.123456+00:00"}'
    assert wire[1] == '{"ticker":"MSFT","price":2.68,"timestamp":"2026-09-10T10:00:00.000000+00:00"}'
    back = P.parse_prices(env).orderBy("ticker").collect()
    assert [(r.ticker, r.price, r.timestamp) for r in back] == [
        ("AAPL", 187.12, dt.datetime(2026, 9, 10, 10, 0, 5, 123456)),
        ("MSFT", 2.68, dt.datetime(2026, 9, 10, 10, 0, 0)),
    ]
    heads = spark.createDataFrame(
        [("AAPL", 'Quote "x"\nnew line', "src", "2026-09-10 10:00:05")], "ticker string, headline string, source string, ts string"
    ).select("ticker", "headline", "source", F.to_timestamp("ts").alias("timestamp"))
    t = P.parse_texts(P.to_envelope(P.encode_text_event(heads, "stock_texts"))).first()
    assert t.headline == 'Quote "x"\nnew line' and t.source == "src"
    assert t.timestamp == dt.datetime(2026, 9, 10, 10, 0, 5)


def test_key_is_ticker_bytes(spark):
    ticks = spark.createDataFrame([("AAPL", 1.0, None)], "ticker string, price double, timestamp timestamp")
    assert bytes(P.encode_price_event(ticks, "t").first().key) == b"AAPL"


def test_kafka_paths_fail_clearly_without_the_connector(spark):
    import pytest

    from moodtick.sinks.topic import write_topic
    from moodtick.sources.envelope import kafka_available, read_envelope

    if kafka_available(spark):
        pytest.skip("connector present")
    with pytest.raises(RuntimeError, match="Kafka"):
        read_envelope(spark, "stock_prices", fmt="kafka")
    ticks = spark.createDataFrame([("AAPL", 1.0, None)], "ticker string, price double, timestamp timestamp")
    with pytest.raises(RuntimeError, match="Kafka"):
        write_topic(P.encode_price_event(ticks, "stock_prices"), fmt="kafka")
    with pytest.raises(ValueError):
        read_envelope(spark, "stock_prices", fmt="files")


def test_topic_files_batch_and_stream(spark, scratch):
    """Two batch writes never repeat an offset; a stream writes NULL offsets."""
    from moodtick.operators.parse import encode_price_event
    from moodtick.sinks.topic import stream_topic, write_topic

    ticks = spark.createDataFrame(
        [("A", 1.5, dt.datetime(2024, 1, 1, 10, 0, s)) for s in range(20)], "ticker string, price double, timestamp timestamp"
    )
    write_topic(encode_price_event(ticks, "t"), fmt="files", path=f"{scratch}/topic")
    write_topic(encode_price_event(ticks, "t"), fmt="files", path=f"{scratch}/topic")
    offsets = [r.offset for r in spark.read.parquet(f"{scratch}/topic").collect()]
    assert len(offsets) == 40 == len(set(offsets))
    ticks.write.parquet(f"{scratch}/ticks")
    source = spark.readStream.schema(ticks.schema).parquet(f"{scratch}/ticks")
    q = stream_topic(encode_price_event(source, "t"), f"{scratch}/ck", fmt="files", path=f"{scratch}/streamed", trigger={"availableNow": True})
    q.awaitTermination()
    rows = spark.read.parquet(f"{scratch}/streamed").collect()
    assert len(rows) == 20 and {r.offset for r in rows} == {None}
