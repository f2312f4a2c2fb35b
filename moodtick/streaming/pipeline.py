"""The streaming correlation query.

Two topic streams → parse → clean + score → watermark + window aggregates →
stream-stream join on (ticker, window struct) → shape → ``foreachBatch`` into
a keyed sink (Parquet manifest table or JDBC merge). Append mode: a window is
emitted once the minimum of both streams' watermarks passes its end.

Progress survives restarts through ``checkpointLocation`` (a folder in shared
storage); the sinks are idempotent per batch id, so a batch retried after a
failure (the sink raises, Spark does not commit it) lands exactly once.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..operators.parse import parse_prices, parse_texts
from ..operators.shape import shape_metrics
from ..plans.pipeline import correlate
from ..session import session_conf

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def correlation_stream(price_env: DataFrame, text_env: DataFrame, lexicon, cfg: Config = DEFAULT, score=None) -> DataFrame:
    """The shaped metrics stream (window flattened after the join). Give ``start`` the
    same ``cfg``: watermark policy and shuffle width are read when a query starts. ``score``:
    a user's scorer in place of the lexicon. Unparseable messages are left out; a stream
    that keeps them starts with ``streaming.split``."""
    return shape_metrics(correlate(parse_prices(price_env), parse_texts(text_env), lexicon, cfg, score))


def use_rocksdb_state(spark: SparkSession) -> None:
    """State in RocksDB instead of executor heap (many tickers × open windows)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def start(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = "metrics_sink",
    trigger: dict | None = None,
    cfg: Config = DEFAULT,
) -> StreamingQuery:
    """Start ``df`` into ``foreachBatch(sink)`` in append mode.

    The multiple-watermark policy and, if given, the shuffle width of ``cfg`` hold for
    this query (the state of a stateful query keeps that width for its lifetime); the
    session's settings are restored.

    ``trigger``: None (next batch as soon as the last ends), or e.g.
    ``{"availableNow": True}`` for backfill/tests, ``{"processingTime": "1 minute"}``.
    """
    if getattr(sink, "takes_writer", False):
        sink = functools.partial(sink, writer=checkpoint)
    w = df.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    settings = {"spark.sql.streaming.multipleWatermarkPolicy": cfg.watermark_policy}
    if cfg.shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(cfg.shuffle_partitions)
    with session_conf(df.sparkSession, settings):
        return w.start()


def to_console(df: DataFrame, name: str, num_rows: int = 5, checkpoint: str | None = None,
               trigger: dict | None = None) -> StreamingQuery:
    """Verification sink: print each micro-batch."""
    w = (
        df.writeStream.outputMode("append")
        .format("console")
        .option("truncate", "false")
        .option("numRows", str(num_rows))
        .queryName(name)
    )
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Block until all ``queries`` have ended (or ``timeout`` seconds pass); raise as
    soon as one of them fails. Only these queries are watched, not earlier ones of
    the session."""
    import time

    deadline = None if timeout is None else time.monotonic() + timeout
    while active := [q for q in queries if q.isActive]:
        if deadline is not None and time.monotonic() >= deadline:
            break
        for q in queries:
            if q.exception() is not None:
                raise RuntimeError(f"streaming query {q.name} failed: {q.exception()}")
        active[0].awaitTermination(0.5)
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name} failed: {q.exception()}")
