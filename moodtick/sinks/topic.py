"""Publishing encoded events to a topic (batch backfill or stream).

The frame comes from ``operators.parse.encode_*_event`` (key, value, topic,
timestamp). With the Kafka connector on the classpath the rows go to the
broker (``kafka.bootstrap.servers`` from ``Config``; the key decides the topic
partition, so one ticker stays ordered); otherwise they are appended as
envelope Parquet files that ``sources.envelope.read_envelope(fmt="files")``
replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..operators.parse import to_envelope
from ..sources.envelope import kafka_available


def _next_offset(spark: SparkSession, path: str) -> int:
    """One above the largest offset of a file topic; 0 for a new one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return 0
    last = spark.read.schema("offset long").parquet(path).agg(F.max("offset")).first()[0]
    return 0 if last is None else last + 1


def write_topic(encoded: DataFrame, *, fmt: str = "kafka", path: str | None = None, cfg: Config = DEFAULT) -> None:
    """Batch publish."""
    if fmt == "kafka":
        if not kafka_available(encoded.sparkSession):
            raise RuntimeError("Kafka connector not on the classpath; use fmt='files'")
        (
            encoded.select("key", "value", "topic")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
            .save()
        )
        return
    if fmt == "files":
        if path is None:
            raise ValueError("fmt='files' needs a path")
        to_envelope(encoded, first_offset=_next_offset(encoded.sparkSession, path)).write.mode("append").parquet(path)
        return
    raise ValueError(f"unknown topic format {fmt!r}")


def stream_topic(encoded: DataFrame, checkpoint: str, *, fmt: str = "kafka", path: str | None = None,
                 cfg: Config = DEFAULT, trigger: dict | None = None) -> StreamingQuery:
    """Streaming publish (append)."""
    if fmt == "kafka":
        w = (
            encoded.select("key", "value", "topic")
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
        )
    elif fmt == "files":
        if path is None:
            raise ValueError("fmt='files' needs a path")
        w = to_envelope(encoded).writeStream.format("parquet").option("path", path)
    else:
        raise ValueError(f"unknown topic format {fmt!r}")
    w = w.option("checkpointLocation", checkpoint).outputMode("append")
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
