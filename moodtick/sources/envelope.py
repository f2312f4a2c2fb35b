"""Topic sources: a message envelope (key, value, topic, partition, offset, ...).

``read_envelope`` returns the same envelope columns whatever the transport:

* ``kafka``  — Spark's Kafka source (needs the spark-sql-kafka package on the
  classpath; options from ``Config.kafka_options``);
* ``files``  — Parquet files holding envelope rows (used for replay, backfill
  and tests; ``maxFilesPerTrigger`` paces a stream).

Both work as batch (``spark.read``) and as stream (``spark.readStream``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..operators.partitioning import spread
from ..schemas import ENVELOPE


def kafka_available(spark: SparkSession) -> bool:
    jvm = spark.sparkContext._jvm
    try:
        jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def read_envelope(
    spark: SparkSession,
    topic: str,
    *,
    fmt: str = "kafka",
    path: str | None = None,
    stream: bool = True,
    cfg: Config = DEFAULT,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to (or read) one topic; returns the envelope columns."""
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        if not kafka_available(spark):
            raise RuntimeError(
                "Kafka source not on the classpath; add "
                "org.apache.spark:spark-sql-kafka-0-10_2.13 or use fmt='files'"
            )
        opts = cfg.kafka_options(topic)
        # topics are keyed by ticker, so a hot ticker is a hot topic partition:
        # let the source split large offset ranges over at least one task per core
        opts["minPartitions"] = str(spark.sparkContext.defaultParallelism)
        if not stream:
            opts.pop("failOnDataLoss", None)
            if opts.get("startingOffsets") == "latest":
                opts["startingOffsets"] = "earliest"
        return reader.format("kafka").options(**opts).load()
    if fmt == "files":
        if path is None:
            raise ValueError("fmt='files' needs a path")
        r = reader.schema(ENVELOPE)
        if stream and max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = spread(r.parquet(path))
        return df.where(F.col("topic") == F.lit(topic)) if topic else df
    raise ValueError(f"unknown envelope format {fmt!r}")
