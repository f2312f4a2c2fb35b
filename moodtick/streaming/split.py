"""One parse, two outputs: accepted events and rejects of a topic stream.

A micro-batch is decoded once and split inside ``foreachBatch``. Each output of batch n is
written to a folder of its own and then renamed to ``<root>/<output>/batch=<n>``, a name
that must not exist yet: whoever reads sees whole batches only, and a batch that Spark runs
again after a failure finds what it has already published and skips it. Both outputs
belong to the same batch id of one checkpoint, so together they hold every message once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..operators.parse import ACCEPTED, REJECTED, accepted, parse_split, rejected
from ..sinks.commit_log import Conflict, publish_new
from .pipeline import start


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def publish_batch(df: DataFrame, folder: str, batch_id: int) -> bool:
    """``df`` as ``<folder>/batch=<batch_id>``, all or nothing; False if it is there already."""
    spark, final = df.sparkSession, f"{folder}/batch={batch_id}"
    if _exists(spark, final):
        return False
    staged = f"{folder.rstrip('/').rpartition('/')[0]}/_staged/{uuid.uuid4().hex}"
    df.write.parquet(staged)
    try:
        publish_new(spark, staged, final)
    except Conflict:
        return False
    return True


def split_sink(root: str, outputs: dict[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that publishes every output of each batch."""

    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()  # decoded once for all outputs
        try:
            for name, of in outputs.items():
                publish_batch(of(df), f"{root}/{name}", batch_id)
        finally:
            df.unpersist()

    return run


def start_split(envelope: DataFrame, kind: str, root: str, checkpoint: str, name: str | None = None,
                trigger: dict | None = None, cfg: Config = DEFAULT) -> StreamingQuery:
    """Stream a topic (``kind`` "price" or "text") into ``<root>/accepted`` and ``<root>/rejected``."""
    outputs = {"accepted": lambda df: accepted(df, kind), "rejected": rejected}
    return start(parse_split(envelope, kind), split_sink(root, outputs), checkpoint, name, trigger, cfg)


def read_output(spark: SparkSession, root: str, output: str, kind: str, stream: bool = False) -> DataFrame:
    """The published batches of one output; as a stream, batches arrive as they are published.
    Empty while nothing is published."""
    schema, path = (REJECTED if output == "rejected" else ACCEPTED[kind]), f"{root}/{output}"
    if not _exists(spark, path):
        spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
            spark._jvm.org.apache.hadoop.fs.Path(path))
    reader = spark.readStream if stream else spark.read
    return reader.schema(f"{schema}, batch long").parquet(path).drop("batch")
