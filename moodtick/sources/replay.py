"""Replaying a topic in steps: one distributed write, one step per micro-batch.

Every message belongs to the step of its key (any keys, also none). One job writes the
files of all steps, the same number of files for each; their modification times are then
set in step order, which is the order in which Spark's file source takes them, so a stream
with that many files per trigger reads one step per micro-batch, over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.partitioning import spread
from ..schemas import ENVELOPE

#: Topic of the empty messages that give every step its number of files.
PADDING = "_padding"


def with_steps(envelope: DataFrame, key: str = "key") -> tuple[DataFrame, int]:
    """``envelope`` with ``step``: the place of its key among the distinct keys (by bytes,
    a null key last), and the number of steps. The keys of a replay are a short list."""
    keys = envelope.groupBy(key).count()
    order = Window.orderBy(F.col(key).isNull(), F.col(key))
    ranks = keys.select(F.col(key).alias("_key"), (F.row_number().over(order) - 1).alias("step"))
    n = keys.count()
    return envelope.join(ranks, envelope[key].eqNullSafe(ranks["_key"])).drop("_key"), n


def write_steps(envelope: DataFrame, path: str, key: str = "key", files: int = 4) -> int:
    """Write a topic as replayable files, ``files`` per step; returns the number of steps."""
    spark = envelope.sparkSession
    rows, steps = with_steps(envelope, key)
    part = F.pmod(F.xxhash64("value", "timestamp"), F.lit(files)).cast("int")
    pad = spark.range(steps).select(
        *[F.lit(PADDING if f.name == "topic" else None).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields],
        F.col("id").cast("int").alias("step"), F.explode(F.sequence(F.lit(0), F.lit(files - 1))).alias("file"),
    )
    out = rows.withColumn("file", part).select(*[f.name for f in ENVELOPE.fields], "step", "file").unionByName(pad)
    # a (step, file) is written by one task, so it is one file; a hot key is spread over its files
    out.repartition("step", "file").write.partitionBy("step", "file").option("maxRecordsPerFile", 0).parquet(path)
    _order_files(spark, path)
    return steps


def _order_files(spark: SparkSession, path: str) -> None:
    """Modification times in step order (a second apart): metadata of steps x files entries."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for step in fs.listStatus(root):
        name = step.getPath().getName()
        if name.startswith("step="):
            for file in fs.listStatus(step.getPath()):
                for data in fs.listStatus(file.getPath()):
                    fs.setTimes(data.getPath(), 1_000_000_000_000 + 1000 * int(name[5:]), -1)


def read_steps(spark: SparkSession, path: str, topic: str, files: int = 4) -> DataFrame:
    """The topic as a stream, one step per micro-batch."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENVELOPE.fields)
    reader = spark.readStream.schema(f"{columns}, step int, file int").option("maxFilesPerTrigger", str(files))
    rows = spread(reader.parquet(path)).where(F.col("topic") == F.lit(topic))
    return rows.select(*[f.name for f in ENVELOPE.fields])
