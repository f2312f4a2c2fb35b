"""State of a streaming query read back from its checkpoint (Spark's state data sources)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import utc_wall_clock


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store: operator_id, operator, store, partitions,
    and the first and last batch whose state is kept."""
    m = spark.read.format("state-metadata").load(checkpoint)
    return m.select(
        F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator"), F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"), F.col("minBatchId").alias("first_batch"), F.col("maxBatchId").alias("last_batch"),
    )


def rows(spark: SparkSession, checkpoint: str, operator_id: int, store: str = "default", batch: int | None = None) -> DataFrame:
    """(partition_id, key, value) of one state store after ``batch`` (default: the last one)."""
    r = spark.read.format("statestore").option("operatorId", str(operator_id)).option("storeName", store)
    if batch is not None:
        r = r.option("batchId", str(batch))
    return r.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that are still open in each windowed aggregate of a query: operator_id,
    side ("price" or "sentiment", by what its state adds up), ticker, window_start, window_end."""
    found = None
    for r in operators(spark, checkpoint).where("operator = 'stateStoreSave'").select("operator_id", "store").distinct().collect():
        state = rows(spark, checkpoint, r["operator_id"], r["store"])
        window = next(f.name for f in state.schema["key"].dataType.fields if f.dataType.typeName() == "struct")
        # prices keep a smallest and a largest one beside sum and counts
        side = "price" if sum(f.dataType.typeName() == "double" for f in state.schema["value"].dataType.fields) > 1 else "sentiment"
        own = state.select(
            F.lit(r["operator_id"]).cast("long").alias("operator_id"), F.lit(side).alias("side"), F.col("key.ticker").alias("ticker"),
            utc_wall_clock(F.col("key")[window]["start"]).alias("window_start"), utc_wall_clock(F.col("key")[window]["end"]).alias("window_end"),
        )
        found = own if found is None else found.unionByName(own)
    return found


def join_rows(spark: SparkSession, checkpoint: str) -> int:
    """Rows buffered by the stream-stream joins of a query."""
    ids = [r[0] for r in operators(spark, checkpoint).where("operator = 'symmetricHashJoin'").select("operator_id").distinct().collect()]
    n = 0
    for i in ids:
        for side in ("left", "right"):
            n += spark.read.format("statestore").option("operatorId", str(i)).option("joinSide", side).load(checkpoint).count()
    return n
