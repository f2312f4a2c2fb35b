"""Data-quality checks in one pass per input.

``late_rows`` marks rows that arrive (in a given arrival order) with an event
time older than the high-water mark of everything that arrived before, minus
the watermark delay: the rows a streaming watermark would treat as late.
The running maximum is computed without a single-task window over the whole
input: arrival order is cut into blocks of bounded size, whose maxima are cut
into blocks again, until one block holds all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import PRICE_EVENT, TEXT_EVENT
from .parse import is_reject, parse_event_time

DEFAULT_BLOCK = 1 << 20  # rows per arrival block (bounds the largest window group)
DEFAULT_FANOUT = 1 << 10  # blocks per group of blocks, on every level


def _max_before(rows: DataFrame, at: str, value: str, n: int, size: int, fanout: int) -> DataFrame:
    """``rows`` (``at``: 0 to n - 1, unique) with ``_before``: the largest ``value`` of all rows
    with a smaller ``at``. Rows are cut into blocks of ``size``; a block's own prefix is a
    window over that block, what came before the block is the same question over one row
    per block, and so on until one block holds all: no window group exceeds ``size`` or
    ``fanout`` rows."""
    block, top = f"{at}_blk", f"{value}_max"
    cut = rows.withColumn(block, F.expr(f"`{at}` div {size}"))
    in_block = Window.partitionBy(block).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    own = cut.withColumn("_before", F.max(value).over(in_block))
    if n <= size:
        return own.drop(block)
    blocks = cut.groupBy(block).agg(F.max(value).alias(top))
    upper = _max_before(blocks, block, top, -(-n // size), fanout, fanout)
    upper = upper.select(block, F.col("_before").alias("_upper"))
    return own.join(upper, block, "left").withColumn("_before", F.greatest("_before", "_upper")).drop(block, "_upper")


def late_rows(
    df: DataFrame, seq_col: str, ts_col: str, delay: str = "1 minute", block: int = DEFAULT_BLOCK,
    fanout: int = DEFAULT_FANOUT,
) -> DataFrame:
    """``df`` plus ``high_water`` (max event time of strictly earlier arrivals)
    and ``is_late``. ``seq_col`` is a unique arrival order of whole numbers.

    One aggregate finds the span of the arrival order; the running maximum then takes as
    many levels as that span needs."""
    lo, hi = df.agg(F.min(seq_col), F.max(seq_col)).first()
    n = 0 if lo is None else hi - lo + 1
    marked = _max_before(df.withColumn("_at", F.col(seq_col) - F.lit(lo or 0)), "_at", ts_col, n, block, fanout)
    hw = F.col("_before")
    return marked.select(
        *df.columns,
        hw.alias("high_water"),
        F.coalesce(F.col(ts_col) < hw - F.expr(f"INTERVAL {delay}"), F.lit(False)).alias("is_late"),
    )


def stream_quality(df: DataFrame, name: str, value_col: str, seq_col: str, delay: str = "1 minute",
                   block: int = DEFAULT_BLOCK) -> DataFrame:
    """One row: rows, NULL ticker / time / value, late rows."""
    # flags instead of the values: what is shuffled and sorted is the arrival order and the time
    slim = df.select(
        F.col(seq_col).alias("seq"),
        "timestamp",
        F.col("ticker").isNull().alias("no_ticker"),
        F.col(value_col).isNull().alias("no_value"),
    )
    marked = late_rows(slim, "seq", "timestamp", delay, block)
    return marked.agg(
        F.lit(name).alias("stream"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("no_ticker").alias("null_ticker"),
        F.count_if(F.col("timestamp").isNull()).alias("null_time"),
        F.count_if("no_value").alias("null_value"),
        F.count_if(F.col("is_late")).alias("late_rows"),
    )


def metrics_quality(metrics: DataFrame) -> DataFrame:
    """One row: rows, duplicate keys, windows with NULL prices, windows without
    headlines. One aggregation per key, then one over the keys."""
    per_key = metrics.groupBy("ticker", "window_start").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("avg_price").isNull()).alias("_null_price"),
        F.count_if(F.col("headline_count") == 0).alias("_no_headline"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
        F.coalesce(F.sum("_null_price"), F.lit(0)).cast("long").alias("null_price_windows"),
        F.coalesce(F.sum("_no_headline"), F.lit(0)).cast("long").alias("no_headline_windows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_keys"),
    )


def envelope_quality(envelope: DataFrame, kind: str) -> DataFrame:
    """One row per topic: messages, values that are not a parseable event (bad
    JSON, NULL, or no known field), and parsed events with a NULL ticker, price /
    headline or event time. One pass over the envelope."""
    schema = PRICE_EVENT if kind == "price" else TEXT_EVENT
    fields = [f.name for f in schema.fields]
    value_field = "price" if kind == "price" else "headline"
    d = envelope.select("topic", F.from_json(F.col("value").cast("string"), schema).alias("data"))
    reject = is_reject(fields)
    ok = ~reject
    return d.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(reject).alias("rejects"),
        F.count_if(ok & F.col("data.ticker").isNull()).alias("null_ticker"),
        F.count_if(ok & F.col(f"data.{value_field}").isNull()).alias("null_value"),
        F.count_if(ok & parse_event_time(F.col("data.timestamp")).isNull()).alias("null_time"),
    )
