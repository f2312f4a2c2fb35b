"""Reading the stored metrics table (the dashboard's source).

Parquet: the keyed manifest table (``sinks.parquet_table``). JDBC: a parallel
read, one task per date range (``predicates``), so a large table is not pulled
through one connection; ``pushDownLimit`` / ``pushDownAggregate`` let the
database answer ``ORDER BY … LIMIT`` and simple aggregates itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, METRICS_TABLE, Config
from ..schemas import METRICS_COLUMNS


def date_predicates(first: dt.date, last: dt.date, days_per_part: int = 1) -> list[str]:
    """WHERE clauses splitting [first, last] into day ranges (one read task each),
    plus one for rows outside it, so no row is missed."""
    preds, d = [], first
    while d <= last:
        e = d + dt.timedelta(days=days_per_part)
        preds.append(f"window_start >= TIMESTAMP '{d} 00:00:00' AND window_start < TIMESTAMP '{e} 00:00:00'")
        d = e
    preds.append(
        f"window_start < TIMESTAMP '{first} 00:00:00' OR window_start >= TIMESTAMP '{d} 00:00:00' "
        "OR window_start IS NULL"
    )
    return preds


def read_metrics_jdbc(
    spark: SparkSession,
    props: dict[str, str],
    cfg: Config = DEFAULT,
    table: str = METRICS_TABLE,
    url: str | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """The 9 stored columns over JDBC (parallel when ``predicates`` are given)."""
    url = url or cfg.jdbc_url
    opts = {"pushDownLimit": "true", "pushDownAggregate": "true", **props}
    if predicates:
        df = spark.read.jdbc(url, table, predicates=predicates, properties=dict(opts))
    else:
        df = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**opts).load()
    return df.select(*[F.col(c) for c in METRICS_COLUMNS])


def read_metrics_parquet(spark: SparkSession, root: str) -> DataFrame:
    from ..sinks.parquet_table import KeyedParquetTable

    return KeyedParquetTable(spark, root).read()
