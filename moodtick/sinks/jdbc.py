"""Keyed upsert into a database table over JDBC.

Executors write the micro-batch in parallel into a per-batch stage table
(Spark's JDBC writer, one connection per task); the driver then runs a single
set-based statement that merges the stage into the target, and drops the
stage. No row passes through the driver. The statement replaces the non-key
columns of existing keys and inserts new keys, so replaying a batch leaves the
same table. Errors propagate, so a streaming query retries the batch.

Dialects: ``postgres`` (INSERT … ON CONFLICT DO UPDATE) and ``ansi``
(MERGE INTO, e.g. Derby, H2, Oracle, SQL Server).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..config import METRICS_TABLE
from ..schemas import METRICS, METRICS_KEY, TICKER_MAX_LEN

_SQL_TYPES = {
    "string": f"VARCHAR({TICKER_MAX_LEN})",
    "timestamp_ntz": "TIMESTAMP",
    "double": "DOUBLE PRECISION",
    "int": "INTEGER",
}


def create_table_sql(table: str = METRICS_TABLE, schema=METRICS, key: Sequence[str] = METRICS_KEY,
                     if_not_exists: bool = True) -> str:
    cols = []
    for f in schema.fields:
        t = _SQL_TYPES[f.dataType.simpleString()]
        cols.append(f"{f.name} {t}{'' if f.nullable else ' NOT NULL'}")
    ine = "IF NOT EXISTS " if if_not_exists else ""
    return f"CREATE TABLE {ine}{table} ({', '.join(cols)}, PRIMARY KEY ({', '.join(key)}))"


def merge_sql(table: str, stage: str, columns: Sequence[str], key: Sequence[str], dialect: str,
              stage_quote: str = "") -> str:
    q = lambda c: f"{stage_quote}{c}{stage_quote}"
    non_key = [c for c in columns if c not in key]
    if dialect == "postgres":
        return (
            f"INSERT INTO {table} ({', '.join(columns)}) "
            f"SELECT {', '.join(q(c) for c in columns)} FROM {stage} "
            f"ON CONFLICT ({', '.join(key)}) DO UPDATE SET "
            + ", ".join(f"{c} = EXCLUDED.{c}" for c in non_key)
        )
    if dialect == "ansi":
        on = " AND ".join(f"t.{k} = s.{q(k)}" for k in key)
        return (
            f"MERGE INTO {table} t USING {stage} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{q(c)}' for c in non_key)} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join('s.' + q(c) for c in columns)})"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def _execute(spark: SparkSession, url: str, props: dict[str, str], statements: Sequence[str]) -> None:
    jvm = spark.sparkContext._jvm
    jp = jvm.java.util.Properties()
    for k, v in props.items():
        if k != "driver":
            jp.setProperty(k, v)
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, jp)
    try:
        conn.setAutoCommit(False)
        st = conn.createStatement()
        try:
            for sql in statements:
                st.execute(sql)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            st.close()
    finally:
        conn.close()


class JdbcUpsert:
    """``foreachBatch`` sink merging each batch into ``table``."""

    def __init__(self, spark: SparkSession, url: str, props: dict[str, str], table: str = METRICS_TABLE,
                 key: Sequence[str] = METRICS_KEY, dialect: str = "postgres", stage_quote: str = "",
                 num_partitions: int | None = None):
        self.spark, self.url, self.props = spark, url, dict(props)
        self.table, self.key, self.dialect, self.stage_quote = table, tuple(key), dialect, stage_quote
        self.num_partitions = num_partitions

    def ensure_table(self) -> None:
        _execute(self.spark, self.url, self.props, [create_table_sql(self.table, key=self.key)])

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        from .merge import dedup_batch

        if batch.isEmpty():  # no stage table, no statement
            return
        cols = [f.name for f in METRICS.fields]
        b = dedup_batch(batch.select(*cols), self.key)
        stage = f"{self.table}_stage_{batch_id}"
        w = b.write.format("jdbc").option("url", self.url).option("dbtable", stage).mode("overwrite")
        for k, v in self.props.items():
            w = w.option(k, v)
        if self.num_partitions:
            w = w.option("numPartitions", str(self.num_partitions))
        w.save()
        _execute(
            self.spark,
            self.url,
            self.props,
            [merge_sql(self.table, stage, cols, self.key, self.dialect, self.stage_quote), f"DROP TABLE {stage}"],
        )

    def foreach_batch(self):
        def _fn(df: DataFrame, epoch_id: int) -> None:
            self.merge(df, epoch_id)

        return _fn
