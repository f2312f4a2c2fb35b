"""Raw / cleaned / metrics layers as date-partitioned Parquet tables, each built on the one before.

bronze: the message envelopes as received, by topic and date;
silver: parsed, cleaned and scored events, by event date, streamed from bronze;
gold:   the joined window metrics, a keyed table, refreshed for the dates that silver got rows of.

Every layer is a stream with a checkpoint of its own, so an increment reads only what is
new in the layer before it: envelopes are read and parsed once. Partitioning by date lets
readers prune to the days they ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..operators.join import join_price_sentiment
from ..operators.parse import ACCEPTED, parse_prices, parse_texts
from ..operators.shape import shape_metrics
from ..operators.windows import clean_and_score, price_window_metrics, sentiment_window_metrics
from ..schemas import ENVELOPE
from .parquet_table import KeyedParquetTable

DATE_COL = "event_date"
_SCHEMAS = {
    "bronze": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENVELOPE.fields) + f", {DATE_COL} date",
    "silver_prices": f"{ACCEPTED['price']}, {DATE_COL} date",
    "silver_texts": f"{ACCEPTED['text']}, cleaned_headline string, sentiment_score double, {DATE_COL} date",
}


class Lake:
    """Three layers below ``root``. The windows of ``cfg`` must divide a day."""

    def __init__(self, spark: SparkSession, root: str, lexicon, cfg: Config = DEFAULT, score=None):
        self.spark, self.root, self.lexicon, self.cfg, self.score = spark, root.rstrip("/"), lexicon, cfg, score
        self.gold = KeyedParquetTable(spark, f"{self.root}/gold", granularity="day")

    def table(self, layer: str, spark: SparkSession | None = None, stream: bool = False) -> DataFrame:
        """A layer's rows (bronze, silver_prices, silver_texts), read back from its files."""
        spark = spark or self.spark
        return (spark.readStream if stream else spark.read).schema(_SCHEMAS[layer]).parquet(f"{self.root}/{layer}")

    def _append(self, rows: DataFrame, layer: str, by: list[str], trigger: dict) -> StreamingQuery:
        return (
            rows.writeStream.format("parquet").partitionBy(*by).outputMode("append").option("path", f"{self.root}/{layer}")
            .option("checkpointLocation", f"{self.root}/_checkpoints/{layer}").trigger(**trigger).start()
        )

    def start_bronze(self, price_env: DataFrame, text_env: DataFrame, trigger: dict) -> StreamingQuery:
        both = price_env.unionByName(text_env).withColumn(DATE_COL, F.to_date("timestamp"))
        return self._append(both, "bronze", ["topic", DATE_COL], trigger)

    def start_silver(self, trigger: dict) -> list[StreamingQuery]:
        bronze = lambda topic: self.table("bronze", stream=True).where(F.col("topic") == topic)
        prices = parse_prices(bronze(self.cfg.price_topic))
        texts = clean_and_score(parse_texts(bronze(self.cfg.text_topic)), self.lexicon, self.cfg, self.score)
        return [
            self._append(df.withColumn(DATE_COL, F.to_date("timestamp")), name, [DATE_COL], trigger)
            for name, df in (("silver_prices", prices), ("silver_texts", texts))
        ]

    def start_gold(self, trigger: dict) -> StreamingQuery:
        new = self.table("silver_prices", stream=True).select(DATE_COL).unionByName(self.table("silver_texts", stream=True).select(DATE_COL))
        checkpoint = f"{self.root}/_checkpoints/gold"

        def refresh(df: DataFrame, batch_id: int) -> None:
            dates = [r[0] for r in df.where(F.col(DATE_COL).isNotNull()).distinct().collect()]  # days, not rows
            if dates:
                self.gold.merge(self.metrics(dates, df.sparkSession), batch_id, writer=checkpoint)

        return new.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint).trigger(**trigger).start()

    def metrics(self, dates: list, spark: SparkSession | None = None) -> DataFrame:
        """The window metrics of some days, from silver (only those days' folders are read)."""
        own = lambda layer: self.table(layer, spark).where(F.col(DATE_COL).isin(dates))
        prices, texts = price_window_metrics(own("silver_prices"), self.cfg), sentiment_window_metrics(own("silver_texts"), self.cfg)
        return shape_metrics(join_price_sentiment(prices, texts))

    def advance(self, price_env: DataFrame, text_env: DataFrame) -> None:
        """Take everything that has arrived through all layers (each stream: availableNow)."""
        now = {"availableNow": True}
        for started in (lambda: [self.start_bronze(price_env, text_env, now)], lambda: self.start_silver(now), lambda: [self.start_gold(now)]):
            for q in started():
                q.awaitTermination()
                if q.exception() is not None:
                    raise RuntimeError(str(q.exception()))

    def read(self) -> dict[str, DataFrame]:
        """All layers from their files."""
        gold = self.gold.read().withColumn(DATE_COL, F.to_date("window_start"))
        return {name: self.table(name) for name in ("bronze", "silver_prices", "silver_texts")} | {"gold": gold}


def layers(price_env: DataFrame, text_env: DataFrame, lexicon, cfg: Config = DEFAULT) -> dict[str, DataFrame]:
    """The same layers as one batch plan (a backfill without stored layers)."""
    bronze = price_env.unionByName(text_env, allowMissingColumns=True).withColumn(
        DATE_COL, F.to_date("timestamp")
    )
    prices = parse_prices(price_env)
    texts = clean_and_score(parse_texts(text_env), lexicon, cfg)
    silver_prices = prices.withColumn(DATE_COL, F.to_date("timestamp"))
    silver_texts = texts.withColumn(DATE_COL, F.to_date("timestamp"))
    gold = shape_metrics(
        join_price_sentiment(price_window_metrics(prices, cfg), sentiment_window_metrics(texts, cfg))
    ).withColumn(DATE_COL, F.to_date("window_start"))
    return {"bronze": bronze, "silver_prices": silver_prices, "silver_texts": silver_texts, "gold": gold}


def layer_counts(ls: dict[str, DataFrame]) -> DataFrame:
    """(layer, event_date, n_rows) for every layer."""
    out = None
    for name, df in ls.items():
        c = df.groupBy(DATE_COL).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("layer"), DATE_COL, "n_rows"
        )
        out = c if out is None else out.unionByName(c)
    return out


def write_layers(ls: dict[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Write each layer under ``root/<layer>`` partitioned by date. With
    ``mode='overwrite'`` only the dates present are replaced (dynamic overwrite)."""
    spark = next(iter(ls.values())).sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for name, df in ls.items():
            # no repartition by date: a hot date would land in one task; each task writes its own dates
            df.write.mode(mode).partitionBy(DATE_COL).parquet(f"{root.rstrip('/')}/{name}")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
