"""Scoring a headline stream against a lexicon table that changes while it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, Config
from ..functions.sentiment import score_by_join
from ..functions.text import clean_text
from ..operators.parse import parse_texts
from ..sources.lexicon import LexiconTable
from .pipeline import start
from .split import publish_batch

SCORED = "ticker string, headline string, source string, timestamp timestamp, sentiment_score double, lexicon_version int"


def score_batch(events: DataFrame, table: LexiconTable, cfg: Config = DEFAULT, row: str = "_row") -> DataFrame:
    """Events (with a unique ``row`` id, dropped) and their score by the newest version of the
    lexicon, with its number (both NULL before the first version)."""
    versions = table.versions()
    if not versions:
        none = F.lit(None)
        return events.drop(row).select("*", none.cast("double").alias("sentiment_score"), none.cast("int").alias("lexicon_version"))
    texts = events.select(row, clean_text("headline").alias("_cleaned"))
    scores = score_by_join(texts, [row], "_cleaned", table.read(versions[-1]), cfg)
    return events.join(scores, row).drop(row).withColumn("lexicon_version", F.lit(versions[-1]))


def start_scoring(text_env: DataFrame, table: LexiconTable, root: str, checkpoint: str, name: str | None = None,
                  trigger: dict | None = None, cfg: Config = DEFAULT) -> StreamingQuery:
    """Stream headlines into ``<root>/scored``, one published folder per micro-batch."""

    def sink(df: DataFrame, batch_id: int) -> None:
        own = df.withColumn("_row", F.monotonically_increasing_id()).persist()  # ids that both sides of the join see
        try:
            publish_batch(score_batch(own, table, cfg), f"{root}/scored", batch_id)
        finally:
            own.unpersist()

    return start(parse_texts(text_env), sink, checkpoint, name, trigger, cfg)


def read_scored(spark, root: str, stream: bool = False) -> DataFrame:
    """The scored events; as a stream, an input of ``sentiment_window_metrics``."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(f"{SCORED}, batch long").parquet(f"{root}/scored").drop("batch")
