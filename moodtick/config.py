"""Engine configuration.

One dataclass carries every knob the pipeline reads: endpoints (taken from the
environment with defaults), window length, watermark delay, null policy of the
scorer, dashboard scope, shuffle width. Functions take a ``Config`` instead of
reading globals, so batch, stream and tests share one definition.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

# Topic names and endpoint defaults of the original deployment.
PRICE_TOPIC = "stock_prices"
TEXT_TOPIC = "stock_texts"
DEFAULT_BROKER_HOST = "localhost"
DEFAULT_BROKER_PORT = "9092"
DEFAULT_DB_HOST = "localhost"
DEFAULT_DB_PORT = "5433"
DEFAULT_DB_NAME = "sentiment_db"
METRICS_TABLE = "stock_sentiment_metrics"


@dataclass(frozen=True)
class Config:
    # event-time windowing (the original uses 1 minute / 1 minute)
    window: str = "1 minute"
    watermark_delay: str = "1 minute"
    # global watermark across the two streams: "min" (Spark's default; a silent
    # stream holds output back) or "max" (the faster stream drives, the slower
    # one's late rows are dropped)
    watermark_policy: str = "min"
    # sentiment scorer
    null_policy: str = "text"  # "text": NULL headline scored as text 'none'; "skip": NULL score
    alpha: float = 15.0  # normalisation constant of the compound score
    score_digits: int = 4
    # dashboard
    latest_limit: int = 50
    scope: str = "global"  # "global": newest N rows overall; "per_ticker": newest N per ticker
    recent_rows: int = 10
    # endpoints
    broker_host: str = field(default_factory=lambda: os.getenv("KAFKA_HOST", DEFAULT_BROKER_HOST))
    broker_port: str = field(default_factory=lambda: os.getenv("KAFKA_PORT", DEFAULT_BROKER_PORT))
    db_host: str = field(default_factory=lambda: os.getenv("DB_HOST", DEFAULT_DB_HOST))
    db_port: str = field(default_factory=lambda: os.getenv("DB_PORT", DEFAULT_DB_PORT))
    db_name: str = DEFAULT_DB_NAME
    price_topic: str = PRICE_TOPIC
    text_topic: str = TEXT_TOPIC
    starting_offsets: str = "latest"
    # physical
    # shuffle width of the streaming query (fixed by its first start); None keeps the session's
    shuffle_partitions: int | None = None

    @property
    def bootstrap_servers(self) -> str:
        return f"{self.broker_host}:{self.broker_port}"

    @property
    def jdbc_url(self) -> str:
        return f"jdbc:postgresql://{self.db_host}:{self.db_port}/{self.db_name}"

    def kafka_options(self, topic: str) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": "false",
        }

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT = Config()
