"""Envelope ⇄ event rows.

Decoding: ``value`` bytes → string → ``from_json`` with the fixed schema in
PERMISSIVE mode (malformed JSON gives a struct of NULLs, a non-numeric price a
NULL price). Timestamps go through ``try_to_timestamp`` so junk yields NULL
instead of failing the query under ANSI mode.

Encoding: one event row → key = ticker bytes, value = JSON bytes with the
price rounded to 2 dp and an ISO-8601 UTC timestamp with microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import utc_wall_clock
from ..schemas import PRICE_EVENT, TEXT_EVENT

# Wire format of event timestamps (UTC, microseconds, +00:00) and price precision.
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
WIRE_UTC_OFFSET = "+00:00"
PRICE_DIGITS = 2

_PRICE_FIELDS = [f.name for f in PRICE_EVENT.fields]
_TEXT_FIELDS = [f.name for f in TEXT_EVENT.fields]


def parse_event_time(c: Column) -> Column:
    """ISO-8601 string (offset, optional fraction) → timestamp; junk → NULL."""
    return F.try_to_timestamp(c)


def _decoded(envelope: DataFrame, schema) -> DataFrame:
    return envelope.select(F.from_json(F.col("value").cast("string"), schema).alias("data"))


def is_reject(fields: list[str]) -> Column:
    # from_json in PERMISSIVE mode: unparseable input (or a NULL value) → every field NULL
    all_null = F.col(f"data.{fields[0]}").isNull()
    for f in fields[1:]:
        all_null = all_null & F.col(f"data.{f}").isNull()
    return F.col("data").isNull() | all_null


def parse_prices(envelope: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """(ticker, price, timestamp); rows whose JSON did not parse are dropped
    unless ``keep_rejects`` (then they stay, all NULL)."""
    d = _decoded(envelope, PRICE_EVENT)
    if not keep_rejects:
        d = d.where(~is_reject(_PRICE_FIELDS))
    return d.select(
        F.col("data.ticker").alias("ticker"),
        F.col("data.price").alias("price"),
        parse_event_time(F.col("data.timestamp")).alias("timestamp"),
    )


def parse_texts(envelope: DataFrame, keep_rejects: bool = False) -> DataFrame:
    """(ticker, headline, source, timestamp)."""
    d = _decoded(envelope, TEXT_EVENT)
    if not keep_rejects:
        d = d.where(~is_reject(_TEXT_FIELDS))
    return d.select(
        F.col("data.ticker").alias("ticker"),
        F.col("data.headline").alias("headline"),
        F.col("data.source").alias("source"),
        parse_event_time(F.col("data.timestamp")).alias("timestamp"),
    )


#: Columns of accepted events by kind, and of rejects.
ACCEPTED = {
    "price": "ticker string, price double, timestamp timestamp",
    "text": "ticker string, headline string, source string, timestamp timestamp",
}
REJECTED = "topic string, partition int, offset long, raw_value string, reason string"


def parse_split(envelope: DataFrame, kind: str) -> DataFrame:
    """One decoding for both outputs: the message's coordinates and raw text, the event's
    fields, and ``reason`` (NULL for an event) — see ``accepted`` and ``rejected``."""
    schema, fields = (PRICE_EVENT, _PRICE_FIELDS) if kind == "price" else (TEXT_EVENT, _TEXT_FIELDS)
    raw = F.col("value").cast("string")
    d = envelope.select("topic", "partition", "offset", raw.alias("raw_value"), F.from_json(raw, schema).alias("data"))
    reason = F.when(F.col("raw_value").isNull(), "null value").when(is_reject(fields), "not an event")
    return d.withColumn("reason", reason)


def accepted(split: DataFrame, kind: str) -> DataFrame:
    """The events of ``parse_split``, as ``parse_prices`` / ``parse_texts`` give them."""
    own = {"price": ["ticker", "price"], "text": ["ticker", "headline", "source"]}[kind]
    return split.where("reason IS NULL").select(
        *[F.col(f"data.{c}").alias(c) for c in own], parse_event_time(F.col("data.timestamp")).alias("timestamp")
    )


def rejected(split: DataFrame) -> DataFrame:
    """Where each reject of ``parse_split`` came from, its raw text, and why."""
    return split.where("reason IS NOT NULL").select("topic", "partition", "offset", "raw_value", "reason")


def rejects(envelope: DataFrame, kind: str) -> DataFrame:
    """Envelope rows whose value is not a parseable event (NULL, not JSON, or no
    known field): topic coordinates plus the raw text, for a reject output."""
    schema, fields = (PRICE_EVENT, _PRICE_FIELDS) if kind == "price" else (TEXT_EVENT, _TEXT_FIELDS)
    d = envelope.select(
        "topic",
        "partition",
        "offset",
        F.col("value").cast("string").alias("raw_value"),
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
    )
    return d.where(is_reject(fields)).drop("data")


def wire_timestamp(ts: Column) -> Column:
    """UTC ISO-8601 with microseconds and offset, e.g. 2024-01-01T00:00:07.179575+00:00,
    whatever the session time zone."""
    return F.concat(F.date_format(utc_wall_clock(ts), WIRE_TIMESTAMP_FORMAT), F.lit(WIRE_UTC_OFFSET))


def encode_price_event(ticks: DataFrame, topic: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(ticker, price, timestamp) → (key, value, topic, timestamp); the event
    time doubles as the message timestamp. ``carry`` columns pass through."""
    payload = F.struct(
        F.col("ticker").alias("ticker"),
        F.round(F.col("price"), PRICE_DIGITS).alias("price"),
        wire_timestamp(F.col("timestamp")).alias("timestamp"),
    )
    return ticks.select(
        F.col("ticker").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("timestamp").alias("timestamp"),
        *carry,
    )


def encode_text_event(headlines: DataFrame, topic: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(ticker, headline, source, timestamp) → (key, value, topic, timestamp) + ``carry``."""
    payload = F.struct(
        F.col("ticker").alias("ticker"),
        F.col("headline").alias("headline"),
        F.col("source").alias("source"),
        wire_timestamp(F.col("timestamp")).alias("timestamp"),
    )
    return headlines.select(
        F.col("ticker").cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("timestamp").alias("timestamp"),
        *carry,
    )


def to_envelope(encoded: DataFrame, partitions: int = 3, first_offset: int = 0) -> DataFrame:
    """Complete an encoded frame to the full envelope schema for a file topic:
    partition = hash(key) mod ``partitions`` (keyed like a topic partitioner);
    offset = an increasing id from ``first_offset`` on (not dense) in a batch, NULL on a
    stream (Spark numbers no stream rows); timestampType 0."""
    offset = F.lit(None).cast("long") if encoded.isStreaming else F.monotonically_increasing_id() + F.lit(first_offset)
    return encoded.select(
        "key",
        "value",
        "topic",
        F.pmod(F.hash("key"), F.lit(partitions)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
