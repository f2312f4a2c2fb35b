"""Registered queries: name → fn(spark, sf_dir) -> DataFrame.

Each query reads the given tables (through the ``ticks`` / ``headlines``
views) and runs the engine's operators over all of their rows. Doubles are
rounded to 6 dp at the output so results compare across engines whose
summation order differs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import PRICE_TOPIC, TEXT_TOPIC, Config
from ..functions import labels as L
from ..functions import sentiment as S
from ..functions.rules import Rules, score_rules
from ..functions.sentiment import TEST_LEXICON
from ..functions.text import clean_text
from ..functions.times import instant_from_utc, utc_wall_clock
from ..operators import analyses as A
from ..operators import dashboard as D
from ..operators import parse as P
from ..operators import quality as Q
from ..operators import windows as Wn
from ..operators.shape import key_violations
from ..operators.windows import WINDOW_COL
from ..plans import pipeline
from ..schemas import PRICE_EVENT, TEXT_EVENT, TICKER_MAX_LEN
from ..sinks import lake
from ..sinks.topic import write_topic
from ..sources import tables
from ..sources.envelope import read_envelope
from ..sources.lexicon import LexiconTable
from ..sources.replay import read_steps, write_steps
from ..session import session_conf, stream_width
from ..streaming import pipeline as SP
from ..streaming import state
from ..streaming.score import read_scored, start_scoring
from ..streaming.split import read_output, start_split

OUT_DIGITS = 6
# Output rounding is half away from zero after scaling by (1 + 1e-12): values that
# are exact decimal ties (e.g. 5.8463 / 40) land on the same side in every engine
# whatever the summation order, since the float noise (~1e-16) is far below it.
TIE_GUARD = 1.000000000001

DAILY = Config(window="1 day")
HOURLY = Config(window="1 hour")
MINUTE = Config(window="1 minute")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def r6(c) -> F.Column:
    return F.round((F.col(c) if isinstance(c, str) else c) * F.lit(TIE_GUARD), OUT_DIGITS)


def round_doubles(df: DataFrame, digits: int = OUT_DIGITS) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name) * F.lit(TIE_GUARD), digits).alias(f.name)
            if f.dataType.typeName() == "double"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def metrics_view(spark: SparkSession, sf_dir: str, cfg: Config = DAILY) -> DataFrame:
    """The stored-metrics table as the pipeline computes it from the test tables."""
    return pipeline.metrics(tables.ticks(spark, sf_dir), tables.headlines(spark, sf_dir), TEST_LEXICON, cfg)


# ---------------------------------------------------------------- pipeline core


@register("join_price_sentiment")
def q_join_price_sentiment(spark, sf_dir):
    return round_doubles(metrics_view(spark, sf_dir, DAILY))


@register("join_price_sentiment_hourly")
def q_join_price_sentiment_hourly(spark, sf_dir):
    return round_doubles(metrics_view(spark, sf_dir, HOURLY))


@register("join_price_sentiment_minute")
def q_join_price_sentiment_minute(spark, sf_dir):
    return round_doubles(metrics_view(spark, sf_dir, MINUTE))


# ---------------------------------------------------------------- envelopes, parsing


def price_envelope(spark, sf_dir):
    return P.to_envelope(P.encode_price_event(tables.ticks(spark, sf_dir), PRICE_TOPIC))


def text_envelope(spark, sf_dir):
    return P.to_envelope(P.encode_text_event(tables.headlines(spark, sf_dir), TEXT_TOPIC))


def _ntz(c):
    return utc_wall_clock(c)


@register("src_price_envelope")
def q_src_price_envelope(spark, sf_dir):
    env = price_envelope(spark, sf_dir)
    d = env.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        _ntz("timestamp").alias("broker_time"),
        F.from_json(F.col("value").cast("string"), PRICE_EVENT).alias("data"),
    )
    return d.select("key", "topic", "broker_time", F.col("data.ticker").alias("ticker"),
                    F.col("data.price").alias("price"))


@register("src_text_envelope")
def q_src_text_envelope(spark, sf_dir):
    env = text_envelope(spark, sf_dir)
    d = env.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        _ntz("timestamp").alias("broker_time"),
        F.from_json(F.col("value").cast("string"), TEXT_EVENT).alias("data"),
    )
    return d.select("key", "topic", "broker_time", F.col("data.ticker").alias("ticker"),
                    F.col("data.source").alias("source"))


@register("enc_price_event")
def q_enc_price_event(spark, sf_dir):
    e = P.encode_price_event(tables.ticks(spark, sf_dir), PRICE_TOPIC)
    v = F.col("value").cast("string")
    return e.select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(v, "$.ticker").alias("ticker"),
        F.get_json_object(v, "$.price").cast("double").alias("price"),
        F.get_json_object(v, "$.timestamp").alias("wire_timestamp"),
    )


@register("enc_text_event")
def q_enc_text_event(spark, sf_dir):
    h = tables.headlines(spark, sf_dir)
    e = P.encode_text_event(h, TEXT_TOPIC, carry=("doc_id", "headline"))
    v = F.col("value").cast("string")
    return e.select(
        "doc_id",
        F.col("key").cast("string").alias("key"),
        F.get_json_object(v, "$.source").alias("source"),
        F.get_json_object(v, "$.timestamp").alias("wire_timestamp"),
        (F.get_json_object(v, "$.headline") == F.col("headline")).alias("headline_roundtrip"),
    )


@register("parse_prices")
def q_parse_prices(spark, sf_dir):
    p = P.parse_prices(price_envelope(spark, sf_dir))
    return p.select("ticker", "price", _ntz("timestamp").alias("timestamp"))


@register("parse_texts")
def q_parse_texts(spark, sf_dir):
    t = P.parse_texts(text_envelope(spark, sf_dir))
    return t.select("ticker", "headline", "source", _ntz("timestamp").alias("timestamp"))


@register("parse_timestamps")
def q_parse_timestamps(spark, sf_dir):
    """Event times written in several ISO forms (and junk) parse back safely."""
    e = tables.table(spark, sf_dir, "events").select("event_id", instant_from_utc("ts").alias("t"), "props")
    return e.select(
        "event_id",
        _ntz(P.parse_event_time(P.wire_timestamp(F.col("t")))).alias("t_offset"),
        _ntz(P.parse_event_time(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))).alias("t_zulu"),
        _ntz(P.parse_event_time(F.date_format("t", "yyyy-MM-dd HH:mm:ss"))).alias("t_seconds"),
        _ntz(P.parse_event_time(F.col("props"))).alias("t_junk"),
    )


def mixed_price_topic(spark, sf_dir):
    """A price topic carrying valid events plus unparseable values: the events'
    ``props`` JSON (no event field) and the documents' prose (not JSON)."""
    valid = price_envelope(spark, sf_dir)
    ev = tables.table(spark, sf_dir, "events").select(
        F.col("event_type").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit(PRICE_TOPIC).alias("topic"),
        instant_from_utc("ts").alias("timestamp"),
    )
    docs = tables.table(spark, sf_dir, "documents").select(
        F.col("source").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit(PRICE_TOPIC).alias("topic"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )
    return valid.unionByName(P.to_envelope(ev)).unionByName(P.to_envelope(docs))


@register("parse_rejects")
def q_parse_rejects(spark, sf_dir):
    return P.rejects(mixed_price_topic(spark, sf_dir), "price").select("topic", "raw_value")


@register("parse_valid_count")
def q_parse_valid_count(spark, sf_dir):
    """Rows that survive parsing of the mixed topic, per ticker."""
    p = P.parse_prices(mixed_price_topic(spark, sf_dir))
    return p.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_rows"), F.count("price").alias("n_prices"))


# ---------------------------------------------------------------- cleaning, scoring


@register("clean_headlines")
def q_clean_headlines(spark, sf_dir):
    h = tables.headlines(spark, sf_dir)
    return h.select("doc_id", "ticker", clean_text("headline").alias("cleaned_headline"))


@register("score_lexicon")
def q_score_lexicon(spark, sf_dir):
    s = Wn.clean_and_score(tables.headlines(spark, sf_dir), S.TEST_LEXICON, DAILY)
    return s.select("doc_id", "ticker", "sentiment_score")


#: Words of the test documents as negation, boosters and contrast word of the position rules.
TEST_RULES = Rules(negations=frozenset({"the", "les"}), boosters={"and": 1, "que": 1, "of": -1}, contrast=frozenset({"was", "une"}))


@register("score_rules")
def q_score_rules(spark, sf_dir):
    """Every document under the position rules: negations and boosters up to three tokens
    back, a contrast word, marks."""
    h = tables.headlines(spark, sf_dir)
    return h.select("doc_id", score_rules(F.lower("headline"), TEST_LEXICON, TEST_RULES).alias("sentiment_score"))


@register("score_lexicon_join")
def q_score_lexicon_join(spark, sf_dir):
    h = tables.headlines(spark, sf_dir).select("doc_id", clean_text("headline").alias("cleaned_headline"))
    return S.score_by_join(h, ["doc_id"], "cleaned_headline", S.lexicon_frame(spark, S.TEST_LEXICON))


@register("score_lexicon_vectorised")
def q_score_lexicon_vectorised(spark, sf_dir):
    """All documents scored with the 676-word rule lexicon: above the literal-map
    bound, so the vectorised (Arrow + hash lookup) form runs."""
    s = Wn.clean_and_score(tables.headlines(spark, sf_dir), S.rule_lexicon(), DAILY)
    return s.select("doc_id", "ticker", "sentiment_score")


@register("score_lexicon_join_large")
def q_score_lexicon_join_large(spark, sf_dir):
    """The same lexicon through the token ⋈ lexicon join form."""
    h = tables.headlines(spark, sf_dir).select("doc_id", clean_text("headline").alias("cleaned_headline"))
    return S.score_by_join(h, ["doc_id"], "cleaned_headline", S.lexicon_frame(spark, S.rule_lexicon()))


# ---------------------------------------------------------------- windowed aggregates


def _flat_window(df):
    return df.select(
        "ticker",
        _ntz(F.col(f"{WINDOW_COL}.start")).alias("window_start"),
        _ntz(F.col(f"{WINDOW_COL}.end")).alias("window_end"),
        *[c for c in df.columns if c not in ("ticker", WINDOW_COL)],
    )


@register("agg_price_window")
def q_agg_price_window(spark, sf_dir):
    return round_doubles(_flat_window(Wn.price_window_metrics(tables.ticks(spark, sf_dir), MINUTE)))


@register("agg_sentiment_window")
def q_agg_sentiment_window(spark, sf_dir):
    scored = Wn.clean_and_score(tables.headlines(spark, sf_dir), S.TEST_LEXICON, MINUTE)
    return round_doubles(_flat_window(Wn.sentiment_window_metrics(scored, MINUTE)))


# ---------------------------------------------------------------- sink shaping, checks, merges


@register("snk_row_shape")
def q_snk_row_shape(spark, sf_dir):
    m = metrics_view(spark, sf_dir, HOURLY)
    return m.select(
        "ticker",
        "window_start",
        "window_end",
        F.timestamp_diff("SECOND", F.col("window_start"), F.col("window_end")).alias("window_seconds"),
        "price_count",
        "headline_count",
        r6("avg_sentiment").alias("avg_sentiment"),
    )


@register("chk_target_key")
def q_chk_target_key(spark, sf_dir):
    m = metrics_view(spark, sf_dir, HOURLY)
    per_key = m.groupBy("ticker", "window_start").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.col("window_end").isNull().cast("int")).alias("_null_end")
    )
    null_key = F.col("ticker").isNull() | F.col("window_start").isNull()
    long_ticker = F.length("ticker") > TICKER_MAX_LEN
    return per_key.agg(
        F.sum("_n").cast("long").alias("n_rows"),
        F.coalesce(F.sum(F.when(null_key, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
        F.coalesce(F.sum(F.when(long_ticker, F.col("_n"))), F.lit(0)).cast("long").alias("long_tickers"),
        F.count_if((F.col("_n") > 1) | null_key | long_ticker | (F.col("_null_end") > 0)).alias("violations"),
    )


@register("chk_key_violations")
def q_chk_key_violations(spark, sf_dir):
    """The merge's key check on metrics of which some windows have lost a key part or their
    end, have a ticker that is too long, or stand there twice."""
    m, hour = metrics_view(spark, sf_dir, HOURLY), F.hour("window_start")
    broken = m.select(
        F.when(hour == 1, None).when(hour == 2, F.repeat("ticker", F.lit(3))).otherwise(F.col("ticker")).alias("ticker"),
        F.when(hour == 3, None).otherwise(F.col("window_start")).alias("window_start"),
        F.when(hour == 4, None).otherwise(F.col("window_end")).alias("window_end"),
        *[c for c in m.columns if c not in ("ticker", "window_start", "window_end")],
    )
    twice = broken.where(hour == 0)
    return key_violations(broken.unionByName(twice)).select("ticker", "window_start", "n_rows", "null_end")


def _split_batches(spark, sf_dir, cfg: Config):
    """Two overlapping arrivals of the same streams: events before day 20, and
    events from day 15 on. Together they hold every row."""
    t, h = tables.ticks(spark, sf_dir), tables.headlines(spark, sf_dir)
    cut_a = instant_from_utc(F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00")))
    cut_b = instant_from_utc(F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))
    a = pipeline.metrics(t.where(F.col("timestamp") < cut_a), h.where(F.col("timestamp") < cut_a), TEST_LEXICON, cfg)
    b = pipeline.metrics(t.where(F.col("timestamp") >= cut_b), h.where(F.col("timestamp") >= cut_b), TEST_LEXICON, cfg)
    return a, b


def _scratch_table(spark):
    import uuid

    from ..session import shared_path
    from ..sinks.parquet_table import KeyedParquetTable

    return KeyedParquetTable(spark, shared_path(spark, "moodtick-tables", uuid.uuid4().hex))


def _outdated(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` with wrong values in the windows that ``b`` has too."""
    both = b.select("ticker", "window_start", F.lit(True).alias("both"))
    own = a.join(both, ["ticker", "window_start"], "left")
    off = F.when(F.col("both"), 1000).otherwise(0)
    return own.withColumns({c: F.col(c) + off for c in ("avg_price", "max_price", "avg_sentiment")}).drop("both")


@register("snk_upsert_merge")
def q_snk_upsert_merge(spark, sf_dir):
    """Batch A then batch B merged into a keyed Parquet table; A holds other values
    on the overlap, B's replace them, so the table equals the metrics of all rows."""
    a, b = _split_batches(spark, sf_dir, HOURLY)
    a = _outdated(a, b)
    tbl = _scratch_table(spark)
    tbl.merge(a, 0)
    tbl.merge(b, 1)
    return round_doubles(tbl.read())


@register("snk_upsert_replay")
def q_snk_upsert_replay(spark, sf_dir):
    """As snk_upsert_merge, with batch B replayed under its own id (skipped) and
    applied again under a new id, by another writer and without an id: same table.
    A replay of A under its old id changes nothing; a merge of it would."""
    a, b = _split_batches(spark, sf_dir, HOURLY)
    a = _outdated(a, b)
    tbl = _scratch_table(spark)
    tbl.merge(a, 0)
    tbl.merge(b, 1)
    tbl.merge(a, 0)
    tbl.merge(b, 1)
    tbl.merge(b, 0, writer="another")
    tbl.merge(b)
    return round_doubles(tbl.read())


@register("src_metrics_read")
def q_src_metrics_read(spark, sf_dir):
    """Write the hourly metrics through the keyed sink, read the 9 columns back."""
    tbl = _scratch_table(spark)
    tbl.merge(metrics_view(spark, sf_dir, HOURLY), 0)
    return round_doubles(tbl.read())


RANGE = (dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11, 6))


@register("src_metrics_range")
def q_src_metrics_range(spark, sf_dir):
    """A range of window starts from the stored table: only the folders that meet it are opened."""
    tbl = _scratch_table(spark)
    tbl.merge(metrics_view(spark, sf_dir, HOURLY), 0)
    return round_doubles(tbl.read_range(*RANGE))


@register("dash_latest50_stored")
def q_dash_latest50_stored(spark, sf_dir):
    """The newest 50 rows of the stored table, from its newest folders."""
    tbl = _scratch_table(spark)
    tbl.merge(metrics_view(spark, sf_dir, HOURLY), 0)
    return round_doubles(tbl.newest(50))


@register("src_topic_files")
def q_src_topic_files(spark, sf_dir):
    """Both topics published as files and read through the topic reader, then decoded."""
    root = _scratch(spark)
    write_topic(P.encode_price_event(tables.ticks(spark, sf_dir), PRICE_TOPIC), fmt="files", path=f"{root}/topics")
    write_topic(P.encode_text_event(tables.headlines(spark, sf_dir), TEXT_TOPIC), fmt="files", path=f"{root}/topics")
    prices = P.parse_prices(read_envelope(spark, PRICE_TOPIC, fmt="files", path=f"{root}/topics", stream=False))
    texts = P.parse_texts(read_envelope(spark, TEXT_TOPIC, fmt="files", path=f"{root}/topics", stream=False))
    a = prices.select(F.lit(PRICE_TOPIC).alias("topic"), "ticker", "price", F.lit(None).cast("string").alias("source"), _ntz("timestamp").alias("timestamp"))
    b = texts.select(F.lit(TEXT_TOPIC).alias("topic"), "ticker", F.lit(None).cast("double").alias("price"), "source", _ntz("timestamp").alias("timestamp"))
    return a.unionByName(b)


# ---------------------------------------------------------------- dashboard


GLOBAL50 = HOURLY.with_(scope="global")
PER_TICKER50 = HOURLY.with_(scope="per_ticker")


def latest50(spark, sf_dir):
    return D.latest(metrics_view(spark, sf_dir, HOURLY), GLOBAL50)


@register("dash_latest50")
def q_dash_latest50(spark, sf_dir):
    return round_doubles(latest50(spark, sf_dir))


@register("dash_latest50_per_ticker")
def q_dash_latest50_per_ticker(spark, sf_dir):
    return round_doubles(D.latest(metrics_view(spark, sf_dir, HOURLY), PER_TICKER50))


@register("dash_distinct_tickers")
def q_dash_distinct_tickers(spark, sf_dir):
    return D.distinct_tickers(latest50(spark, sf_dir))


@register("dash_filter_ticker")
def q_dash_filter_ticker(spark, sf_dir):
    return round_doubles(D.select_ticker(latest50(spark, sf_dir), "click"))


@register("dash_kpis")
def q_dash_kpis(spark, sf_dir):
    return round_doubles(D.kpis_display(D.kpis(latest50(spark, sf_dir))))


@register("dash_kpis_all")
def q_dash_kpis_all(spark, sf_dir):
    """Unrounded KPIs for every ticker over the whole table."""
    return round_doubles(D.kpis(metrics_view(spark, sf_dir, HOURLY)))


@register("dash_kpis_empty")
def q_dash_kpis_empty(spark, sf_dir):
    return round_doubles(D.kpis_for(latest50(spark, sf_dir), "no_such_ticker"))


@register("dash_series")
def q_dash_series(spark, sf_dir):
    return round_doubles(D.series(latest50(spark, sf_dir)))


@register("dash_recent10")
def q_dash_recent10(spark, sf_dir):
    return round_doubles(D.recent(metrics_view(spark, sf_dir, HOURLY), HOURLY))


@register("dash_recent10_of_latest50")
def q_dash_recent10_of_latest50(spark, sf_dir):
    """The last ten windows per ticker of the dashboard's selection, the newest 50 rows."""
    return round_doubles(D.recent(latest50(spark, sf_dir), HOURLY))


@register("dash_latest")
def q_dash_latest(spark, sf_dir):
    m = metrics_view(spark, sf_dir, HOURLY)
    return round_doubles(
        m.groupBy("ticker").agg(
            F.max("window_start").alias("latest_window"),
            F.max_by("avg_price", "window_start").alias("latest_price"),
            F.max_by("avg_sentiment", "window_start").alias("latest_sentiment"),
        )
    )


@register("dash_delta")
def q_dash_delta(spark, sf_dir):
    k = D.kpis(metrics_view(spark, sf_dir, DAILY))
    return round_doubles(k.select("ticker", "first_price", "latest_price", "price_delta", "total_windows"))


@register("overlay_scaled")
def q_overlay_scaled(spark, sf_dir):
    return round_doubles(D.overlay(metrics_view(spark, sf_dir, HOURLY)))


@register("label_sentiment3")
def q_label_sentiment3(spark, sf_dir):
    m = metrics_view(spark, sf_dir, HOURLY)
    return round_doubles(m.select("ticker", "window_start", "avg_sentiment", L.sentiment3("avg_sentiment").alias("label")))


@register("label_sentiment5")
def q_label_sentiment5(spark, sf_dir):
    m = metrics_view(spark, sf_dir, HOURLY)
    return round_doubles(m.select("ticker", "window_start", "avg_sentiment", L.sentiment5("avg_sentiment").alias("label")))


@register("label_correlation")
def q_label_correlation(spark, sf_dir):
    return round_doubles(D.correlation(metrics_view(spark, sf_dir, DAILY)))


@register("label_correlation_small")
def q_label_correlation_small(spark, sf_dir):
    """Correlation and label over the newest 1, 2 and 3 windows of each ticker: none up to 2."""
    m = metrics_view(spark, sf_dir, DAILY)
    newest = m.withColumn("rn", F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("window_start"))))
    parts = [
        round_doubles(D.correlation(newest.where(F.col("rn") <= k))).select(F.lit(k).alias("selected"), "*") for k in (1, 2, 3)
    ]
    return parts[0].union(parts[1]).union(parts[2])


@register("corr_price_sentiment")
def q_corr_price_sentiment(spark, sf_dir):
    return round_doubles(D.correlation(metrics_view(spark, sf_dir, HOURLY)))


# ---------------------------------------------------------------- analyses


@register("an_direction_agreement")
def q_an_direction_agreement(spark, sf_dir):
    return round_doubles(A.direction_agreement(metrics_view(spark, sf_dir, DAILY), DAILY))


@register("an_negative_spikes")
def q_an_negative_spikes(spark, sf_dir):
    return round_doubles(A.negative_spikes(metrics_view(spark, sf_dir, HOURLY), HOURLY, z=2.0))


@register("an_lag_correlation")
def q_an_lag_correlation(spark, sf_dir):
    return round_doubles(A.lag_correlation(metrics_view(spark, sf_dir, DAILY), DAILY, max_lag=3))


@register("an_largest_changes")
def q_an_largest_changes(spark, sf_dir):
    return round_doubles(A.largest_changes(metrics_view(spark, sf_dir, DAILY), DAILY, n=10))


@register("an_sentiment_by_hour")
def q_an_sentiment_by_hour(spark, sf_dir):
    return round_doubles(A.sentiment_by_hour(metrics_view(spark, sf_dir, HOURLY)))


@register("an_volatility")
def q_an_volatility(spark, sf_dir):
    return round_doubles(A.volatility(metrics_view(spark, sf_dir, HOURLY), "1 day"))


WATCHLIST = ("click", "purchase", "view")


@register("an_watchlist_compare")
def q_an_watchlist_compare(spark, sf_dir):
    return round_doubles(A.watchlist_compare(metrics_view(spark, sf_dir, HOURLY), WATCHLIST))


# ---------------------------------------------------------------- lake layers, quality


def _arrivals(spark, sf_dir, root: str):
    """Both topics as files in two arrivals (before 2024-01-15, and the rest); yields the
    streams over all files that have arrived."""
    cut = instant_from_utc(F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00")))
    n = spark.sparkContext.defaultParallelism
    for early in (True, False):
        for name, env in (("prices", price_envelope(spark, sf_dir)), ("texts", text_envelope(spark, sf_dir))):
            before = F.coalesce(F.col("timestamp") < cut, F.lit(False))
            env.where(before if early else ~before).repartition(n).write.mode("append").parquet(f"{root}/{name}")
        yield (read_envelope(spark, PRICE_TOPIC, fmt="files", path=f"{root}/prices"),
               read_envelope(spark, TEXT_TOPIC, fmt="files", path=f"{root}/texts"))


def _lake(spark, sf_dir) -> lake.Lake:
    root = _scratch(spark)
    layers = lake.Lake(spark, f"{root}/lake", TEST_LEXICON, HOURLY)
    with session_conf(spark, stream_width(spark)):
        for prices, texts in _arrivals(spark, sf_dir, root):
            layers.advance(prices, texts)
    return layers


@register("lake_layers")
def q_lake_layers(spark, sf_dir):
    """Rows per layer and date of the stored layers, filled in two increments."""
    return lake.layer_counts(_lake(spark, sf_dir).read())


@register("lake_gold")
def q_lake_gold(spark, sf_dir):
    """The gold layer after two increments: all windows, each from all its events."""
    return round_doubles(_lake(spark, sf_dir).gold.read())


@register("dq_report")
def q_dq_report(spark, sf_dir):
    t = tables.table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("ticker"), F.col("value").alias("price"),
        instant_from_utc("ts").alias("timestamp"),
    )
    h = tables.headlines(spark, sf_dir)
    a = Q.stream_quality(t, "prices", "price", "event_id", "1 minute")
    b = Q.stream_quality(h, "headlines", "headline", "doc_id", "1 minute")
    return a.unionByName(b)


@register("dq_envelope")
def q_dq_envelope(spark, sf_dir):
    """Quality of a price topic carrying valid events, JSON without event fields
    and prose: one pass over every message."""
    return Q.envelope_quality(mixed_price_topic(spark, sf_dir), "price")


@register("dq_metrics")
def q_dq_metrics(spark, sf_dir):
    return Q.metrics_quality(metrics_view(spark, sf_dir, HOURLY))


# ---------------------------------------------------------------- streaming (run to completion, then read)


def _scratch(spark, *parts):
    import uuid

    from ..session import shared_path

    return shared_path(spark, "moodtick-streams", uuid.uuid4().hex, *parts)


def stage_topics(spark, sf_dir, root: str) -> tuple[str, str]:
    """Write both topics' envelopes as Parquet files (the replayable file form of a topic)."""
    pdir, tdir = f"{root}/prices", f"{root}/texts"
    # one file per core, like a topic with that many partitions, so a stream reads it in parallel
    n = spark.sparkContext.defaultParallelism
    price_envelope(spark, sf_dir).repartition(n).write.mode("overwrite").parquet(pdir)
    text_envelope(spark, sf_dir).repartition(n).write.mode("overwrite").parquet(tdir)
    return pdir, tdir


def _run_join_stream(spark, sf_dir, root: str | None = None):
    from ..sinks.parquet_table import KeyedParquetTable

    root = root or _scratch(spark)
    pdir, tdir = stage_topics(spark, sf_dir, root)
    prices = read_envelope(spark, PRICE_TOPIC, fmt="files", path=pdir)
    texts = read_envelope(spark, TEXT_TOPIC, fmt="files", path=tdir)
    # the whole history arrives as one micro-batch here (a backfill through the
    # stream), so day partitions; a live minute-triggered stream uses "hour"
    table = KeyedParquetTable(spark, f"{root}/table", granularity="day")
    with session_conf(spark, stream_width(spark)):
        q = SP.start(SP.correlation_stream(prices, texts, TEST_LEXICON, MINUTE), table.foreach_batch(),
                     f"{root}/checkpoint", name=None, trigger={"availableNow": True}, cfg=MINUTE)
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return round_doubles(table.read())


@register("join_price_sentiment_stream")
def q_join_price_sentiment_stream(spark, sf_dir):
    """The streaming pipeline (1-minute windows, 1-minute watermark) over the
    topics replayed from files with availableNow, merged into a keyed table.
    Only closed windows come out: end <= min over streams(max event time) - delay."""
    return _run_join_stream(spark, sf_dir)


@register("join_price_sentiment_stream_rocksdb")
def q_join_price_sentiment_stream_rocksdb(spark, sf_dir):
    """The same stream with its aggregation and join state in RocksDB."""
    with session_conf(spark, {"spark.sql.streaming.stateStore.providerClass": SP.ROCKSDB_PROVIDER}):
        return _run_join_stream(spark, sf_dir)


def _stream_window_to_files(spark, df, root: str):
    out = f"{root}/out"
    with session_conf(spark, stream_width(spark)):
        q = (
            _flat_window(df).writeStream.outputMode("append").format("parquet")
            .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(out)
        )
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out)


@register("join_price_sentiment_stream_steps")
def q_join_price_sentiment_stream_steps(spark, sf_dir):
    """The same stream in several micro-batches: both topics replayed ten days at a time,
    with state carried and watermarks moved from one to the next."""
    from ..sinks.parquet_table import KeyedParquetTable

    root = _scratch(spark)
    decade = F.expr("(dayofmonth(timestamp) - 1) div 10")
    for env, name in ((price_envelope(spark, sf_dir), "prices"), (text_envelope(spark, sf_dir), "texts")):
        write_steps(env.withColumn("decade", decade), f"{root}/{name}", key="decade")
    table = KeyedParquetTable(spark, f"{root}/table", granularity="day")
    streams = read_steps(spark, f"{root}/prices", PRICE_TOPIC), read_steps(spark, f"{root}/texts", TEXT_TOPIC)
    with session_conf(spark, stream_width(spark)):
        q = SP.start(SP.correlation_stream(*streams, TEST_LEXICON, MINUTE), table.foreach_batch(),
                     f"{root}/checkpoint", name=None, trigger={"availableNow": True}, cfg=MINUTE)
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return round_doubles(table.read())


@register("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """The mixed topic streamed into two outputs: every message is an accepted event or a
    reject with its raw text and the reason."""
    root = _scratch(spark)
    n = spark.sparkContext.defaultParallelism
    mixed_price_topic(spark, sf_dir).repartition(2 * n).write.parquet(f"{root}/topic")
    topic = read_envelope(spark, PRICE_TOPIC, fmt="files", path=f"{root}/topic", max_files_per_trigger=n)
    start_split(topic, "price", f"{root}/out", f"{root}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    good, bad = (read_output(spark, f"{root}/out", x, "price") for x in ("accepted", "rejected"))
    none = F.lit(None)
    good = good.select(F.lit("accepted").alias("output"), "ticker", "price", _ntz("timestamp").alias("timestamp"),
                       none.cast("string").alias("raw_value"), none.cast("string").alias("reason"))
    bad = bad.select(F.lit("rejected").alias("output"), none.cast("string").alias("ticker"), none.cast("double").alias("price"),
                     none.cast("timestamp_ntz").alias("timestamp"), "raw_value", "reason")
    return good.unionByName(bad)


#: The first version of the lexicon that the scoring stream finds; the second is TEST_LEXICON.
FIRST_LEXICON = {"that": 1.5, "can't": -2.0, ":)": 2.0}


@register("score_stream_lexicon")
def q_score_stream_lexicon(spark, sf_dir):
    """Headlines scored on a stream by a lexicon table of which a second version appears
    between two arrivals (events before 2024-01-15, and the rest)."""
    root = _scratch(spark)
    lexicon = LexiconTable(spark, f"{root}/lexicon")
    for (_, texts), entries in zip(_arrivals(spark, sf_dir, root), (FIRST_LEXICON, TEST_LEXICON)):
        lexicon.publish(spark.createDataFrame(list(entries.items()), "token string, valence double"))
        q = start_scoring(texts, lexicon, f"{root}/out", f"{root}/checkpoint", trigger={"availableNow": True})
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return read_scored(spark, f"{root}/out").select("ticker", "source", _ntz("timestamp").alias("timestamp"), "sentiment_score", "lexicon_version")


@register("str_state_rows")
def q_str_state_rows(spark, sf_dir):
    """The windows that the streaming join's aggregates still hold open after the replay,
    read back from the checkpoint."""
    root = _scratch(spark)
    _run_join_stream(spark, sf_dir, root)
    found = state.open_windows(spark, f"{root}/checkpoint")
    return found.select("side", "ticker", "window_start", "window_end")


@register("stream_price_window")
def q_stream_price_window(spark, sf_dir):
    root = _scratch(spark)
    pdir, _ = stage_topics(spark, sf_dir, root)
    ticks = P.parse_prices(read_envelope(spark, PRICE_TOPIC, fmt="files", path=pdir))
    return round_doubles(_stream_window_to_files(spark, Wn.price_window_metrics(ticks, MINUTE), root))


@register("stream_sentiment_window")
def q_stream_sentiment_window(spark, sf_dir):
    root = _scratch(spark)
    _, tdir = stage_topics(spark, sf_dir, root)
    texts = Wn.clean_and_score(P.parse_texts(read_envelope(spark, TEXT_TOPIC, fmt="files", path=tdir)),
                               TEST_LEXICON, MINUTE)
    return round_doubles(_stream_window_to_files(spark, Wn.sentiment_window_metrics(texts, MINUTE), root))


@register("stream_late_data")
def q_stream_late_data(spark, sf_dir):
    """Late data on the real tables: the headline topic is replayed one ticker per
    micro-batch, in ticker order (``sources.replay``: written in one job, any number of
    keys), so each ticker's history arrives after the previous ones have pushed the watermark to the end of the month. Rows whose window
    end is at or below the late-events watermark (the watermark two batches
    back) are dropped; the rest are aggregated in 1-minute windows and emitted
    once closed. Every row of the table goes through the stream."""
    root = _scratch(spark)
    write_steps(text_envelope(spark, sf_dir), f"{root}/texts")
    texts = P.parse_texts(read_steps(spark, f"{root}/texts", TEXT_TOPIC))
    scored = Wn.clean_and_score(texts, TEST_LEXICON, MINUTE)
    return round_doubles(_stream_window_to_files(spark, Wn.sentiment_window_metrics(scored, MINUTE), root))


def _run_join_late(spark, sf_dir, cfg: Config):
    from ..sinks.parquet_table import KeyedParquetTable

    root = _scratch(spark)
    write_steps(price_envelope(spark, sf_dir), f"{root}/prices")
    write_steps(text_envelope(spark, sf_dir), f"{root}/texts")
    prices = read_steps(spark, f"{root}/prices", PRICE_TOPIC)
    texts = read_steps(spark, f"{root}/texts", TEXT_TOPIC)
    table = KeyedParquetTable(spark, f"{root}/table", granularity="day")
    keep = {"spark.sql.streaming.multipleWatermarkPolicy": spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy")}
    with session_conf(spark, {**stream_width(spark), **keep}):
        q = SP.start(SP.correlation_stream(prices, texts, TEST_LEXICON, cfg), table.foreach_batch(),
                     f"{root}/checkpoint", name=None, trigger={"availableNow": True}, cfg=cfg)
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return round_doubles(table.read())


@register("join_stream_late_data")
def q_join_stream_late_data(spark, sf_dir):
    """The stream-stream pipeline with late data on both inputs: both topics are
    replayed one ticker per micro-batch, in ticker order. The global watermark is the minimum
    of the two streams' (max event time - delay); rows whose window end is at or
    below the late-events watermark are dropped on each side before the
    aggregates meet in the join. Every row of both tables goes through the stream."""
    return _run_join_late(spark, sf_dir, MINUTE)


@register("join_stream_late_data_max_policy")
def q_join_stream_late_data_max_policy(spark, sf_dir):
    """As join_stream_late_data with the global watermark the maximum over the
    two streams (the faster stream drives; more rows of the slower one are late)."""
    return _run_join_late(spark, sf_dir, MINUTE.with_(watermark_policy="max"))
