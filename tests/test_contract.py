"""Driver contract, scorer equivalence, and plan shape."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001, SF01
from moodtick.functions import sentiment as S
from moodtick.functions.text import clean_text
from moodtick.plans import catalog
from moodtick.sources import tables


def test_entry_runs_with_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 30
    assert df.columns == [
        "ticker", "window_start", "window_end", "avg_price", "min_price", "max_price",
        "price_count", "avg_sentiment", "headline_count",
    ]


def test_every_query_has_oracle_or_is_streaming():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(catalog.QUERIES) <= set(o)


def test_map_and_join_scoring_agree_on_documents(spark):
    h = tables.headlines(spark, SF01).select("doc_id", clean_text("headline").alias("cleaned_headline"))
    a = h.select("doc_id", S.score_column(F.col("cleaned_headline"), S.TEST_LEXICON).alias("s"))
    b = S.score_by_join(h, ["doc_id"], "cleaned_headline", S.lexicon_frame(spark, S.TEST_LEXICON))
    diff = a.join(b, "doc_id", "full").where(~F.col("s").eqNullSafe(F.col("sentiment_score")))
    assert diff.count() == 0 and a.count() == b.count() == 1000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_stays_in_the_jvm(spark):
    p = plan(catalog.QUERIES["score_lexicon"](spark, SF001))
    assert "Python" not in p
    # the test file is one row group (one split): rows are spread before scoring
    assert "RoundRobinPartitioning" in p


def test_scan_prunes_columns(spark):
    df = catalog.QUERIES["agg_price_window"](spark, SF001)
    p = plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p or (
        "ReadSchema: struct<event_type:string,value:double,ts:timestamp_ntz>" in p
    ), p


def test_watchlist_filter_reaches_the_scan(spark):
    from moodtick.operators import analyses as A

    m = catalog.metrics_view(spark, SF001, catalog.HOURLY)
    df = A.watchlist_compare(m, ["click", "view"])
    p = df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ex = plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "PushedFilters: [In(event_type, [click,view])" in ex or "In(event_type" in ex, ex
    assert p


def test_join_reuses_aggregate_partitioning(spark):
    """The whole-window key lets the join reuse the aggregates' hash
    partitioning: one exchange per side, none added for the join."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(catalog.metrics_view(spark, SF001, catalog.MINUTE))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in p, p


def test_small_side_broadcast_only_after_measurement(spark):
    """Static plan: sort-merge join. After execution AQE has measured the
    aggregated side and switched to a broadcast join."""
    df = catalog.metrics_view(spark, SF001, catalog.MINUTE)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final and "BroadcastHashJoin" in final, final


@pytest.mark.parametrize("name", ["dash_latest50_per_ticker", "dash_recent10"])
def test_per_ticker_topk_is_limited_before_shuffle(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(catalog.QUERIES[name](spark, SF001))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p, p


def test_window_aggregates_combine_map_side(spark):
    import re

    p = re.sub(r"#\d+L?", "", plan(catalog.metrics_view(spark, SF001, catalog.HOURLY)))
    for f in ("partial_avg(price)", "partial_min(price)", "partial_max(price)", "partial_count(price)",
              "partial_avg(sentiment_score)", "partial_count(headline)"):
        assert f in p, f


def test_spread_only_when_input_has_few_splits(spark):
    from moodtick.operators.partitioning import spread

    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == cores
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread(many) is many


def test_results_do_not_depend_on_the_session_time_zone(spark):
    """Window bounds are UTC wall clock even under another session zone."""
    utc = {tuple(r) for r in catalog.QUERIES["join_price_sentiment_hourly"](spark, SF001).collect()}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ny = {tuple(r) for r in catalog.metrics_view(spark, SF001, catalog.HOURLY).transform(catalog.round_doubles)
              .collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ny == utc and len(utc) > 0
