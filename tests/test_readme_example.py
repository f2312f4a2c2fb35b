"""The README's batch example, run on the test tables."""

from conftest import SF001
from moodtick.config import Config
from moodtick.functions.sentiment import TEST_LEXICON
from moodtick.operators.parse import parse_prices, parse_texts
from moodtick.plans import catalog
from moodtick.plans.dashboard import dashboard_view
from moodtick.plans.pipeline import metrics
from moodtick.sinks.parquet_table import KeyedParquetTable
from moodtick.sources.envelope import read_envelope


def test_batch_backfill_then_dashboard(spark, scratch):
    pdir, tdir = catalog.stage_topics(spark, SF001, scratch)
    cfg = Config(window="1 hour")
    p = parse_prices(read_envelope(spark, cfg.price_topic, fmt="files", path=pdir, stream=False))
    t = parse_texts(read_envelope(spark, cfg.text_topic, fmt="files", path=tdir, stream=False))
    table = KeyedParquetTable(spark, f"{scratch}/metrics", granularity="day")
    assert table.merge(metrics(p, t, TEST_LEXICON, cfg), batch_id=0)
    stored = table.read()
    assert stored.count() == catalog.metrics_view(spark, SF001, catalog.HOURLY).count()
    view = dashboard_view(stored, ticker="click")
    k = view["kpis_display"].first()
    assert k.ticker == "click" and k.total_windows == view["selected"].count() > 0
