"""Keyed sink: merge, replay, replacement, NULL prices, key checks, JDBC SQL."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from moodtick.operators.shape import conform, key_violations, shape_metrics
from moodtick.schemas import METRICS
from moodtick.sinks.jdbc import create_table_sql, merge_sql
from moodtick.sinks.merge import dedup_batch, merge_frames
from moodtick.sinks.parquet_table import KeyedParquetTable


def metrics_rows(spark, rows):
    return spark.createDataFrame(rows, METRICS)


def row(t, day, minute, price, sent=0.1, n=1, h=1):
    start = dt.datetime(2024, 1, day, 10, minute)
    return (t, start, start + dt.timedelta(minutes=1), price, price, price, n, sent, h)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_merge_twice_equals_once(spark, scratch):
    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    batch = metrics_rows(spark, [row("A", 1, 0, 1.0), row("A", 2, 0, 2.0), row("B", 1, 0, 3.0)])
    assert tbl.merge(batch, 0)
    once = as_set(tbl.read())
    assert not tbl.merge(batch, 0)  # replay of the same batch id: no-op
    assert tbl.merge(batch, 1)  # same rows under a new id: same table
    assert as_set(tbl.read()) == once and len(once) == 3


def test_changed_row_replaces_non_key_columns(spark, scratch):
    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    tbl.merge(metrics_rows(spark, [row("A", 1, 0, 1.0), row("A", 1, 1, 5.0), row("A", 3, 0, 9.0)]), 0)
    tbl.merge(metrics_rows(spark, [row("A", 1, 0, 2.0, sent=-0.5, n=4, h=7)]), 1)
    got = {(r.ticker, r.window_start): r for r in tbl.read().collect()}
    assert len(got) == 3
    r = got[("A", dt.datetime(2024, 1, 1, 10, 0))]
    assert (r.avg_price, r.avg_sentiment, r.price_count, r.headline_count) == (2.0, -0.5, 4, 7)
    assert got[("A", dt.datetime(2024, 1, 1, 10, 1))].avg_price == 5.0
    # only the touched date was rewritten
    parts = tbl.current()["partitions"]
    assert parts["2024-01-01"].startswith("data/b000000000001") and parts["2024-01-03"].startswith("data/b000000000000")


def test_window_with_only_null_prices_is_stored_null(spark):
    joined = spark.createDataFrame(
        [("A", (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 1)), None, None, None, 0, None, 1)],
        "ticker string, time_window struct<start:timestamp,end:timestamp>, avg_price double, min_price double,"
        " max_price double, price_count bigint, avg_sentiment double, headline_count bigint",
    )
    r = shape_metrics(joined).first()
    assert r.avg_price is None and r.price_count == 0 and r.avg_sentiment == 0.0
    assert [f.dataType for f in conform(shape_metrics(joined)).schema] == [f.dataType for f in METRICS]


def test_dedup_batch_is_deterministic(spark):
    b = metrics_rows(spark, [row("A", 1, 0, 1.0), row("A", 1, 0, 3.0), row("A", 1, 0, 2.0)])
    assert [r.avg_price for r in dedup_batch(b).collect()] == [3.0]
    t = metrics_rows(spark, [row("A", 1, 0, 0.5), row("B", 1, 0, 0.7)])
    m = {(r.ticker, r.avg_price) for r in merge_frames(t, b).collect()}
    assert m == {("A", 3.0), ("B", 0.7)}


def test_key_violations(spark):
    rows = [row("A", 1, 0, 1.0), row("A", 1, 0, 2.0), row("TOO_LONG_TICKER", 1, 0, 1.0)]
    df = spark.createDataFrame(rows, METRICS)
    assert key_violations(df).count() == 2
    assert key_violations(df.dropDuplicates(["ticker", "window_start"]).where(F.length("ticker") <= 10)).count() == 0


def test_jdbc_statements():
    ddl = create_table_sql()
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS stock_sentiment_metrics (ticker VARCHAR(10) NOT NULL")
    assert "PRIMARY KEY (ticker, window_start)" in ddl
    cols = [f.name for f in METRICS.fields]
    pg = merge_sql("m", "m_stage_3", cols, ("ticker", "window_start"), "postgres")
    assert "ON CONFLICT (ticker, window_start) DO UPDATE SET window_end = EXCLUDED.window_end" in pg
    assert "ticker = EXCLUDED.ticker" not in pg
    ansi = merge_sql("m", "m_stage_3", cols, ("ticker", "window_start"), "ansi", stage_quote='"')
    assert ansi.startswith('MERGE INTO m t USING m_stage_3 s ON t.ticker = s."ticker" AND t.window_start = s."window_start"')
    assert 'WHEN NOT MATCHED THEN INSERT (ticker, window_start' in ansi


def test_jdbc_read_predicates_cover_every_row():
    import datetime as dt

    from moodtick.sources.metrics import date_predicates

    p = date_predicates(dt.date(2024, 1, 1), dt.date(2024, 1, 3))
    assert len(p) == 4
    assert p[0] == "window_start >= TIMESTAMP '2024-01-01 00:00:00' AND window_start < TIMESTAMP '2024-01-02 00:00:00'"
    assert p[-1].startswith("window_start < TIMESTAMP '2024-01-01 00:00:00' OR window_start >= TIMESTAMP '2024-01-04")


def test_hour_partitions_rewrite_only_the_touched_hour(spark, scratch):
    tbl = KeyedParquetTable(spark, f"{scratch}/t", granularity="hour")
    first = [row("A", 1, 0, 1.0), row("B", 1, 0, 2.0)]
    later = dt.datetime(2024, 1, 1, 11, 0)
    first.append(("A", later, later + dt.timedelta(minutes=1), 3.0, 3.0, 3.0, 1, 0.0, 1))
    tbl.merge(metrics_rows(spark, first), 0)
    tbl.merge(metrics_rows(spark, [row("A", 1, 0, 9.0)]), 1)
    parts = tbl.current()["partitions"]
    assert sorted(parts) == ["2024-01-01T10", "2024-01-01T11"]
    assert parts["2024-01-01T10"].startswith("data/b000000000001") and parts["2024-01-01T11"].startswith("data/b000000000000")
    assert {(r.ticker, r.avg_price) for r in tbl.read().collect()} == {("A", 9.0), ("B", 2.0), ("A", 3.0)}


def test_merge_rejects_key_constraint_violations(spark, scratch):
    import pytest

    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    for bad in ([row(None, 1, 0, 1.0)], [row("TOO_LONG_TICKER", 1, 0, 1.0)]):
        nullable = "ticker string, window_start timestamp_ntz, window_end timestamp_ntz, avg_price double, " \
                   "min_price double, max_price double, price_count int, avg_sentiment double, headline_count int"
        df = spark.createDataFrame(bad, nullable)
        with pytest.raises(ValueError, match="constraints"):
            tbl.merge(df, 0)
    assert tbl.current() is None


def test_vacuum_keeps_what_retained_snapshots_read(spark, scratch):
    import os

    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    tbl.merge(metrics_rows(spark, [row("A", 1, 0, 1.0), row("A", 2, 0, 2.0)]), 0)
    tbl.merge(metrics_rows(spark, [row("A", 1, 0, 3.0)]), 1)
    tbl.merge(metrics_rows(spark, [row("A", 1, 0, 4.0)]), 2)
    before = as_set(tbl.read())
    batches = sorted(os.listdir(f"{scratch}/t/data"))
    deleted = tbl.vacuum(retain=2)
    # snapshot 0's day-1 partition is read by neither of the two newest snapshots
    assert f"data/{batches[0]}/window_part=2024-01-01" in deleted and "_log/000000000000.json" in deleted
    assert os.path.isdir(f"{scratch}/t/data/{batches[0]}/window_part=2024-01-02")  # still current
    assert os.path.isdir(f"{scratch}/t/data/{batches[1]}/window_part=2024-01-01")  # read by snapshot 1
    assert as_set(tbl.read()) == before
    assert tbl.vacuum(retain=2) == []


def test_no_writer_loses_a_batch(spark, scratch):
    """Batch ids belong to a writer: a new checkpoint, a second stream and a backfill all merge."""
    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    assert tbl.merge(metrics_rows(spark, [row("A", 1, 0, 1.0)]), 5, writer="one")
    assert tbl.merge(metrics_rows(spark, [row("A", 1, 1, 2.0)]), 0, writer="new checkpoint")
    assert tbl.merge(metrics_rows(spark, [row("A", 2, 0, 3.0)]))
    assert not tbl.merge(metrics_rows(spark, [row("A", 1, 0, 9.0)]), 5, writer="one")
    assert tbl.merge(metrics_rows(spark, [row("B", 1, 0, 4.0)]), 6, writer="one")
    assert not tbl.merge(metrics_rows(spark, [row("A", 1, 1, 9.0)]), 0, writer="new checkpoint")
    assert sorted(r.avg_price for r in tbl.read().collect()) == [1.0, 2.0, 3.0, 4.0]


def test_rows_that_break_a_constraint(spark, scratch):
    from pyspark.sql import functions as F

    good, late = metrics_rows(spark, [row("A", 1, 0, 1.0)]), metrics_rows(spark, [row("A", 1, 1, 2.0)])
    bad = late.withColumn("window_end", F.lit(None).cast("timestamp_ntz")).union(metrics_rows(spark, [row("LONGER_THAN_TEN", 1, 0, 3.0)]))
    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    with pytest.raises(ValueError):
        tbl.merge(good.union(bad), 0)
    assert tbl.current() is None
    assert tbl.merge(good.union(bad), 0, on_violation="reject")
    assert tbl.merge(bad, 1, on_violation="reject")
    assert tbl.read().count() == 1
    assert sorted(r.reason for r in tbl.rejects().collect()) == ["long ticker"] * 2 + ["null window_end"] * 2


def test_range_read_and_newest_open_only_the_folders_they_need(spark, scratch):
    """30 days: one day opens one folder; the newest rows open as many as hold them."""
    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    tbl.merge(metrics_rows(spark, [row(t, d, m, d + m / 10) for t in "AB" for d in range(1, 31) for m in range(3)]), 0)

    def folders(df):
        return {f.split("window_part=")[1].split("/")[0] for f in df.inputFiles()}

    day = tbl.read_range(dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8))
    assert folders(day) == {"2024-01-07"} and day.count() == 6
    part = tbl.read_range(dt.datetime(2024, 1, 7, 10, 1), dt.datetime(2024, 1, 8, 10, 1))
    assert folders(part) == {"2024-01-07", "2024-01-08"} and part.count() == 6
    assert tbl.read_range(dt.datetime(2025, 1, 1)).count() == 0 and tbl.read_range().count() == 180
    seven = tbl.newest(7)
    assert folders(seven) == {"2024-01-29", "2024-01-30"}
    want = tbl.read().orderBy(F.desc("window_start"), "ticker").limit(7)
    assert seven.collect() == want.collect()
    assert tbl.newest(1000).count() == 180 and KeyedParquetTable(spark, f"{scratch}/none").newest(3).count() == 0
    nulls = tbl.log.state().files[f"{next(p for p in tbl.log.state().files)}"]
    assert nulls["rows"] == 6 and nulls["nulls"] == {}


def test_two_writers_both_land(spark, scratch, monkeypatch):
    """A second writer commits between a merge's read and its publication: other partitions
    only need the next version, the same partition is merged again."""
    root = f"{scratch}/t"
    one, two = KeyedParquetTable(spark, root), KeyedParquetTable(spark, root)
    one.merge(metrics_rows(spark, [row("A", 1, 0, 1.0)]), 0, writer="one")
    commit, others = one.log.commit, [[row("B", 2, 0, 2.0)], [row("C", 1, 0, 3.0), row("A", 1, 0, 9.0)]]

    def late(*a, **k):
        if others:
            two.merge(metrics_rows(spark, others.pop(0)), writer="two")
        return commit(*a, **k)

    monkeypatch.setattr(one.log, "commit", late)
    assert one.merge(metrics_rows(spark, [row("A", 1, 0, 5.0), row("A", 1, 1, 6.0)]), 1, writer="one")
    got = {(r.ticker, r.window_start.day, r.window_start.minute): r.avg_price for r in one.read().collect()}
    assert got == {("A", 1, 0): 5.0, ("A", 1, 1): 6.0, ("B", 2, 0): 2.0, ("C", 1, 0): 3.0}
    assert one.current()["version"] == 3 and not one.merge(metrics_rows(spark, [row("A", 1, 0, 7.0)]), 1, writer="one")


def test_writers_in_threads(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    tables = [KeyedParquetTable(spark, f"{scratch}/t") for _ in range(3)]
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(t.merge, metrics_rows(spark, [row("ABC"[i], 1, k, float(k + i))]), k, f"w{i}") for k in range(3) for i, t in enumerate(tables)]
        assert sum(j.result() for j in jobs) >= 3
    state = tables[0].log.state()
    got = {(r.ticker, r.window_start.minute) for r in tables[0].read().collect()}
    # ids of one writer that came out of order are replays; everything committed is there
    assert {("ABC"[i], n) for i in range(3) for n in [state.writers[f"w{i}"]]} <= got and len(state.files) == 1


def test_a_commit_does_not_grow_with_the_table(spark, scratch, monkeypatch):
    from moodtick.sinks import commit_log

    log = commit_log.CommitLog(spark, f"{scratch}/t")
    sizes, create = [], log._create

    def sized(name, content):
        sizes.append((name, create(name, content)))

    monkeypatch.setattr(log, "_create", sized)
    state = log.state()
    for k in range(45):
        state = log.commit(state, {f"data/b{k:05d}/window_part=x{k:05d}": {"part": f"x{k:05d}", "rows": 1}}, [], "w", k)
    own = [n for name, n in sizes if "checkpoint" not in name]
    assert max(own) - min(own) <= 4 and [name[:12] for name, _ in sizes if "checkpoint" in name] == ["000000000019", "000000000039"]
    again = commit_log.CommitLog(spark, f"{scratch}/t").state()
    assert again == state and len(again.files) == 45 and again.writers == {"w": 44}
    assert len(log.state(7).files) == 8
    with pytest.raises(commit_log.Conflict):
        log.commit(log.state(3), {}, [])
    assert log.forget(3) and log.state() == state and len(log.state(42).files) == 43 and log.forget(3) == []


def test_expire_drops_whole_partitions(spark, scratch):
    tbl = KeyedParquetTable(spark, f"{scratch}/t")
    tbl.merge(metrics_rows(spark, [row("A", d, 0, 1.0) for d in (1, 2, 3)]), 0)
    assert tbl.expire(dt.datetime(2024, 1, 3, 10)) == ["2024-01-01", "2024-01-02"]
    assert [r.window_start.day for r in tbl.read().collect()] == [3] and tbl.expire(dt.datetime(2024, 1, 3)) == []
    assert tbl.read(version=0).count() == 3
