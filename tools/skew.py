"""Hot-key experiment: one ticker holds 40% of all price rows.

Runs the hourly metrics pipeline and the per-ticker dashboard queries on a
skewed derivation of ``events`` (event types click and view both become ticker
``hot``), with Spark's event log written to a fresh scratch folder, then
reports per stage how many records the busiest task read against the median.

Usage: python tools/skew.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="moodtick-eventlog-")
    from pyspark.sql import functions as F

    from moodtick.config import Config
    from moodtick.functions.sentiment import TEST_LEXICON
    from moodtick.operators import analyses as A
    from moodtick.operators import dashboard as D
    from moodtick.plans import pipeline
    from moodtick.session import build_session
    from moodtick.sources import tables

    spark = build_session(
        "local[8]",
        app_name="moodtick-skew",
        shuffle_partitions=8,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # keep every reduce partition visible (AQE would merge these small shuffles into one task)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    cfg = Config(window="1 hour")
    ticks = tables.ticks(spark, sf_dir).withColumn(
        "ticker", F.when(F.col("ticker").isin("click", "view"), F.lit("hot")).otherwise(F.col("ticker"))
    )
    share = ticks.agg(F.avg((F.col("ticker") == "hot").cast("double"))).first()[0]
    heads = tables.headlines(spark, sf_dir).withColumn(
        "ticker", F.when(F.col("ticker").isin("click", "view"), F.lit("hot")).otherwise(F.col("ticker"))
    )
    m = pipeline.metrics(ticks, heads, TEST_LEXICON, cfg)
    jobs = {
        "metrics": m,
        "per_ticker_top50": D.latest(m, cfg.with_(scope="per_ticker")),
        "kpis_all_tickers": D.kpis(m),
        "direction_agreement": A.direction_agreement(m, cfg),
    }
    for name, df in jobs.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()

    # read the event log: records read per task, per stage
    stage_name, per_stage = {}, {}
    for path in sorted(glob.glob(os.path.join(logdir, "**", "*"), recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                if e.get("Event") == "SparkListenerStageSubmitted":
                    info = e["Stage Info"]
                    desc = (e.get("Properties") or {}).get("spark.job.description", "")
                    stage_name[info["Stage ID"]] = desc
                if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                    tm = e["Task Metrics"]
                    recs = tm["Input Metrics"]["Records Read"] + tm["Shuffle Read Metrics"]["Total Records Read"]
                    per_stage.setdefault(e["Stage ID"], []).append(recs)
    print(json.dumps({"sf_dir": sf_dir, "hot_share_of_price_rows": round(share, 3), "event_log": logdir}))
    print("| job | stage | tasks | records read (max task) | records read (median task) |")
    print("| --- | --- | --- | --- | --- |")
    for sid in sorted(per_stage):
        r = per_stage[sid]
        if sum(r) == 0:
            continue
        print(f"| {stage_name.get(sid, '')} | {sid} | {len(r)} | {max(r):,} | {int(statistics.median(r)):,} |")


if __name__ == "__main__":
    main()
