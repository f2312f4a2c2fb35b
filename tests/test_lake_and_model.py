"""Lake layers written and read back; user-model plug-in scorer."""

from pyspark.sql import functions as F

from conftest import SF001
from moodtick.functions.sentiment import TEST_LEXICON, model_scorer
from moodtick.plans import catalog
from moodtick.sinks import lake


def test_layers_written_partitioned_by_date(spark, scratch):
    ls = lake.layers(catalog.price_envelope(spark, SF001), catalog.text_envelope(spark, SF001), TEST_LEXICON,
                     catalog.HOURLY)
    lake.write_layers(ls, scratch)
    expect = {(r.layer, r.event_date, r.n_rows) for r in lake.layer_counts(ls).collect()}
    got = set()
    for name in ls:
        back = spark.read.parquet(f"{scratch}/{name}")
        got |= {(name, r.event_date, r["count"]) for r in back.groupBy(lake.DATE_COL).count().collect()}
    assert got == expect
    # a date filter prunes to one partition directory
    gold = spark.read.parquet(f"{scratch}/gold").where(F.col(lake.DATE_COL) == "2024-01-02")
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    # rewriting one date replaces only that date (dynamic partition overwrite)
    one = {"gold": ls["gold"].where(F.col(lake.DATE_COL) == "2024-01-02").limit(1)}
    lake.write_layers(one, scratch)
    after = {r.event_date.isoformat(): r["count"] for r in
             spark.read.parquet(f"{scratch}/gold").groupBy(lake.DATE_COL).count().collect()}
    assert after["2024-01-02"] == 1 and len(after) == len({d for (n, d, _) in expect if n == "gold"})


def test_model_scorer_scores_every_row(spark):
    """The plug-in point: an iterator pandas UDF around a user's model (here a
    text-length model); the model is built once per task by ``load``."""

    def load():
        return lambda s: s.fillna("").str.len().astype("float64")

    score = model_scorer(load)
    df = spark.range(0, 5000, numPartitions=2).select(F.col("id").cast("string").alias("t"))
    out = df.select(score("t").alias("s")).agg(F.sum("s"), F.count("s")).first()
    assert out[0] == float(sum(len(str(i)) for i in range(5000))) and out[1] == 5000
