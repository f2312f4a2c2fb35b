import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from moodtick.llm import merkle
from moodtick.session import shared_path

COLUMNS = ["doc_id", "source", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def sides(tree, i, fanout):
    out = []
    for level in tree[:-1]:
        a = i - i % fanout
        out.append((i % fanout, "".join(level[a:i] + level[i + 1 : a + fanout])))
        i //= fanout
    return out


def plain(rows, fanout):
    """(doc_id, source, leaf, subroot, root, sides) of (doc_id, source, text) rows."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), r[0]))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s])], fanout) for s in names}
    top = levels([trees[s][-1][0] for s in names], fanout)
    return [
        (x[3], s, x[2], trees[s][-1][0], top[-1][0], sides(trees[s], i, fanout) + sides(top, k, fanout))
        for k, s in enumerate(names)
        for i, x in enumerate(sorted(by[s]))
    ]


def written(spark, df, fanout, stride, claim=None):
    m = merkle.Manifest(spark, shared_path(spark, f"merkle-{uuid.uuid4().hex}"), fanout, stride)
    return m.write(merkle.leaves(df, COLUMNS, claim))


def check(spark, df, fanout, stride):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    found = [(r.doc_id, r.source, r.leaf, r.subroot, r.root, [tuple(s) for s in r.sides]) for r in written(spark, df, fanout, stride).proofs().collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, plain(rows, fanout)))


@pytest.mark.parametrize("fanout, stride", [(2, 3), (3, 1), (16, 2)])
def test_trees_of_all_sizes_against_brute_force(spark, fanout, stride):
    """Sources of 1 to 83 rows, sizes at and beside powers; null source, null ids, repeated rows."""
    sizes = {"a": 1, "b": 2, "é": 8, "B": 9, "c": 16, "d": 17, "e": 64, "f": 65, None: 83, "": 3}
    rows = [(i % 61 if i % 7 else None, s, f"t{i % 50}" if i % 5 else None) for s, n in sizes.items() for i in range(n)]
    check(spark, spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5), fanout, stride)


def test_edge_cases(spark, edge, no_rows):
    named = edge.withColumn("source", F.col("lang")).withColumn("node", F.lit(1)).withColumn("tree", F.lit(2))
    check(spark, named, 4, 2)
    assert written(spark, no_rows.withColumn("source", F.col("lang")), 16, 2).proofs().count() == 0


def test_a_changed_row_is_found(spark):
    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("Text "), "id").alias("text"))
    other = merkle.digest(F.col("doc_id"), F.col("source"), F.lower("text"))
    found = written(spark, df, 4, 2, F.when(F.col("doc_id") % 10 == 0, other)).proofs()
    ok = found.withColumn("ok", merkle.folded(F.coalesce("claim", "leaf"), F.col("sides")) == F.col("root"))
    assert {r.doc_id for r in ok.where("NOT ok").collect()} == set(range(0, 100, 10))


def test_only_every_few_levels_are_stored(spark):
    m = written(spark, spark.range(300).selectExpr("id AS doc_id", "'s' AS source", "'x' AS text"), 4, 2)
    assert [m.stored("source", k).select(F.sum(F.size("nodes"))).first()[0] for k in range(3)] == [300, 19, 2]
