import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtick.llm import substrings
from moodtick.llm.common import read

SF = "/root/testdata/sf0.001"


def plain(rows, length):
    """(doc_id, n_words, n_removed, kept text) of (doc_id, text) rows, by a table of all windows."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    where = {}
    for (d, _), w in zip(rows, split):
        for i in range(len(w) - length + 1):
            where.setdefault(tuple(w[i : i + length]), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in where.items()}
    out = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - length + 1):
            m = least[tuple(w[i : i + length])]
            if m is not None and (d is None or m < d):
                gone.update(range(i, i + length))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def check(df, **how):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    found = substrings.deduplicated(df, **how)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found.collect()), key=repr)
    assert got == plain(rows, how.get("length", 50))
    return got


def test_documents_against_brute_force(spark):
    assert sum(r[2] for r in check(read(spark, SF, "documents"))) > 100


def test_edge_cases(spark, edge, no_rows):
    check(edge.withColumn("id", F.lit(1)).withColumn("windows", F.lit(2)), length=8, seed=3)
    again = edge.union(edge.withColumn("doc_id", F.col("doc_id") + 100))
    check(again, length=5, seed=2)
    out = substrings.deduplicated(edge.withColumn("n_words", F.lit(1)), length=8, seed=3)
    assert out.columns == [*edge.columns, "n_words", "_n_words", "n_removed", "repeats"]
    assert substrings.deduplicated(no_rows).count() == 0


@pytest.mark.parametrize("length, seed", [(12, 4), (12, 12), (9, 1)])
def test_passages_with_edits_and_edges(spark, length, seed):
    """Few words (ties among grams), passages cut, moved, edited and repeated, equal ids, null ids."""
    rng = random.Random(length * 100 + seed)
    pool = [[rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    rows = []
    for d in range(120):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = list(rng.choice(pool))
            a = rng.randrange(len(p))
            words += p[a:] if rng.random() < 0.5 else p
            if rng.random() < 0.3 and words:
                words[rng.randrange(len(words))] = "edit"
            words += [f"own{d}"] if rng.random() < 0.5 else []
        rows.append((rng.choice([d, d, d // 2, None]), "  ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), length=length, seed=seed)


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    """Runs cut at other places in each copy: the copies are found by their reaches."""
    text = " ".join(f"w{i * i % 977}" for i in range(700))
    rows = [(k, " ".join([f"own{k}"] * k + [text])) for k in range(1, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = check(df)
    # workers fork with the module as it is here: a small chunk cuts runs in every text
    monkeypatch.setattr(substrings, "CHUNK", 64)
    hashes = substrings.Words().of(text.encode().split())
    first, shape = substrings.runs(hashes)[2:]
    n = shape % substrings.SHAPE
    assert n.sum() == 651 and (np.diff(first) == n[:-1]).all() and set(range(64, 651, 64)) <= set(first.tolist())
    assert sum(r[2] for r in whole) == 4 * 700


def test_maximal_repeats(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(1, passage), (2, f"x {passage} y {passage}"), (3, passage[:-4])], "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.repeats] for r in substrings.deduplicated(df).collect()}
    assert found == {1: [], 2: [(1, 61), (62, 122)], 3: [(0, 59)]}
