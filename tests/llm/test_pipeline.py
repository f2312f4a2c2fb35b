import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from moodtick.llm import bpe, common, decontaminate, simhash
from moodtick.llm.common import read

from .test_decontaminate import plain as windows
from .test_quality import plain as counts
from .test_simhash import plain_components, plain_fingerprint
from .test_tokens import ENCODING

SF = "/root/testdata/sf0.001"
PRIVATE = re.compile(r"\+\d \(\d{3}\) \d{3}-\d{4}|[\w.]+@[\w.]+\w|\b\d{16}\b|\b(?:\d{1,3}\.){3}\d{1,3}\b")


def test_stages_against_brute_force(spark, scratch):
    docs, columns = read(spark, SF, "documents"), read(spark, SF, "documents").columns
    held = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        held.append((before, {r.doc_id: r for r in docs.collect()}))
        assert k == 4 or docs.columns == columns
    (a, b), (c, d), (e, f), (g, h), (i, j) = held
    # too few labels here for a cutoff: the base rules alone decide
    assert set(b) == {x for x, r in a.items() if not counts(r.text)[-1]} and all(b[x] == a[x] for x in b)
    rows = [(x, plain_fingerprint(r.text)) for x, r in sorted(c.items())]
    assert set(d) == set(plain_components(rows)) and all(d[x] == c[x] for x in d)
    items = [(str(r.item_id), r.text) for r in read(spark, SF, "benchmark").collect()]
    for x, r in e.items():
        n, hit, _ = windows(r.text, items)
        assert (x in f) == (hit <= n * 0.5)
        if x in f:
            assert f[x].n_chars == len(f[x].text) and windows(f[x].text, items)[1] == 0
            assert hit or f[x].text == r.text
    assert set(g) == set(h)
    private = {p for r in g.values() for p in PRIVATE.findall(r.text)}
    assert private and not private & {p for r in h.values() for p in PRIVATE.findall(r.text)}
    assert all(PRIVATE.sub("", h[x].text) == PRIVATE.sub("", g[x].text) for x in g)
    assert set(i) == set(j)
    for x, r in j.items():
        want = np.array(ENCODING.encode_ordinary(i[x].text), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(i[x].text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_empty_documents(spark, no_rows, scratch):
    docs = read(spark, SF, "documents").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{k}")
        docs = spark.read.parquet(f"{scratch}/{k}")
        assert docs.count() == 0


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture()
def fresh(spark):
    """A session without bounds of its own on Arrow batches but Spark's."""
    own, rows = spark.newSession(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    own.conf.set(rows, "10000")
    own.conf.unset(BATCH_BYTES)
    return own


def test_arrow_batches_of_the_operators_are_bounded_by_bytes(fresh):
    """10,000 rows of 5 kB, and one row above the bound, whole."""

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64()), "bytes": pa.array([b.nbytes], pa.int64())})

    long = "w" * (3 * common.BATCH)
    docs = fresh.range(10_000, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")
    docs = docs.union(fresh.createDataFrame([(10_000, long)], docs.schema).coalesce(1)).coalesce(1)
    bench = fresh.createDataFrame([("a", " ".join("abcdefghijkl"))], "item_id string, text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    for of in (
        lambda: simhash.with_fingerprints(docs),
        lambda: decontaminate.matches(docs, bench),
        lambda: bpe.encoded(docs, path, public_tokenizers.PATTERN),
    ):
        fresh.conf.unset(BATCH_BYTES)
        of()
        found = docs.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r.n for r in found) == 10_001
        *most, last = sorted(r.bytes for r in found)  # a batch ends with the row that reaches the bound
        assert max(most) < 2 * common.BATCH and last < 2 * common.BATCH + len(long)


def test_a_bound_of_the_session_is_kept(fresh):
    fresh.conf.set(BATCH_BYTES, "12345")
    simhash.with_fingerprints(fresh.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert fresh.conf.get(BATCH_BYTES) == "12345"


def _remembers(spark):
    """(pid, what the worker remembers) of the workers that were asked."""

    def ask(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"pid": pa.array([os.getpid()], pa.int64()), "key": pa.array([str(common._HELD[0])])})

    return spark.range(1, numPartitions=1).mapInArrow(ask, "pid long, key string").collect()


def test_workers_forget_the_words_of_an_operator_at_the_next(fresh):
    docs = fresh.range(8, numPartitions=1).selectExpr("id AS doc_id", "'some words of a text' AS text")
    bench = fresh.createDataFrame([("a", " ".join("abcdefghijkl"))], "item_id string, text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")

    def words():
        return len(bpe.encoded(docs, path, public_tokenizers.PATTERN).collect())

    for other in (lambda: simhash.with_fingerprints(docs), lambda: decontaminate.matches(docs, bench)):
        assert words() == 8
        (before,) = _remembers(fresh)
        other().collect()
        (after,) = _remembers(fresh)
        if before.pid == after.pid and "bpe" in before.key:
            assert after.key == "None"


def test_held_makes_one_thing_at_a_time():
    made = []
    try:
        a = common.held("a", lambda: made.append("a") or made[:])
        assert common.held("a", lambda: made.append("again")) is a
        assert common.held("b", lambda: made.append("b") or made[:]) == ["a", "b"]
        common.forget()
        assert common._HELD == [None, None]
        assert common.held("b", lambda: made.append("b") or made[:]) == ["a", "b", "b"]
    finally:
        common.forget()
