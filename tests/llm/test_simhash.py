import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from moodtick.llm import components, simhash
from moodtick.llm.common import read

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, max_bits=4):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(rows))]


def check(df):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in df.select("doc_id", "text").collect()]
    want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(rows, plain_components(rows))), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str) == want


def test_documents_against_brute_force(spark):
    check(read(spark, SF, "documents"))


def test_edge_cases(edge, no_rows):
    check(edge)
    assert simhash.near_duplicates(no_rows).count() == 0
    left = simhash.deduplicated(edge)
    assert left.columns == edge.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 5, 6]
    assert simhash.deduplicated(no_rows).count() == 0


@pytest.mark.parametrize("tiles", [64, 3])
def test_large_buckets(spark, monkeypatch, tiles):
    """Many fingerprints of one neighbourhood in buckets above the limit: tile by tile, or cut again first."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(150)}
    monkeypatch.setattr(simhash, "BUCKET", 16 if tiles == 64 else 40)
    monkeypatch.setattr(simhash, "TILES", tiles)
    monkeypatch.setattr(simhash, "RECUTS", 1)
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    found = {r.node: r.component for r in components.components(simhash.links(df)).collect()}
    rows = [(simhash._signed(f), f) for f in sorted(fps)]
    want = plain_components(rows)
    for (s, _), c in zip(rows, want):
        assert found.get(s, s) == c


def test_blocks_follow_the_number_of_fingerprints():
    assert [simhash.blocks_for(n, 4) for n in (0, 10**6, 10**9, 10**10, 10**11, 10**15)] == [6, 6, 6, 7, 7, 8]


def test_long_chain_is_one_component(spark):
    chain = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    found = components.components(chain).collect()
    assert {r.node for r in found} == set(range(201)) and {r.component for r in found} == {0}


def test_fingerprints_are_spread_over_masks():
    masks = simhash.masks(0, 6, 4)
    assert len(masks) == 15 and all(m.bit_count() in (21, 22, 20) for m in masks)
