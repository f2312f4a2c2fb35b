"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _attach(edges: DataFrame, mins: DataFrame) -> DataFrame:
    return edges.join(mins, "u")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _attach(both.where("v > u"), m).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    m = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = _attach(e, m).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.union(m.select("u", F.col("m").alias("v"))).distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v) bigint links in either direction -> (node, component), component the
    smallest node reachable. Nodes without a link to another node are not returned.

    Every round is two joins on the node id and two distributed minima; nothing is
    collected but a row count and a checksum. A hot node (the centre of a large star)
    is split by Spark's skew join. Null ends and self links are ignored; an empty
    table gives an empty result."""
    e = checkpoint(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = _state(e)
    while state[0]:
        e = checkpoint(_small_star(_large_star(e)))
        if (new := _state(e)) == state:
            break
        state = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v"), F.col("v")).distinct()
    )
