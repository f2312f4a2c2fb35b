"""Merkle manifest of a table: one tree per source, one tree over their roots.

Checkpoint and recompute: of each tree only every ``stride``-th level is written, as one
row per aligned subtree (the nodes of its lowest level and its top). The levels between
are made again from that row when proofs are read, their siblings emitted, and forgotten.
Hashing is SQL on arrays; Python only numbers the sorted leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint

FANOUT = 16
STRIDE = 2
_LEAF = ["node", "doc_id", "source", "claim"]
NODE = "array<struct<node string, doc_id long, source string, claim string>>"


def digest(*values) -> Column:
    """Lower-case hex sha256 of a row's values: each '-' if null, else its UTF-8 bytes' number, ':', itself."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def leaves(docs: DataFrame, columns: list[str], claim: Column | None = None) -> DataFrame:
    """doc_id, source, the row's digest ``node``, and ``claim``: the digest that a copy
    holds for the row (null: the same)."""
    own = digest(*[F.col(f"`{c}`") for c in columns])
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        own.alias("node"), (F.lit(None) if claim is None else claim).cast("string").alias("claim"),
    )


# ------------------------------------------------------------------ numbers


def _sources(batches: Iterator[pa.RecordBatch]):
    """Per batch: the batch, and (first row, source) of every stretch of one source."""
    for b in batches:
        codes = b.column("source").dictionary_encode(null_encoding="encode")
        at, names = codes.indices.to_numpy(zero_copy_only=False), codes.dictionary.to_pylist()
        if len(at):
            cuts = [0, *((at[1:] != at[:-1]).nonzero()[0] + 1).tolist()]
            yield b, [(c, names[at[c]]) for c in cuts]


def _summary(batches):
    """One row per partition: its number, the first and last source, how many sources, rows of the last one."""
    last, first, trees, rows, part = None, None, 0, 0, None
    for b, cuts in _sources(batches):
        for (a, name), z in zip(cuts, [c for c, _ in cuts[1:]] + [b.num_rows]):
            if trees and name == last:
                rows += z - a
            else:
                first = name if not trees else first
                trees, rows, last = trees + 1, z - a, name
        part = b.column("part")[0].as_py()
    if trees:
        yield pa.RecordBatch.from_pylist([{"part": part, "first": first, "last": last, "trees": trees, "rows": rows}], _SUMMARY)


_SUMMARY = pa.schema([("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("trees", pa.int64()), ("rows", pa.int64())])


def _numbered(start: dict[int, tuple[int, int]]):
    def run(batches):
        tree = pos = last = None
        for b, cuts in _sources(batches):
            if tree is None:  # the number of the first row's tree, and the row's place in it
                (tree, pos), last = start[b.column("part")[0].as_py()], cuts[0][1]
            trees, places = [], []
            for (a, name), z in zip(cuts, [c for c, _ in cuts[1:]] + [b.num_rows]):
                if name != last:
                    tree, pos, last = tree + 1, 0, name
                trees.append(np.full(z - a, tree))
                places.append(np.arange(pos, pos + z - a))
                pos += z - a
            own = [pa.array(np.concatenate(x).astype(np.int64)) for x in (trees, places)]
            yield pa.RecordBatch.from_arrays([*own, *[b.column(c) for c in _LEAF]], names=["tree", "pos", *_LEAF])

    return run


def numbered(found: DataFrame) -> DataFrame:
    """The leaves with ``tree`` (number of their source, null first, by bytes) and ``pos`` in it
    (by doc_id, null first; ties by digest).

    A range sort deals a source over many tasks, equal rows too; the driver sees one row
    per partition and adds up where each begins."""
    found = checkpoint(found.withColumn("copy", F.monotonically_increasing_id()))
    order = ["source", "doc_id", "node", "copy"]
    rows = checkpoint(found.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy"))
    rows = rows.withColumn("part", F.spark_partition_id())
    start, tree, pos, last = {}, -1, 0, object()
    parts = rows.select("part", "source").mapInArrow(_summary, "part int, first string, last string, trees long, rows long")
    for r in sorted(parts.collect(), key=lambda r: r["part"]):
        if r["first"] != last:
            tree, pos = tree + 1, 0
        start[r["part"]] = (tree, pos)
        pos = r["rows"] + (pos if r["trees"] == 1 else 0)
        tree, last = tree + r["trees"] - 1, r["last"]
    return rows.mapInArrow(_numbered(start), "tree long, pos long, node string, doc_id long, source string, claim string")


# ------------------------------------------------------------------ trees


def _risen(nodes: Column, fanout: int) -> Column:
    """The level above: every ``fanout`` digests (the last run may have fewer) become one."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, F.lit(fanout)), ""), 256))


def _blocks(nodes: DataFrame, fanout: int, stride: int) -> DataFrame:
    """(tree, pos, node, …) -> one row per aligned subtree: its nodes, its top, whether the
    tree ends here (it has no other subtree on this level, so it rises until one node is left)."""
    cap = fanout**stride
    rows = (
        nodes.withColumn("block", F.expr(f"pos div {cap}")).groupBy("tree", "block")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "node", "doc_id", "source", "claim"))).alias("nodes"))
        .withColumn("whole", (F.col("block") == 0) & (F.size("nodes") < cap))
        .withColumn("top", F.col("nodes.node"))
    )
    for _ in range(stride):
        rows = rows.withColumn("top", F.when(F.col("whole") & (F.size("top") == 1), F.col("top")).otherwise(_risen(F.col("top"), fanout)))
    keep = F.transform("nodes", lambda x: F.struct(x["node"].alias("node"), x["doc_id"].alias("doc_id"), x["source"].alias("source"), x["claim"].alias("claim")))
    return rows.select("tree", "block", "whole", F.element_at("top", 1).alias("top"), keep.cast(NODE).alias("nodes"))


def _bare(nodes: DataFrame) -> DataFrame:
    none = [F.lit(None).cast(t).alias(c) for c, t in (("doc_id", "long"), ("source", "string"), ("claim", "string"))]
    return nodes.select("tree", "pos", "node", *none)


class Manifest:
    """The stored levels of all trees below ``folder``: ``kind=source`` and, over their
    roots, ``kind=root``; ``level=k`` holds the subtrees whose lowest level is ``k * stride``."""

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT, stride: int = STRIDE):
        self.spark, self.folder, self.fanout, self.stride = spark, folder, fanout, stride

    def stored(self, kind: str, level: int) -> DataFrame:
        schema = f"tree long, block long, whole boolean, top string, nodes {NODE}"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/kind={kind}/level={level}")

    def _store(self, kind: str, nodes: DataFrame) -> tuple[int, DataFrame]:
        """Write every ``stride``-th level; (how many, (tree, top) of all trees)."""
        level, ends = 0, None
        while True:
            _blocks(nodes, self.fanout, self.stride).write.parquet(f"{self.folder}/kind={kind}/level={level}")
            found = self.stored(kind, level)
            done = found.where("whole").select("tree", F.col("top").alias("node"))
            ends = done if ends is None else ends.union(done)
            rest = found.where("NOT whole").select("tree", F.col("block").alias("pos"), F.col("top").alias("node"))
            level += 1
            if rest.isEmpty():
                return level, ends
            nodes = _bare(rest)

    def write(self, found: DataFrame) -> "Manifest":
        """Build all trees over ``leaves``."""
        sources, ends = self._store("source", numbered(found))
        tops = ends.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "node")
        roots, _ = self._store("root", _bare(tops))
        height = [(kind, n) for kind, n in (("source", sources), ("root", roots))]
        self.spark.createDataFrame(height, "kind string, levels int").coalesce(1).write.parquet(f"{self.folder}/heights")
        return self

    def _paths(self, kind: str, levels: int, above: DataFrame) -> DataFrame:
        """``above``: (tree, sides, …) of every tree's top. One row per lowest node: its tree,
        place, itself, and ``sides`` from it to the top of all: (its place in the run, the
        other digests of the run) of each level."""
        extra = [c for c in above.columns if c not in ("tree", "sides")]
        ends = above.withColumn("block", F.lit(0).cast("long")).withColumn("whole", F.lit(True))
        upper = None
        for level in range(levels - 1, -1, -1):
            tops = ends if upper is None else ends.unionByName(upper.withColumn("whole", F.lit(False)))
            own = self._regenerated(self.stored(kind, level)).join(tops, ["tree", "block", "whole"])
            upper = own.select("tree", "block", F.posexplode("steps"), "sides", *extra).select(
                "tree", (F.col("block") * self.fanout**self.stride + F.col("pos")).alias("block"),
                F.concat("col.sides", "sides").alias("sides"), "col.node", *extra)
            if level:
                upper = upper.drop("node")
        return upper

    def _regenerated(self, stored: DataFrame) -> DataFrame:
        """The levels between, made again for every stored subtree: ``steps``, one (node, sides) per lowest node."""
        n = self.fanout
        stored = stored.withColumn("level0", F.col("nodes.node"))
        for k in range(1, self.stride):
            stored = stored.withColumn(f"level{k}", _risen(F.col(f"level{k - 1}"), n))

        def side(j: Column, k: int) -> Column:
            at = F.floor(j / n**k).cast("int")
            run = F.slice(F.col(f"level{k}"), at - at % n + 1, F.lit(n))
            others = F.concat(F.slice(run, F.lit(1), at % n), F.slice(run, at % n + 2, F.lit(n)))
            step = F.struct((at % n).alias("at"), F.array_join(others, "").alias("others"))
            return F.when(~F.col("whole") | (F.size(f"level{k}") > 1), step)

        def steps(x: Column, j: Column) -> Column:
            return F.struct(x.alias("node"), F.filter(F.array(*[side(j, k) for k in range(self.stride)]), lambda s: s.isNotNull()).alias("sides"))

        return stored.select("tree", "block", "whole", "top", F.transform("nodes", steps).alias("steps"))

    def proofs(self) -> DataFrame:
        """One row per leaf: doc_id, source, ``leaf``, ``claim``, ``subroot``, ``root``, and
        ``sides`` from the leaf to the root (see ``folded``)."""
        levels = dict(tuple(r) for r in self.spark.read.parquet(f"{self.folder}/heights").collect())
        none = F.array().cast("array<struct<at int, others string>>")
        root = self.stored("root", levels["root"] - 1).select("tree", none.alias("sides"), F.col("top").alias("root"))
        tops = self._paths("root", levels["root"], root).select(
            F.col("block").alias("tree"), "sides", F.col("node.node").alias("subroot"), "root")
        found = self._paths("source", levels["source"], tops)
        return found.select("node.doc_id", "node.source", F.col("node.node").alias("leaf"), "node.claim", "subroot", "root", "sides")


def siblings(sides: Column) -> Column:
    """The digests of a proof as one text, from the leaf's run to the root's, left to right."""
    return F.array_join(F.transform(sides, lambda s: s["others"]), "")


def folded(leaf: Column, sides: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    def up(node: Column, s: Column) -> Column:
        cut = s["at"] * 64
        return F.sha2(F.concat(F.substring(s["others"], F.lit(1), cut), node, F.substring(s["others"], cut + 1, F.length(s["others"]))), 256)

    return F.aggregate(sides, leaf, up)
