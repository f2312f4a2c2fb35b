"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming check.

Fingerprints within ``max_bits`` of each other that are cut into more than
``max_bits`` blocks agree on at least ``blocks - max_bits`` whole blocks. Every
choice of that many blocks is a mask; fingerprints equal under a mask meet in a
bucket and are compared there. A bucket of more than BUCKET distinct fingerprints is
dealt into tiles of that size, and every two tiles are compared by a task of their own.
Above TILES tiles the bucket is cut again first, by the same step on the bits its mask
leaves open (RECUTS times at most), so the result stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import checkpoint, clean_name, forget, small_batches
from .components import components

SEED = 42
BUCKET = 4096
TILES = 64
RECUTS = 2
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The signed 64-bit fingerprint of one text; 0 without words."""
    import xxhash

    words = (text or b"").lower().split()  # bytes: A-Z, and ASCII white space, only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(joined, SEED)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-shingle] + 1])
        cuts = zip(starts.tolist(), ends[shingle - 1 :].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), "<u8", len(starts))
    by_byte = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by_byte[:, k], minlength=256) @ _BITS for k in range(7, -1, -1)])
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, out: str = "fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint (bigint) in column ``out``."""
    schema = StructType([*docs.schema.fields, StructField(out, LongType())])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for b in batches:
            texts = b.column(at).cast(pa.binary())
            fps = pa.array([fingerprint(x.as_py(), shingle) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, fps], names=[*b.schema.names, out])

    return small_batches(docs).mapInArrow(run, schema)


@lru_cache(maxsize=100_000)
def masks(mask: int, blocks: int, max_bits: int) -> tuple[int, ...]:
    """The masks below ``mask`` (bits already fixed): each choice of blocks of the open bits."""
    open_bits = [i for i in range(64) if not mask >> i & 1]
    cut = [sum(1 << int(i) for i in part) for part in np.array_split(open_bits, blocks)]
    return tuple(mask | sum(c) for c in combinations(cut, blocks - max_bits))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _expand(blocks: int, max_bits: int):
    def run(batches):
        for b in batches:
            fixed, fp = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1))
            for m in np.unique(fixed):
                own = fp[fixed == m]
                for mask in masks(int(m), blocks, max_bits):
                    key = np.full(len(own), mask, np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in (key, own & key, own)], names=["mask", "part", "fp"]
                    )

    return run


def star_links(fp: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the fingerprints linked at ``max_bits`` or fewer bits, as (root, member) positions."""
    out, rest = [], np.arange(len(fp))
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            near = np.bitwise_count(fp[rest] ^ fp[front.pop()]) <= max_bits
            reached, rest = rest[near], rest[~near]
            out += [(int(root), int(x)) for x in reached]
            front += list(reached)
    return out


_FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("mask", pa.int64()), ("part", pa.int64()), ("tile", pa.int32()), ("fps", pa.binary())])
_FOUND_DDL = "u long, v long, mask long, part long, tile int, fps binary"


def _linked(fp: np.ndarray, max_bits: int) -> pa.RecordBatch | None:
    found = np.array(star_links(fp, max_bits), np.int64).reshape(-1, 2)
    if not len(found):
        return None
    ends = fp.view(np.int64)[found.T]
    none = [pa.nulls(len(found), f.type) for f in list(_FOUND)[2:]]
    return pa.RecordBatch.from_arrays([pa.array(ends[0]), pa.array(ends[1]), *none], schema=_FOUND)


def _compare(max_bits: int):
    """Partitions sorted by bucket -> links (u, v); a bucket that is too large comes back in
    tiles of BUCKET fingerprints (mask, part, tile, fps)."""

    def run(batches):
        key, held, tile = None, np.empty(0, np.uint64), 0

        def cut():
            nonlocal held, tile
            row = {"u": None, "v": None, "mask": key[0], "part": key[1], "tile": tile, "fps": held[:BUCKET].tobytes()}
            held, tile = held[BUCKET:], tile + 1
            return pa.RecordBatch.from_pylist([row], _FOUND)

        def settle():
            if tile:
                while len(held):
                    yield cut()
            elif len(held) > 1 and (found := _linked(held, max_bits)):
                yield found

        for b in batches:
            mask, part, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (part[1:] != part[:-1])) + 1
            edges = [0, *cuts.tolist(), len(fp)]
            for a, z in zip(edges, edges[1:]):
                if a == z:
                    continue
                if (here := (int(mask[a]), int(part[a]))) != key:
                    yield from settle()
                    key, held, tile = here, np.empty(0, np.uint64), 0
                held = np.concatenate([held, fp[a:z]]) if len(held) else fp[a:z]
                while len(held) > BUCKET:
                    yield cut()
        yield from settle()

    return run


def _opened(batches):
    """Tiles -> their fingerprints, to be cut again."""
    for b in batches:
        for mask, fps in zip(b.column(0).to_pylist(), b.column(1)):
            fp = np.frombuffer(fps.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), mask)), pa.array(fp)], names=["mask", "fp"])


def _pairs_of_tiles(max_bits: int):
    """Partitions sorted by pair -> links within the two tiles of each."""

    def run(batches):
        key = first = None
        for b in batches:
            pairs = zip(*(b.column(i).to_pylist() for i in range(4)))
            for here, fps in zip(pairs, b.column(4)):
                own = np.frombuffer(fps.as_py(), np.uint64)
                if here == key and (found := _linked(np.concatenate([first, own]), max_bits)):
                    yield found.select(["u", "v"])
                key, first = here, own

    return run


def links(fps: DataFrame, max_bits: int = 4, blocks: int | None = None) -> DataFrame:
    """Distinct ``fp`` bigint -> (u, v): links that join exactly the fingerprints
    connected by steps of ``max_bits`` or fewer bits (a spanning forest of every
    bucket, not all its pairs)."""
    blocks = blocks or max_bits + 2
    todo = fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    found = []
    for depth in range(RECUTS + 1):
        out = checkpoint(
            todo.mapInArrow(_expand(blocks, max_bits), "mask long, part long, fp long")
            .repartition("mask", "part")
            .sortWithinPartitions("mask", "part")
            .mapInArrow(_compare(max_bits), _FOUND_DDL)
        )
        found.append(out.where("u IS NOT NULL").select("u", "v"))
        sizes = out.where("u IS NULL").groupBy("mask", "part").agg((F.max("tile") + 1).alias("tiles"))
        large = out.where("u IS NULL").select("mask", "part", "tile", "fps").join(sizes, ["mask", "part"])
        if sizes.isEmpty():
            break
        side_by_side = large if depth == RECUTS else large.where(F.col("tiles") <= TILES)
        pairs = side_by_side.select("mask", "part", "tile", "fps", F.explode(F.expr("sequence(0, tiles - 1)")).alias("other")).where("tile <> other")
        pairs = pairs.select("mask", "part", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "fps")
        found.append(
            pairs.repartition("mask", "part", "low", "high")
            .sortWithinPartitions("mask", "part", "low", "high")
            .mapInArrow(_pairs_of_tiles(max_bits), "u long, v long")
        )
        todo = large.where(F.col("tiles") > TILES).select("mask", "fps").mapInArrow(_opened, "mask long, fp long")
        if depth == RECUTS or todo.isEmpty():
            break
    return reduce(DataFrame.union, found)


def blocks_for(n: int, max_bits: int) -> int:
    """So many blocks that ``n`` evenly spread fingerprints stay well below BUCKET a bucket."""
    for blocks in range(max_bits + 2, max_bits + 5):
        if n >> (64 * (blocks - max_bits) // blocks) < BUCKET // 4:
            break
    return blocks


def groups(fps: DataFrame, max_bits: int = 4, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp) -> one row per distinct fp: fp, component_id (smallest non-null
    doc_id reachable; null if all are null), keep_fp (a fingerprint that doc_id has).

    Copies collapse to one node before anything is joined, so a group of exact
    copies of any size costs one partial row per task."""
    nodes = checkpoint(fps.groupBy("fp").agg(F.min(doc_id).alias("least")))
    found = components(links(nodes.select("fp"), max_bits, blocks_for(nodes.count(), max_bits))).withColumnRenamed("node", "fp")
    own = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = own.groupBy("component").agg(
        F.min(F.struct(F.col("least").isNull().alias("none"), F.col("least").alias("id"), F.col("fp"))).alias("k")
    )
    return own.join(first, "component").select(
        "fp", F.col("k.id").alias("component_id"), F.col("k.fp").alias("keep_fp")
    )


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts, and texts of white space, have fingerprint zero and are
    linked like any other; texts with fewer words than a shingle have the whole
    sequence as their one shingle. Repeated rows and ids are returned as often as
    they occur. A null doc_id is returned; it names a component only if the
    component has no other (component_id null). Extra columns are not read. An
    empty table gives no rows."""
    fps = checkpoint(with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle).drop("text"))
    # a fingerprint that a third of the rows share is split by the skew join
    return fps.join(groups(fps, max_bits), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` with one row of each component left: the one with the
    smallest doc_id (null last). Rows that agree in doc_id and fingerprint are taken
    for one document; any one of them, the first by a hash of its text, stays."""
    fp, rank = clean_name(docs, "fp"), clean_name(docs, "rank")
    own = with_fingerprints(docs, text, shingle, fp)
    fps = checkpoint(own.select(F.col(doc_id).alias("doc_id"), F.col(fp).alias("fp")))
    stay = groups(fps, max_bits).select("component_id", "keep_fp").distinct()
    keep_id, keep_fp = clean_name(own, "keep_id"), clean_name(own, "keep_fp")
    stay = stay.select(F.col("component_id").alias(keep_id), F.col("keep_fp").alias(keep_fp))
    kept = own.join(stay, own[doc_id].eqNullSafe(stay[keep_id]) & (own[fp] == stay[keep_fp]), "left_semi")
    w = Window.partitionBy(doc_id, fp).orderBy(F.xxhash64(text))
    return kept.withColumn(rank, F.row_number().over(w)).where(F.col(rank) == 1).select(*docs.columns)
