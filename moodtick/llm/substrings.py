"""Repeated passages of words between documents: winnowed anchors, extended both ways.

Of the ``SEED``-word grams in a window of ``length`` words the one with the least hash is
the window's anchor, so equal windows have equal anchors at equal places. Consecutive
windows mostly share an anchor: such a run is one row. Documents are joined on anchors.

Extension never looks at pairs. Runs with one anchor that reach equally far to both sides
(a digest of all their words) are one class, and every run of a class repeats the one in
the smallest document. Where an anchor has several classes, as at the edges of a passage,
the first run of each class is extended on its own: first by half the missing words to the
left (for the windows that reach so far) and to the right (for the others), which must
agree with another document; then word by word, every reach of so many words to the left
and the rest of ``length`` to the right being a class again. Classes are counted as partial
aggregates, so an anchor that a third of the documents share costs one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import checkpoint, clean_name

LENGTH = 50
SEED = 10
CHUNK = 1 << 16
VOCABULARY = 1 << 20
#: Odd multipliers of the two rolling hashes, and of the finishing steps.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIXERS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
NULL_ID = 2**63 - 1
SHAPE = 1 << 32

# ------------------------------------------------------------------ words as numbers


class Words(dict):
    """word (bytes) -> its column in ``hashes``, two 64-bit hashes a word."""

    def __init__(self):
        self.hashes = np.empty((2, 1024), np.uint64)

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h, at = xxhash.xxh3_128_intdigest(word), len(self)
        if at == self.hashes.shape[1]:
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)], axis=1)
        self.hashes[0, at], self.hashes[1, at] = h & 0xFFFFFFFFFFFFFFFF, h >> 64
        self[word] = at
        return at

    def of(self, words: list[bytes]) -> np.ndarray:
        """(2, n) hashes of a text's words; words are forgotten between texts when there are many."""
        if len(self) > VOCABULARY:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.hashes[:, at]


def _mix(x: np.ndarray) -> np.ndarray:
    for m in MIXERS:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hash of any stretch of a text's words in two lookups."""

    powers = [np.ones(1, np.uint64)] * 4  # of the bases and of their inverses modulo 2^64

    def __init__(self, hashes: np.ndarray, kind: int):
        n = len(hashes) + 1
        for k, base in ((kind, BASES[kind]), (kind + 2, pow(BASES[kind], -1, 1 << 64))):
            if len(Rolling.powers[k]) < n:
                factors = np.full(2 * n, base, np.uint64)
                factors[0] = 1
                Rolling.powers[k] = np.cumprod(factors, dtype=np.uint64)
        self.back = Rolling.powers[kind + 2]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * Rolling.powers[kind][: n - 1], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])


def runs(hashes: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """(seed hash, digest of the run's reach, first window, shape) of every run of windows with
    one anchor: it has shape % 2^32 windows and its anchor begins shape // 2^32 words after
    the first one's start. A run also ends every CHUNK windows."""
    windows = hashes.shape[1] - length + 1
    if windows < 1:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    grams = Rolling(hashes[0], 0)
    at = np.arange(hashes.shape[1] - seed + 1)
    grams = grams(at, at + seed)
    view = np.lib.stride_tricks.sliding_window_view(grams, length - seed + 1)
    anchor = np.concatenate([view[a : a + CHUNK].argmin(axis=1) + np.arange(a, min(a + CHUNK, windows)) for a in range(0, windows, CHUNK)])
    new = anchor[1:] != anchor[:-1]
    new[CHUNK - 1 :: CHUNK] = True
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    n = np.diff(np.append(first, windows))
    reach = Rolling(hashes[1], 1)(first, first + n + length - 1)
    shape = (anchor[first] - first) * SHAPE + n
    return grams[anchor[first]], _mix(reach + shape.astype(np.uint64)), first, shape


def _words(text) -> list[bytes]:
    return (text.as_buffer().to_pybytes() if text.is_valid else b"").split()


def _packed(rows: Iterator[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of equally long arrays (numbers are repeated) as batches of about CHUNK rows."""
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=names)

    for row in rows:
        n = len(row[-1])
        for a in range(0, n, CHUNK):
            held.append([np.full(min(n - a, CHUNK), x) if isinstance(x, int) else x[a : a + CHUNK] for x in row])
            size += len(held[-1][-1])
            if size >= CHUNK:
                yield batch()
                held, size = [], 0
    if held:
        yield batch()


def _runs_of(length: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        memory = Words()
        for b in batches:
            ids, hashes = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, text in enumerate(b.column(2).cast(pa.binary())):
                words = _words(text)
                if len(words) >= length:
                    g, d, first, shape = runs(memory.of(words), length, seed)
                    yield ids[i], hashes[i], g.view(np.int64), d.view(np.int64), first, shape

    return lambda batches: _packed(rows(batches), ["id", "hash", "g", "d", "first", "shape"])


def _halves_of(length: int, seed: int):
    """Texts and their runs -> one row per half of a run: the digest ``e`` of the anchor with
    half of the missing words on one side, and the digests ``w`` of the windows on that side."""
    half = (length - seed) // 2

    def run(batches):
        memory = Words()
        for b in batches:
            ids, hashes, found = (b.column(k).to_pylist() for k in (0, 1, 3))
            out = []
            for i, text in enumerate(b.column(2).cast(pa.binary())):
                roll = Rolling(memory.of(_words(text))[1], 1)
                g = np.array([r["g"] for r in found[i]])
                first = np.array([r["first"] for r in found[i]])
                shape = np.array([r["shape"] for r in found[i]])
                anchor, end = first + shape // SHAPE, first + shape % SHAPE
                middle = np.clip(anchor - half + 1, first, end)  # windows before it reach half to the left
                sides = ((first, middle, anchor - half, anchor + seed), (middle, end, anchor, anchor + seed + half))
                for start, stop, a, z in sides:
                    use = stop > start
                    start, stop = start[use], stop[use]
                    sizes = stop - start
                    at = np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    w = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), roll(at, at + length).view(np.int64))
                    own = [np.full(len(start), x) for x in (ids[i], hashes[i])]
                    columns = [*map(pa.array, (*own, g[use], roll(a[use], z[use]).view(np.int64), start)), w]
                    out.append(pa.RecordBatch.from_arrays(columns, names=["id", "hash", "g", "e", "first", "w"]))
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


# ------------------------------------------------------------------ the join


def _least(rows: DataFrame, *key: str) -> DataFrame:
    """The keys that two ids have, and the smallest of them. Written down, so that a join on
    them is planned between two shuffles, where Spark splits a hot key."""
    found = rows.groupBy(*key).agg(F.min("id").alias("least"), F.max("id").alias("most"))
    return checkpoint(found.where("least < most").drop("most"))


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(id, hash, windows): for every text the windows, as (first, n) stretches, whose words
    also stand in a document with a smaller doc_id. ``hash`` is the text's xxhash64, ``id``
    the doc_id, a null one being the largest long. Texts without such a window have no row."""
    own = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    found = checkpoint(own.mapInArrow(_runs_of(length, seed), "id long, hash long, g long, d long, first long, shape long"))
    shared = checkpoint(found.join(_least(found, "g"), "g", "left_semi"))
    placed = shared.join(_least(shared, "g", "d"), ["g", "d"], "left")
    whole = placed.where("id > least").select("id", "hash", "first", F.expr(f"shape % {SHAPE}").alias("n"))

    several = checkpoint(shared.groupBy("g").agg((F.min("d") < F.max("d")).alias("several")).where("several").select("g"))
    opened = placed.where("least IS NULL OR id = least").join(several, "g", "left_semi")
    opened = opened.groupBy("id", "hash").agg(F.collect_set(F.struct("g", "first", "shape")).alias("runs"))
    texts = own.join(opened, ["id", "hash"]).select("id", "hash", "text", "runs")
    halves = checkpoint(texts.mapInArrow(_halves_of(length, seed), "id long, hash long, g long, e long, first long, w array<long>"))
    agreed = halves.join(_least(halves, "g", "e"), ["g", "e"], "left_semi")
    reaches = checkpoint(agreed.select("id", "hash", "g", "first", F.posexplode("w").alias("k", "w")).select("id", "hash", "g", "w", (F.col("first") + F.col("k")).alias("first")))
    part = reaches.join(_least(reaches, "g", "w"), ["g", "w"]).where("id > least").select("id", "hash", "first", F.lit(1).cast("long").alias("n"))
    return whole.union(part).groupBy("id", "hash").agg(F.collect_set(F.struct("first", "n")).alias("windows"))


def covered(n_words: int, windows, length: int = LENGTH) -> np.ndarray:
    """Which words lie in a window of the (first, n) stretches."""
    step = np.zeros(n_words + 1, np.int64)
    for first, n in windows:
        step[first] += 1
        step[min(n_words, first + n + length - 1)] -= 1
    return np.cumsum(step)[:n_words] > 0


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs``; ``text`` is what is left of it, its words joined by
    one space, with new columns ``n_words``, ``n_removed`` and ``repeats`` (the maximal
    repeats as (start, end) word positions).

    Removed is each word in a window of ``length`` words that also stands in a document with
    a smaller doc_id, judged on the input: of a passage that documents share, the smallest
    keeps it. Rows with equal doc_id do not remove words of each other; a null doc_id counts
    as the largest. Null, empty and short texts lose nothing (a null text has no words and
    becomes ''). New columns get an underscore in front of a name that ``docs`` has already.
    An empty table gives no rows."""
    key, hashed, found = (clean_name(docs, c) for c in ("id", "hash", "windows"))
    at = repeats(docs, text, doc_id, length, seed).select(F.col("id").alias(key), F.col("hash").alias(hashed), F.col("windows").alias(found))
    own = docs.withColumn(key, F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))).withColumn(hashed, F.xxhash64(text))
    own = own.join(at, [key, hashed], "left").select(*[F.col(f"`{c}`") for c in docs.columns], found)
    n, gone, spans = (clean_name(docs, c) for c in ("n_words", "n_removed", "repeats"))
    fields = [StructField(f.name, StringType()) if f.name == text else f for f in docs.schema.fields]
    schema = StructType([*fields, StructField(n, LongType()), StructField(gone, LongType()), *StructType.fromDDL(f"`{spans}` array<struct<start long, end long>>").fields])
    where, names = docs.columns.index(text), [*docs.columns, n, gone, spans]

    def run(batches):
        for b in batches:
            texts, kept, totals, removed, cuts = b.column(where).cast(pa.binary()), [], [], [], []
            for x, windows in zip(texts, b.column(len(b.columns) - 1).to_pylist()):
                words = _words(x)
                mask = covered(len(words), [(w["first"], w["n"]) for w in windows or ()], length)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).reshape(-1, 2)
                kept.append(b" ".join(w for w, m in zip(words, mask.tolist()) if not m) if len(edge) else b" ".join(words))
                totals.append(len(words))
                removed.append(int(mask.sum()))
                cuts.append([{"start": int(s), "end": int(e)} for s, e in edge])
            columns = list(b.columns[:-1])
            columns[where] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=names)

    return own.mapInArrow(run, schema)
