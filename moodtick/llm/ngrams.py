"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

Training is three passes of packed, sorted arrays through Spark's shuffle:

1. words: distinct words and counts of a task, hashed, merged by ranges of the hash.
   A word's number is its place in the sorted hashes.
2. pairs: (number before, number) with counts, merged by a hash of the word before
   (for words before that hold a large share of all tokens, of the pair, so that no
   shard takes them whole).
3. continuations: distinct words before each word, merged by ranges of the number.

The model is a folder of sorted arrays which workers map into memory. Documents are
scored where they are; nothing but a few numbers per shard reaches the driver.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket, checkpoint, clean_name, shared_folder, write_atomically

SEED = 0
TOKENS = 2_000_000  # of a task in memory at a time
BEGIN = np.uint64(0xFFFFFFFF)  # the number before a first word
_END = b""  # the end token: no word is empty


def words(text: bytes | None) -> list[bytes]:
    """Words of A-Z lower-cased text, and one end."""
    return [*(text or b"").lower().split(), _END]


# --- packed arrays
def pack(sorted_keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys and counts: differences by byte planes, compressed."""
    import zstandard

    planes = [np.diff(sorted_keys, prepend=np.uint64(0)), counts]
    raw = b"".join(np.ascontiguousarray(p.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for p in planes)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(2, 8, -1)
    keys, counts = (np.ascontiguousarray(x.T).view("<u8").ravel() for x in raw)
    return np.cumsum(keys, dtype=np.uint64), counts


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with summed counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    if len(parts) > 1:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit permutation (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, of equal width."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def save(folder: str, name: str, array: np.ndarray) -> None:
    import io

    f = io.BytesIO()
    np.save(f, array)
    write_atomically(os.path.join(folder, name + ".npy"), f.getbuffer())


def small(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))


# --- sequences of a batch
class Sequences:
    """Texts as sequences of places in their distinct words."""

    def __init__(self):
        self.place: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes | None) -> None:
        place = self.place
        ws = words(text)
        for w in ws:
            if w not in place:
                place[w] = len(place)
        self.parts.append(np.fromiter(map(place.__getitem__, ws), np.int32, len(ws)))
        self.size += len(ws)

    def hashes(self) -> np.ndarray:
        import xxhash

        return np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in self.place), "<u8", len(self.place))


def _portions(batches, column: int = 0):
    """Sequences of up to TOKENS tokens (or one text), with the rows they stand for."""
    own, rows = Sequences(), []
    for b in batches:
        texts = b.column(column).cast(pa.binary())
        begun = 0
        for i, t in enumerate(texts):
            own.add(t.as_py())
            if own.size >= TOKENS:
                yield own, [*rows, b.slice(begun, i + 1 - begun)]
                own, rows, begun = Sequences(), [], i + 1
        if begun < b.num_rows:
            rows.append(b.slice(begun))
    if own.size:
        yield own, rows


def _send(shards: np.ndarray, keys: np.ndarray, counts: np.ndarray):
    """Keys and counts to their shards, as packed rows."""
    order = np.lexsort((keys, shards))
    shards, keys, counts = shards[order], keys[order], counts[order]
    cuts = np.flatnonzero(np.diff(shards)) + 1
    rows = [(int(shards[a]), pack(keys[a:z], counts[a:z])) for a, z in zip([0, *cuts], [*cuts, len(keys)]) if a < z]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "packed"]
    )


_SENT = "shard long, packed binary"


def _received(batches):
    """Rows sorted by shard -> (shard, keys, counts), a shard at a time."""
    at, parts, size = None, [], 0
    for b in batches:
        for shard, packed in zip(b.column(0).to_pylist(), b.column(1)):
            if shard != at:
                if parts:
                    yield at, *merge(parts)
                at, parts, size = shard, [], 0
            parts.append(unpack(packed.as_py()))
            size += len(parts[-1][0])
            if size > 4 * TOKENS and size > 2 * len(parts[0][0]):  # else copies pile up
                parts = [merge(parts)]
                size = len(parts[0][0])
    if parts:
        yield at, *merge(parts)


def _gather(sent: DataFrame, shards: int) -> DataFrame:
    return sent.repartition(shards, "shard").sortWithinPartitions("shard")


# --- the model
@dataclass
class Meta:
    folder: str
    shards: int
    first: list[int]  # the number of the first word of each word shard
    tokens: int
    vocabulary: int
    hot: int  # a word with more tokens has its pairs dealt by the pair
    pairs: int = 0
    discounts: tuple = ()  # of pairs, for counts 1, 2, 3 and more
    lower: tuple = ()  # of continuations
    lower_mass: float = 1.0  # probability that the discounts of continuations leave over


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the number of keys with count 1, 2, 3, 4; where
    the counts are too few for the formula, the nearest value in 0 to the count."""
    n1, n2, n3, n4 = n
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k) for k, d in zip((0.95, 1.95, 2.95), raw))


def _discount(d: tuple, counts: np.ndarray) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


def _few(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


class Arrays:
    """The model's arrays, mapped on first use."""

    def __init__(self, meta: Meta):
        self.meta, self.open = meta, {}

    def __call__(self, name: str, shard: int) -> np.ndarray | None:
        key = f"{name}-{shard:06d}"
        if key not in self.open:
            path = os.path.join(self.meta.folder, key + ".npy")
            self.open[key] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.open[key]

    def find(self, name: str, shards: np.ndarray, keys: np.ndarray):
        """For each shard with keys: the shard, the asked places, their place in the shard's keys, and whether found."""
        order = np.lexsort((keys, shards))
        s = shards[order]
        cuts = np.flatnonzero(np.diff(s)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(s)]):
            if a == z:
                continue
            own, asked = self(name, int(s[a])), order[a:z]
            if own is None or not len(own):
                continue
            place = np.searchsorted(own, keys[asked])
            ok = own[np.minimum(place, len(own) - 1)] == keys[asked]
            yield int(s[a]), asked[ok], place[ok]

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of each word."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for shard, asked, place in self.find("words", shard_of(hashes, self.meta.shards), hashes):
            number[asked] = place + self.meta.first[shard]
            count[asked] = self("counts", shard)[place]
        return number, count

    def word_shard(self, number: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.meta.first), number, side="right") - 1


def _pairs(own: Sequences, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Over all tokens of the portion: the number before (BEGIN at a start; -1 unknown), the number, and where texts start."""
    now = np.concatenate([number[p] for p in own.parts])
    starts = np.concatenate([[0], np.cumsum([len(p) for p in own.parts])[:-1]])
    before = np.concatenate([[0], now[:-1]])
    before[starts] = int(BEGIN)
    return before, now, starts


def _pair_shard(meta: Meta, before: np.ndarray, keys: np.ndarray, count_before: np.ndarray) -> np.ndarray:
    hot = (count_before > meta.hot) | (before == BEGIN)
    return shard_of(np.where(hot, mix(keys), mix(before)), meta.shards)


def train(docs: DataFrame, text: str = "text", folder: str | None = None, shards: int | None = None) -> Meta:
    """Fit on all rows of ``docs``; a null text counts as empty (an end token alone).

    The folder must be on a mount that all machines share. Retried tasks replace their
    files by equal ones. A table without rows gives a model of no words."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "ngrams")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(text).cast("binary").alias("text"))

    def count_words(batches):
        for own, _ in _portions(batches):
            counts = np.bincount(np.concatenate(own.parts), minlength=len(own.place))
            hashes = own.hashes()
            yield _send(shard_of(hashes, shards), hashes, counts)

    def store_words(batches):
        for shard, keys, counts in _received(batches):
            save(folder, f"words-{shard:06d}", keys)
            save(folder, f"counts-{shard:06d}", small(counts))
            yield pa.RecordBatch.from_pylist([{"shard": shard, "distinct": len(keys), "total": int(counts.sum())}])

    found = _gather(texts.mapInArrow(count_words, _SENT), shards).mapInArrow(store_words, "shard long, distinct long, total long").collect()
    distinct = dict((r.shard, r.distinct) for r in found)
    first = np.concatenate([[0], np.cumsum([distinct.get(s, 0) for s in range(shards)])[:-1]]).tolist()
    tokens, vocabulary = sum(r.total for r in found), sum(distinct.values())
    if vocabulary >= int(BEGIN):
        raise ValueError(f"{vocabulary} distinct words: numbers have 32 bits")
    meta = Meta(folder, shards, first, tokens, vocabulary, max(100, tokens // (4 * shards)))

    def count_pairs(batches):
        arrays = Arrays(meta)
        for own, _ in _portions(batches):
            number, count = arrays.numbers(own.hashes())
            before, now, _ = _pairs(own, number)
            keys, n = np.unique(before.astype(np.uint64) << np.uint64(32) | now.astype(np.uint64), return_counts=True)
            prior = keys >> np.uint64(32)
            by_number = np.argsort(number)
            at = by_number[np.minimum(np.searchsorted(number, prior.astype(np.int64), sorter=by_number), len(number) - 1)]
            yield _send(_pair_shard(meta, prior, keys, count[at]), keys, n)

    def store_pairs(batches):
        arrays = Arrays(meta)
        for shard, keys, counts in _received(batches):
            save(folder, f"pairs-{shard:06d}", keys)
            save(folder, f"times-{shard:06d}", small(counts))
            prior = keys >> np.uint64(32)
            heads = np.flatnonzero(np.concatenate([[True], prior[1:] != prior[:-1]]))
            stats = np.stack([np.add.reduceat(x, heads) for x in (counts, counts == 1, counts == 2, counts >= 3)], axis=1).astype(np.int64)
            numbers = prior[heads]
            known = np.minimum(numbers, np.uint64(max(0, vocabulary - 1))).astype(np.int64)
            count = np.zeros(len(heads), np.int64)
            at = arrays.word_shard(known)
            for s in np.unique(at):
                count[at == s] = arrays("counts", int(s))[known[at == s] - meta.first[s]]
            part = (count > meta.hot) | (numbers == BEGIN)  # other shards hold pairs of these too
            save(folder, f"heads-{shard:06d}", numbers[~part])
            save(folder, f"stats-{shard:06d}", small(stats[~part].ravel()).reshape(-1, 4))
            # few: at most 4 * shards words are hot
            rows = [{"kind": "hot", "shard": int(h), "packed": s.astype("<i8").tobytes()} for h, s in zip(numbers[part].tolist(), stats[part])]
            rows.append({"kind": "few", "shard": len(keys), "packed": np.array(_few(counts), "<i8").tobytes()})
            after, distinct_before = np.unique(keys & np.uint64(0xFFFFFFFF), return_counts=True)
            to = arrays.word_shard(after.astype(np.int64))
            sent = _send(to, after, distinct_before)
            rows += [{"kind": "next", "shard": s, "packed": p} for s, p in zip(*(c.to_pylist() for c in sent.columns))]
            schema = pa.schema([("kind", pa.string()), ("shard", pa.int64()), ("packed", pa.binary())])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def store_next(batches):
        for shard, keys, counts in _received(batches):
            own = np.zeros(distinct[shard], np.int64)
            own[keys.astype(np.int64) - meta.first[shard]] = counts.astype(np.int64)
            save(folder, f"next-{shard:06d}", small(own))
            yield pa.RecordBatch.from_pylist([{"few": _few(counts)}])

    pairs = _gather(texts.mapInArrow(count_pairs, _SENT), shards).mapInArrow(store_pairs, "kind string, shard long, packed binary")
    pairs = checkpoint(pairs)
    hot: dict[int, np.ndarray] = {}
    few = np.zeros(4, np.int64)
    for r in pairs.where("kind <> 'next'").collect():
        stat = np.frombuffer(r.packed, "<i8")
        if r.kind == "hot":
            hot[r.shard] = hot.get(r.shard, 0) + stat
        else:
            meta.pairs += r.shard
            few = few + stat
    numbers = np.array(sorted(hot), np.uint64)
    save(folder, "heads-hot", numbers)
    save(folder, "stats-hot", np.array([hot[int(h)] for h in numbers], np.int64).reshape(-1, 4))
    lower = _gather(pairs.where("kind = 'next'").select("shard", "packed"), shards).mapInArrow(store_next, "few array<long>").collect()
    meta.discounts = discounts(few.tolist())
    meta.lower = discounts(np.sum([r.few for r in lower], axis=0).tolist() if lower else [0] * 4)
    totals = np.sum([r.few for r in lower], axis=0) if lower else np.zeros(4)
    meta.lower_mass = float(np.dot(meta.lower, [totals[0], totals[1], vocabulary - totals[0] - totals[1]])) / max(1, meta.pairs)
    write_atomically(os.path.join(folder, "meta.json"), json.dumps(meta.__dict__).encode())
    return meta


class Model:
    """A trained model, mapped into memory."""

    def __init__(self, meta: Meta):
        self.meta, self.arrays = meta, Arrays(meta)
        self.hot = np.load(os.path.join(meta.folder, "heads-hot.npy"))
        self.hot_stats = np.load(os.path.join(meta.folder, "stats-hot.npy"))

    def lower(self, number: np.ndarray) -> np.ndarray:
        """Continuation probability of each word; an unknown word has the share of one word unseen."""
        m = self.meta
        p = np.full(len(number), m.lower_mass / (m.vocabulary + 1))
        known = np.flatnonzero(number >= 0)
        at = self.arrays.word_shard(number[known])
        for s in np.unique(at):
            own = known[at == s]
            n = self.arrays("next", int(s))[number[own] - m.first[s]].astype(np.int64)
            p[own] += np.maximum(n - _discount(m.lower, n), 0) / max(1, m.pairs)
        return p

    def pair(self, before: np.ndarray, now: np.ndarray, lower: np.ndarray, count: np.ndarray) -> np.ndarray:
        """P(now | before) of distinct pairs: ``lower`` of the word, ``count`` of the word before."""
        m, prior = self.meta, before.astype(np.uint64)
        known = before >= 0
        hot = known & ((count > m.hot) | (prior == BEGIN))
        shards = shard_of(mix(prior), m.shards)
        total, one, two, three = (np.zeros(len(before), np.int64) for _ in range(4))

        def put(asked, stats):
            for x, column in zip((total, one, two, three), stats.T):
                x[asked] = column

        for s, asked, place in self.arrays.find("heads", np.where(known & ~hot, shards, -1), prior):
            put(asked, self.arrays("stats", s)[place])
        if len(self.hot):
            place = np.minimum(np.searchsorted(self.hot, prior), len(self.hot) - 1)
            ok = np.flatnonzero(hot & (self.hot[place] == prior))
            put(ok, self.hot_stats[place[ok]])
        keys = prior << np.uint64(32) | np.maximum(now, 0).astype(np.uint64)
        seen = known & (now >= 0)
        times = np.zeros(len(before), np.int64)
        deal = np.where(seen, np.where(hot, shard_of(mix(keys), m.shards), shards), -1)
        for s, asked, place in self.arrays.find("pairs", deal, keys):
            times[asked] = self.arrays("times", s)[place]
        d1, d2, d3 = m.discounts or (0, 0, 0)
        part = np.maximum(total, 1)
        mass = (d1 * one + d2 * two + d3 * three) / part
        with_pair = np.maximum(times - _discount(m.discounts or (0, 0, 0), times), 0) / part
        return np.where(total > 0, with_pair + mass * lower, lower)

    def score(self, own: Sequences) -> dict[str, np.ndarray]:
        """Per text: tokens, known ones, sum of log10 of the smoothed unigram share, and of the model."""
        m = self.meta
        number, count = self.arrays.numbers(own.hashes())
        place = np.concatenate(own.parts)
        before_place = np.concatenate([[0], place[:-1]])
        starts = np.concatenate([[0], np.cumsum([len(p) for p in own.parts])[:-1]])
        before_place[starts] = len(number)
        # distinct pairs of places, ordered by what is looked up
        code, back = np.unique(before_place.astype(np.int64) * len(number) + place, return_inverse=True)
        b, w = np.divmod(code, len(number))
        with_begin = np.append(number, int(BEGIN))
        p = self.pair(with_begin[b], number[w], self.lower(number)[w], np.append(count, 0)[b])
        base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.vocabulary + 1)))
        add = lambda x: np.add.reduceat(x, starts)
        return {
            "n_tokens": np.array([len(x) for x in own.parts], np.int64),
            "n_known": add((count > 0).astype(np.int64)[place]),
            "base_score": add(base[place]),
            "score": add(np.log10(p)[back]),
        }


def scored(docs: DataFrame, meta: Meta, text: str = "text") -> DataFrame:
    """One row per row of ``docs`` (columns but the text kept) with n_tokens, n_known,
    train_tokens, base_score, score (log10 probability; perplexity is
    10^(-score / n_tokens)).

    A null or empty text is one end token. Repeated rows are scored one by one; an empty
    table gives no rows. New columns get an underscore in front of a name that ``docs`` has."""
    kept = [c for c in docs.columns if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    new = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double"}
    names = [*kept, *(clean_name(docs, k) for k in new)]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), *(f"`{k}` {v}" for k, v in zip(names[len(kept) :], new.values()))])

    def run(batches):
        model = Model(meta)
        for own, rows in _portions(batches):
            found = model.score(own)
            found["train_tokens"] = np.full(len(own.parts), meta.tokens, np.int64)
            table = pa.Table.from_batches(rows).drop_columns([text]).combine_chunks()
            columns = [table.column(c).combine_chunks() for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(found[k]) for k in new)], names=names)

    own = docs.select(F.col(text).cast("binary").alias(text), *kept)
    return own.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return bucket(doc_id, 10) == 0
