"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Training words stream
through it, one step per word, and the state gives the longest run ending at the
word that some item has. A run of ``window`` words or more marks its last
``window`` words; an item of fewer words marks where the whole of it occurs.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import checkpoint, clean_name, forget, held, shared_folder, small_batches, write_atomically

WINDOW = 10
#: Words of the items in one automaton (about 1 kB each); a larger benchmark is
#: dealt over several automata, which see the documents one after the other.
MAX_WORDS = 200_000
#: Words are runs of a-z, 0-9 and everything outside ASCII, after A-Z became a-z.
_FOLD = bytes(x if x >= 0x80 or chr(x).isalnum() else 0x20 for x in range(256)).lower()


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window, self.vocabulary = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        number = self.vocabulary.setdefault
        own = [(item, [number(w, len(self.vocabulary)) for w in ws]) for item, ws in items if ws]
        for _, ids in own:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.least = min([window, *(len(ids) for _, ids in own)])
        self.items: dict[int, set[str]] = {}  # by the state of a whole window
        self.short: dict[int, list[tuple[int, str]]] = {}  # by the state of a whole short item
        for item, ids in own:
            if len(ids) < window:
                for state, _ in self.walk(ids):
                    pass
                self.short.setdefault(state, []).append((len(ids), item))
            else:
                for state, size in self.walk(ids):
                    if size >= window:
                        self.items.setdefault(self.of_window(state), set()).add(item)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, q, c)
        new = self._state({}, 0, length[last] + 1)
        while last >= 0 and c not in nxt[last]:
            nxt[last][c] = new
            last = link[last]
        if last >= 0:
            q = nxt[last][c]
            link[new] = q if length[q] == length[last] + 1 else self._split(last, q, c)
        return new

    def _state(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """A state for the shorter runs of q, those that follow p."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def walk(self, ids) -> Iterator[tuple[int, int]]:
        """After each word: the state and the length of the longest matching run."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for c in ids:
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            yield state, size

    def of_window(self, state: int) -> int:
        """The state of the last ``window`` words of a run that long."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def match(self, ws: list[bytes]) -> tuple[list[int], set[str], int]:
        """Marked words as flat [start, end, ...] spans, the items found, the longest run."""
        known = np.fromiter(map(self.vocabulary.get, ws, repeat(-1)), np.int64, len(ws))
        spans: list[int] = []
        found: set[str] = set()
        longest = 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], known >= 0, [False]])))
        for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if z - a < self.least:  # a word that no item has ends every run
                continue
            for at, (state, size) in enumerate(self.walk(known[a:z].tolist()), a + 1):
                longest = max(longest, size)
                back = 0
                if size >= self.window:
                    back = self.window
                    found |= self.items[self.of_window(state)]
                if self.short:
                    up = state
                    while up:
                        for n, item in self.short.get(up, ()):
                            if n <= size:
                                back = max(back, n)
                                found.add(item)
                        up = self.link[up]
                if back:
                    start = at - back
                    while spans and spans[-1] >= start:
                        spans.pop()
                        start = min(start, spans.pop())
                    spans += [start, at]
        return spans, found, longest if longest >= self.least else 0


def _merge(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def cut(text: bytes, spans: list[int]) -> bytes:
    """``text`` without the words of the spans and what stands between them."""
    folded, at, starts, ends = text.translate(_FOLD), 0, [], []
    for w in folded.split():
        at = folded.index(w, at)
        starts.append(at)
        at += len(w)
        ends.append(at)
    out, last = [], 0
    for s, e in zip(spans[::2], spans[1::2]):
        out.append(text[last : starts[s]])
        last = ends[e - 1]
    return b"".join([*out, text[last:]])


def _read(path: str, least: int) -> Automaton:
    def load():
        with open(path, "rb") as f:
            own = pickle.load(f)
        own.least = least
        return own

    return held((path, least), load)  # one at a time in memory


def automata(benchmark: DataFrame, item_id: str, text: str, window: int) -> list[Callable[[], Automaton]]:
    """The items in automata of about MAX_WORDS words or one item each, as functions that
    workers call. A benchmark of one automaton is sent to them; those of a larger one are
    built by a task each and read from the shared folder."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).cast("binary").alias("text")
    ).distinct()
    n = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-n // (2 * MAX_WORDS)) or 1  # a word and what follows it are two bytes at least
    if shards == 1:
        shared = spark.sparkContext.broadcast(Automaton([(r.item, words(bytes(r.text))) for r in items.collect()], window))

        def sent() -> Automaton:
            forget()  # the broadcast itself is Spark's to drop
            return shared.value

        return [sent]
    folder = shared_folder(spark, "automata")

    def build(rows: pa.Table) -> pa.Table:
        k = rows["shard"][0].as_py()
        own = Automaton([(i, words(t)) for i, t in zip(rows["item"].to_pylist(), rows["text"].to_pylist())], window)
        write_atomically(f"{folder}/{k}", pickle.dumps(own, pickle.HIGHEST_PROTOCOL))
        return pa.table({"shard": pa.array([k], pa.int64()), "least": pa.array([own.least], pa.int64())})

    dealt = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)))
    built = dealt.groupBy("shard").applyInArrow(build, "shard long, least long").collect()
    least = min(r.least for r in built)  # of all items: an automaton answers as if it had them all
    return [partial(_read, f"{folder}/{r.shard}", least) for r in sorted(built)]


_KINDS = {"n_words": LongType(), "n_hit": LongType(), "longest": IntegerType(), "spans": ArrayType(IntegerType()), "items": ArrayType(StringType())}


def _marked(docs: DataFrame, shared: list, text: str, extra: list[str], remove: bool = False) -> DataFrame:
    """``docs`` with the columns ``extra``, of the kinds of _KINDS, merged over all automata.
    With ``remove`` (one automaton only) the text comes back without its marked spans."""
    schema = StructType([*docs.schema.fields, *(StructField(k, v) for k, v in zip(extra, _KINDS.values()))])
    names = docs.columns
    at = names.index(text)

    def one(load, first: bool):
        def run(batches):
            auto = load()
            for b in batches:
                column = b.column(at)
                raw = [x.as_py() for x in column.cast(pa.binary())]
                found = []
                for i, t in enumerate(raw):
                    ws = words(t)
                    spans, items, longest = auto.match(ws)
                    if not first:
                        _, _, was, spans0, items0 = (b.column(len(names) + j)[i].as_py() for j in range(5))
                        spans, items, longest = _merge(spans0, spans), items | set(items0), max(was, longest)
                    here = spans if remove else []
                    while here:
                        raw[i] = cut(raw[i], here)
                        here = auto.match(words(raw[i]))[0]
                    found.append((len(ws), sum(spans[1::2]) - sum(spans[::2]), longest, spans, sorted(items)))
                columns = [*b.columns[: len(names)]]
                if remove:
                    columns[at] = pa.array(raw, pa.binary()).cast(column.type)
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string()))
                more = [pa.array([f[j] for f in found], kinds[j]) for j in range(5)]
                yield pa.RecordBatch.from_arrays([*columns, *more], names=[*names, *extra])

        return run

    out = small_batches(docs)
    for k, load in enumerate(shared):
        out = out.mapInArrow(one(load, k == 0), schema)
        if k + 1 < len(shared):
            out = checkpoint(out)  # so that workers hold one automaton at a time
    return out


def _cut(docs: DataFrame, text: str, spans: str) -> DataFrame:
    """``docs`` with ``text`` cut by its ``spans``."""
    at, by = docs.columns.index(text), docs.columns.index(spans)

    def run(batches):
        for b in batches:
            raw = [cut(t.as_py(), s.as_py()) for t, s in zip(b.column(at).cast(pa.binary()), b.column(by))]
            columns = [*b.columns]
            columns[at] = pa.array(raw, pa.binary()).cast(columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, remove_over: float | None = None) -> DataFrame:
    """The rows of ``docs`` with: n_words, n_hit, longest (the longest run, or 0 where it is
    shorter than a window and every item), spans (flat word positions [start, end, ...]),
    items (item ids as strings, sorted, each once).

    With ``remove_over`` set, the text comes back without its marked spans (and again,
    until no window of any item is left), and documents whose marked share of the words
    was above it are left out; spans then are those of the text as it came. How many
    automata the items are dealt over changes no result.

    A null or empty text has no words and is never marked. Null item texts and items
    without words match nothing; a null item id counts as ''. Repeated rows are
    answered one by one. An empty benchmark marks nothing. Result columns that ``docs``
    has already are named with leading underscores."""
    extra = [clean_name(docs, k) for k in _KINDS]
    n_words, n_hit, _, spans, _ = extra
    shared = automata(benchmark, item_id, item_text, window)
    out = _marked(docs, shared, text, extra, remove=remove_over is not None and len(shared) == 1)
    if remove_over is None:
        return out
    covered = F.col(n_hit) <= F.col(n_words) * remove_over
    if len(shared) == 1:
        return out.where(covered)
    # judged on the text as it came; what a cut joins anew is shown to all automata again
    out = checkpoint(out.where(covered))
    done, now = [out.where(F.size(spans) == 0)], out.where(F.size(spans) > 0)
    while not now.isEmpty():
        now = _cut(now, text, spans).select(*out.columns)
        again = [clean_name(out, k) for k in _KINDS]
        now = checkpoint(_marked(now, shared, text, again))
        spans = again[3]
        done.append(now.where(F.size(spans) == 0).select(*out.columns))
        now = now.where(F.size(spans) > 0)
    return reduce(DataFrame.unionAll, done)


def decontaminated(docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.5, **names) -> DataFrame:
    """``docs`` without marked spans, and without documents marked above ``max_coverage``."""
    return matches(docs, benchmark, remove_over=max_coverage, **names).select(*docs.columns)


def items_sha256(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)
