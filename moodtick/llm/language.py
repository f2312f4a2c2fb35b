"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds labelled text. A text is parsed against
each: the next phrase is the longest match of what follows anywhere in the training
text. The language that needs the fewest phrases, each weighed by the logarithm of
the training length, per character wins.

Every language has an alphabet of its own, all letters of its training text; a letter
that it does not have is a phrase of its own. The automata are packed into sparse
transition arrays, built by Spark tasks, one language each. All texts of a batch are
parsed in step: they are cut into segments that start as if a phrase began there, then
every segment is parsed again from the state in which the one before really ended, until
both parses stand in one state; from there on they are the same.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket, clean_name

#: The bounded training sample of a language: whole rows, in the order of a hash of their id
#: (rows above LONGEST characters last), so many at most, and no more once they have
#: TRAINING characters together. The first row is always taken.
DOCUMENTS, TRAINING, LONGEST = 200, 60_000, 20_000
SEGMENT = 512
UNKNOWN = "und"


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """By code point: 2 for a letter, 1 for a mark that belongs to one, 0 for the rest."""
    first = (unicodedata.category(chr(c))[0] for c in range(0x110000))
    return np.fromiter((2 if c == "L" else 1 if c == "M" else 0 for c in first), np.uint8, 0x110000)


def points(text: str) -> np.ndarray:
    """Code points of the lower-cased letters and marks; a run of anything else is one 0."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    c = np.where(kinds()[c] > 0, c, 0)
    return c[(c != 0) | (np.concatenate([[1], c[:-1]]) != 0)] if len(c) else c


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(link)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p, last = last, new
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p < 0:
            continue
        q = following[p][c]
        if length[q] == length[p] + 1:
            link[new] = q
            continue
        copy = len(link)
        following.append(dict(following[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = link[new] = copy
        while p >= 0 and following[p].get(c) == q:
            following[p][c] = copy
            p = link[p]
    return following


def packed(following: list[dict[int, int]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, owner, target): state s goes on with code c to target[base[s] + c] if
    owner[base[s] + c] is s. Rows are laid over each other, those of several cells where they
    fit behind the one before, then those of one cell in the gaps."""
    base, cells = [0] * len(following), sum(map(len, following))
    owner, target = [-1] * (2 * cells + size + 1), [0] * (2 * cells + size + 1)
    at = free = 0
    for s in sorted(range(len(following)), key=lambda s: -len(following[s])):
        codes = list(following[s])
        if not codes:
            break  # the last ones, without a cell of their own
        if len(codes) == 1:
            while owner[free] >= 0 or free < codes[0]:
                free += 1
            here = free - codes[0]
        else:
            while any(owner[at + c] >= 0 for c in codes):
                at += 1
            here = at
        while here + 2 * size >= len(owner):
            owner += [-1] * len(owner)
            target += [0] * len(target)
        base[s] = here
        for c, to in following[s].items():
            owner[here + c], target[here + c] = s, to
    used = max(base) + size
    return tuple(np.array(x, np.int32) for x in (base, owner[:used], target[:used]))


class Language:
    """One language: its letters (code 1 on; 0 is what is no letter) and packed automaton."""

    def __init__(self, name: str, letters: np.ndarray, base: np.ndarray, owner: np.ndarray, target: np.ndarray, length: int):
        self.name, self.letters, self.base, self.owner, self.target = name, letters, base, owner, target
        self.length, self.weight = length, np.log2(length + 2)
        start = base[0] + np.arange(len(letters) + 2)
        # where a phrase that starts with a code stands; one without a match stays at the start
        self.start = np.where(owner[start] == 0, target[start], 0).astype(np.int32)

    @classmethod
    def of(cls, name: str, texts: list[str]) -> Language:
        c = np.concatenate([points(" " + t) for t in texts] or [np.zeros(0, np.int32)])
        letters = np.unique(c[c > 0])
        codes = np.where(c > 0, np.searchsorted(letters, c) + 1, 0)
        return cls(name, letters, *packed(automaton(codes.tolist()), len(letters) + 2), len(codes))

    def codes(self, c: np.ndarray) -> np.ndarray:
        """Own codes of code points; letters of other alphabets get the last one, which no state goes on with."""
        at = np.minimum(np.searchsorted(self.letters, c), max(0, len(self.letters) - 1))
        known = self.letters[at] == c if len(self.letters) else np.zeros(len(c), bool)
        return np.where(c == 0, 0, np.where(known, at + 1, len(self.letters) + 1)).astype(np.int32)

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase starts."""
        cell = self.base.take(state) + code
        on = self.owner.take(cell) == state
        return np.where(on, self.target.take(cell), self.start.take(code)), ~on | (state == 0)

    def phrases(self, columns: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Phrases of each segment, given its own column of codes (segments by falling size),
        the sizes, and the segment before each (-1: the first of its text)."""
        n = len(sizes)
        state, trace = np.zeros(n, np.int32), np.zeros(columns.shape, np.int32)
        begun = np.zeros(columns.shape, bool)
        live = n - np.searchsorted(sizes[::-1], np.arange(len(columns)), side="right")
        for t, k in enumerate(live.tolist()):
            if not k:
                break
            state[:k], begun[t, :k] = self.step(state[:k], columns[t, :k])
            trace[t, :k] = state[:k]
        total, guess = begun.sum(axis=0), np.cumsum(begun, axis=0, dtype=np.int32)
        end = trace[sizes - 1, np.arange(n)]
        inner = np.flatnonzero(first >= 0)
        seen = np.zeros(n, np.int32)  # the state a segment was last parsed from
        while len(seg := inner[end[first[inner]] != seen[inner]]):
            now = seen[seg] = end[first[seg]]
            count, t = np.zeros(len(seg), np.int64), 0
            while len(seg):
                now, new = self.step(now, columns[t, seg])
                count += new
                same = now == trace[t, seg]  # from here on as first parsed
                met = seg[same]
                total[met] = count[same] + guess[sizes[met] - 1, met] - guess[t, met]
                end[met] = trace[sizes[met] - 1, met]
                over = ~same & (sizes[seg] == t + 1)
                total[seg[over]], end[seg[over]] = count[over], now[over]
                go = ~(same | over)
                seg, now, count, t = seg[go], now[go], count[go], t + 1
        return total


class Model:
    def __init__(self, languages: list[Language]):
        self.languages = sorted(languages, key=lambda x: x.name)

    @classmethod
    def of(cls, texts: dict[str, list[str]]) -> Model:
        return cls([Language.of(k, v) for k, v in texts.items()])

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (code points, not empty) per language."""
        count = np.array([-(-len(t) // SEGMENT) for t in texts])
        at = np.concatenate([[0], np.cumsum(count)[:-1]])
        sizes = np.full(count.sum(), SEGMENT)
        sizes[at + count - 1] = [len(t) - SEGMENT * (k - 1) for t, k in zip(texts, count.tolist())]
        flat = np.zeros(len(sizes) * SEGMENT, np.int32)
        for a, t in zip(at.tolist(), texts):
            flat[a * SEGMENT : a * SEGMENT + len(t)] = t
        before = np.arange(len(sizes)) - 1
        before[at] = -1
        # longest segments first: a step then works on a leading part only
        order = np.argsort(-sizes, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        first = np.where(before[order] >= 0, place[before[order]], -1)
        letters, inverse = np.unique(flat, return_inverse=True)
        out = np.empty((len(self.languages), len(texts)), np.int64)
        for k, language in enumerate(self.languages):
            own = language.codes(letters)[inverse].reshape(-1, SEGMENT)
            found = language.phrases(np.ascontiguousarray(own[order].T), sizes[order], first)
            out[k] = np.add.reduceat(found[place], at)
        return out.T

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [points(t or "") for t in texts]
        lettered = [i for i, c in enumerate(coded) if (kinds()[c] == 2).any()]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if lettered and self.languages:
            rate = self.phrases([coded[i] for i in lettered]) * np.array([x.weight for x in self.languages])
            best = rate.argmin(axis=1)
            low = rate[np.arange(len(rate)), best]
            rate[np.arange(len(rate)), best] = np.inf
            margin = 1 - low / rate.min(axis=1) if rate.shape[1] > 1 else np.ones(len(rate))
            for i, b, m in zip(lettered, best.tolist(), margin.tolist()):
                names[i], scores[i] = self.languages[b].name, min(1.0, max(0.0, m))
        return names, scores


_BUILT = "lang string, letters binary, base binary, owner binary, target binary, length long"


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place"])
    x = Language.of(rows["lang"].iloc[0], rows["text"].tolist())
    arrays = [a.astype(np.int32).tobytes() for a in (x.letters, x.base, x.owner, x.target)]
    return pd.DataFrame([[x.name, *arrays, x.length]], columns=["lang", "letters", "base", "owner", "target", "length"])


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Fit every value of ``lang`` on a bounded sample of its rows (see DOCUMENTS, TRAINING,
    LONGEST), whole texts. Null languages, texts and ids, and texts without a letter, are not
    used; copies count once. The model has one automaton of about 1 MB per language, all languages are kept."""
    own = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("id")).dropna()
    slim = own.where(F.col("text").rlike(r"\p{L}")).select("lang", "id", F.xxhash64("text").alias("hash"), F.length("text").alias("n"))
    by_hash = Window.partitionBy("lang").orderBy(F.col("n") > LONGEST, F.xxhash64("id"), "id", "hash")
    ranked = slim.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= DOCUMENTS)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = ranked.withColumn("before", before).where(F.col("before") < TRAINING).select("lang", "id", "hash", "place")
    chosen = F.broadcast(chosen.dropDuplicates(["lang", "id", "hash"]))  # DOCUMENTS short rows a language
    texts = own.withColumn("hash", F.xxhash64("text")).join(chosen, ["lang", "id", "hash"])
    texts = texts.dropDuplicates(["lang", "hash"]).select("lang", "text", "place")
    found = texts.groupBy("lang").applyInPandas(_built, _BUILT).collect()
    return Model([Language(r.lang, *(np.frombuffer(bytes(x), np.int32) for x in (r.letters, r.base, r.owner, r.target)), r.length) for r in found])


def identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """One row per row of ``docs`` (columns but the text kept) with lang_pred and score
    (with an underscore in front where ``docs`` has a column of that name).

    Whole texts are parsed. ``und`` with score 0 for a null text or one without a letter,
    and for all if the model has no language. The score is the share by which the best
    language needs less than the next one. Ties go to the first language by name.
    Repeated rows are answered one by one; an empty table gives none."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about 1 MB per language, see ``train``
    kept = [c for c in docs.columns if c != text]
    names = [*kept, clean_name(docs, "lang_pred"), clean_name(docs, "score")]
    own = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {own[c]}" for c in kept), f"`{names[-2]}` string", f"`{names[-1]}` double"])

    def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Rows with about a million characters together: bounds the traces of a parse."""
        at, sizes = batch.schema.names.index(text), 0
        lengths = [len(x.as_py() or "") for x in batch.column(at)]
        start = 0
        for i, n in enumerate(lengths):
            if i > start and sizes + n > 1 << 20:
                yield batch.slice(start, i - start)
                start, sizes = i, 0
            sizes += max(n, SEGMENT)
        if start < batch.num_rows:
            yield batch.slice(start)

    def run(batches):
        m = shared.value
        for whole in batches:
            for b in pieces(whole):
                languages, scores = m.predict(b.column(b.schema.names.index(text)).to_pylist())
                columns = [b.column(b.schema.names.index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())], names=names)

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return bucket(doc_id, 4) == 2
