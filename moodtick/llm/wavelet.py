"""Token files as wavelet matrices: one compressed file per shard.

Sixteen (or as many as the ids need) bit planes, the highest bit first. In the plane
of a level stands that bit of every token, in the order in which the levels above
have stably dealt the tokens, zeros before ones. With the number of ones before a
position (rank) a token is read, a value counted or its occurrences found by one
step per level.

File: the magic, a header of fixed size, then the sections, each compressed alone:
doc ids, a null mask, tokens per document, and the planes.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from dataclasses import dataclass
from itertools import chain, pairwise
from operator import attrgetter
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import _L, Memo, chunks, simple_pieces, whole
from .common import shared_folder, write_atomically

MAGIC = b"MTWM0001"
SHARD = 1 << 21  # tokens after which a shard ends with its document
CHUNKS, PIECES = 200 << 20, 120 << 20  # bytes of chunks and pieces that a worker remembers
SLICE = 6 << 20  # bytes of texts that are encoded together
RUN = 32  # words that the library's model gets at once
# Byte-level BPE shows bytes without a printable Latin-1 character as the characters from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_BYTES = {chr(c): b for b, c in _SHOWN.items()}
_BLANK = chr(_SHOWN[32])
_LATIN = {i: chr(i).encode().decode("latin-1").translate(_SHOWN) for i in range(0x250)}  # a character's bytes as shown
_MARKED = rf"^[{_L}]+[!-/:-@\[-`{{-~]+$"  # a word and marks
_ID = attrgetter("id")
_HEAD = struct.Struct("<8sQQI")  # magic, documents, tokens, planes


def _ones(words: np.ndarray) -> np.ndarray:
    """Ones before each 64-bit word, and at last all of them."""
    return np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])


def _at_ones(values: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """The values where the plane has ones."""
    mask = pa.Array.from_buffers(pa.bool_(), len(values), [None, pa.py_buffer(plane)])
    return pa.array(values).filter(mask).to_numpy()


@dataclass
class Matrix:
    """Planes as 64-bit words (bit i of the plane: bit i % 64 of word i // 64)."""

    n: int
    planes: list[np.ndarray]

    def __post_init__(self):
        self.before = [_ones(p) for p in self.planes]
        self.zeros = [self.n - int(b[-1]) for b in self.before]

    @classmethod
    def of(cls, tokens: np.ndarray) -> Matrix:
        levels = max(1, int(tokens.max()).bit_length()) if len(tokens) else 1
        planes, now = [], tokens.astype(np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bit = now & now.dtype.type(1 << level) != 0
            packed = np.packbits(bit, bitorder="little")
            planes.append(np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8"))
            if level:
                now = np.concatenate([_at_ones(now, ~planes[-1]), _at_ones(now, planes[-1])])
        return cls(len(tokens), planes)

    def _bits(self, k: int) -> np.ndarray:
        return np.unpackbits(self.planes[k].view(np.uint8), bitorder="little", count=self.n).view(bool)

    def rank(self, k: int, at: np.ndarray) -> np.ndarray:
        """Ones of plane k before each position."""
        word, bit = np.divmod(at, 64)
        part = np.append(self.planes[k], np.uint64(0))[word] & ((np.uint64(1) << bit.astype(np.uint64)) - np.uint64(1))
        return self.before[k][word] + np.bitwise_count(part)

    def access(self, at) -> np.ndarray:
        """The tokens at the positions."""
        at = np.asarray(at, np.int64)
        if len(at) and not 0 <= at.min() <= at.max() < self.n:
            raise IndexError(f"a position is outside the {self.n} tokens")
        out = np.zeros(len(at), np.uint32)
        for k, plane in enumerate(self.planes):
            bit = (plane[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0
            ones = self.rank(k, at)
            out = out << np.uint32(1) | bit
            at = np.where(bit, self.zeros[k] + ones, at - ones)
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        if token >> len(self.planes):
            return 0, 0
        for k in range(len(self.planes)):
            a, z = self.rank(k, np.array([start, end]))
            if token >> (len(self.planes) - 1 - k) & 1:
                start, end = self.zeros[k] + int(a), self.zeros[k] + int(z)
            else:
                start, end = start - int(a), end - int(z)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the token occurs in positions start to end."""
        a, z = self._range(token, start, self.n if end is None else end)
        return z - a

    def occurrences(self, token: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """The positions of the token, in order (of them those from first to last)."""
        a, z = self._range(token, 0, self.n)
        at = np.arange(a, z)[first:last]
        for k in range(len(self.planes) - 1, -1, -1):
            one = token >> (len(self.planes) - 1 - k) & 1
            at = self.select(k, at - self.zeros[k] * one, bool(one))
        return at

    def select(self, k: int, nth: np.ndarray, one: bool) -> np.ndarray:
        """The position in plane k of the nth (from 0) one, or zero."""
        full = self.before[k] if one else np.minimum(np.arange(len(self.before[k])) * 64, self.n) - self.before[k]
        word = np.searchsorted(full, nth, side="right") - 1
        bits = np.unpackbits(self.planes[k][word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        left = (nth - full[word])[:, None]
        return word * 64 + np.argmax(np.cumsum(bits if one else 1 - bits, axis=1, dtype=np.int64) > left, axis=1)

    def tokens(self) -> np.ndarray:
        """All tokens, by undoing the dealing from the last level up."""
        kind, last = (np.uint16 if len(self.planes) <= 16 else np.uint32), len(self.planes) - 1
        now = self._bits(last).astype(kind)
        for k in range(last - 1, -1, -1):
            bit, up = self._bits(k), np.empty_like(now)
            up[np.flatnonzero(~bit)] = now[: self.zeros[k]]
            up[np.flatnonzero(bit)] = now[self.zeros[k] :] | kind(1 << (last - k))
            now = up
        return now.astype(np.uint32)


def write(path: str, doc_ids: list[int | None], sizes: list[int], tokens: np.ndarray) -> None:
    matrix = Matrix.of(tokens)
    sections = [
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], np.uint8).tobytes(),
        np.array(sizes, "<u8").tobytes(),
        *(p.tobytes() for p in matrix.planes),
    ]
    pack = zstandard.ZstdCompressor(level=1)
    out = [_HEAD.pack(MAGIC, len(doc_ids), len(tokens), len(matrix.planes))]
    for s in sections:
        c = pack.compress(s)
        out += [struct.pack("<Q", len(c)), c]
    write_atomically(path, *out)


def open_shard(path: str) -> tuple[list[int | None], np.ndarray, Matrix]:
    """Document ids, tokens per document, and the matrix of one file."""
    with open(path, "rb") as f:
        data = f.read()
    magic, docs, n, levels = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError(f"{path} is no token file")
    at, sections = _HEAD.size, []
    for _ in range(3 + levels):
        (size,) = struct.unpack_from("<Q", data, at)
        sections.append(zstandard.ZstdDecompressor().decompress(data[at + 8 : at + 8 + size]))
        at += 8 + size
    ids, none = np.frombuffer(sections[0], "<i8").tolist(), sections[1]
    assert len(ids) == docs
    return (
        [None if none[i] else x for i, x in enumerate(ids)],
        np.frombuffer(sections[2], "<u8").astype(np.int64),
        Matrix(n, [np.frombuffer(s, "<u8") for s in sections[3:]]),
    )


def _crosses(token: str) -> bool:
    """Whether a token has a blank right after a letter, or after a part of a character."""
    if _BLANK not in token[1:]:
        return False
    text = bytes(_BYTES.get(c, ord(c)) for c in token).decode(errors="surrogateescape")
    return any(b == " " and (a.isalpha() or "\udc80" <= a <= "\udcff") for a, b in pairwise(text))


class Tokens:
    """Whole texts through the tokenizers library, many at once; chunks seen before are remembered.

    As the library does it, the string of a special token in a text becomes that token;
    with ``inert`` it is text like any other."""

    def __init__(self, path: str, inert: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = inert
        self.special = [] if inert else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that start with a blank
        self.opens[[i for t, i in vocabulary.items() if t[:1] == _BLANK]] = True
        self.run = 1 if self.model.ignore_merges or any(map(_crosses, self.tokenizer.get_vocab(with_added_tokens=False))) else RUN
        self.known: dict[str, bytes] = {}
        self.left = CHUNKS
        self.pieces = Memo(self._piece, PIECES)

    def _text(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """The library's model on the characters that stand for a match's bytes (below U+0250)."""
        return array("I", map(_ID, self.model.tokenize(piece.translate(_LATIN)))).tobytes()

    def _add(self, new: dict[str, bytes]) -> None:
        self.left -= 300 * len(new) + 5 * sum(map(len, new))
        self.known |= new

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words of Latin letters, each with the blank before it: the library's model
        gets several at once, as no token reaches from a letter over a blank."""
        shown = [w if w.isascii() else w.translate(_LATIN) for w in words]
        runs = (self.model.tokenize(_BLANK + _BLANK.join(shown[k : k + self.run])) for k in range(0, len(shown), self.run))
        ids = np.array(array("I", map(_ID, chain.from_iterable(runs))), "<u4")
        starts, raw = np.append(np.flatnonzero(self.opens[ids]), len(ids)) * 4, ids.tobytes()
        return dict(zip(words, [raw[a:z] for a, z in pairwise(starts.tolist())], strict=True))

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of different chunks, none of them the first of its text."""
        if self.left < 0:
            self.known, self.left = {}, CHUNKS
        known = self.known
        found = list(map(known.get, chunks))
        new = [c for c, ids in zip(chunks, found) if ids is None]
        # letters are one match of the split pattern with the blank before them; a word is
        # remembered once, whatever stands behind it
        words = {c for c in new if c.isalpha() and (c.isascii() or max(c) < "\u0250")}
        parts = {c: simple_pieces(c) for c in new if c not in words}
        inner = {p[1:] for own in parts.values() if own for p in own if p[0] == " " and p[1:].isalpha()}
        self._add(self._words([*words, *(w for w in inner if w not in words and w not in known)]))
        self._add(
            {
                c: b"".join([known[p[1:]] if p[0] == " " and p[1:].isalpha() else self.pieces[p] for p in own]) if own else self._text(whole(c))
                for c, own in parts.items()
            }
        )
        return [known[c] if ids is None else ids for c, ids in zip(chunks, found)]

    def _table(self, chunks: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of different chunks; words with marks behind them, which are a match of
        their own, in two parts."""
        if not len(chunks):
            return pa.array([], pa.large_binary())
        whole_size, marked = pc.binary_length(chunks), pc.match_substring_regex(chunks, _MARKED)
        size = pc.if_else(marked, pc.binary_length(pc.utf8_rtrim(chunks, punctuation)), whole_size).to_numpy()
        # in the same bytes: word, marks, word, marks, ...
        _, offsets, data = chunks.buffers()
        starts = np.frombuffer(offsets, np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
        cuts = np.append(np.stack([starts[:-1], starts[:-1] + size], axis=1).ravel(), starts[-1])
        parts = pa.LargeStringArray.from_buffers(2 * len(chunks), pa.py_buffer(cuts), data)
        word, mark = (parts.take(pa.array(np.arange(k, len(parts), 2))).dictionary_encode() for k in (0, 1))
        words = pa.array(self._chunks(word.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        marks = pa.array([self.pieces[m] if m else b"" for m in mark.dictionary.to_pylist()], pa.large_binary())
        return pc.binary_join_element_wise(words.take(word.indices), marks.take(mark.indices), pa.scalar(b"", pa.large_binary()))

    def encode(self, text: str) -> bytes:
        return self.many([text])[0].tobytes()

    def many(self, texts: list[str | None], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each with ``end`` after it, and how many
        each has. Of all chunks but the first of a text, every different one is looked up once."""
        firsts, rests, others, rows = [], [], [], []
        for row, text in enumerate(texts):
            text = text or ""
            plain, rest = text.replace("\n", " "), None
            if any(s in text for s in self.special):
                first = text  # all of it as the library does it
            elif plain.isprintable() and "  " not in plain:  # the chunks are what stands between blanks
                first, blank, rest = text.replace("\n", " \n").partition(" ")
                rest = rest if blank else None
            else:
                first, *more = chunks(text)
                others += more
                rows += [row] * len(more)
            firsts.append(self._text(first))
            rests.append(rest)
        split = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        every, at = split.flatten(), np.arange(len(texts))
        row = np.repeat(at, split.value_lengths().fill_null(0))
        if others:
            every, row = pa.concat_arrays([every, pa.array(others, pa.large_string())]), np.append(row, rows)
        size = np.bincount(row, minlength=len(texts))
        del rests, split  # the texts once more
        every = every.dictionary_encode()
        codes, n = every.indices.to_numpy(), len(every.dictionary)
        if others:
            codes = codes[np.argsort(row, kind="stable")]
        # a text is its first chunk, the codes of the others, and the end
        stops = np.cumsum(size)
        marks = np.stack([stops - size, stops], axis=1).ravel()
        codes = np.insert(codes, marks, np.stack([n + at, np.full(len(at), n + len(at))], axis=1).ravel())
        table = pa.concat_arrays([self._table(every.dictionary), pa.array([*firsts, end], pa.large_binary())])
        out = table.take(pa.array(codes))
        _, offsets, ids = out.buffers()
        bounds = np.frombuffer(offsets, np.int64)[np.append(stops - size + 2 * at, len(codes))] // 4
        return np.frombuffer(ids, "<u4", bounds[-1]), np.diff(bounds)


_TOKENS: dict[tuple[str, bool], Tokens] = {}


def _slices(batch: pa.RecordBatch):
    """The batch in slices of SLICE bytes of text (column 1), or one row."""
    ends, at = np.cumsum(pc.binary_length(batch.column(1)).fill_null(0), dtype=np.int64), 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def write_shards(
    docs: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id", end: int = 0, folder: str | None = None, inert: bool = False
) -> DataFrame:
    """Write the ids of all texts, each with ``end`` after it, in ascending doc_id order.

    Returns one row per file, in the order of ``part``, ``shard``: path, documents,
    tokens. The texts are sorted by ranges of doc_id, and by a hash of the text where a
    doc_id has several rows, so that one id's rows may fill several ranges. Null ids come first, null
    texts are empty (only the end id), repeated rows are written as often as they
    occur. No file is written for no rows. A retried task replaces its files by equal
    ones. ``folder`` must be on a mount that all machines share."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")

    def run(batches):
        import os

        from pyspark import TaskContext

        if (tokenizer, inert) not in _TOKENS:
            _TOKENS[tokenizer, inert] = Tokens(tokenizer, inert)
        encode, part, shard = _TOKENS[tokenizer, inert].many, TaskContext.get().partitionId(), 0
        tail = np.array([end], "<u4").tobytes()
        held: list[np.ndarray] = []
        sizes: list[int] = []
        ids: list[int | None] = []

        def flush():
            nonlocal shard
            path = os.path.join(folder, f"{part:06d}-{shard:06d}.wm")
            write(path, ids, sizes, np.concatenate(held))
            rows = [[part], [shard], [path], [len(ids)], [sum(sizes)]]
            shard += 1
            for x in (held, sizes, ids):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["part", "shard", "path", "documents", "tokens"])

        n = 0
        for b in (s for batch in batches for s in _slices(batch)):
            own, counts = encode(b.column(1).to_pylist(), tail)
            pa.default_memory_pool().release_unused()
            ends, docs, at, done = np.cumsum(counts), b.column(0).to_pylist(), 0, 0
            while at < len(docs):
                stop = min(len(docs), int(np.searchsorted(ends, done + SHARD - n)) + 1)
                held.append(own[done : ends[stop - 1]])
                sizes += counts[at:stop].tolist()
                ids += docs[at:stop]
                n += len(held[-1])
                at, done = stop, int(ends[stop - 1])
                if n >= SHARD:
                    yield flush()
                    n = 0
        if ids:
            yield flush()

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        own.repartitionByRange(width, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, "part long, shard long, path string, documents long, tokens long")
    )


def with_starts(files: DataFrame) -> DataFrame:
    """The rows of ``write_shards`` (one for 2^21 tokens) with ``before``: the ids of all files before."""
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))


def read_shards(files: DataFrame) -> DataFrame:
    """The rows of ``with_starts`` -> one row per document from the files: doc_id, start
    (ids of all documents before it), n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers)."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    # a row here is a file of megabytes: rows are dealt by number, as Spark would join small partitions
    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        for b in batches:
            for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, sizes, matrix = open_shard(path)
                raw, stops = memoryview(matrix.tokens().astype("<u4").tobytes()), np.cumsum(sizes)
                starts = stops - sizes
                crc = [zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(starts.tolist(), stops.tolist())]
                columns = [pa.array(x, pa.int64()) for x in (ids, before + starts, sizes, crc)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return files.select("path", "before").repartition(width, "path").mapInArrow(run, ", ".join(f"{n} long" for n in names))
