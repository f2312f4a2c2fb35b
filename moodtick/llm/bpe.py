"""Byte-level BPE by tree reduction: encode halves, join them at a re-encoded window.

Text level: a text of more than LEAF_TEXT characters is halved; the halves are joined by
encoding anew the window around the seam, which grows on either side to the next provable
cut (see ``chunks``); ids outside the window stay. Piece level (one match of the split
pattern): bytes up to LEAF are merged directly, anything longer is halved, and the halves
are joined by merging anew the last and first w tokens; the tokens outside stay if the
window gives the same outermost tokens, because an id sequence is the encoding of its
bytes exactly if every pair of neighbours is. Otherwise w doubles. Nodes of the tree that
many pieces have in common are remembered. Decoding concatenates up the tree.
"""

from __future__ import annotations

import base64
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from .chunks import SAFE_CUT, Memo, chunks, simple_pieces, whole
from .common import clean_name, held, small_batches

LEAF = 4  # bytes of a piece that are merged directly
LEAF_TEXT = 1 << 10  # characters of a text that are split directly
WINDOW = 64  # bytes of a window that are merged directly; larger ones are encoded pair by pair
NODE = 24  # bytes of a node that is remembered
CHUNKS, PIECES, NODES, PAIRS = 160 << 20, 60 << 20, 60 << 20, 20 << 20  # bytes remembered by a worker
_NONE = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern).findall
        self.pieces = Memo(self._piece_ids, PIECES)
        self.nodes = Memo(self.piece, NODES)
        self.joins = {"text": 0, "piece": 0}
        self.by_chunk = Memo(self._chunk, CHUNKS)
        self.stays = Memo(lambda pair: self.merge(pair[0] + pair[1]) == [*pair], PAIRS)

    # --- one piece
    def merge(self, piece: bytes) -> list[bytes]:
        """Tokens of a few bytes by merging the lowest rank, leftmost first."""
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pair = [rank(piece[i : i + 2], _NONE) for i in range(len(piece) - 1)]
        while pair and (best := min(pair)) < _NONE:
            i = pair.index(best)
            parts[i] += parts.pop(i + 1)
            del pair[i]
            if i < len(pair):
                pair[i] = rank(parts[i] + parts[i + 1], _NONE)
            if i:
                pair[i - 1] = rank(parts[i - 1] + parts[i], _NONE)
        return parts

    def direct(self, piece: bytes) -> list[bytes]:
        """Tokens of a piece: the sequence in which every pair of neighbours is what merging
        the pair's bytes gives. The longest token comes first, a shorter one where a pair
        fails; positions from which no sequence ends are not tried twice."""
        ranks, stays, n = self.ranks, self.stays, len(piece)
        out: list[bytes] = []
        dead: set[int] = set()
        at, size = 0, min(n, self.longest)
        while at < n:
            while size:
                token = piece[at : at + size]
                if token in ranks and at + size not in dead and (not out or stays[out[-1], token]):
                    break
                size -= 1
            if size:
                out.append(token)
                at += size
                size = min(n - at, self.longest)
            else:
                dead.add(at)
                last = out.pop()
                at, size = at - len(last), len(last) - 1
        return out

    def join(self, a: list[bytes], b: list[bytes]) -> list[bytes]:
        """The tokens of two neighbours' bytes together."""
        self.joins["piece"] += 1
        w = 2
        while True:
            left, right = a[-w:], b[:w]
            window = b"".join(left + right)
            mid = self.merge(window) if len(window) <= WINDOW else self.direct(window)
            if (len(a) <= w or mid[0] == left[0]) and (len(b) <= w or mid[-1] == right[-1]):
                return a[:-w] + mid + b[w:]
            w *= 2

    def piece(self, piece: bytes) -> list[bytes]:
        """Tokens of one match of the split pattern."""
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        a, b = piece[:half], piece[half:]
        if len(b) <= NODE:
            return self.join(self.nodes[a], self.nodes[b])
        return self.join(self.piece(a), self.piece(b))

    # --- one match of the split pattern
    def _piece_ids(self, piece: str) -> bytes:
        return array("I", map(self.ranks.__getitem__, self.piece(piece.encode()))).tobytes()

    # --- a text
    def _pattern(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() and (chunk.isascii() or max(chunk) < "\u0250"):  # one match, with the blank before it
            return self._piece_ids(" " + chunk)
        known = simple_pieces(chunk)
        if not known:
            return self._pattern(whole(chunk))
        # a word is remembered once, whatever stands behind it
        return b"".join([self.by_chunk[p[1:]] if p[0] == " " and p[1:].isalpha() else self.pieces[p] for p in known])

    def _direct(self, text: str) -> bytes:
        first, *rest = chunks(text)
        return self._pattern(first) + b"".join(map(self.by_chunk.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if len(text) <= LEAF_TEXT:
            return self._direct(text)
        self.joins["text"] += 1
        seam = len(text) // 2
        start, end = self._window(text, seam)
        if end - start > max(256, len(text) // 2):  # hardly a cut near the seam: the window is a part of its own
            return b"".join([self.encode(text[:start]), self._direct(text[start:end]), self.encode(text[end:])])
        a, b = self.encode(text[:seam]), self.encode(text[seam:])
        keep_a = len(a) - 4 * self._count_back(a, len(text[start:seam].encode()))
        keep_b = 4 * self._count_on(b, len(text[seam:end].encode()))
        return a[:keep_a] + self._direct(text[start:end]) + b[keep_b:]

    def _window(self, text: str, seam: int) -> tuple[int, int]:
        """The window around a seam, grown on either side until it ends at a cut or with the text."""
        w = 32
        while True:
            w *= 2
            low = max(0, seam - w)
            start = max((m.start() for m in SAFE_CUT.finditer(text, low + 1, seam)), default=low)
            if start > low or not low:
                break
        w = 32
        while True:
            w *= 2
            high = min(len(text), seam + w)
            m = SAFE_CUT.search(text, seam + 1, high)
            if m or high == len(text):
                return start, m.start() if m else high

    def _count_on(self, ids: bytes, size: int) -> int:
        """The number of ids that start the sequence and have ``size`` bytes."""
        own, n = memoryview(ids).cast("I"), 0
        while size > 0:
            size -= len(self.tokens[own[n]])
            n += 1
        assert not size, "a cut inside a token"
        return n

    def _count_back(self, ids: bytes, size: int) -> int:
        own, n = memoryview(ids).cast("I"), 0
        while size > 0:
            n += 1
            size -= len(self.tokens[own[-n]])
        assert not size, "a cut inside a token"
        return n

    def decode(self, ids: bytes) -> bytes:
        if len(ids) <= 4 * LEAF_TEXT:
            return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist()))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _encoder(path: str, pattern: str) -> BPE:
    return held(("bpe", path, pattern), lambda: BPE(read_ranks(path), pattern))


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", decode: bool = True) -> DataFrame:
    """The rows of ``docs`` with ``ids`` (binary: little-endian unsigned 32-bit) and, on
    request, ``decoded`` (binary: the bytes those ids stand for).

    ``path`` is a rank file every worker can read, ``pattern`` the split pattern. A null
    text counts as empty: no ids. Whole texts of any length are encoded; memory grows
    with the longest text of a batch. Rows are independent, repeated ones included; an
    empty table gives none. Result columns that ``docs`` has already are named with
    leading underscores."""
    ids, decoded = clean_name(docs, "ids"), clean_name(docs, "decoded")
    new = [ids, decoded] if decode else [ids]
    at, schema = docs.columns.index(text), StructType([*docs.schema.fields, *(StructField(c, BinaryType()) for c in new)])

    def run(batches):
        bpe = _encoder(path, pattern)
        for whole_batch in batches:
            for k in range(0, whole_batch.num_rows, 512):
                b = whole_batch.slice(k, 512)
                out = [bpe.encode(x.as_py() or "") for x in b.column(at)]
                more = [pa.array(out, pa.binary())]
                if decode:
                    more.append(pa.array(map(bpe.decode, out), pa.binary()))
                yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *new])

    return small_batches(docs).mapInArrow(run, schema)
