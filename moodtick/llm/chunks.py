"""Cut texts where byte-level BPE provably starts anew, and remember the chunks.

The split pattern matches white space runs, or at most one leading space with a run
of other characters; it never looks back. A position after a character that is no
white space and before a blank or line end is therefore always between two matches,
and what follows it is split as if the text began there. Encoding the chunks one by
one gives the ids of the whole text.
"""

from __future__ import annotations

import re

# x1c-x1f count as white space for Python but not for the pattern: no cut next to them.
SAFE_CUT = re.compile(r"(?<=\S)(?<![\x1c-\x1f])(?=[ \t\r\n])")


def chunks(text: str) -> list[str]:
    """Chunks whose concatenation is ``text``; a chunk that starts with no blank or line
    end (all but the first have one) stands for itself with a blank before it."""
    plain = text.replace("\n", " ")
    if plain.isprintable() and "  " not in plain:  # no white space but single blanks and line ends
        return text.replace("\n", " \n").split(" ")
    parts = SAFE_CUT.split(text)
    return [parts[0], *(p[1:] if p[0] == " " and p[1:2] not in (" ", "\n", "\t", "\r", "") else p for p in parts[1:])]


# The split pattern for Latin text: its letters and numbers up to U+024F, spelt out.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+").findall


def simple_pieces(chunk: str) -> list[str] | None:
    """The matches of the split pattern in a chunk (not the first) without characters
    beyond Latin letters; None for other chunks."""
    if chunk.isascii() and chunk.isprintable():
        return _LATIN(" " + chunk if chunk[:1] != " " else chunk)
    if chunk and max(chunk) < "\u0250" and chunk.replace("\n", " ").isprintable():
        return _LATIN(whole(chunk))
    return None


def whole(chunk: str) -> str:
    """The text of a chunk after the first."""
    return chunk if chunk[:1] in (" ", "\n", "\t", "\r") else " " + chunk


class Memo(dict):
    """Results by key, in about ``limit`` bytes: when the newer half is full, the older half
    is forgotten, but for what has been asked for since."""

    ENTRY = 300  # bytes of an entry with a short key; long ones count for more

    def __init__(self, make, limit: int):
        self.make, self.half = make, limit // 2
        self.clear()

    def clear(self):
        super().clear()
        self.old, self.left = {}, self.half

    def __missing__(self, key):
        self.left -= self.ENTRY if len(key) < 20 else self.ENTRY + 5 * len(key)
        if self.left < 0:
            self.old, self.left = dict(self), self.half
            super().clear()
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        self[key] = out
        return out
