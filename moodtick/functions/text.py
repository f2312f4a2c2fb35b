"""Text cleaning and tokenisation as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cleaning collapses any whitespace run to one blank (no trim);
# the tokeniser splits the lower-cased text on runs of non a-z characters.
WHITESPACE_RUN = r"\s+"
TOKEN_SPLIT = "[^a-z]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """lower + collapse whitespace runs to one blank; NULL stays NULL; no trim."""
    return F.regexp_replace(F.lower(_c(c)), WHITESPACE_RUN, " ")


def tokens(cleaned: Column | str) -> Column:
    """array<string> of a-z tokens of an already cleaned text (may hold empty strings)."""
    return F.split(_c(cleaned), TOKEN_SPLIT)
