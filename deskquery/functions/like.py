"""LIKE and ILIKE as Column expressions.

``%`` matches any run, ``_`` exactly one byte of the UTF-8 text, and there is
no escape character. Patterns without ``_`` work on the text; those with ``_``
compare both sides in Latin-1, where one character is one byte.

Patterns that are one prefix, suffix, infix or prefix and suffix stay Spark
LIKE, which becomes a string test and pushes prefixes down to Parquet. All
others become a regular expression of atomic groups: taking each inner piece at
its leftmost place is never wrong, so nothing is tried twice and no pattern is
slow.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Capitals whose small letter depends on their neighbours, or is two: here every character is folded by itself, on both sides.
_ALONE = ("\u03a3\u0130", "\u03c3i")
_SIMPLE = re.compile(r"%?[^%_]*%?|[^%_]+%[^%_]+")


def like(column: Column, pattern: str, fold_case: bool = False) -> Column:
    if fold_case:
        column, pattern = F.lower(F.translate(column, *_ALONE)), "".join(dict(zip(*_ALONE, strict=True)).get(c, c.lower()) for c in pattern)
    if _SIMPLE.fullmatch(pattern):
        return column.like(pattern.replace("\\", "\\\\"))
    if "_" in pattern:
        column, pattern = F.decode(F.encode(column, "UTF-8"), "ISO-8859-1"), pattern.encode().decode("latin-1")
    return column.rlike(_regex(pattern))


def _regex(pattern: str) -> str:
    first, *rest = (_piece(p) for p in re.split("%+", pattern))
    if not rest:
        return rf"(?s)\A{first}\z"
    *inner, last = rest
    return rf"(?s)\A{first}" + "".join(f"(?>.*?{p})" for p in inner) + rf".*{last}\z"


def _piece(text: str) -> str:
    return "".join("." if c == "_" else c if c.isalnum() and c.isascii() else f"\\x{{{ord(c):x}}}" for c in text)
