"""Values as quoted and escaped text, for files of separated values, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DeskQueryError
from ..functions.render import as_text
from ..functions.types import column_type

#: Column types that are quoted.
QUOTED = ("Text", "Memo/Hyperlink", "DateTime", "Binary", "OLE", "Replication ID")
BINARY = ("strip", "raw", "octal", "hex")


def escaped(df: DataFrame, quote: str = '"', escape: str | None = None, binary: str = "raw", control: bool = False, quote_text: bool = True, **formats) -> DataFrame:
    """Every column as text.

    quote is put around texts, dates and bytes; inside it is doubled, or has escape before it, which then escapes itself.
    binary: bytes are left out, put as they are (as Latin-1), or written in octal or hexadecimal numbers. control: carriage
    return, line feed, tab and backslash become two characters. formats: see functions.render. Null stays null."""
    if binary not in BINARY:
        raise DeskQueryError(f"binary is one of {', '.join(BINARY)}")

    def written(f: T.StructField) -> Column:
        raw = isinstance(f.dataType, T.BinaryType)
        text = _bytes(F.col(f"`{f.name}`"), binary) if raw else as_text(f, **formats)
        if not (quoting := column_type(f).name in QUOTED):
            return text
        numbers = raw and binary in ("octal", "hex")
        if quote_text and quote and not numbers:
            if escape:
                text = _replaced(text, {quote: escape + quote, escape: escape + escape})
            else:
                text = F.replace(text, F.lit(quote), F.lit(quote + quote))
        if control and quoting and not numbers:
            text = _replaced(text, {"\r": "\\r", "\n": "\\n", "\t": "\\t"} | ({} if escape == "\\" and quote_text else {"\\": "\\\\"}))
        return F.concat(F.lit(quote), text, F.lit(quote)) if quote_text else text

    return df.select(*[written(f).alias(f.name) for f in df.schema.fields])


def _bytes(column: Column, binary: str) -> Column:
    match binary:
        case "strip":
            return F.when(column.isNotNull(), "")
        case "raw":
            return F.decode(column, "ISO-8859-1")
        case "hex":
            return F.hex(column)
    pairs = F.regexp_extract_all(F.hex(column), F.lit("([0-9A-F]{2})"), 1)
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("\\"), F.lpad(F.conv(p, 16, 8), 3, "0"))), "")


def _replaced(text: Column, by: dict[str, str]) -> Column:
    """All replacements at once, so that none sees another's result: the pieces between, and what is put for each match."""
    pattern = "|".join(re.escape(k) for k in by)
    found = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    gaps = F.split(text, pattern, -1)
    put = F.transform(found, lambda m: F.element_at(F.create_map(*[F.lit(x) for pair in by.items() for x in pair]), m))
    return F.array_join(F.zip_with(gaps, put, lambda gap, m: F.concat(gap, F.coalesce(m, F.lit("")))), "")
