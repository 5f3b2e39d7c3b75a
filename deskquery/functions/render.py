"""Text rendering of values and the optional float rounding of the legacy string interface."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def significant(column: Column, digits: int) -> Column:
    """A double rounded to so many significant digits."""
    return F.format_string(f"%.{digits - 1}e", column.cast("double")).cast("double")


def compatible_floats(df: DataFrame) -> DataFrame:
    """Single columns to 8 and Double columns to 16 significant digits, as doubles."""
    digits = {T.FloatType: 8, T.DoubleType: 16}
    picked = [F.when(df[f"`{f.name}`"].isNotNull(), significant(df[f"`{f.name}`"], digits[type(f.dataType)])).alias(f.name) if type(f.dataType) in digits else df[f"`{f.name}`"] for f in df.schema.fields]
    return df.select(*picked)


def as_text(field: T.StructField, date_format: str = "yyyy-MM-dd HH:mm:ss", short_date_format: str = "yyyy-MM-dd", true: str = "1", false: str = "0", guid_braces: bool = True) -> Column:
    """A column as text: dates by date_format, or by short_date_format where the metadata's Format is Short Date, booleans as the words given, numbers by their shortest form, bytes in hexadecimal."""
    column, meta = F.col(f"`{field.name}`"), field.metadata or {}
    if isinstance(field.dataType, T.BooleanType):
        return F.when(column, true).when(~column, false)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, short_date_format if meta.get("Format") == "Short Date" else date_format)
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    if meta.get("access_type") == "Replication ID" and not guid_braces:
        return F.translate(column, "{}", "")
    return column.cast("string")


def render(df: DataFrame, **formats) -> DataFrame:
    """Every column as text; formats are those of as_text."""
    return df.select(*[as_text(f, **formats).alias(f.name) for f in df.schema.fields])


def table_text(df: DataFrame, most: int | None = None, **formats) -> str:
    """The result, or its first rows, as a table of characters. Rows come to the driver: this is for reading."""
    rows = [["" if v is None else v for v in r] for r in (render(df, **formats) if most is None else render(df.limit(most), **formats)).collect()]
    widths = [max([len(c), *[len(r[i]) for r in rows]]) for i, c in enumerate(df.columns)]
    rule = "+" + "+".join("-" * w for w in widths) + "+"
    line = lambda values: "|" + "|".join(v.ljust(w) for v, w in zip(values, widths, strict=True)) + "|"
    return "\n".join([rule, line(df.columns), rule, *map(line, rows), rule])
