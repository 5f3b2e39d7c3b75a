"""Syntax tree to DataFrame: filter, then sort, then limit, then projection.

Sort keys need not be selected, so the projection comes last; Catalyst turns
sort and limit into one top-k operator and prunes the scan's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import UnknownColumn
from ..functions.types import ColumnType, column_type
from ..operators.ordering import row_limit, sort_column
from ..operators.predicates import lower
from .ast import Select


def ascii_fold(name: str) -> str:
    """Names match without regard to the case of ASCII letters."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in name)


def plan(select: Select, table: DataFrame) -> DataFrame:
    fields = {}
    for f in table.schema.fields:
        fields.setdefault(ascii_fold(f.name), f)

    def field(name: str):
        found = fields.get(ascii_fold(name))
        if found is None:
            raise UnknownColumn(name)
        return found

    def quoted(name: str) -> Column:
        return F.col("`" + name.replace("`", "``") + "`")

    def resolve(name: str) -> tuple[Column, ColumnType]:
        f = field(name)
        return quoted(f.name), column_type(f)

    picked = None if select.columns is None else [(quoted(field(n).name), n, field(n).metadata) for n in select.columns]
    rows = table if select.where is None else table.filter(lower(select.where, resolve))
    if select.count:
        counted = rows.agg(F.count(F.lit(1)).cast("string").alias("count"))
        return counted.limit(0) if select.top is not None and int(select.top) == 0 else counted
    if select.order:
        rows = rows.orderBy(*[sort_column(k, resolve) for k in select.order])
    limit = row_limit(select, table)
    if limit is not None:
        rows = rows.limit(limit)
    return rows if picked is None else rows.select(*[c.alias(n, metadata=m) if m else c.alias(n) for c, n, m in picked])
