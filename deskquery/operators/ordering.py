"""ORDER BY, Len() and the row limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import TypeMismatch
from ..functions.types import TEXT
from ..plans.ast import Select, SortKey
from .predicates import Resolve


def sort_column(key: SortKey, resolve: Resolve) -> Column:
    """NULLs first ascending, last descending. Texts sort by bytes, Len() counts code points."""
    column, kind = resolve(key.column)
    if key.by_length:
        if kind.family != TEXT:
            raise TypeMismatch(f"Len({key.column}): ORDER BY Len is for text columns, not {kind.name}")
        column = F.char_length(column)
    elif not kind.sortable:
        raise TypeMismatch(f"ORDER BY on column type {kind.name} not supported")
    return column.desc_nulls_last() if key.descending else column.asc_nulls_first()


def row_limit(select: Select, table: DataFrame) -> int | None:
    """Rows to return at most; None: all. A percentage is of the whole table, before WHERE."""
    if select.top is None:
        return None
    if select.percent:
        return int(table.count() / 100 * select.top)  # reads no data columns
    return int(select.top) if select.top >= 0 else None
