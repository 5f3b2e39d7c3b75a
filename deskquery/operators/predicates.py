"""WHERE: syntax tree to a Column.

The dialect's logic has two values: a comparison with NULL is false, so its
negation is true. In positive places plain comparisons do the same, since a
filter drops NULL and FALSE alike, and plain comparisons reach the Parquet
scan. NOT is moved to the leaves, and a negated leaf also takes the NULLs.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import TypeMismatch
from ..functions.like import like
from ..functions.types import BOOL, FLOAT, INT, TEXT, ColumnType
from ..plans import ast
from .coerce import NEVER, coerce, literal_value

_OPS: dict[str, Callable] = {"=": operator.eq, "<>": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}
_OPPOSITE = {"=": "<>", "<>": "=", "<": ">=", ">": "<=", "<=": ">", ">=": "<"}

#: Gives a column by the name a query uses, and its type.
Resolve = Callable[[str], tuple[Column, ColumnType]]


def lower(node, resolve: Resolve, negated: bool = False) -> Column:
    """The condition as a Column that is true for exactly the rows to keep (elsewhere false or null)."""
    match node:
        case ast.Not(part):
            return lower(part, resolve, not negated)
        case ast.And(parts) | ast.Or(parts):
            both = operator.and_ if isinstance(node, ast.And) != negated else operator.or_
            return reduce(both, [lower(p, resolve, negated) for p in parts])
        case ast.LiteralCompare():
            return F.lit(_fold(node) != negated)
        case ast.IsNull(name, not_null):
            column, kind = resolve(name)
            if kind.family == BOOL:  # stored in the null mask: FALSE is null
                is_true = F.coalesce(column, F.lit(False))
                return is_true if not_null != negated else ~is_true
            return column.isNotNull() if not_null != negated else column.isNull()
        case ast.Compare(name, op, literal):
            return _compare(*resolve(name), op, literal, negated)
        case ast.Like(name, pattern, fold):
            column, kind = resolve(name)
            if kind.family != TEXT:
                return F.lit(negated)
            return _leaf(column, like(column, pattern.text, fold), negated)
        case ast.InList(name, items):
            column, kind = resolve(name)
            if kind.family == BOOL:
                column = column.cast("int")
            elif kind.family == FLOAT:
                column = column.cast("double")
            found = [c for x in items if (c := coerce(kind, x)) is not NEVER]
            return _leaf(column, column.isin(*found), negated) if found else F.lit(negated)
    raise TypeError(f"not a predicate: {node!r}")


def _leaf(column: Column, test: Column, negated: bool) -> Column:
    return (~test) | column.isNull() if negated else test


def _compare(column: Column, kind: ColumnType, op: str, literal: ast.Literal, negated: bool) -> Column:
    value = coerce(kind, literal)
    if value is NEVER:
        return F.lit(negated)
    if kind.family == BOOL:
        plain = literal_value(kind, literal)
        column, value = (column, F.lit(bool(plain))) if plain in (0, 1) and op in ("=", "<>") else (column.cast("int"), value)
    elif kind.family == FLOAT:
        column = column.cast("double")
    elif kind.family == INT and literal.kind == "decimal":
        column = column.cast("double")
    if negated:
        return _OPS[_OPPOSITE[op]](column, value) | column.isNull()
    return _OPS[op](column, value)


def _fold(node: ast.LiteralCompare) -> bool:
    """A comparison of two constants. Texts compare with texts and numbers with numbers; NULL equals nothing."""
    left, right = node.left, node.right
    if "null" in (left.kind, right.kind):
        return False
    if (left.kind == "string") != (right.kind == "string") or (left.kind == "datetime") != (right.kind == "datetime"):
        raise TypeMismatch(f"cannot compare {left.text!r} with {right.text!r}")
    a, b = (x.value.encode() if x.kind == "string" else x.value for x in (left, right))
    return _OPS[node.op](a, b)
