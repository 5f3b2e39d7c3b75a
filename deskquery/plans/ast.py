"""Immutable syntax tree of the dialect. Statements are hashable, so parses can be cached by text."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Literal:
    """kind: int, decimal, string, bool, null, datetime or param. text is the source spelling, which text columns compare with."""

    kind: str
    value: object
    text: str


@dataclass(frozen=True)
class Compare:
    column: str
    op: str
    literal: Literal


@dataclass(frozen=True)
class Like:
    column: str
    pattern: Literal
    fold_case: bool


@dataclass(frozen=True)
class IsNull:
    column: str
    negated: bool


@dataclass(frozen=True)
class InList:
    column: str
    items: tuple[Literal, ...]


@dataclass(frozen=True)
class LiteralCompare:
    left: Literal
    op: str
    right: Literal


@dataclass(frozen=True)
class And:
    parts: tuple


@dataclass(frozen=True)
class Or:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


@dataclass(frozen=True)
class SortKey:
    column: str
    descending: bool
    by_length: bool


@dataclass(frozen=True)
class Select:
    """columns: None for *; count: COUNT(*); top: row limit or percentage (see percent), None without one."""

    table: str
    columns: tuple[str, ...] | None
    count: bool
    where: object | None
    order: tuple[SortKey, ...]
    top: float | None
    percent: bool
    num_params: int


@dataclass(frozen=True)
class ListTables:
    num_params: int = 0


@dataclass(frozen=True)
class DescribeTable:
    table: str
    num_params: int = 0


@dataclass(frozen=True)
class Connect:
    path: str
    num_params: int = 0


@dataclass(frozen=True)
class Disconnect:
    num_params: int = 0
