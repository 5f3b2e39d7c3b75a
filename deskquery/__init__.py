"""deskquery: a read-only desktop-database SQL dialect on Spark DataFrames."""

from .engine import Cursor, Engine, Statement
from .errors import DeskQueryError, ParamError, QuerySyntaxError, ReadOnlyError, TypeMismatch, UnknownColumn, UnknownTable

__all__ = ["Cursor", "DeskQueryError", "Engine", "ParamError", "QuerySyntaxError", "ReadOnlyError", "Statement", "TypeMismatch", "UnknownColumn", "UnknownTable"]
