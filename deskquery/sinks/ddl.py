"""CREATE TABLE statements for other databases, from the schemas of tables.

What a schema knows beyond names and types comes from its fields' metadata:
access_type, size, Required, DefaultValue, AllowZeroLength, Description and
Format. Indexes and relationships are not part of a schema and not written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..errors import DeskQueryError
from ..functions.types import column_size, column_type


@dataclass(frozen=True)
class Dialect:
    types: dict[str, str]
    quotes: tuple[str, str]
    create: str = "CREATE TABLE {}"
    drop: str = "DROP TABLE {};"
    short_date: str | None = None
    now: str = "current_date"
    short_now: str = "current_date"
    not_empty: bool = False
    comments: bool = False
    joins_namespace: bool = False  # as a prefix of the name, where there are no namespaces
    lower: bool = False


# What each type is called. {chars} and {bytes} are a length, {number} precision and scale.
DIALECTS = {
    "access": Dialect(
        {"Boolean": "Boolean", "Byte": "Byte", "Integer": "Integer", "Long Integer": "Long Integer", "Currency": "Currency", "Single": "Single", "Double": "Double", "DateTime": "DateTime", "Binary": "Binary",
         "Text": "Text ({chars})", "OLE": "OLE ({bytes})", "Memo/Hyperlink": "Memo/Hyperlink ({chars})", "Replication ID": "Replication ID", "Numeric": "Numeric ({number})"},
        ("[", "]"), now="Date()", short_now="Date()", joins_namespace=True,
    ),
    "sybase": Dialect(
        {"Boolean": "bit", "Byte": "char ({bytes})", "Integer": "smallint", "Long Integer": "int", "Currency": "money", "Single": "real", "Double": "float", "DateTime": "smalldatetime", "Binary": "varbinary ({bytes})",
         "Text": "nvarchar ({chars})", "OLE": "varbinary(max)", "Memo/Hyperlink": "nvarchar(max)", "Replication ID": "Sybase_Replication ID", "Numeric": "numeric ({number})"},
        ('"', '"'), short_date="DATE", now="getdate()", short_now="getdate()", not_empty=True, comments=True,
    ),
    "oracle": Dialect(
        {"Boolean": "NUMBER(1)", "Byte": "NUMBER(3)", "Integer": "NUMBER(5)", "Long Integer": "NUMBER(11)", "Currency": "NUMBER(15,2)", "Single": "FLOAT", "Double": "FLOAT", "DateTime": "TIMESTAMP", "Binary": "BINARY",
         "Text": "VARCHAR2 ({chars})", "OLE": "BLOB", "Memo/Hyperlink": "CLOB", "Replication ID": "NUMBER ({bytes})", "Numeric": "NUMBER ({number})"},
        ('"', '"'), short_date="DATE", now="sysdate", comments=True,
    ),
    "postgres": Dialect(
        {"Boolean": "BOOLEAN", "Byte": "SMALLINT", "Integer": "INTEGER", "Long Integer": "INTEGER", "Currency": "NUMERIC(15,2)", "Single": "REAL", "Double": "DOUBLE PRECISION", "DateTime": "TIMESTAMP WITHOUT TIME ZONE", "Binary": "BYTEA",
         "Text": "VARCHAR ({chars})", "OLE": "BYTEA", "Memo/Hyperlink": "TEXT", "Replication ID": "UUID", "Numeric": "NUMERIC ({number})"},
        ('"', '"'), create="CREATE TABLE IF NOT EXISTS {}", drop="DROP TABLE IF EXISTS {};", short_date="DATE", now="now()", not_empty=True, comments=True, lower=True,
    ),
    "mysql": Dialect(
        {"Boolean": "boolean", "Byte": "tinyint", "Integer": "smallint", "Long Integer": "int", "Currency": "float", "Single": "float", "Double": "double", "DateTime": "datetime", "Binary": "blob",
         "Text": "varchar ({chars})", "OLE": "blob", "Memo/Hyperlink": "text", "Replication ID": "char(38)", "Numeric": "numeric ({number})"},
        ("`", "`"), drop="DROP TABLE IF EXISTS {};", short_date="date", now="now()", not_empty=True, joins_namespace=True,
    ),
    "sqlite": Dialect(
        {"Boolean": "INTEGER", "Byte": "INTEGER", "Integer": "INTEGER", "Long Integer": "INTEGER", "Currency": "REAL", "Single": "REAL", "Double": "REAL", "DateTime": "DateTime", "Binary": "BLOB",
         "Text": "varchar", "OLE": "BLOB", "Memo/Hyperlink": "TEXT", "Replication ID": "INTEGER", "Numeric": "INTEGER"},
        ("`", "`"), drop="DROP TABLE IF EXISTS {};", now="date('now')", short_now="date('now')", joins_namespace=True,
    ),
}
#: Types of Parquet tables that the dialects have no name for.
_LIKE = {"Big Integer": "Numeric", "Complex": "Long Integer"}


def create_table(name: str, schema: T.StructType, dialect: str, namespace: str | None = None, drop: bool = False, not_null: bool = True, defaults: bool = True, not_empty: bool = True, comments: bool = True) -> str:
    """The statements that make a table with the columns of schema."""
    if dialect not in DIALECTS:
        raise DeskQueryError(f"unknown dialect {dialect}; there are {', '.join(DIALECTS)}")
    d = DIALECTS[dialect]
    table = _table(d, namespace, name)
    columns = []
    for f in schema.fields:
        meta = f.metadata or {}
        parts = [f"\t{_quoted(d, f.name)}\t\t\t{_type(d, f)}"]
        if not_null and (column_type(f).name == "Boolean" or str(meta.get("Required", "")).lower().startswith("y")):
            parts.append("NOT NULL")
        if defaults and (value := _default(d, f)) is not None:
            parts.append(f"DEFAULT {value}")
        if comments and dialect == "mysql" and meta.get("Description"):
            parts.append(f"COMMENT {_text(meta['Description'])}")
        columns.append(" ".join(parts))
    lines = [d.drop.format(table)] if drop else []
    lines += [d.create.format(table), " (", ", \n".join(columns), ");"]
    for f in schema.fields:
        meta = f.metadata or {}
        if not_empty and d.not_empty and str(meta.get("AllowZeroLength", "")).lower().startswith("n"):
            lines.append(f"ALTER TABLE {table} ADD CHECK ({_quoted(d, f.name)} <>'');")
        if comments and d.comments and meta.get("Description"):
            lines.append(f"COMMENT ON COLUMN {table}.{_quoted(d, f.name)} IS {_text(meta['Description'])};")
    return "\n".join(lines) + "\n"


def _type(d: Dialect, f: T.StructField) -> str:
    kind, size = column_type(f).name, column_size(f)
    if kind == "DateTime" and d.short_date and _short(f):
        return d.short_date
    precise = isinstance(f.dataType, T.DecimalType)
    number = f"{f.dataType.precision}, {f.dataType.scale}" if precise else "19, 0" if kind == "Big Integer" else "28, 0"
    return d.types[_LIKE.get(kind, kind)].format(chars=size // 2 or 255, bytes=size or 255, number=number)


def _short(f: T.StructField) -> bool:
    return (f.metadata or {}).get("Format") == "Short Date"


def _default(d: Dialect, f: T.StructField) -> str | None:
    given = (f.metadata or {}).get("DefaultValue")
    if given is None:
        return "FALSE" if column_type(f).name == "Boolean" else None
    if len(given) > 1 and given[0] == given[-1] == '"':
        return _text(given[1:-1])
    return {"yes": "TRUE", "no": "FALSE", "date()": d.short_now if _short(f) else d.now}.get(given.lower(), given)


def _table(d: Dialect, namespace: str | None, name: str) -> str:
    if namespace and not d.joins_namespace:
        return f"{_quoted(d, namespace)}.{_quoted(d, name)}"
    return _quoted(d, f"{namespace}_{name}" if namespace else name)


def _quoted(d: Dialect, name: str) -> str:
    first, last = d.quotes
    return first + _plain(name.lower() if d.lower else name).replace(last, last + last) + last


def _text(value: str) -> str:
    return "'" + _plain(value).replace("'", "''") + "'"


def _plain(value: str) -> str:
    return "".join(f"\\{ord(c):03o}" if ord(c) < 32 else c for c in value)
