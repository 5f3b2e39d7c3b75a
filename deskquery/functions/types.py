"""The fifteen column types, their families and sizes, and how Spark types map to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

INT, FLOAT, DECIMAL, TEXT, DATE, BOOL, RAW = "int", "float", "decimal", "text", "date", "bool", "raw"


@dataclass(frozen=True)
class ColumnType:
    name: str
    family: str
    size: int | None  # bytes; None: from the column's metadata
    sortable: bool = True
    has_length: bool = False


# Type names and byte sizes that DESCRIBE TABLE reports.
TYPES = {
    t.name: t
    for t in (
        ColumnType("Boolean", BOOL, 0),
        ColumnType("Byte", INT, 1),
        ColumnType("Integer", INT, 2),
        ColumnType("Long Integer", INT, 4),
        ColumnType("Currency", DECIMAL, 8),
        ColumnType("Single", FLOAT, 4),
        ColumnType("Double", FLOAT, 8),
        ColumnType("DateTime", DATE, 8),
        ColumnType("Binary", RAW, None, sortable=False, has_length=True),
        ColumnType("Text", TEXT, None, has_length=True),
        ColumnType("OLE", RAW, None, sortable=False, has_length=True),
        ColumnType("Memo/Hyperlink", TEXT, 0, has_length=True),
        ColumnType("Replication ID", TEXT, 16),
        ColumnType("Numeric", DECIMAL, 17, sortable=False),
        ColumnType("Complex", INT, 4),
        # Extension: 64-bit integers of Parquet tables.
        ColumnType("Big Integer", INT, 8),
    )
}
#: Bytes reported for a Text column of unknown length: 255 characters of two bytes.
DEFAULT_TEXT_SIZE = 510
_SPARK = {
    T.StringType: "Text", T.BooleanType: "Boolean", T.ByteType: "Integer", T.ShortType: "Integer", T.IntegerType: "Long Integer", T.LongType: "Big Integer",
    T.FloatType: "Single", T.DoubleType: "Double", T.TimestampType: "DateTime", T.TimestampNTZType: "DateTime", T.DateType: "DateTime", T.BinaryType: "Binary",
}


def column_type(field: T.StructField) -> ColumnType:
    """The type named in the field's metadata, else the one its Spark type stands for. Unknown types behave like OLE."""
    named = (field.metadata or {}).get("access_type")
    if named in TYPES:
        return TYPES[named]
    if isinstance(field.dataType, T.DecimalType):
        return TYPES["Currency" if (field.dataType.precision, field.dataType.scale) == (19, 4) else "Numeric"]
    return TYPES[_SPARK.get(type(field.dataType), "OLE")]


def column_size(field: T.StructField) -> int:
    """Size in bytes."""
    declared = (field.metadata or {}).get("size")
    kind = column_type(field)
    if declared is not None:
        return int(declared)
    if kind.size is not None:
        return kind.size
    return DEFAULT_TEXT_SIZE if kind.name == "Text" else 0


def column_length(field: T.StructField) -> int | None:
    """The length a result column reports: only for texts and bytes of known size."""
    return size if column_type(field).has_length and (size := column_size(field)) > 0 else None
