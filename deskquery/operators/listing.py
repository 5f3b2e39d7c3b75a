"""LIST TABLES, DESCRIBE TABLE and the description of a result's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.types import column_length, column_size, column_type

_SCAN = {"int": "int64", "float": "float64", "decimal": "string", "text": "string", "date": "datetime", "bool": "bool", "raw": "bytes"}


def list_tables(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], T.StructType([T.StructField("Tables", T.StringType())]))


def describe_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per column: name, type and size in bytes, all as text."""
    rows = [(f.name, column_type(f).name, str(column_size(f))) for f in schema.fields]
    return spark.createDataFrame(rows, T.StructType([T.StructField(n, T.StringType()) for n in ("Column Name", "Type", "Size")]))


def describe_result(schema: T.StructType) -> list[dict]:
    """Name, type, length, nullability and Python-side kind of each result column. Nullability is never known."""
    return [
        {"name": f.name, "type": (k := column_type(f)).name, "length": column_length(f), "nullable": None, "scan_type": "float64" if k.name == "Currency" else _SCAN[k.family]}
        for f in schema.fields
    ]
