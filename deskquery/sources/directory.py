"""A directory of Parquet tables, a desktop database file or a mapping as a database.

The listing goes through Spark's Hadoop file systems, so any path that Spark
reads will do. A table's schema is read when a query first names it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DeskQueryError, UnknownTable
from ..plans.planner import ascii_fold
from .desktop_file import read_table, table_names

_SUFFIX = ".parquet"
#: Endings of desktop database files.
FILES = (".mdb", ".accdb")


class Database:
    """Tables by name, without regard to the case of ASCII letters. source: a directory, a desktop database file, or tables by name."""

    def __init__(self, spark: SparkSession, source: str | Mapping[str, DataFrame]):
        if isinstance(source, str) and not source.strip():
            raise DeskQueryError("the path of the database is empty")
        self.spark, self.source = spark, source
        self._names: dict[str, str] | None = None
        self._frames: dict[str, DataFrame] = {}

    def refresh(self) -> None:
        """Forget listings and schemas, so that changed files are seen."""
        self._names, self._frames = None, {}

    def names(self) -> list[str]:
        return list(self._index().values())

    def table(self, name: str) -> DataFrame:
        key = ascii_fold(name)
        if key not in self._frames:
            stored = self._index().get(key)
            if stored is None and self._is_file:
                stored = name  # a system table is not listed, but has a name
            if stored is None:
                raise UnknownTable(name)
            self._frames[key] = _ingest(self._read(stored))
        return self._frames[key]

    @property
    def _is_file(self) -> bool:
        return isinstance(self.source, str) and self.source.lower().endswith(FILES)

    def _read(self, name: str) -> DataFrame:
        if isinstance(self.source, Mapping):
            return self.source[name]
        return read_table(self.spark, self.source, name) if self._is_file else self.spark.read.parquet(f"{self.source.rstrip('/')}/{name}{_SUFFIX}")

    def _index(self) -> dict[str, str]:
        if self._names is None:
            listed = table_names(self.source) if self._is_file else sorted(self.source) if isinstance(self.source, Mapping) else sorted(self._files())
            self._names = {ascii_fold(n): n for n in listed}
        return self._names

    def _files(self) -> list[str]:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.source)
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(path):
            raise DeskQueryError(f"no database at {self.source}")
        found = [s.getPath().getName() for s in files.listStatus(path)]
        return [n.removesuffix(_SUFFIX) for n in found if n.endswith(_SUFFIX)]


def _ingest(df: DataFrame) -> DataFrame:
    """Booleans are never null: the value is what the null mask holds."""
    nullable = [f for f in df.schema.fields if isinstance(f.dataType, T.BooleanType) and f.nullable]
    if not nullable:
        return df
    return df.withColumns({f.name: F.coalesce(df[f"`{f.name}`"], F.lit(False)).alias(f.name, metadata=f.metadata or {}) for f in nullable})
