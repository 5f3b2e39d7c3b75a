"""Entry point: statements in, DataFrames out."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from .errors import DeskQueryError, ReadOnlyError
from .functions.render import compatible_floats
from .operators.listing import describe_result, describe_table, list_tables
from .plans import ast
from .plans.params import bind
from .plans.parser import parse
from .plans.planner import plan
from .sinks.ddl import create_table
from .sources.directory import Database


class Engine:
    """A read-only database. compat_floats rounds Single and Double results to 8 and 16 digits."""

    def __init__(self, spark: SparkSession, source: str | Mapping[str, DataFrame], compat_floats: bool = False):
        self.spark, self.compat_floats = spark, compat_floats
        self.connect(source)

    def connect(self, source: str | Mapping[str, DataFrame]) -> None:
        """From now on statements are about this database."""
        self._database = Database(self.spark, source)

    def disconnect(self) -> None:
        self._database = None

    @property
    def database(self) -> Database:
        if self._database is None:
            raise DeskQueryError("no database is connected")
        return self._database

    def create_table(self, table: str, dialect: str, **options) -> str:
        """The statements that make the table in another database: see sinks.ddl."""
        return create_table(table, self.database.table(table).schema, dialect, **options)

    def sql(self, query: str, *params) -> DataFrame:
        """The result as a lazy DataFrame. Only TOP n PERCENT runs a job at once, to count the table."""
        return self._run(bind(parse(query), params))

    def prepare(self, query: str) -> Statement:
        return Statement(self, query)

    def ping(self) -> None:
        """Raises if the database cannot be listed."""
        self.database.refresh()
        self.database.names()

    def refresh(self) -> None:
        self.database.refresh()

    def execute(self, query: str, *params) -> None:
        raise ReadOnlyError("the database is read-only")

    def begin(self) -> None:
        raise ReadOnlyError("transactions are not supported")

    def _run(self, statement) -> DataFrame:
        match statement:
            case ast.ListTables():
                return list_tables(self.spark, self.database.names())
            case ast.Connect(path):
                self.connect(path)
                return list_tables(self.spark, self.database.names())
            case ast.Disconnect():
                self.disconnect()
                return list_tables(self.spark, [])
            case ast.DescribeTable(table):
                return describe_table(self.spark, self.database.table(table).schema)
        found = plan(statement, self.database.table(statement.table))
        return compatible_floats(found) if self.compat_floats else found


class Statement:
    """A parsed query that runs any number of times."""

    def __init__(self, engine: Engine, query: str):
        self.engine, self.tree = engine, parse(query)

    @property
    def num_params(self) -> int:
        return self.tree.num_params

    def query(self, *params) -> DataFrame:
        return self.engine._run(bind(self.tree, params))

    def rows(self, *params) -> Cursor:
        return Cursor(self.query(*params))


class Cursor:
    """Rows one at a time, without holding the whole result. cancel() stops the jobs behind it."""

    def __init__(self, df: DataFrame):
        self.df, self.group = df, f"deskquery-{uuid.uuid4()}"
        self._rows: Iterator | None = None

    @property
    def columns(self) -> list[dict]:
        return describe_result(self.df.schema)

    def __iter__(self):
        return self

    def __next__(self) -> tuple:
        if self._rows is None:
            self._rows = self._started()
        return tuple(next(self._rows))

    def _started(self) -> Iterator:
        """The rows, whose jobs belong to the cursor's group. The thread's own group is put back, so that its later jobs are not this cursor's."""
        sc = self.df.sparkSession.sparkContext
        own = {k: sc.getLocalProperty(k) for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
        sc.setJobGroup(self.group, "deskquery cursor", interruptOnCancel=True)
        try:
            return self.df.toLocalIterator(prefetchPartitions=True)
        finally:
            for k, v in own.items():
                sc.setLocalProperty(k, v)

    def cancel(self) -> None:
        self.df.sparkSession.sparkContext.cancelJobGroup(self.group)

    def close(self) -> None:
        self.cancel()
        self._rows = iter(())
