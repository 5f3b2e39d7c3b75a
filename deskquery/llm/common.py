"""What the operators share: table access, the shared folder, batches, boxed rows and joins with hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word patterns, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"
#: A key is hot when more than one in so many rows has it, so at most so many keys are.
HOT = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors share, under spark.checkpoint.dir.

    Only where that setting is missing and all tasks run in this process (a test) is a temporary folder made."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        base = tempfile.mkdtemp(prefix="shared-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str | None = None, compression: str = "snappy") -> DataFrame:
    """The rows written as Parquet to the shared folder and read back: computed once, with no lineage, and safe when executors go."""
    path = path or shared_folder(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared folder that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def slices(batches: Iterator[pa.RecordBatch], at: int, rows: int = 1000, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows and bytes of column at (string or binary) at most; a longer text is a piece of its own."""
    for b in batches:
        column = b.column(at)
        start = size = 0
        for i, n in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
            if i > start and (i - start >= rows or size + n > most):
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if len(b) > start:
            yield b.slice(start)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col(quoted(c)) for c in df.columns]


def boxed(df: DataFrame, *more: Column) -> DataFrame:
    """One column ``row`` with all columns of df, so that no other name can clash with theirs, and more beside it."""
    return df.select(F.struct(*columns(df)).alias("row"), *more)


def unboxed(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def let(value: Column, body) -> Column:
    """body(value), with value computed once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The runs of characters other than white space. Null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def hot_keys(counts: DataFrame, key: list[str], n: str) -> DataFrame:
    """The keys of counts (key columns, n rows each) that more than one in HOT rows have: HOT rows at most. Broadcast."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return F.broadcast(counts.filter(F.col(n) * HOT > total).select(*key))


def join_hot(rows: DataFrame, table: DataFrame, key: list[str], hot: DataFrame) -> DataFrame:
    """rows with the one row that table has for their key. Rows of hot keys stay where they are and meet a broadcast table of HOT rows at most; only the others are shuffled."""
    few = F.broadcast(table.join(hot, key, "left_semi"))
    return rows.join(few, key).unionByName(rows.join(hot, key, "left_anti").join(table.join(hot, key, "left_anti"), key))
