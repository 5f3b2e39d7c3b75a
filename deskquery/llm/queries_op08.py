"""op8: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read
from .pii import KINDS, candidates, chosen, fit, listed


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut(read(spark, sf_dir, "documents").select("doc_id", candidates(F.col("text")).alias("spans")))
    rows = found.select("doc_id", chosen(F.col("spans"), fit(found)).alias("s")).withColumn("b", F.filter("s", lambda x: x["base"]))
    counts = [_count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(listed(F.col("b")), 256).alias("base_sha256"), listed(F.col("s")).alias("spans"))


def _count(kind: int):
    return F.size(F.filter("b", lambda x: x["kind"] == kind)).cast("long")


QUERIES = {"op8_pii": op8_pii}
ORACLE: dict[str, str] = {}  # boosted trees are beyond SQL; tests compare the base spans with brute force
