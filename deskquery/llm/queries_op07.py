"""op7: near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .simhash import near_duplicates


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op7_simhash": op7_simhash}
ORACLE: dict[str, str] = {}  # components and XXH64 are beyond SQL; tests compare with brute force
