"""op4: all documents in sixteen shards of nearly equal size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .sharding import pack

SHARDS = 16


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack(read(spark, sf_dir, "documents").select("doc_id", "text"), bins=SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_sharding": op4_sharding}
ORACLE: dict[str, str] = {}  # sequential packing; tests compare with brute force
