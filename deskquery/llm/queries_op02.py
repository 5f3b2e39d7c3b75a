"""op2: quality scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .labelled import remainder, sample
from .quality_classifier import scored


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = sample(read(spark, sf_dir, "labels"), "quality", 3, 1)
    found = scored(read(spark, sf_dir, "documents").select("doc_id", "text"), labelled)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_quality_classifier": op2_quality_classifier}
ORACLE: dict[str, str] = {}  # a fitted model; tests check its held-out accuracy and a brute-force fit
