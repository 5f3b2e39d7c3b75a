"""op5: toxicity scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .labelled import remainder, sample
from .toxicity import fit, scored


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, sample(read(spark, sf_dir, "labels"), "toxic", 4, 2))
    return scored(docs, model).select("doc_id", (remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLE: dict[str, str] = {}  # a fitted model; tests check its held-out accuracy and the segments by brute force
