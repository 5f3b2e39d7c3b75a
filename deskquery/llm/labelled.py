"""The labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a classifier is fitted on, at most about so many: beyond, a fraction of them by a hash of the id.
MOST_LABELLED = 200_000


def remainder(parts: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id, as text, modulo parts; of a null id 0 - 1, which is no remainder."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)), F.lit(-1))


def sample(labels: DataFrame, label: str, parts: int, held_out: int, most: int = MOST_LABELLED) -> DataFrame:
    """doc_id and label (0 or 1) of rows outside the held-out fold. One row per id, of label 1 where its labels differ; rows without id or label are left out."""
    rows = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(parts) != held_out))
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return rows.groupBy("doc_id").agg(F.max(label).alias("label"))
