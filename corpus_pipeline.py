"""Documents to token ids: rules, near-duplicates, decontamination, personal data, pieces.

Each stage works on all rows that the one before kept, written as Parquet in the
shared folder. All stages but the last return the columns of documents, whatever
their names, and as many extra ones as there are; texts of any length work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskquery.llm import decontamination, piece_lattice, pii, quality_rules, simhash
from deskquery.llm.common import boxed, cut, read, unboxed

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy. Null and empty texts fail it; repeated rows are judged alike; an empty table stays empty."""
    rows = quality_rules.ledger(boxed(docs, F.col("text")))
    return unboxed(rows.filter(quality_rules.passes("v1")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that of the smallest id. Texts without words are one component; of repeated rows one stays; an empty table stays empty."""
    return simhash.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any verified window of a benchmark item: null and empty texts among them, and all where the benchmark is empty."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"), min_items=1)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and n_chars as the new text has it (null for a null text). Repeated rows stay alike; an empty table stays empty."""
    done = pii.redacted(docs)
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces, with checks of both directions. Null and empty texts have no pieces; repeated rows give repeated rows; an empty table gives an empty result."""
    found = piece_lattice.encode(docs.select("doc_id", "text"), MODEL)
    return found.select("doc_id", "n_pieces", "ids", "ids_crc32", F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"))


STAGES = [
    ("quality rules", apply_quality_rules),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", redact_personal_data),
    ("SentencePiece encoding and decoding", encode_pieces),
]
#: Components, boosted trees and segmentations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
