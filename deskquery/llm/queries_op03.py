"""op3: all documents as pieces and back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .piece_lattice import encode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model: str = MODEL) -> DataFrame:
    found = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return found.select("doc_id", "n_pieces", "ids_crc32", F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"))


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
ORACLE: dict[str, str] = {}  # a segmentation by dynamic programming; tests compare with brute force and the round trip
