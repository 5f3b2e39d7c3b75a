"""op6: all documents as token files, read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import read
from .token_files import read_back, write

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op6_token_files(spark: SparkSession, sf_dir: str, tokenizer: str = TOKENIZER) -> DataFrame:
    return read_back(write(read(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer))


QUERIES = {"op6_token_files": op6_token_files}
ORACLE: dict[str, str] = {}  # needs the tokenizer; tests compare with it and check the round trip
