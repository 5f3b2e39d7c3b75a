"""op1: benchmark windows inside all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .decontamination import contamination


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), (F.col("n_items") >= 2).alias("contaminated"))


QUERIES = {"op1_decontamination": op1_decontamination}
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Every run of as many words as a window has is compared with the windows. {docs} names the documents.
HITS_SQL = f"""
dw AS (SELECT doc_id, {_WORDS} AS w FROM {{docs}}),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, w[i:i + 7] AS x, len(w[i:i + 7]) AS n FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
size AS (SELECT DISTINCT n FROM win),
run AS (SELECT doc_id, i, n, w[i:i + n - 1] AS x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, size WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, run.n, item_id FROM run JOIN win ON run.x = win.x),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY doc_id),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id)"""

ORACLE = {
    "op1_decontamination": "WITH "
    + HITS_SQL.format(docs="documents")
    + " SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated"
    " FROM dw LEFT JOIN items USING (doc_id) LEFT JOIN cover USING (doc_id)",
}
