"""op10: the rule ledger of all documents, under the current policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .quality_rules import BASE, ledger, mask, passes

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(read(spark, sf_dir, "documents").select("doc_id", "text"))
    failed_base = F.col("failed").bitwiseAND(F.lit(mask(BASE)).cast("long")) != 0
    return rows.select("doc_id", *COLUMNS, failed_base.alias("base_failed"), passes("v1").alias("kept"), "failed")


QUERIES = {"op10_quality_rules": op10_quality_rules}

LEDGER_SQL = r"""
t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, [w[i], w[i + 1], w[i + 2]] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
  length(regexp_replace(text, '\PL+', '', 'g')) AS n_letters, length(regexp_replace(text, '\P{Lu}+', '', 'g')) AS n_upper FROM t),
s AS (SELECT m.*, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words FROM m LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
  + CASE WHEN n_symbols > 0.4 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
  + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END
  + CASE WHEN 2 * n_upper > n_letters THEN 64 ELSE 0 END AS BIGINT) AS failed FROM s)"""

ORACLE = {
    "op10_quality_rules": f"WITH {LEDGER_SQL} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f",
}
