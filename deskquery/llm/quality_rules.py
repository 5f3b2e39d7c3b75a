"""Quality rules: a ledger with one bit per failed rule.

Every rule is evaluated once per document. The ledger keeps the measurements
and the failure bits; a policy is a versioned bit mask over it, so policies
change and rules are ablated without reading a text again.

Cases: a null or empty text has no words and fails ``few_words``; any length
works, in memory proportional to one text; repeated rows give repeated rows; an
empty table gives an empty ledger; other columns pass through, whatever their
names, and those whose names the ledger uses are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, boxed, let, words_of

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


@dataclass(frozen=True)
class Rule:
    """A document fails where condition, SQL over the measurements, holds."""

    name: str
    condition: str


#: Bit i belongs to rule i. New rules are added at the end, so that stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "n_symbols > 0.4 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("word_length_low", "word_chars < 2 * n_words"),
    Rule("word_length_high", "word_chars > 15 * n_words"),
    Rule("upper_case", "2 * n_upper > n_letters"),
)
BASE = ("few_words", "repeated_words")
#: Policies by version: the rules whose failure rejects a document.
POLICIES = {"base": BASE, "v1": tuple(r.name for r in RULES)}


def mask(rules: tuple[str, ...]) -> int:
    return sum(1 << i for i, r in enumerate(RULES) if r.name in rules)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements and ``failed``, the bits of the rules that the document fails (long)."""
    rows = boxed(docs, _measure(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("m"))
    kept = [c for c in docs.columns if c.lower() not in (*MEASURES, "failed")]
    measured = rows.select("row", *[F.col("m").getField(m).cast("long").alias(m) for m in MEASURES])
    bits = [F.when(F.expr(r.condition), 1 << i).otherwise(0).cast("long") for i, r in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed).select(*[F.col("row").getField(c).alias(c) for c in kept], *MEASURES, "failed")


def passes(policy: str = "v1") -> Column:
    """True where a ledger row passes the policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that fail it alone, whom the policy without it would keep."""
    whole = mask(POLICIES[policy])
    cells = []
    for i, r in enumerate(RULES):
        if 1 << i & whole:
            hit = F.col("failed").bitwiseAND(F.lit(whole).cast("long"))
            cells += [F.sum((hit.bitwiseAND(F.lit(1 << i).cast("long")) != 0).cast("long")).alias(f"n_{r.name}"), F.sum((hit == (1 << i)).cast("long")).alias(f"only_{r.name}")]
    totals = rows.agg(*cells)
    names = [r.name for i, r in enumerate(RULES) if 1 << i & whole]
    return totals.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(f"n_{n}", F.lit(0)).alias("n_failed"), F.coalesce(f"only_{n}", F.lit(0)).alias("n_only")) for n in names])).alias("r")).select("r.*")


def _measure(text: Column) -> Column:
    def measured(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"),
            F.char_length(F.array_join(words, "")).alias("word_chars"),
            F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
            lines["n"].alias("n_lines"),
            lines["dup"].alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.char_length(F.regexp_replace(text, r"\P{L}+", "")).alias("n_letters"),
            F.char_length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("n_upper"),
        )

    with_words = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    lines = let(with_words, lambda found: F.struct(F.size(found).alias("n"), (F.size(found) - F.size(F.array_distinct(found))).alias("dup")))
    return let(words_of(text), measured)


def _repeat_words(words: Column) -> Column:
    """Words inside any three-word window that the text has twice or more.

    Windows are compared by 64-bit hashes. Most texts repeat none, which one
    hash set shows; otherwise (hash, place) pairs are sorted, equal neighbours
    give the places of repeated windows, and the union of those is counted."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2]))

    def counted(found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(let(pairs, repeated))

    def repeated(z: Column) -> Column:
        n = F.size(z)
        kept = F.filter(z, lambda e, k: ((k > 0) & (F.get(z, k - 1)["x"] == e["x"])) | ((k < n - 1) & (F.get(z, k + 1)["x"] == e["x"])))
        return let(F.sort_array(F.transform(kept, lambda e: e["i"])), covered)

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, k: F.when(k == 0, 3).otherwise(F.least(F.lit(3), p - F.get(places, k - 1))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    return let(hashes, lambda h: F.when(F.size(h) < 3, 0).otherwise(let(windows(h), counted)))
