"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole of a
shorter item. Its shingles are its runs of five words (of all its words, if it
has fewer). A document that holds the window holds all its shingles, so it is
enough to join documents with one necessary shingle of each window, the rarest
in the corpus. The place of that shingle fixes where the window would start;
starts outside the document are discarded, and a candidate counts only if every
shingle of the window stands at its own place, compared as text.

The corpus is read once: its shingles meet the hashes of all benchmark shingles,
and the few that match are kept with their places in the shared folder, from
which rarity, candidates and verification come, on the shingles' text. The
benchmark's hashes, eight bytes each, are broadcast up to ``MAX_BROADCAST`` of
them and joined by a shuffle beyond that, in which each document's header has a
key of its own and frequent shingles meet a broadcast table.

Cases: null, empty and wordless texts have no words and no hits; null ids of
documents and of items are ids like any other (a null item counts, and stands
in no list of names); documents that repeat as whole rows each get the same
result; texts of any length work, in memory proportional to one text; an empty
benchmark hits nothing; ``contamination`` carries no other columns, and
``clean`` leaves all as they are, so names cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hot_keys, join_hot, let

WINDOW = 8
SHINGLE = 5
#: Hashes of the broadcast table, of eight bytes: 16 MB at most, and twice that as a table of Spark's.
MAX_BROADCAST = 2_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def plain_words(text: Column) -> Column:
    """Words of digits, letters a to z (A to Z are lower-cased) and all characters beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAKS), "")


def _shingles(words: Column, size: int) -> Column:
    """(pos, key) of each run of size words."""
    run = lambda i: F.concat_ws(" ", *[words[i + k] for k in range(size)])
    every = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.struct(i.cast("int").alias("pos"), run(i).alias("key")))
    return F.when(F.size(words) >= size, every).otherwise(F.array().cast("array<struct<pos:int,key:string>>"))


def windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: win (its words with a space between), len, and items, the ids that have it."""

    def cut_out(words: Column) -> Column:
        last = F.greatest(F.size(words) - WINDOW, F.lit(0))
        every = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("win"), F.least(F.size(words), F.lit(WINDOW)).alias("len")))
        return F.when(F.size(words) > 0, every)

    rows = benchmark.select("item_id", F.inline(let(plain_words(F.col("text")), cut_out)))
    ids = F.collect_set(F.struct(F.col("item_id").cast("string").alias("id")))  # a struct, since sets drop nulls
    return rows.groupBy("win", "len").agg(F.transform(ids, lambda x: x["id"]).alias("items"))


def occurrences(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per row of docs one header (doc_id, text_hash, n_words), and every verified window: doc_id, text_hash, start, len, items."""
    wins = cut(windows(benchmark))
    sizes = [r[0] for r in wins.select(F.least("len", F.lit(SHINGLE)).alias("s")).distinct().collect()]  # five values at most
    inside = lambda s: let(F.split("win", " "), lambda w: _shingles(w, s))
    parts = [wins.filter(F.least("len", F.lit(SHINGLE)) == s).select("win", "len", F.inline(inside(s))) for s in sizes]
    needs = cut(reduce(DataFrame.union, parts)) if parts else None

    def entries(words: Column) -> Column:
        header = F.array(F.struct(F.size(words).alias("pos"), F.lit("").alias("key")))
        return F.concat(header, *[_shingles(words, s) for s in sizes])

    spread = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"), F.inline(let(plain_words(F.col("text")), entries)))
    met = spread
    if needs is not None:
        known = needs.select(F.xxhash64("key").alias("hash")).distinct()
        if needs.count() <= MAX_BROADCAST:  # headers meet the hash of their empty key
            known = F.broadcast(known.union(docs.sparkSession.range(1).select(F.xxhash64(F.lit("")))).distinct())
            met = spread.withColumn("hash", F.xxhash64("key")).join(known, "hash").drop("hash")
        else:  # headers are dealt by the hash of their text, and kept whether or not that is met
            hashed = spread.withColumn("hash", F.when(F.col("key") == "", F.col("text_hash")).otherwise(F.xxhash64("key")))
            met = hashed.join(known.withColumn("met", F.lit(True)), "hash", "left").filter("key = '' OR met").drop("hash", "met")
    met = cut(met)
    headers = met.filter("key = ''").select("doc_id", "text_hash", F.col("pos").cast("long").alias("n_words"))
    if needs is None:
        return headers, headers.select("doc_id", "text_hash", F.lit(0).alias("start"), F.lit(0).alias("len"), F.array().cast("array<string>").alias("items")).limit(0)
    found = met.filter("key <> ''").distinct()  # rows that repeat count once

    # The rarest shingle of each window; a window with a shingle that no document has cannot occur.
    counts = cut(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    ranked = needs.join(counts, "key", "left").groupBy("win", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "pos", "key")).alias("r"))
    prefix = ranked.filter("r.n > 0").select("win", "len", F.col("r.pos").alias("offset"), F.col("r.key").alias("key"))

    start = F.col("pos") - F.col("offset")
    lengths = headers.groupBy("doc_id", "text_hash").agg(F.max("n_words").alias("n"))
    candidates = join_hot(found, prefix, ["key"], hot_keys(counts, ["key"], "n")).select("doc_id", "text_hash", "win", "len", start.alias("start")).filter("start >= 0").alias("c")
    lengths = lengths.alias("l")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))
    candidates = candidates.join(lengths, same("c", "l")).filter(F.col("start") + F.col("len") <= F.col("n")).select("c.*")
    wanted = candidates.join(needs, ["win", "len"]).select("doc_id", "text_hash", "win", "len", "start", (F.col("start") + F.col("pos")).alias("pos"), "key").alias("w")
    there = found.alias("f")
    held = wanted.join(there, same("w", "f") & (F.col("w.pos") == F.col("f.pos")) & (F.col("w.key") == F.col("f.key")), "left_semi")
    whole = held.groupBy("doc_id", "text_hash", "win", "len", "start").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.col("len") - F.least("len", F.lit(SHINGLE)) + 1)
    return headers, whole.join(wins, ["win", "len"]).select("doc_id", "text_hash", "start", "len", "items")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, text_hash, n_words, n_hit (words inside any window), n_items and items (sorted as text, a null last)."""
    headers, hits = occurrences(docs, benchmark)
    places = F.sort_array(F.collect_set(F.struct("start", "len")))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    joined = lambda a, p: F.struct(F.greatest(a["end"], p["start"] + p["len"]).alias("end"), (a["n"] + F.greatest(F.lit(0), p["start"] + p["len"] - F.greatest(a["end"], p["start"]))).cast("long").alias("n"))
    per_doc = hits.groupBy("doc_id", "text_hash").agg(places.alias("places"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    per_doc = per_doc.select("doc_id", "text_hash", F.aggregate("places", none, joined)["n"].alias("n_hit"), "items").alias("p")
    h = headers.alias("h")
    both = h.join(per_doc, F.col("h.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("h.text_hash") == F.col("p.text_hash")), "left")
    items = F.coalesce("p.items", F.array().cast("array<string>"))
    return both.select("h.doc_id", "h.text_hash", "h.n_words", F.coalesce("p.n_hit", F.lit(0).cast("long")).alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"))


def clean(docs: DataFrame, benchmark: DataFrame, min_items: int = 1) -> DataFrame:
    """docs without those that hold verified windows of min_items or more items."""
    bad = contamination(docs, benchmark).filter(F.col("n_items") >= min_items).select("doc_id", "text_hash").distinct().alias("b")
    d = docs.alias("d")
    return d.join(bad, F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64("d.text") == F.col("b.text_hash")), "left_anti")
