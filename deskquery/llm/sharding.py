"""Sharding by best-fit-decreasing bin packing.

Rows of equal text form an indivisible group. Groups, largest first, enter the
bin with the least room that still holds them, found in a balanced tree of
remaining capacities; what fits nowhere opens a new bin, or, when the number of
bins is given, enters the emptiest.

The packing looks at sizes only, so it runs on their histogram, exactly: n bytes
hold at most the square root of 2 n different sizes, and a run of equal sizes is
placed a bin at a time. Groups then find their bin by their rank among those of
equal size. Ranks, and the places of rows inside a shard, are counted in two
levels, by buckets of a hash and inside each, and frequent texts meet a
broadcast table, so that no task holds a size, a shard or a hot group.

Cases: a null text is empty, has the size 1 and groups with empty texts; null
ids come first; repeated rows share their group's shard and get places of their
own; an empty table gives an empty result; texts are read once and not
shuffled; a group larger than its even share has a shard to itself.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, hot_keys, join_hot, quoted

#: Hash buckets that ranks and places are counted by.
BUCKETS = 1024
_GROUP = ["text_hash", "text_crc32", "size"]


class _Tree:
    """A treap of (room, bin) with random priorities: balanced with high probability."""

    def __init__(self):
        self.top, self.random = None, random.Random(7)

    def add(self, key) -> None:
        low, high = self._split(self.top, key)
        self.top = self._join(self._join(low, [key, self.random.random(), None, None]), high)

    def remove(self, key) -> None:
        low, rest = self._split(self.top, key)
        _, high = self._split(rest, (key[0], key[1] + 1))
        self.top = self._join(low, high)

    def least_from(self, key):
        """The smallest entry not below key."""
        found, node = None, self.top
        while node:
            found, node = (node[0], node[2]) if node[0] >= key else (found, node[3])
        return found

    def largest(self):
        node = self.top
        while node and node[3]:
            node = node[3]
        return node and node[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return [low[0], low[1], low[2], self._join(low[3], high)]
        return [high[0], high[1], self._join(low, high[2]), high[3]]


def best_fit(sizes: list[tuple[int, int]], capacity: int | None = None, bins: int | None = None) -> dict[int, list[tuple[int, int]]]:
    """Packs counts of sizes (size, count), each size once. Per size: (end, bin), the ranks below end go to bin.

    capacity: bins of that capacity, as few as best fit needs; larger items get a bin each. bins: so many bins, as even as can be."""
    sizes = sorted(sizes, reverse=True)
    tree, opened, plan = _Tree(), 0, {}
    left = [[s, n] for s, n in sizes]
    alone: list[tuple[int, int]] = []
    if bins is not None:
        room, total = bins, sum(s * n for s, n in sizes)
        while room > 1 and left and left[0][0] * room > total:  # more than an even share
            alone.append((left[0][0], opened))
            total, room, opened = total - left[0][0], room - 1, opened + 1
            left[0][1] -= 1
            left = left if left[0][1] else left[1:]
        capacity = -(-total // room)
        for b in range(opened, bins):
            tree.add((capacity, b))
        opened = bins
    for s, b in alone:
        runs = plan.setdefault(s, [])
        runs.append(((runs[-1][0] if runs else 0) + 1, b))
    for s, n in left:
        runs = plan.setdefault(s, [])
        done = runs[-1][0] if runs else 0
        while n:
            fit = tree.least_from((s, -1))
            if fit is None and bins is None:
                fit, opened = (max(capacity, s), opened), opened + 1
            elif fit is None:
                fit = tree.largest()
                tree.remove(fit)
            else:
                tree.remove(fit)
            k = min(n, max(1, fit[0] // s))
            n, done = n - k, done + k
            runs.append((done, fit[1]))
            tree.add((fit[0] - k * s, fit[1]))
    return plan


def ranked(df: DataFrame, by: list[str], bucket: Column, order: list[Column]) -> DataFrame:
    """df with rank, gapless from 0 among rows of equal by. Buckets of a hash are counted first; rows are only numbered inside theirs."""
    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(*by, "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_row", F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(*order)) - 1)
    return numbered.join(offsets, [*by, "_bucket"]).withColumn("rank", (F.col("_before") + F.col("_row")).cast("long")).drop("_bucket", "_before", "_row")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes and 1), text_crc32 and text_hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))


def _placed(groups: DataFrame, plan: dict[int, list[tuple[int, int]]], counts: dict[int, int]) -> DataFrame:
    """groups with the shard of their weight and rank. All ranks of all weights lie on one line, on which a run of a plan is an interval."""
    weights = np.array(sorted(counts), np.int64)
    before = np.cumsum([0, *[counts[w] for w in weights.tolist()][:-1]]).astype(np.int64) if len(weights) else np.empty(0, np.int64)
    runs = [(int(at) + end, shard) for w, at in zip(weights.tolist(), before, strict=True) for end, shard in plan[w]]
    known = groups.sparkSession.sparkContext.broadcast((weights, before, np.array([e for e, _ in runs], np.int64), np.array([s for _, s in runs], np.int32)))  # as many as weights and shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, before, ends, shards = known.value
        for b in batches:
            weight, rank = (b.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
            at = before[np.searchsorted(weights, weight)] + rank
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(3)], pa.array(shards[np.searchsorted(ends, at, "right")], pa.int32())], [*_GROUP, "shard"])

    return groups.select(*_GROUP, "weight", "rank").mapInArrow(run, "text_hash long, text_crc32 long, size long, shard int")


def pack(docs: DataFrame, bins: int | None = None, capacity: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, text_hash, shard and slot, gapless from 0 inside each shard, by doc_id inside a bucket."""
    rows = cut(measured(docs))
    groups = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("copies")).withColumn("weight", F.col("size") * F.col("copies"))
    groups = cut(ranked(groups, ["weight"], F.pmod(F.xxhash64(*_GROUP), F.lit(BUCKETS)), [F.col(c) for c in _GROUP]))
    counts = {r["weight"]: r["n"] for r in groups.groupBy("weight").agg(F.count(F.lit(1)).alias("n")).collect()}  # k different weights add up to k * k / 2 bytes at least
    placed = _placed(groups, best_fit(list(counts.items()), capacity, bins), counts)
    sharded = cut(join_hot(rows, placed, _GROUP, hot_keys(groups, _GROUP, "copies")))
    # A row's own number deals rows that repeat, too.
    slots = ranked(sharded, ["shard"], F.pmod(F.xxhash64("doc_id", "text_hash", F.monotonically_increasing_id()), F.lit(BUCKETS)), [F.col("doc_id").asc_nulls_first(), F.col("text_hash")])
    return slots.withColumnRenamed("rank", "slot")


def write_shards(docs: DataFrame, path: str, bins: int | None = None, capacity: int | None = None) -> None:
    """docs as Parquet, one folder per shard. A column named shard is replaced."""
    places = pack(docs, bins, capacity).select("doc_id", "text_hash", "shard").distinct().alias("p")
    d = docs.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.xxhash64(F.coalesce(F.col("d.text").cast("string"), F.lit(""))) == F.col("p.text_hash"))
    d.join(places, same).select(*[F.col(f"d.{quoted(c)}") for c in docs.columns if c.lower() != "shard"], F.col("p.shard").alias("shard")).write.partitionBy("shard").parquet(path)
