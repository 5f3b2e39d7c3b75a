"""SimHash near-duplicates by pivot distance tables.

A fingerprint has a bit set where more than half of the shingle hashes have it.
Fingerprints link at ``MAX_DISTANCE`` or fewer differing bits, and linked
documents form components.

Search. The 64 bits are cut into six blocks; four differing bits leave two
blocks equal, so every link lies in one of the fifteen buckets that a
fingerprint enters, one per pair of blocks. (Distances of random fingerprints
to any pivot lie so close together that a pivot alone would leave more than
half of all pairs; the buckets bound what the pivot tables are asked.) Inside a
bucket a table holds the distances to the pivots. By the triangle inequality
two fingerprints whose distances to some pivot differ by more than
``MAX_DISTANCE`` cannot link: rows are sorted by the first pivot, only the
window in reach is looked at, pairs are discarded by the largest coordinate
difference, and survivors are verified bit by bit. Only a spanning forest of
each bucket leaves the task, never its pairs. Buckets over ``CHUNK`` rows are cut
into chunks, and every pair of chunks becomes a task of its own, so no link is
lost and no task grows with a bucket.

Copies cost nothing here: the search sees distinct fingerprints. Components
come from min-label propagation with pointer jumping, each round a table in the
shared folder.

Frequent fingerprints, nodes with many links and the labels of large components
meet a broadcast table of bounded size, so that no task holds their rows.

Cases: null, empty and blank texts have the fingerprint zero and link to one
another; ids are whole numbers (others raise), null ids take part and never name
a component unless it has no other; repeated rows give repeated rows (and one of
them stays in ``first_of_each``); texts of any length work; an empty table gives
an empty result; ``near_duplicates`` carries no other columns, and
``first_of_each`` keeps all as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, cut, hot_keys, join_hot, remove, shared_folder, slices, unboxed

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
CHUNK = 2048
N_PIVOTS = 16
_PART = 1 << 15  # shingles or pairs handled at once


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint, as a signed integer."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, _PART):
        hashes = np.array([digest(join(words[i : i + SHINGLE]), SEED) for i in range(at, min(n, at + _PART))], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fp of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            fps = pa.array([fingerprint(t) for t in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def pivots() -> np.ndarray:
    """Fixed reference fingerprints, far apart from one another."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little"), SEED) for i in range(N_PIVOTS)], np.uint64)


def links(fps: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints fps (column fp) within MAX_DISTANCE."""
    entries = fps.select("fp", F.explode(F.array(*[_bucket(k, pair) for k, pair in enumerate(combinations(BLOCKS, 2))])).alias("bucket"))
    sizes = entries.groupBy("bucket").count()
    hot = sizes.filter(F.col("count") > chunk).select("bucket", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    dealt = entries.join(hot, "bucket", "left").withColumn("c", F.when(F.col("chunks").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), F.col("chunks"))).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))))
    dealt = dealt.select(F.xxhash64("bucket", F.least("c", "other"), F.greatest("c", "other")).alias("task"), "fp")
    found = dealt.repartition("task").sortWithinPartitions("task").mapInArrow(_search, "a long, b long")
    return found.distinct()


def _bucket(k: int, pair) -> F.Column:
    fp, key = F.col("fp"), F.lit(k).cast("long")
    for start, width in pair:
        key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
    return key


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task in, edges out. Only whole tasks are searched; the last of a batch waits for the next."""
    rest_task, rest_fp = np.empty(0, np.int64), np.empty(0, np.int64)
    reference = pivots()

    def edges(task, fp) -> Iterator[pa.RecordBatch]:
        if len(fp) > 1:
            a, b = _forest(task, fp.view(np.uint64), reference)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        task, fp = (np.concatenate([r, c.to_numpy(zero_copy_only=False)]) for r, c in ((rest_task, batch.column(0)), (rest_fp, batch.column(1))))
        whole = int(np.searchsorted(task == task[-1], True)) if len(task) else 0
        yield from edges(task[:whole], fp[:whole])
        rest_task, rest_fp = task[whole:].copy(), fp[whole:].copy()
    yield from edges(rest_task, rest_fp)


def _forest(task: np.ndarray, fp: np.ndarray, reference: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links within each task."""
    first = np.bitwise_count(fp ^ reference[0])
    order = np.lexsort((first, task))
    task, fp, first = task[order], fp[order], first[order].astype(np.int16)
    alone = np.ones(len(task), bool)
    same = task[1:] == task[:-1]
    alone[1:] &= ~same
    alone[:-1] &= ~same
    task, fp, first = task[~alone], fp[~alone], first[~alone]
    if not len(fp):
        return fp, fp
    table = np.bitwise_count(fp[:, None] ^ reference[None, :]).astype(np.int16)
    # The window of a row: the rows after it in its task whose first coordinate is in reach.
    _, group = np.unique(task, return_inverse=True)
    place = group.astype(np.int64) * 1024 + first
    end = np.searchsorted(place, place + MAX_DISTANCE, "right")
    reach = end - np.arange(len(fp)) - 1
    root = np.arange(len(fp))
    starts = np.concatenate([[0], np.cumsum(reach)])
    at = 0
    while at < len(fp):
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + (1 << 20), "right")) - 1)
        n = reach[at:stop]
        i = np.repeat(np.arange(at, stop), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(starts[at:stop] - starts[at], n)
        for k in range(1, reference.size, 5):  # the largest coordinate difference, a few pivots at a time
            near = np.abs(table[i, k : k + 5] - table[j, k : k + 5]).max(1, initial=0) <= MAX_DISTANCE
            i, j = i[near], j[near]
        linked = (np.bitwise_count(fp[i] ^ fp[j]) <= MAX_DISTANCE) & (fp[i] != fp[j])
        _unite(root, i[linked], j[linked])
        at = stop
    top = _roots(root)
    member = np.flatnonzero(top != np.arange(len(top)))
    a, b = fp[top[member]], fp[member]
    return a, b


def _roots(root: np.ndarray) -> np.ndarray:
    while not np.array_equal(up := root[root], root):
        root[:] = up
    return root


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union by smallest index, all edges at once, until nothing changes."""
    while len(a):
        _roots(root)
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))


def components(edges: DataFrame) -> DataFrame:
    """node and label, the smallest node it is connected to, for every node of the edges (a, b)."""
    spark = edges.sparkSession
    folder = lambda: shared_folder(spark)
    both = cut(edges.select(F.col("a").alias("node"), F.col("b").alias("next")).union(edges.select("b", "a")), at_both := folder())
    hubs = hot_keys(both.groupBy("next").agg(F.count(F.lit(1)).alias("n")), ["next"], "n")  # many link to one, as in a star
    labels = cut(both.groupBy("node").agg(F.min("next").alias("m")).select("node", F.least("node", "m").alias("label")), old := folder())
    while True:
        seen = join_hot(both, labels.select(F.col("node").alias("next"), "label"), ["next"], hubs).groupBy("node").agg(F.min("label").alias("seen"))
        hooked = cut(labels.join(seen, "node").select("node", F.least("label", "seen").alias("label"), F.col("label").alias("old")), at_hooked := folder())
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        large = hot_keys(hooked.groupBy("label").agg(F.count(F.lit(1)).alias("n")), ["label"], "n")  # a large component shares its label
        jumped = cut(join_hot(hooked, up, ["label"], large).select("node", F.least("label", "up").alias("label"), (F.least("label", "up") != F.col("old")).alias("moved")), new := folder())
        labels = jumped.select("node", "label")
        for path in (old, at_hooked):
            remove(spark, path)
        old = new
        if jumped.filter("moved").isEmpty():
            remove(spark, at_both)
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, text_hash, fp, component_id (the smallest doc_id reachable) and root (the component's smallest fingerprint)."""
    prints = cut(fingerprints(docs))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")))
    found = components(links(distinct.select("fp"))).withColumnsRenamed({"node": "fp", "label": "root"})
    named = found.join(distinct.drop("copies"), "fp").groupBy("root").agg(F.min("first_id").alias("component_id"))
    large = hot_keys(found.groupBy("root").agg(F.count(F.lit(1)).alias("n")), ["root"], "n")
    grouped = join_hot(found, named, ["root"], large).select("fp", "root", "component_id")
    classes = cut(distinct.join(grouped, "fp", "left").select("fp", "copies", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")))
    return join_hot(prints, classes.drop("copies"), ["fp"], hot_keys(classes, ["fp"], "copies")).select("doc_id", "text_hash", "fp", "component_id", "root")


def first_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that of the smallest id (of equal ids the smallest text hash, of equal rows any)."""
    found = near_duplicates(docs)
    kept = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k")).select("k.doc_id", "k.text_hash")
    ids = boxed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("d")
    k = kept.distinct().alias("k")
    rows = ids.join(k, (F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))) & (F.col("d.text_hash") == F.col("k.text_hash")), "left_semi")
    return unboxed(rows.dropDuplicates(["doc_id", "text_hash"]))
