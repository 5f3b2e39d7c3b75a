"""SentencePiece encoding and decoding over a relational lattice.

A text becomes pieces of a SentencePiece model so that the sum of the pieces'
scores is largest (Viterbi). The model file at hand holds merge ranks, not
probabilities, so a piece of rank r scores the logarithm of a normalised Zipf
law, 1 / (r + 2). Characters without a piece fall back to their bytes.

No piece runs over the start of a word (a run of spaces, a line feed, or a run
of marks whose first no piece holds behind a letter or digit), so a text's best
segmentation is that of its words, and words are segmented once, by the
lattice: their substrings of bounded length are exploded, joined with the piece
table on equality (of a hash, then of the text), grouped into edges by word and
folded by a higher-order aggregate that carries the best score and last edge of
every prefix; a second one walks from the last edge back.

How words travel. A task reads its texts once, in batches of bounded size, and
leaves each document as places in its batch's list of words. That list's words
are grouped over all batches, segmented, and go back to their batches, where
the documents' ids and the texts made from them are put together. Documents
are not shuffled: they lie in a table bucketed by batch. Frequent words, those
seen most in a bounded sample of the documents, take the lattice first and are
broadcast, ``VOCABULARY`` of them at most, so that they need not travel once a
batch; which words these are changes no result. All words take the lattice but
those over ``LONGEST`` characters, whose rows of edges would outgrow a task:
they are segmented by the same recursion (``Pieces.segment``).

Cases: null and empty texts have no pieces and decode to the empty text; other
texts decode to themselves, but for U+2581, which the model uses for the space
and which decodes to one; repeated rows give repeated rows; an empty table
gives an empty result; texts of any length work, in memory proportional to one
batch; the text is replaced by ``decoded``, other columns pass through, and
those with the results' names are replaced.
"""

from __future__ import annotations

import ctypes
import math
import re
import string
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, quoted, shared_folder, slices

SPACE = "▁"
VOCABULARY = 1 << 18
SAMPLE = 20_000  # documents that frequent words are looked for in, about
COMMON = 64  # characters of a frequent word at most
LONGEST = 4096
BATCH = 16 << 20  # bytes of text of a batch, at most about
_ADDED = ("ids", "n_pieces", "ids_crc32", "decoded")
_EDGE_KEYS = 50_000  # words of a task whose edges stay in memory


class Pieces:
    """The piece table of a model file, with U+2581 written as the space that it stands for."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        byte_ids = [i for i in ids if model.is_byte(i)]
        self.of_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in byte_ids}
        normal = [i for i in ids if not (model.is_byte(i) or model.is_unknown(i) or model.is_control(i) or model.is_unused(i))]
        total = math.log(sum(1 / (r + 2) for r in range(len(normal))))
        self.ids = {model.id_to_piece(i).replace(SPACE, " "): i for i in normal}
        self.score = {p: -math.log(r + 2) - total for r, p in enumerate(self.ids)}
        self.fallback = min(self.score.values()) - 10
        self.longest = max(map(len, self.ids))
        if any(" " in p.lstrip(" ") or "\n" in p for p in self.ids):
            raise ValueError("a piece of this model runs over the start of a word")
        # Marks are the pieces' characters other than letters, digits and spaces. A word ends before a run of them whose first no piece holds behind another character.
        marks = "".join(sorted({c for p in self.ids for c in p if not c.isalnum() and c != " "} | set(string.punctuation)))
        held = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if b in marks and a not in marks and a != " "}
        mark, plain = f"[{re.escape(marks)}]", rf"[^ \n{re.escape(marks)}]"
        more = f"(?:[{re.escape(''.join(sorted(held)))}]{mark}*{plain}*)*" if held else ""
        # Most words are spaces and Latin letters up to a space, a line feed, or a mark that no piece holds behind such a letter: these are found first, at less cost.
        latin = "0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
        behind = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if re.match(f"[{latin}]", a)}
        ends = re.escape("".join(c for c in string.punctuation if c not in behind))
        #: Words of a text with a space before it.
        self.words = rf" *[{latin}]++(?![^ \n{ends}])| *(?:{plain}+|{mark}+{plain}*){more}| +|\n"
        self.entries = {p: (self.score[p], (i,)) for p, i in self.ids.items()}
        #: The bytes of each id: where they start in raw, and how many.
        known = {i: p.encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in self.of_byte.items()}
        parts = [known.get(i, b"") for i in ids]
        self.raw, self.raw_len = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts], np.int64)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len

    def segment(self, word: str) -> list[int]:
        """The best pieces of a word; of equal scores the one whose last piece is longest."""
        score, back, get, longest = [0.0], [(0, ())], self.entries.get, self.longest
        for end in range(1, len(word) + 1):
            top = None
            for start in range(end - longest if end > longest else 0, end):
                entry = get(word[start:end])
                if entry is None:
                    if start < end - 1:
                        continue
                    entry = (self.fallback, tuple(self.of_byte[b] for b in word[start].encode()))
                if top is None or score[start] + entry[0] > top:
                    top, last = score[start] + entry[0], (start, entry[1])
            score.append(top)
            back.append(last)
        parts, at = [], len(word)
        while at:
            at, ids = back[at]
            parts.append(ids)
        return [i for ids in reversed(parts) for i in ids]

    def split(self, text: str | None) -> list[str]:
        return _splitter(self.words)(f" {text.replace(SPACE, ' ')}") if text else []


@cache
def _splitter(pattern: str):
    return re.compile(pattern).findall


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


@contextmanager
def _settings(spark: SparkSession, **given: int):
    """While it lasts: keys (words that a task groups by hash before it sorts; their edges fit into memory, Spark's own setting is made for larger groups), rows (of an Arrow batch)."""
    names = {"keys": "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "rows": "spark.sql.execution.arrow.maxRecordsPerBatch"}
    was = {names[k]: spark.conf.get(names[k]) for k in given}
    try:
        for k, v in given.items():
            spark.conf.set(names[k], str(v))
        yield
    finally:
        for name, value in was.items():
            spark.conf.set(name, value)


def frequent_words(docs: DataFrame, model: str, most: int) -> DataFrame:
    """word and n: the words seen most, and more than once, in a sample of the documents; most at most. Any list does: it only decides how words travel."""
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    rows = docs.select(F.col("text").cast("string").alias("text")).sample(share, 7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, seen = pieces(model), Counter()
        for b in slices(batches, 0):
            for text in b.column(0).to_pylist():
                seen.update(here.split(text))
        kept = [(w, k) for w, k in seen.items() if len(w) <= COMMON]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([k for _, k in kept], pa.int64())], ["word", "n"])

    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1")
    with _settings(docs.sparkSession, rows=500):
        return cut(counts.orderBy(F.desc("n"), "word").limit(most))


def segmented(words: DataFrame, table: Pieces) -> DataFrame:
    """words (one row per word; all columns stay) with ids, the best pieces of the column word, by the lattice."""
    spark = words.sparkSession
    rest = [c for c in words.columns if c != "word"]
    rows = [(p, i, table.score[p]) for p, i in table.ids.items()]
    known = F.broadcast(spark.createDataFrame(rows, "known string, id int, score double").select(F.xxhash64("known").alias("hash"), "known", "id", "score"))  # the model's table
    starts = words.select("*", F.explode(F.sequence(F.lit(0), F.char_length("word") - 1)).alias("start"))
    spans = starts.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(table.longest), F.char_length("word") - F.col("start")))).alias("len"))
    spans = spans.withColumn("piece", F.expr("substring(word, start + 1, len)")).withColumn("hash", F.xxhash64("piece"))
    joined = spans.join(known, "hash", "left")
    same = F.col("piece") == F.col("known")
    edges = joined.filter(same | (F.col("len") == 1))
    # Made before they are grouped, in compiled code. The other columns come with one edge of a word, which each word has.
    edge = F.struct(_edge(F.col("start") + F.col("len"), F.col("start"), F.when(same, F.col("id"))).alias("key"), F.when(same, F.col("score")).otherwise(table.fallback).alias("score")).alias("edge")
    one = (F.col("start") == 0) & (F.col("len") == 1)
    edges = edges.select("word", edge, *[F.when(one, F.col(c)).alias(c) for c in rest])
    grouped = edges.groupBy("word").agg(F.sort_array(F.collect_list("edge")).alias("edges"), *[F.first(c, ignorenulls=True).alias(c) for c in rest])
    best = grouped.select("word", *rest, _best(F.col("edges")).alias("back")).select("word", *rest, _walked(F.col("back")).alias("ids"))
    byte_ids = F.array(*[F.lit(table.of_byte[b]) for b in range(256)])

    def as_bytes(place: Column) -> Column:
        raw = F.hex(F.encode(F.substring(F.col("word"), -place, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(0), F.octet_length(F.substring(F.col("word"), -place, F.lit(1))) - 1), lambda i: F.element_at(byte_ids, F.conv(F.substring(raw, (i * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + 1))

    spelled = F.flatten(F.transform("ids", lambda i: F.when(i >= 0, F.array(i)).otherwise(as_bytes(i))))
    return best.withColumn("ids", F.when(F.exists("ids", lambda i: i < 0), spelled).otherwise(F.col("ids")))


_BITS = (20, 23)  # of an edge's start and of its id, plus 1; its end is above them


def _edge(end: Column, start: Column, known: Column) -> Column:
    """An edge as one number, in order of end, then start. known: the piece's id, or null for an unknown character."""
    return F.shiftleft(end.cast("long"), sum(_BITS)) + F.shiftleft(start.cast("long"), _BITS[1]) + F.coalesce(known + 1, F.lit(0))


def _end(edge: Column) -> Column:
    return F.shiftright(edge, sum(_BITS)).cast("int")


def _start(edge: Column) -> Column:
    return F.shiftright(edge, _BITS[1]).bitwiseAND(F.lit((1 << _BITS[0]) - 1)).cast("int")


def _id(edge: Column) -> Column:
    """An unknown character has its place below zero instead of an id."""
    known = edge.bitwiseAND(F.lit((1 << _BITS[1]) - 1)).cast("int")
    return F.when(known > 0, known - 1).otherwise(-1 - _start(edge))


def _best(edges: Column) -> Column:
    """Viterbi: the last edge of the best way to each end. best and back hold the finished prefixes, score and edge the best so far of the prefix at hand. Edges come by end, then start.

    Spark copies what a fold carries at every step, so that is numbers, and grows by array_append, which costs far less than concat."""
    state = "struct<best:array<double>,back:array<long>,score:double,edge:long>"
    first = F.struct(F.array().alias("best"), F.array().alias("back"), F.lit(0.0).alias("score"), F.lit(0).alias("edge")).cast(state)

    def take(a: Column, e: Column) -> Column:
        score = F.coalesce(F.get(a["best"], _start(e["key"])), a["score"]) + e["score"]  # the prefix just finished is still in score
        further = F.struct(F.array_append(a["best"], a["score"]).alias("best"), F.array_append(a["back"], a["edge"]).alias("back"), score.alias("score"), e["key"].alias("edge"))
        better = F.struct(a["best"].alias("best"), a["back"].alias("back"), score.alias("score"), e["key"].alias("edge"))
        return F.when(_end(e["key"]) > _end(a["edge"]), further).when(score > a["score"], better).otherwise(a)

    return F.aggregate(edges, first, take, lambda a: F.array_append(a["back"], a["edge"]))


def _walked(back: Column) -> Column:
    """The ids of the best way to the last end, from its last edge on."""
    first = F.struct((F.size(back) - 1).alias("at"), F.array().cast("array<int>").alias("ids"))

    def take(a: Column, e: Column) -> Column:
        return F.when((_end(e) == a["at"]) & (a["at"] > 0), F.struct(_start(e).alias("at"), F.array_append(a["ids"], _id(e)).alias("ids"))).otherwise(a)

    return F.aggregate(F.reverse(back), first, take, lambda a: F.reverse(a["ids"]))


class _Places(dict):
    """Word: its place. A new word gets the next one."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


def _packed(places: np.ndarray) -> bytes:
    """Numbers in three bytes, or four where that is too few (the first byte says), all lowest ones first, then all second ones, and so on, which compresses well."""
    width = 3 if not len(places) or places.max() < 1 << 24 else 4
    return bytes([width]) + np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    whole = np.zeros(((len(raw) - 1) // raw[0], 4), np.uint8)
    whole[:, : raw[0]] = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1).T
    return whole.view("<u4").ravel()


def _gathered(flat: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of flat that start at at and have n entries, one after another."""
    ends = np.cumsum(n)
    size = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(size, len(flat)) < 2**31 else np.int64  # these arrays are what a task's memory goes to
    places = np.repeat((at - ends + n).astype(kind), n)
    places += np.arange(size, dtype=kind)
    return flat[places]


class _Table:
    """Ids and bytes of words by place."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, table: Pieces):
        self.ids, self.n, self.at = ids, n, np.cumsum(n) - n
        lengths = table.raw_len[ids]
        self.raw = _gathered(table.raw, table.raw_at[ids], lengths)
        sums = np.concatenate([[0], np.cumsum(lengths)])
        self.raw_n = sums[self.at + n] - sums[self.at]
        self.raw_at = sums[self.at]


def _give_back() -> None:
    """Unused memory of this worker, which stays and would keep it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def _numbered(boxes: DataFrame, model: str, known) -> DataFrame:
    """Rows of documents (batch, row, places: the places of their words in the batch's list, packed) and of each batch's words beyond the frequent ones (batch, place, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, first = pieces(model), {w: k for k, w in enumerate(known.value)}
        words, batch, size, row = _Places(first), TaskContext.get().partitionId() << 32, 0, None

        def rows(n: int, **given) -> pa.RecordBatch:
            every = {"batch": pa.array(np.full(n, batch)), "row": pa.nulls(n, row), "places": pa.nulls(n, pa.binary()), "place": pa.nulls(n, pa.int32()), "word": pa.nulls(n, pa.string())} | given
            return pa.RecordBatch.from_arrays(list(every.values()), list(every))

        def ended() -> Iterator[pa.RecordBatch]:
            new = list(words)[len(first) :]
            for i in range(0, len(new), 50_000):
                part = new[i : i + 50_000]
                yield rows(len(part), place=pa.array(np.arange(i, i + len(part), dtype=np.int32)), word=pa.array(part, pa.string()))

        for b in slices(batches, 1):
            row, place = b.column(0).type, words.__getitem__
            split = [here.split(t) for t in b.column(1).to_pylist()]
            yield rows(len(b), row=b.column(0), places=pa.array([_packed(np.fromiter(map(place, ws), np.uint32, len(ws))) for ws in split], pa.binary()))
            size += b.column(1).nbytes
            if size > BATCH:
                yield from ended()
                words, batch, size = _Places(first), batch + 1, 0
        yield from ended()
        words.clear()
        _give_back()

    schema = T.StructType([T.StructField("batch", T.LongType()), boxes.schema["row"], T.StructField("places", T.BinaryType()), T.StructField("place", T.IntegerType()), T.StructField("word", T.StringType())])
    schema["row"].nullable = True
    return boxes.mapInArrow(run, schema)


def _bucketed(df: DataFrame, n: int, key: str) -> DataFrame:
    """The rows written to the shared folder in n buckets of key, so that grouping by it moves nothing. Each task writes the buckets of its own few keys."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(n, key).option("path", shared_folder(spark)).option("compression", "zstd").saveAsTable(name)
    found = spark.table(name)
    found.schema  # noqa: B018  read before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return found


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of all lists, and their lengths."""
    whole = lists.combine_chunks()
    whole = whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
    return whole.flatten().to_numpy(zero_copy_only=False), whole.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (batch, place, ids) in order of batch, as one row for each run of a batch: places, numbers of ids, and ids. Far less room than row by row."""
    for b in batches:
        if not len(b):
            continue
        key = b.column(0).to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        ids, counts = _flat(pa.chunked_array([b.column(2)]))
        ends = np.concatenate([[0], np.cumsum(counts)])
        lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x, pa.int32())) for at, x in ((bounds, b.column(1).to_numpy()), (bounds, counts), (ends[bounds], ids))]
        yield pa.RecordBatch.from_arrays([pa.array(key[bounds[:-1]]), *lists], ["batch", "places", "counts", "ids"])


def _by_recursion(words: DataFrame, model: str) -> DataFrame:
    """Words with their places, of any length: ids by Pieces.segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 0):
            ids = pa.array([pieces(model).segment(w) for w in b.column(0).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), ids], ["batch", "place", "ids"])

    return words.select("word", "batch", "place").mapInArrow(run, "batch long, place int, ids array<int>")


def encode(docs: DataFrame, model: str, vocabulary: int = VOCABULARY, longest: int = LONGEST) -> DataFrame:
    """docs with ids (array<int>), n_pieces, ids_crc32 (unsigned, of the ids as little-endian 32-bit integers), and decoded (the text made from the ids) instead of text."""
    spark = docs.sparkSession
    table, n = pieces(model), int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = None
    if vocabulary:
        few = frequent_words(docs, model, vocabulary).repartition(4 * n, "word")
        with _settings(spark, keys=_EDGE_KEYS):
            known = segmented(few, table).toArrow().sort_by([("n", "descending")])  # VOCABULARY words of COMMON characters at most
    first = spark.sparkContext.broadcast(known["word"].to_pylist() if known else [])
    known = spark.sparkContext.broadcast(_flat(known["ids"]) if known else (np.empty(0, np.int32), np.empty(0, np.int64)))

    kept = [c for c in docs.columns if c.lower() not in ("text", *_ADDED)]
    some = next(x for x in ("_" * k for k in range(1, len(kept) + 2)) if x not in kept)  # a struct has one field at least
    row = F.struct(F.col("text").isNull().alias(some), *[F.col(quoted(c)) for c in kept]).alias("row")
    with _settings(spark, rows=500):
        listed = _bucketed(_numbered(docs.select(row, F.col("text").cast("string").alias("text")), model, first), n, "batch")

    words, short = listed.filter("word IS NOT NULL").select("word", "batch", "place"), F.char_length("word") <= min(longest, (1 << _BITS[0]) - 1)
    grouped = words.filter(short).repartition(8 * n, "word").select("word", F.struct("batch", "place").alias("at")).groupBy("word").agg(F.collect_list("at").alias("ats"))  # small parts: their edges are many times as large
    found = segmented(grouped, table).select(F.explode("ats").alias("at"), "ids").select("at.batch", "at.place", "ids")
    if not words.filter(~short).isEmpty():
        found = found.union(_by_recursion(words.filter(~short).repartition(n), model))
    with _settings(spark, keys=_EDGE_KEYS):
        sent = cut(found.sortWithinPartitions("batch", "place").mapInArrow(_by_batch, "batch long, places array<int>, counts array<int>, ids array<int>"), compression="zstd")

    def together(documents: pa.Table, new: pa.Table) -> pa.Table:
        _give_back()
        here, (ids, counts) = pieces(model), known.value
        (places, more, all_ids) = (_flat(new.column(c))[0] for c in ("places", "counts", "ids"))
        order, more = np.argsort(places), more.astype(np.int64)
        ids = np.concatenate([ids, _gathered(all_ids, (np.cumsum(more) - more)[order], more[order])])
        every = _Table(ids, np.concatenate([counts, more[order]]), here)
        done = pa.Table.from_batches([_documents(b, every, here) for b in slices(documents.select(["row", "places"]).to_batches(), 1, most=1 << 20)])
        _give_back()
        return done

    result = T.StructType([T.StructField("row", listed.schema["row"].dataType), *[T.StructField(c, t) for c, t in zip(_ADDED, (T.ArrayType(T.IntegerType()), T.LongType(), T.LongType(), T.StringType()), strict=True)]])
    documents = listed.filter("word IS NULL").select("batch", "row", "places")
    done = documents.groupBy("batch").cogroup(sent.groupBy("batch")).applyInArrow(together, result)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *_ADDED)


def _documents(b: pa.RecordBatch, words: _Table, table: Pieces) -> pa.RecordBatch:
    """row and the results of documents, from the places of their words."""
    places = [_unpacked(p) for p in b.column(1).to_pylist()]
    flat = np.concatenate(places) if places else np.empty(0, np.uint32)
    ends = np.cumsum([len(p) for p in places])
    sums = np.concatenate([[0], np.cumsum(words.n[flat])])
    bounds = np.concatenate([[0], sums[ends]]).astype(np.int64)
    ids = _gathered(words.ids, words.at[flat], words.n[flat]).astype("<i4")
    sizes = np.concatenate([[0], np.cumsum(words.raw_n[flat])])
    raw = _gathered(words.raw, words.raw_at[flat], words.raw_n[flat])
    at = np.concatenate([[0], sizes[ends]]).astype(np.int64)
    crcs = [zlib.crc32(ids[s:e]) for s, e in zip(bounds, bounds[1:], strict=False)]
    texts = [raw[s + 1 : e].tobytes().decode("utf-8", "replace") for s, e in zip(at, at[1:], strict=False)]  # without the space in front
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
    return pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(np.diff(bounds)), pa.array(crcs, pa.int64()), pa.array(texts, pa.string())], ["row", *_ADDED])
