"""Token ids in bit-packed files.

Each id takes the least bits that hold the vocabulary. A file holds documents
in ascending order of their ids:

    magic | blocks | index

A block is BLOCK ids (the last may be shorter) packed lowest bit first, and
starts at a byte. The index is a header (bits, counts), the byte offset of
every block, and per document its id, whether that is null, and where its ids
start; the last eight bytes say where the index starts. Any document is read by
unpacking the blocks it lies in, with numpy and without the rest.

Writing: documents are encoded where they lie and their packed ids, not their
texts, are dealt to ranges of doc_id, whose bounds are quantiles of that column
alone; their number follows the bytes of all texts. An id that fills several
quantiles gets as many ranges, and so do null ids, among which their rows are
spread, so no task holds a frequent id. Every task writes its range to a file under a name of its own, so a task
that runs again leaves the first try unused, and returns what it wrote; only
files of the tasks that counted are read.

Cases: a null or empty text has only the end id; ids are whole numbers (others
raise), null ids come first, rows of equal ids in any order; repeated rows are
written as often; an empty table writes no file; texts of any length
work, in memory proportional to one batch and the index of one file; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, slices

MAGIC = b"TOKBITS1"
BLOCK = 1 << 14
END_ID = 1
_HEAD = struct.Struct("<IIQQQ")  # bits, block, ids, documents, blocks
_WORDS = re.compile(r"[^ \t-\r]+").findall  # runs without ASCII white space
_MARKS = re.compile(r"(.*[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f])([!-/:-@\[-`{-~]+)", re.DOTALL).fullmatch  # a letter or digit, then marks; a dotted capital i folds into a letter and a mark
_LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch  # letters that stay apart under NFC
_KEPT = 500_000  # words of a generation that a worker remembers
FILE_TEXT = 256 << 20  # bytes of text that a range has at most, on average


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """ids in so many bits each, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    places = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(places.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(raw: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", n).astype(np.uint32)
    places = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (places.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Writer:
    """Appends documents to one file. Memory: one block and the index."""

    def __init__(self, path: str, bits: int):
        store, name = _store(path)
        store.create_dir(os.path.dirname(name), recursive=True)
        self.out, self.bits = store.open_output_stream(name), bits
        self.out.write(MAGIC)
        self.at, self.n, self.rest = len(MAGIC), 0, np.empty(0, np.uint32)
        self.blocks, self.docs, self.nulls, self.starts = [], [], [], [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.n += len(ids)
        self.starts.append(self.n)
        self.rest = np.concatenate([self.rest, ids.astype(np.uint32)])
        whole = len(self.rest) // BLOCK * BLOCK
        for i in range(0, whole, BLOCK):
            self._block(self.rest[i : i + BLOCK])
        if whole:
            self.rest = self.rest[whole:].copy()

    def _block(self, ids: np.ndarray) -> None:
        raw = pack_bits(ids, self.bits)
        self.blocks.append(self.at)
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        index = _HEAD.pack(self.bits, BLOCK, self.n, len(self.docs), len(self.blocks))
        for values, kind in ((self.blocks, "<u8"), (self.docs, "<i8"), (self.nulls, "u1"), (self.starts, "<u8")):
            index += np.array(values, kind).tobytes()
        self.out.write(index + struct.pack("<Q", self.at))
        self.out.close()


class Reader:
    """Random access to one file."""

    def __init__(self, path: str):
        store, name = _store(path)
        self.file = store.open_input_file(name)
        size = self.file.size()
        (at,) = struct.unpack("<Q", self.file.read_at(8, size - 8))
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        raw = self.file.read_at(size - 8 - at, at)
        self.bits, self.block, self.n, docs, blocks = _HEAD.unpack_from(raw)
        place = _HEAD.size
        parts = []
        for n, kind in ((blocks, "<u8"), (docs, "<i8"), (docs, "u1"), (docs + 1, "<u8")):
            parts.append(np.frombuffer(raw, kind, n, place))
            place += parts[-1].nbytes
        self.blocks, self.docs, self.nulls, self.starts = parts
        self.ends = np.append(self.blocks[1:], at).astype(np.uint64)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids at places start to end of the file."""
        if start >= end:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        raw = self.file.read_at(int(self.ends[last] - self.blocks[first]), int(self.blocks[first]))
        parts = []
        for b in range(first, last + 1):
            at = int(self.blocks[b] - self.blocks[first])
            parts.append(unpack_bits(raw[at : at + int(self.ends[b] - self.blocks[b])], min(self.block, self.n - b * self.block), self.bits))
        return np.concatenate(parts)[start - first * self.block : end - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_bits(path: str) -> int:
    return max(1, (_tokenizer(path).get_vocab_size(with_added_tokens=True) - 1).bit_length())


#: The normalizer and pre-tokenizer of tokenizers whose words' ids do not depend on their neighbours.
_DROPS_SPACE = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)


class Encoder:
    """Ids of texts (UTF-8 bytes), with the end id.

    A tokenizer with the settings _DROPS_SPACE is asked once per stem: it drops white space, folds case and cuts a word before
    marks that follow a letter or digit, so a text's ids are those of its words' stems and of the marks behind them. Any other
    tokenizer is asked for whole texts."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        settings = json.loads(self.tokenizer.to_str())
        self.by_word = (settings["normalizer"], settings["pre_tokenizer"]) == _DROPS_SPACE and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["normalized"]) for t in settings["added_tokens"])
        self.words = _Words(self.tokenizer) if self.by_word else None

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array([*e.ids, END_ID], "<u4") for e in found]
        self.words.renew()
        end, get = array("I", [END_ID]).tobytes(), self.words.__getitem__
        return [np.frombuffer(b"".join(map(get, t.split())) + end, "<u4") for t in texts]  # bytes: only ASCII white space splits


class _Words(dict):
    """UTF-8 word: its ids as bytes. A new word is cut into its stem and the marks behind, which are words themselves.

    Stems of Latin letters alone are one token of the pre-tokenizer, so they go straight to the model, with each letter as normalizer
    and pre-tokenizer write it. Two generations are remembered: when the newer is full, the older goes, and what is still in use comes back."""

    def __init__(self, tokenizer):
        self.tokenizer, self.tokenize, self.older = tokenizer, tokenizer.model.tokenize, {}
        folded = tokenizer.normalizer.normalize_str
        self.written = {i: tokenizer.pre_tokenizer.pre_tokenize_str(folded(chr(i)))[0][0] for i in range(256) if _LETTERS(chr(i))}

    def renew(self) -> None:
        if len(self) > _KEPT:
            self.older = dict(self)
            self.clear()

    def __missing__(self, raw: bytes) -> bytes:
        found = self.older.get(raw)
        if found is None:
            parts = _parts(raw)
            if len(parts) > 1:
                found = self[parts[0]] + self[parts[1]]
            elif parts[0] != raw:
                found = self[parts[0]]
            else:
                found = self.asked(raw.decode("utf-8", "replace"))
        self[raw] = found
        return found

    def asked(self, stem: str) -> bytes:
        if _LETTERS(stem):
            return array("I", [t.id for t in self.tokenize(stem.translate(self.written))]).tobytes()
        return array("I", self.tokenizer.encode(stem, add_special_tokens=False).ids).tobytes()


@cache
def _encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker, so that a task starts with the words of those before."""
    return Encoder(path)


def _parts(raw: bytes) -> tuple[bytes, ...]:
    """Stem and marks. Only plain ASCII is folded here: other letters may combine before the tokenizer folds them."""
    if raw.isalnum():  # ASCII letters and digits
        return (raw.lower(),)
    word = raw.decode("utf-8", "replace")
    m = None if "<|" in word else _MARKS(word)  # that may be a special token
    if m:
        stem = m[1].encode()
        return (stem.lower() if stem.isascii() else stem, m[2].encode())
    return (raw.lower() if raw.isascii() and "<|" not in word else raw,)


def ranges(rows: DataFrame, files: int | None) -> tuple[np.ndarray, int]:
    """The bounds of the ranges of doc_id, quantiles that repeat where one id is frequent, and how many ranges the null ids take."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("known"), F.sum(F.octet_length("text")).alias("size")).first()
    if files is None:
        files = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(found.size or 0) // FILE_TEXT))
    nulls = files * (found.n - found.known) // max(found.n, 1)
    rest = files - nulls
    return np.array(sorted(rows.approxQuantile("doc_id", [i / rest for i in range(1, rest)], 0.1 / rest)) if rest > 1 and found.known else []), nulls  # files numbers


def range_of(ids: pa.Array, spread: np.ndarray, bounds: np.ndarray, nulls: int) -> np.ndarray:
    """The range of each id. Those that an id fills whole, and those of null ids, are dealt by spread, any numbers from 0."""
    known = ids.fill_null(0).to_numpy(zero_copy_only=False)
    first, last = (np.searchsorted(bounds, known.astype(float), side) for side in ("left", "right"))
    own = np.where(last - first > 1, first + 1 + spread % np.maximum(last - first, 1), last) + nulls
    return np.where(np.asarray(ids.is_null()), spread % max(nulls, 1), own)


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, files: int | None = None) -> DataFrame:
    """Writes the files (at once) and returns one row each, in order: file, n_docs, n_ids, start (ids in the files before).

    folder: where, a fresh one in the shared folder if not given; files: how many ranges, if not given as many as shuffle partitions or as FILE_TEXT asks for."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    bounds, nulls = ranges(rows, files)
    n_ranges = len(bounds) + 1 + nulls
    bits = vocabulary_bits(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for b in slices(batches, 1):
            ids = encoder.encode(b.column(1).to_pylist())
            packed = [pack_bits(x, bits) for x in ids]
            spread = np.fromiter(map(zlib.crc32, packed), np.int64, len(packed)) + np.arange(len(packed))
            places = range_of(b.column(0), spread, bounds, nulls)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), b.column(0), pa.array([len(x) for x in ids], pa.int32()), pa.array(packed, pa.binary())], ["range", "doc_id", "n", "packed"])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = part = path = None

        def done() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_pylist([{"range": part, "file": path, "n_docs": len(writer.docs), "n_ids": writer.n}], pa.schema([("range", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

        for b in batches:
            for place, doc_id, n, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if place != part:
                    if writer:
                        yield done()
                    part, path = place, f"{folder}/{place:06d}-{uuid.uuid4().hex}.tok"
                    writer = Writer(path, bits)
                writer.add(doc_id, unpack_bits(packed, n, bits))
        if writer:
            yield done()

    dealt = rows.mapInArrow(encode, "range int, doc_id long, n int, packed binary").repartitionById(n_ranges, "range")
    wrote = dealt.sortWithinPartitions(F.col("range"), F.col("doc_id").asc_nulls_first(), F.col("packed")).mapInArrow(save, "range int, file string, n_docs long, n_ids long")
    found, start, rows_ = sorted(wrote.collect()), 0, []  # one row per file
    for r in found:
        rows_.append((r.file, r.n_docs, r.n_ids, start))
        start += r.n_ids
    return spark.createDataFrame(rows_, "file string, n_docs long, n_ids long, start long")


def read_back(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files of the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                reader = Reader(path)
                for at in range(0, len(reader.docs), 1000):  # a run of documents at a time
                    starts = reader.starts[at : at + 1001].astype(np.int64)
                    ids = reader.ids(int(starts[0]), int(starts[-1])).astype("<u4")
                    crcs = [zlib.crc32(ids[s - starts[0] : e - starts[0]].tobytes()) for s, e in zip(starts, starts[1:], strict=False)]
                    docs = pa.array(reader.docs[at : at + 1000], mask=reader.nulls[at : at + 1000].astype(bool))
                    yield pa.RecordBatch.from_arrays([docs, pa.array(starts[:-1] + base), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return manifest.select("file", "start").repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
