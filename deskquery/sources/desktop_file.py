"""Desktop database files as a Spark data source.

``DesktopFile`` reads pages of one file at any place: it finds the version, undoes
the encryption of header and pages, follows definitions, usage maps and long
values, and turns rows into Python values. ``DesktopSource`` makes a table of it
a DataFrame: the driver reads catalog and definition, and Spark's tasks read runs
of the table's pages, each from the file itself, with no rows passing the driver.

Options of the source: path (local, or a URI that Arrow's file systems open),
table, and columns (a JSON list; the others are not decoded).

Damage: a usage map that is short, unreadable or names foreign pages makes way
for a scan of all pages; a row that does not hold together is left out; a field
beyond its row is null; a chain of long values ends where it breaks or turns back.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from decimal import Decimal
from functools import cached_property

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import DeskQueryError, UnknownColumn, UnknownTable
from ..functions.dates import EPOCH

FORMAT = "desktop"
PAGES_PER_TASK = 2048  # eight megabytes of the larger pages


@dataclass(frozen=True)
class Layout:
    """Sizes and places, in bytes, that differ between the two page formats."""

    page: int
    n_rows_on_page: int
    n_columns: int
    n_indexes: int
    usage_map: int
    columns: int
    index_entry: int
    entry: int
    number: int
    var_number: int
    scale: int
    flags: int
    fixed_at: int
    size: int


# Fixed values of the file format.
OLD = Layout(page=2048, n_rows_on_page=8, n_columns=25, n_indexes=31, usage_map=35, columns=43, index_entry=8, entry=18, number=1, var_number=3, scale=10, flags=13, fixed_at=14, size=16)
NEW = Layout(page=4096, n_rows_on_page=12, n_columns=45, n_indexes=51, usage_map=55, columns=63, index_entry=12, entry=25, number=5, var_number=7, scale=12, flags=15, fixed_at=21, size=23)
HEADER_KEY = bytes((0xC7, 0xDA, 0x39, 0x6B))
VERSIONS = range(7)  # the first is the old format
DATA_PAGE, TABLE_PAGE, CATALOG_PAGE = 1, 2, 2
DELETED, PLACE = 0x4000, 0x1FFF  # of an entry of a page's list of rows
INLINE, ONE_PAGE, LONG_HEADER = 0x80000000, 0x40000000, 12  # of a long value
HIDDEN = 0x80000002  # flags of tables that are not the user's
# Type codes, with the name that metadata carries and the Spark type.
TYPES = {
    1: ("Boolean", T.BooleanType()), 2: ("Byte", T.ShortType()), 3: ("Integer", T.ShortType()), 4: ("Long Integer", T.IntegerType()), 5: ("Currency", T.DecimalType(19, 4)),
    6: ("Single", T.FloatType()), 7: ("Double", T.DoubleType()), 8: ("DateTime", T.TimestampNTZType()), 9: ("Binary", T.BinaryType()), 10: ("Text", T.StringType()),
    11: ("OLE", T.BinaryType()), 12: ("Memo/Hyperlink", T.StringType()), 15: ("Replication ID", T.StringType()), 16: ("Numeric", None), 18: ("Complex", T.IntegerType()),
}


def rc4(key: bytes, data: bytes) -> bytes:
    """The stream cipher RC4; it undoes itself."""
    box, j = list(range(256)), 0
    for i in range(256):
        j = (j + box[i] + key[i % len(key)]) & 255
        box[i], box[j] = box[j], box[i]
    out, i, j = bytearray(data), 0, 0
    for k in range(len(out)):
        i = (i + 1) & 255
        j = (j + box[i]) & 255
        box[i], box[j] = box[j], box[i]
        out[k] ^= box[(box[i] + box[j]) & 255]
    return bytes(out)


def u16(data: bytes, at: int) -> int:
    return int.from_bytes(data[at : at + 2], "little")


def u32(data: bytes, at: int) -> int:
    return int.from_bytes(data[at : at + 4], "little")


@dataclass(frozen=True)
class Column:
    name: str
    code: int
    number: int
    var_number: int
    fixed: bool
    fixed_at: int
    size: int
    scale: int

    @property
    def field(self) -> T.StructField:
        name, kind = TYPES.get(self.code, ("OLE", T.BinaryType()))
        return T.StructField(self.name, kind or T.DecimalType(38, min(self.scale, 38)), True, {"access_type": name, "size": self.size})


@dataclass(frozen=True)
class Table:
    page: int
    n_var: int
    columns: tuple[Column, ...]
    usage_map: bytes

    def schema(self, names: list[str] | None = None) -> T.StructType:
        return T.StructType([c.field for c in self.picked(names)])

    def picked(self, names: list[str] | None) -> list[Column]:
        by_name = {c.name: c for c in self.columns}
        if names is None:
            return list(self.columns)
        if missing := [n for n in names if n not in by_name]:
            raise UnknownColumn(missing[0])
        return [by_name[n] for n in names]


class DesktopFile:
    """read(start, size) gives bytes of the file, fewer at its end."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self._read, self.size = read, size
        head = read(0, NEW.page)
        if len(head) < 0x98 or head[0] != 0:
            raise DeskQueryError("this is no desktop database file")
        self.version = head[0x14]
        if self.version not in VERSIONS:
            raise DeskQueryError(f"unknown version {self.version} of a desktop database file")
        self.old = self.version == 0
        self.layout = OLD if self.old else NEW
        plain = rc4(HEADER_KEY, head[0x18 : 0x18 + (126 if self.old else 128)])
        self.code_page, self.key = u16(plain, 0x3C - 0x18), u32(plain, 0x3E - 0x18)

    @classmethod
    def open(cls, path: str) -> DesktopFile:
        store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        try:
            file = store.open_input_file(name)
        except OSError as error:
            raise DeskQueryError(f"no database at {path}: {error}") from None
        return cls(lambda start, size: file.read_at(max(0, min(size, file.size() - start)), start) if start < file.size() else b"", file.size())

    @classmethod
    def from_bytes(cls, data: bytes) -> DesktopFile:
        return cls(lambda start, size: data[start : start + size], len(data))

    @property
    def n_pages(self) -> int:
        return -(-self.size // self.layout.page)

    def page(self, number: int) -> bytes:
        if not 0 <= number < self.n_pages:
            raise DeskQueryError(f"page {number} is beyond the end of the file")
        raw = self._read(number * self.layout.page, self.layout.page).ljust(self.layout.page, b"\0")
        return rc4((self.key ^ number).to_bytes(4, "little"), raw) if number and self.key else raw

    # Rows

    def rows_on(self, page: bytes) -> int:
        return u16(page, self.layout.n_rows_on_page)

    def row(self, page: bytes, k: int) -> tuple[int, int, int]:
        """Start, end and flags of a row. Rows fill a page from its end, so one ends where the one before starts."""
        at = self.layout.n_rows_on_page + 2
        entry = u16(page, at + 2 * k)
        end = self.layout.page if k == 0 else u16(page, at + 2 * (k - 1)) & PLACE
        start = entry & PLACE
        if k > 1000 or not start <= end <= self.layout.page:
            raise DeskQueryError("a row does not lie on its page")
        return start, end, entry

    def pointed(self, pointer: int) -> bytes:
        """The row that a pointer, a page and the row's number in the lowest byte, names."""
        page = self.page(pointer >> 8)
        start, end, _ = self.row(page, pointer & 255)
        return page[start:end]

    # Definitions

    def definition(self, number: int) -> Table:
        page, lay = self.page(number), self.layout
        if page[0] != TABLE_PAGE:
            raise DeskQueryError(f"page {number} defines no table")
        text, seen, following = bytearray(page), {number}, u32(page, 4)
        while following and following not in seen:  # a long definition goes on behind the heads of further pages
            seen.add(following)
            part = self.page(following)
            text += part[8:]
            following = u32(part, 4)
        n, n_var, n_indexes = u16(text, lay.n_columns), u16(text, lay.n_columns - 2), u32(text, lay.n_indexes)
        at = lay.columns + n_indexes * lay.index_entry
        entries = [bytes(text[at + i * lay.entry : at + (i + 1) * lay.entry]) for i in range(n)]
        at += n * lay.entry
        columns = []
        for e in entries:
            if len(e) < lay.entry:
                raise DeskQueryError(f"the definition on page {number} is cut off")
            width = 1 if self.old else 2
            size = int.from_bytes(text[at : at + width], "little")
            name = self.text(bytes(text[at + width : at + width + size]))
            at += width + size
            columns.append(Column(name, e[0], e[lay.number], u16(e, lay.var_number), bool(e[lay.flags] & 1), u16(e, lay.fixed_at), 0 if e[0] == 1 else u16(e, lay.size), e[lay.scale] if e[0] == 16 else 0))
        return Table(number, n_var, tuple(sorted(columns, key=lambda c: c.number)), self.pointed(u32(text, lay.usage_map)))

    @cached_property
    def catalog(self) -> list[tuple[str, int, bool]]:
        """Name, page and whether it is the user's, of every table."""
        table = self.definition(CATALOG_PAGE)
        columns = table.picked(["Id", "Name", "Type", "Flags"])
        found = []
        for number, name, kind, flags in self.rows(table, columns, self.pages(table)):
            if kind == 1 and name:
                found.append((name, (number or 0) & 0xFFFFFF, not (flags or 0) & HIDDEN))
        return found

    def table(self, name: str) -> Table:
        """By name, without regard to the case of ASCII letters; system tables too."""
        fold = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
        for other, page, _ in self.catalog:
            if fold(other) == fold(name):
                return self.definition(page)
        raise UnknownTable(name)

    # Pages

    def pages(self, table: Table) -> list[int]:
        """The table's data pages, by its usage map, or by looking at all pages where that is broken."""
        try:
            listed = list(self._mapped(table.usage_map))
            whole = bool(listed) and all(self._owned(p, table) for p in listed)
        except DeskQueryError:
            whole = False
        return listed if whole else [p for p in range(1, self.n_pages) if self._owned(p, table)]

    def _owned(self, number: int, table: Table) -> bool:
        page = self.page(number)
        return page[0] == DATA_PAGE and u32(page, 4) == table.page

    def _mapped(self, usage: bytes) -> Iterator[int]:
        if len(usage) < 5 or usage[0] > 1:
            raise DeskQueryError("a usage map is broken")
        if usage[0] == 0:  # the bits are here
            yield from _bits(usage[5:], u32(usage, 1))
            return
        per_page = (self.layout.page - 4) * 8
        for k in range((len(usage) - 1) // 4):  # the bits lie on pages of their own
            if number := u32(usage, 1 + 4 * k):
                yield from _bits(self.page(number)[4:], k * per_page)

    # Values

    def rows(self, table: Table, columns: list[Column], pages: list[int]) -> Iterator[tuple]:
        before = {c.number: sum(o.fixed and o.number < c.number for o in table.columns) for c in columns}
        for number in pages:
            page = self.page(number)
            for k in range(self.rows_on(page)):
                try:
                    start, end, entry = self.row(page, k)
                    if start < end and not entry & DELETED:
                        yield self._values(table, columns, before, page[start:end])
                except DeskQueryError:
                    continue

    def _values(self, table: Table, columns: list[Column], before: dict[int, int], row: bytes) -> tuple:
        width = 1 if self.old else 2
        stored = int.from_bytes(row[:width], "little")
        n_mask = (stored + 7) // 8
        if n_mask >= len(row) - 1:
            raise DeskQueryError("a row does not hold its own mask")
        mask = row[len(row) - n_mask :]
        ends = self._var_places(row, n_mask) if table.n_var else []
        n_fixed = stored - max(len(ends) - 1, 0)
        out = []
        for c in columns:
            there = c.number // 8 < len(mask) and bool(mask[c.number // 8] >> c.number % 8 & 1)
            if c.code == 1:
                out.append(there)
                continue
            if c.fixed:
                field = row[c.fixed_at + width : c.fixed_at + width + c.size] if before[c.number] < n_fixed else None
                field = field if field is not None and len(field) == c.size else None
            else:
                k = c.var_number
                field = row[ends[k] : ends[k + 1]] if k + 1 < len(ends) and ends[k] <= ends[k + 1] <= len(row) else None
            out.append(self.value(c, field) if there and field is not None else None)
        return tuple(out)

    def _var_places(self, row: bytes, n_mask: int) -> list[int]:
        """Where each variable column starts, and where the last one ends. They are listed backwards from the mask."""
        last = len(row) - 1 - n_mask
        if not self.old:
            n = u16(row, last - 1)
            return [u16(row, last - 3 - 2 * i) for i in range(n + 1)] if last - 3 - 2 * n >= 0 else []
        # Places are one byte here; a list of jumps in front of the mask says from which column on another 256 is added.
        n, jumps = row[last], (len(row) - 1) // 256
        first = last - 1 - jumps
        if (first - n) // 256 < jumps:
            jumps -= 1
        if first - n < 0:
            return []
        out, passed = [], 0
        for i in range(n + 1):
            while passed < jumps and row[last - 1 - passed] == i:
                passed += 1
            out.append(row[first - i] + 256 * passed)
        return out

    def value(self, c: Column, raw: bytes):
        match c.code:
            case 2:
                return raw[0]
            case 3 | 4 | 18:
                return int.from_bytes(raw, "little", signed=True)
            case 5:
                return Decimal(int.from_bytes(raw, "little", signed=True)).scaleb(-4)
            case 6 | 7:
                return struct.unpack("<f" if c.code == 6 else "<d", raw)[0]
            case 8:
                return moment(struct.unpack("<d", raw)[0])
            case 10:
                return self.text(raw)
            case 11 | 12:
                whole = self.long_value(raw)
                return self.text(whole) if c.code == 12 else whole
            case 15:
                a, b, d = struct.unpack("<IHH", raw[:8])
                return f"{{{a:08X}-{b:04X}-{d:04X}-{raw[8:10].hex().upper()}-{raw[10:16].hex().upper()}}}"
            case 16:
                digits = b"".join(raw[13 - 4 * k : 17 - 4 * k] for k in range(4))  # four words, the lowest last
                number = int.from_bytes(digits, "little")
                return Decimal((raw[0] >> 7, tuple(map(int, str(number))), -c.scale)) if number < 10**38 else None
        return raw

    def text(self, raw: bytes) -> str:
        if self.old:
            return raw.decode("latin-1")
        if raw[:2] != b"\xff\xfe":
            return raw[: len(raw) // 2 * 2].decode("utf-16-le", "replace")
        parts, short = [], True  # zero bytes switch between one byte a character and two
        for part in _runs(raw[2:]):
            parts.append(part.decode("latin-1").encode("utf-16-le") if short else part)
            short = not short
        return b"".join(parts).decode("utf-16-le", "replace")

    def long_value(self, raw: bytes) -> bytes:
        if len(raw) < LONG_HEADER:
            return b""
        head = u32(raw, 0)
        if head & INLINE:
            return raw[LONG_HEADER:]
        try:
            if head & ONE_PAGE:
                return self.pointed(u32(raw, 4))
        except DeskQueryError:
            return b""
        if head & 0xFF000000:
            return b""
        parts, pointer, seen = [], u32(raw, 4), set()
        while pointer >> 8 and pointer not in seen:
            seen.add(pointer)
            try:
                part = self.pointed(pointer)
            except DeskQueryError:
                break
            if len(part) < 4:
                break
            parts.append(part[4:])
            pointer = u32(part, 0)
        return b"".join(parts)


def _bits(bitmap: bytes, first: int) -> Iterator[int]:
    for at, byte in enumerate(bitmap):
        for bit in range(8 if byte else 0):
            if byte >> bit & 1:
                yield first + 8 * at + bit


def _runs(raw: bytes) -> Iterator[bytes]:
    """Pieces in turn of one byte a character and of two, as zero bytes switch. In the wide ones only a zero in front of a pair does."""
    at, short = 0, True
    while at <= len(raw):
        end = at
        if short:
            found = raw.find(b"\0", at)
            end = len(raw) if found < 0 else found
        else:
            while end + 1 < len(raw) and raw[end]:
                end += 2
            if end + 1 >= len(raw) and raw[end : end + 1] != b"\0":
                yield raw[at:end]
                return
        yield raw[at:end]
        at, short = end + 1, not short


def moment(serial: float) -> datetime | None:
    """A day serial; below zero the fraction still counts forward from midnight. None if beyond the years of a datetime."""
    if not -657_434 <= serial <= 2_958_466:
        return None
    days, part = divmod(serial, 1) if serial >= 0 else (int(serial), -(serial % -1))
    return EPOCH + timedelta(days=int(days), seconds=round(part * 86400))


class DesktopSource(DataSource):
    """format("desktop"): one table of a desktop database file."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _names(self) -> list[str] | None:
        given = self.options.get("columns")
        return json.loads(given) if given else None

    def schema(self) -> T.StructType:
        return DesktopFile.open(self.options["path"]).table(self.options["table"]).schema(self._names())

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return DesktopReader(self.options["path"], self.options["table"], self._names())


class Pages(InputPartition):
    def __init__(self, numbers: list[int]):
        self.numbers = numbers


class DesktopReader(DataSourceReader):
    def __init__(self, path: str, table: str, names: list[str] | None):
        self.path, self.name, self.names = path, table, names

    def partitions(self) -> list[InputPartition]:
        file = DesktopFile.open(self.path)
        pages = file.pages(file.table(self.name))
        return [Pages(pages[i : i + PAGES_PER_TASK]) for i in range(0, len(pages), PAGES_PER_TASK)] or [Pages([])]

    def read(self, partition: Pages) -> Iterator[tuple]:
        file = DesktopFile.open(self.path)
        table = file.table(self.name)
        yield from file.rows(table, table.picked(self.names), partition.numbers)


def read_table(spark: SparkSession, path: str, table: str, columns: list[str] | None = None):
    """A table of the file as a DataFrame, with types and sizes in its metadata."""
    spark.dataSource.register(DesktopSource)
    schema = DesktopFile.open(path).table(table).schema(columns)
    options = {"path": path, "table": table} | ({"columns": json.dumps(columns)} if columns is not None else {})
    return spark.read.format(FORMAT).options(**options).schema(schema).load().to(schema)


def table_names(path: str) -> list[str]:
    """The user's tables, as the catalog lists them."""
    return [name for name, _, own in DesktopFile.open(path).catalog if own]
