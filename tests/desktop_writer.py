"""Writes small desktop database files page by page, for the reader's tests."""

import struct
from datetime import datetime

from deskquery.sources.desktop_file import HEADER_KEY, NEW, OLD, rc4

EPOCH = datetime(1899, 12, 30)


class Writer:
    def __init__(self, old=False, key=0, indirect_maps=False, version=None):
        self.old, self.lay, self.key, self.indirect = old, OLD if old else NEW, key, indirect_maps
        self.version = version if version is not None else 0 if old else 1
        self.pages = [bytearray(self.lay.page) for _ in range(3)]  # header, unused, catalog definition
        self.catalog_rows = []

    def new_page(self):
        self.pages.append(bytearray(self.lay.page))
        return len(self.pages) - 1

    def rows_page(self, owner, rows, kind=1, deleted=(), at=None):
        """A page of rows from its end; returns its number."""
        number = self.new_page() if at is None else at
        page, end, places = self.pages[number], self.lay.page, []
        for k, row in enumerate(rows):
            end -= len(row)
            page[end : end + len(row)] = row
            places.append(end | (0x4000 if k in deleted else 0))
        head = self.lay.n_rows_on_page
        page[0] = kind
        struct.pack_into("<I", page, 4, owner)
        struct.pack_into(f"<H{len(places)}H", page, head, len(places), *places)
        assert end > head + 2 + 2 * len(places)
        return number

    def pointer(self, data):
        return self.rows_page(0, [data]) << 8

    def chain(self, data, size):
        following = 0
        for i in range((len(data) - 1) // size * size, -1, -size):
            following = self.pointer(struct.pack("<I", following) + data[i : i + size])
        return following

    def text(self, s, short=False):
        if self.old:
            return s.encode("latin-1")
        return b"\xff\xfe" + s.encode("latin-1") if short else s.encode("utf-16-le")

    def long(self, data, how="inline"):
        if how == "inline":
            return struct.pack("<III", len(data) | 0x80000000, 0, 0) + data
        if how == "page":
            return struct.pack("<III", len(data) | 0x40000000, self.pointer(data), 0)
        return struct.pack("<III", len(data), self.chain(data, 700), 0)

    def row(self, columns, values, stored=None):
        """columns: (name, code, fixed size or None, scale); values: bytes, None, or for booleans a truth value."""
        stored = len(columns) if stored is None else stored
        mask, fixed, var = bytearray((stored + 7) // 8), b"", []
        for i, ((_, code, size, *_), v) in enumerate(zip(columns, values, strict=True)):
            if i >= stored:
                break
            if v is not None and v is not False:
                mask[i // 8] |= 1 << i % 8
            if code != 1 and size is not None:
                fixed += v if v is not None else bytes(size)
            elif code != 1:
                var.append(v or b"")
        head = bytes([stored]) if self.old else struct.pack("<H", stored)
        places = [len(head) + len(fixed)]
        for v in var:
            places.append(places[-1] + len(v))
        body = head + fixed + b"".join(var)
        if all(size is not None or code == 1 for _, code, size, *_ in columns):
            return body + bytes(mask)
        if not self.old:
            return body + struct.pack(f"<{len(places)}H", *reversed(places)) + struct.pack("<H", len(var)) + bytes(mask)
        jumps = [next(i for i, p in enumerate(places) if p >= 256 * j) for j in range(1, places[-1] // 256 + 1)]
        tail = bytes(p & 255 for p in reversed(places)) + bytes(reversed(jumps)) + bytes([len(var)]) + bytes(mask)
        missing = (len(body) + len(tail) - 1) // 256 - len(jumps)
        return body + bytes(p & 255 for p in reversed(places)) + bytes([255] * missing) + bytes(reversed(jumps)) + bytes([len(var)]) + bytes(mask)

    def define(self, number, columns, data_pages, long=False):
        lay, text = self.lay, bytearray(self.lay.columns)
        text[0] = 2
        struct.pack_into("<HH", text, lay.n_columns - 2, sum(s is None for _, c, s, *_ in columns if c != 1), len(columns))
        if long:  # so many indexes that the columns run over to another page
            n = (lay.page - lay.columns - 100) // lay.index_entry
            struct.pack_into("<I", text, lay.n_indexes, n)
            text += bytes(n * lay.index_entry)
        fixed_at = n_var = 0
        for i, (_, code, size, *scale) in enumerate(columns):
            e = bytearray(lay.entry)
            e[0], e[lay.number] = code, i
            struct.pack_into("<H", e, lay.var_number, n_var)
            if code == 16:
                e[lay.scale] = scale[0]
            if code == 1 or size is not None:
                e[lay.flags] = 1
                struct.pack_into("<H", e, lay.fixed_at, fixed_at)
                struct.pack_into("<H", e, lay.size, size or 0)
                fixed_at += size or 0
            else:
                struct.pack_into("<H", e, lay.size, 100)
                n_var += 1
            text += e
        for name, *_ in columns:
            raw = self.text(name)
            text += (bytes([len(raw)]) if self.old else struct.pack("<H", len(raw))) + raw
        struct.pack_into("<I", text, lay.usage_map, self.usage_map(data_pages))
        first, rest = text[: lay.page], text[lay.page :]
        if rest:
            more = self.new_page()
            self.pages[more][: 8 + len(rest)] = bytes([2]) + bytes(7) + rest
            struct.pack_into("<I", first, 4, more)
        self.pages[number][: len(first)] = first

    def usage_map(self, pages):
        if not self.indirect:
            start = min(pages, default=0)
            bits = bytearray(16)
            for p in pages:
                bits[(p - start) // 8] |= 1 << (p - start) % 8
            return self.pointer(b"\0" + struct.pack("<I", start) + bits)
        number = self.new_page()
        for p in pages:
            self.pages[number][4 + p // 8] |= 1 << p % 8
        return self.pointer(b"\1" + struct.pack("<II", number, 0))

    def table(self, name, columns, pages, flags=0, kind=1, map_pages=None, long=False):
        """pages: lists of rows (value lists, or finished bytes), one list a page."""
        number = self.new_page()
        data = [self.rows_page(number, [r if isinstance(r, bytes) else self.row(columns, r) for r in rows], deleted=[]) for rows in pages]
        self.define(number, columns, data if map_pages is None else map_pages, long)
        self.catalog_rows.append((number, name, kind, flags))
        return number

    def finished(self):
        columns = [("Id", 4, 4), ("Type", 3, 2), ("Flags", 4, 4), ("Name", 10, None)]
        rows = [self.row(columns, [struct.pack("<I", n), struct.pack("<h", kind), struct.pack("<I", flags), self.text(name)]) for n, name, kind, flags in self.catalog_rows]
        self.define(2, columns, [self.rows_page(2, rows)])
        head = self.pages[0]
        head[0x14] = self.version
        size = 126 if self.old else 128
        plain = bytearray(size)
        struct.pack_into("<HI", plain, 0x3C - 0x18, 1252, self.key)
        head[0x18 : 0x18 + size] = rc4(HEADER_KEY, bytes(plain))
        hidden = [rc4((self.key ^ i).to_bytes(4, "little"), bytes(p)) if i and self.key else bytes(p) for i, p in enumerate(self.pages)]
        return b"".join(hidden)


def serial(moment):
    return struct.pack("<d", (moment - EPOCH).total_seconds() / 86400)
