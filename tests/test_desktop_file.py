"""The reader of desktop database files against files written page by page."""

import struct
from datetime import datetime
from decimal import Decimal

import pytest

from deskquery import Engine, UnknownTable
from deskquery.errors import DeskQueryError
from deskquery.sources.desktop_file import DesktopFile, moment, read_table
from tests.desktop_writer import Writer, serial

COLUMNS = [
    ("id", 4, 4), ("flag", 1, None), ("tiny", 2, 1), ("small", 3, 2), ("money", 5, 8), ("single", 6, 4), ("double", 7, 8), ("at", 8, 8), ("bin", 9, None), ("name", 10, None), ("ole", 11, None),
    ("memo", 12, None), ("guid", 15, 16), ("num", 16, 17, 3),
]
WHEN = datetime(2026, 5, 28, 13, 45, 10)


def numeric(number, scale):
    raw = abs(number).to_bytes(16, "little")
    return bytes([0x80 if number < 0 else 0]) + b"".join(raw[12 - 4 * k : 16 - 4 * k] for k in range(4))


def rows(w):
    far = "über " * 500
    return [
        [struct.pack("<i", -7), True, b"\xff", struct.pack("<h", -5), struct.pack("<q", -999_900), struct.pack("<f", 1.5), struct.pack("<d", -0.001), serial(WHEN), b"\1\2", w.text("Ada", True), w.long(b"\0\1" * 900, "chain"),
         w.long(w.text(far), "chain"), bytes(range(16)), numeric(-12345, 3)],
        [struct.pack("<i", 2), False, *[None] * 12],
        [struct.pack("<i", 3), True, b"\0", struct.pack("<h", 32000), struct.pack("<q", 0), struct.pack("<f", 0), struct.pack("<d", 9.5), serial(datetime(1899, 12, 30)), b"", w.text("café x" if w.old else "张三"), w.long(b"one"),
         w.long(w.text("line1\nline2"), "page"), bytes(16), numeric(10**20, 3)],
    ]


def wanted(old):
    far = "über " * 500
    return [
        (-7, True, 255, -5, Decimal("-99.9900"), 1.5, -0.001, WHEN, b"\1\2", "Ada", b"\0\1" * 900, far, "{03020100-0504-0706-0809-0A0B0C0D0E0F}", Decimal("-12.345")),
        (2, False, *[None] * 12),
        (3, True, 0, 32000, Decimal("0.0000"), 0.0, 9.5, datetime(1899, 12, 30), b"", "café x" if old else "张三", b"one", "line1\nline2", "{00000000-0000-0000-0000-000000000000}", Decimal("100000000000000000.000")),
    ]


@pytest.mark.parametrize("old", [False, True])
@pytest.mark.parametrize("key", [0, 0x1234ABCD])
@pytest.mark.parametrize("indirect", [False, True])
def test_round_trip(old, key, indirect):
    w = Writer(old, key, indirect)
    r = rows(w)
    w.table("typed", COLUMNS, [r[:2], r[2:]], long=True)  # the definition goes on on another page
    file = DesktopFile.from_bytes(w.finished())
    table = file.table("TYPED")
    assert [c.name for c in table.columns] == [c[0] for c in COLUMNS]
    assert list(file.rows(table, list(table.columns), file.pages(table))) == wanted(old)
    assert list(file.rows(table, table.picked(["name", "id"]), file.pages(table)))[0] == ("Ada", -7)


@pytest.mark.parametrize("version,good", [(0, True), (1, True), (6, True), (7, False), (255, False)])
def test_versions(version, good):
    data = Writer(version == 0, version=version).finished()
    if good:
        assert DesktopFile.from_bytes(data).catalog == []
    else:
        with pytest.raises(DeskQueryError):
            DesktopFile.from_bytes(data)


def test_no_database(tmp_path):
    for data in (b"", b"\1" + bytes(5000), bytes(100)):
        with pytest.raises(DeskQueryError):
            DesktopFile.from_bytes(data)
    with pytest.raises(DeskQueryError):
        DesktopFile.open(str(tmp_path / "none.mdb"))


IDS = [("id", 4, 4), ("name", 10, None)]


def numbers(w, *ns):
    return [[struct.pack("<i", n), w.text(f"n{n}")] for n in ns]


@pytest.mark.parametrize("broken", [[], [1], [999]])
def test_broken_map(broken):
    """No bits, a foreign page, a page beyond the file: all pages are looked at."""
    w = Writer()
    w.table("t", IDS, [numbers(w, 1, 2), numbers(w, 3)], map_pages=broken)
    w.table("other", IDS, [numbers(w, 9)])
    file = DesktopFile.from_bytes(w.finished())
    table = file.table("t")
    assert [r[0] for r in file.rows(table, list(table.columns), file.pages(table))] == [1, 2, 3]


def test_deleted_and_short_rows():
    w = Writer()
    number = w.new_page()
    made = [w.row(IDS, r) for r in numbers(w, 1, 2, 3)]
    early = w.row(IDS[:1], [struct.pack("<i", 4)])  # written before the table got its second column
    page = w.rows_page(number, [*made, early, b"\xff\xff\0"], deleted=[1])
    w.define(number, IDS, [page])
    w.catalog_rows.append((number, "t", 1, 0))
    file = DesktopFile.from_bytes(w.finished())
    table = file.table("t")
    got = list(file.rows(table, list(table.columns), file.pages(table)))
    assert got[:2] == [(1, "n1"), (3, "n3")] and len(got) == 3 and got[2][0] == 4


@pytest.mark.parametrize("raw,want", [
    (b"\xff\xfeabc", "abc"), (b"\xff\xfeab\0\x20\x5f\x09\x4e\0cd", "ab张三cd"), ("张x".encode("utf-16-le"), "张x"), (b"\xff\xfe\xe9", "é"), (b"", ""), (b"\xff\xfea\0\x20", "a"),
    ("\U0001f600".encode("utf-16-le"), "\U0001f600"),
])
def test_text(raw, want):
    assert DesktopFile.from_bytes(Writer().finished()).text(raw) == want


def test_circular_chain():
    w = Writer()
    page = w.rows_page(0, [struct.pack("<I", (len(w.pages)) << 8) + b"ab"])
    assert page == len(w.pages) - 1
    file = DesktopFile.from_bytes(w.finished())
    assert file.long_value(struct.pack("<III", 2, page << 8, 0)) == b"ab" and file.long_value(b"abc") == b"" and file.long_value(struct.pack("<III", 2, 999 << 8, 0)) == b""


def test_moments():
    assert moment(-1.25) == datetime(1899, 12, 29, 6) and moment(1.5) == datetime(1899, 12, 31, 12) and moment(1e9) is None and moment(float("nan")) is None


@pytest.fixture(params=[False, True])
def path(request, tmp_path):
    w = Writer(request.param, key=0x77)
    w.table("typed", COLUMNS, [rows(w)])
    w.table("many", IDS, [numbers(w, *range(i, i + 20)) for i in range(0, 100, 20)])
    w.table("empty", IDS, [])
    w.table("MSysThings", IDS, [numbers(w, 5)], flags=0x80000000)
    w.table("a form", IDS, [], kind=0)
    place = tmp_path / ("old.mdb" if request.param else "new.accdb")
    place.write_bytes(w.finished())
    return str(place)


def test_engine(spark, path):
    engine = Engine(spark, path)
    assert [r[0] for r in engine.sql("LIST TABLES").collect()] == ["typed", "many", "empty"]
    assert [tuple(r) for r in engine.sql("SELECT * FROM typed").collect()] == wanted(path.endswith("old.mdb"))
    assert [tuple(r) for r in engine.sql("DESCRIBE TABLE many").collect()] == [("id", "Long Integer", "4"), ("name", "Text", "100")]
    assert engine.sql("SELECT COUNT(*) FROM many").first()[0] == "100" and engine.sql("SELECT * FROM empty").collect() == []
    assert [r[0] for r in engine.sql("SELECT TOP 3 name FROM many WHERE id > ? ORDER BY id", 50).collect()] == ["n51", "n52", "n53"]
    assert [r[0] for r in engine.sql("SELECT name FROM msysthings").collect()] == ["n5"]  # system tables go by name
    assert [r[0] for r in engine.sql("SELECT id FROM typed WHERE at = ?", WHEN).collect()] == [-7]
    with pytest.raises(UnknownTable):
        engine.sql("SELECT * FROM none")


def test_tasks(spark, path, monkeypatch):
    from deskquery.sources import desktop_file

    reader = desktop_file.DesktopReader(path, "many", ["name"])
    monkeypatch.setattr(desktop_file, "PAGES_PER_TASK", 2)
    parts = reader.partitions()
    assert len(parts) == 3 and [r for p in parts for r in reader.read(p)] == [(f"n{i}",) for i in range(100)]
    assert read_table(spark, path, "many", ["name"]).columns == ["name"]
