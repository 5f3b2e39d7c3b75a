import itertools
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskquery import Engine, ParamError, QuerySyntaxError, ReadOnlyError, TypeMismatch, UnknownColumn, UnknownTable
from deskquery.errors import DeskQueryError
from deskquery.functions.like import like
from deskquery.functions.render import render, table_text
from deskquery.operators.listing import describe_result
from deskquery.sinks.ddl import DIALECTS, create_table
from deskquery.sinks.values import escaped
from deskquery.streaming.select import stream_select
from tests.fixtures import tables


@pytest.fixture(scope="module")
def engine(spark):
    return Engine(spark, tables(spark))


def ids(engine, query, *params):
    return [r[0] for r in engine.sql(query, *params).collect()]


NULLTEST = [
    ("val_int IN (42, 1)", [2]),
    ("val_int IN ('42', 99)", [2]),
    ("val_int IN ('abc', 1)", []),
    ("val_bool IN (TRUE)", [2]),
    ("val_text IN ('not null')", [2]),
    ("val_text IN ('')", []),
    ("val_int IN ('')", []),
    ("val_int IN (1,2,3,4,5,6,7,8,9,42)", [2]),
    ("val_int IN (NULL, 42)", [2]),
    ("NOT val_int IN (42)", [1]),
    ("NOT val_int IN (7)", [1, 2]),
    ("val_int = 42", [2]),
    ("val_int <> 42", []),
    ("val_int <> 41", [2]),
    ("val_int < 43", [2]),
    ("val_int > 43", []),
    ("val_int <= 42", [2]),
    ("val_int >= 42", [2]),
    ("NOT (val_int = 42)", [1]),
    ("NOT (val_int <> 42)", [1, 2]),
    ("NOT (val_int < 43)", [1]),
    ("NOT (val_int > 43)", [1, 2]),
    ("NOT (val_int <= 42)", [1]),
    ("NOT (val_int >= 42)", [1]),
    ("NOT NOT (val_int = 42)", [2]),
    ("NOT (val_int = 42 AND val_text = 'x')", [1, 2]),
    ("NOT (val_int = 42 OR val_text = 'x')", [1]),
    ("val_int <> NULL", [1]),
    ("val_int = NULL", [1]),
    ("NOT val_int = NULL", [2]),
    ("val_int IS NULL", [1]),
    ("val_int IS NOT NULL", [2]),
    ("NOT (val_int IS NULL)", [2]),
    ("val_bool IS NULL", [1]),
    ("val_bool IS NOT NULL", [2]),
    ("val_bool = TRUE", [2]),
    ("val_bool = -1", []),
    ("val_bool = 0", [1]),
    ("val_bool < 1", [1]),
    ("NOT val_bool = 1", [1]),
    ("val_text LIKE 'not%'", [2]),
    ("NOT val_text LIKE 'not%'", [1]),
    ("val_text ILIKE 'NOT%'", [2]),
    ("val_int LIKE '4%'", []),
    ("NOT val_int LIKE '4%'", [1, 2]),
    ("val_int = 'zz'", []),
    ("NOT val_int = 'zz'", [1, 2]),
    ("val_int = '42'", [2]),
    ("val_int > 41.5", [2]),
    ("val_double = 99.9", [2]),
    ("val_dt = strptime('2026-06-01', '%Y-%m-%d')", [2]),
    ("strptime('2026-06-01', '%Y-%m-%d') <= val_dt", [2]),
    ("val_dt = 1780272000", [2]),
    ("val_dt IN (1780272000)", [2]),
    ("val_dt > 46000.5", [2]),
    ("42 = val_int", [2]),
    ("41 < val_int", [2]),
    ("1 = 1", [1, 2]),
    ("'a' > 'b'", []),
    ("NOT 'a' > 'b'", [1, 2]),
    ("val_int = 42 OR val_int IS NULL AND val_text = 'x'", [2]),
    ("(val_int = 42 OR val_int IS NULL) AND val_bool = 0", [1]),
    ("val_text = not", "error"),
]


@pytest.mark.parametrize(("where", "want"), NULLTEST)
def test_predicates(engine, where, want):
    query = f"SELECT id FROM nulltest WHERE {where} ORDER BY id"
    if want == "error":
        want = []  # a bare word on the right is a string
    assert ids(engine, query) == want


def test_like_against_matcher(spark):
    """Every text over ab up to 4 against every pattern over ab%_ up to 4, by a plain matcher."""

    def matches(text, pattern):
        states = {0}
        closure = lambda s: s | {i + 1 for i in s if i < len(pattern) and pattern[i] == "%"}

        def full(s):
            while (t := closure(s)) != s:
                s = t
            return s

        states = full(states)
        for c in text:
            states = full({i if pattern[i] == "%" else i + 1 for i in states if i < len(pattern) and pattern[i] in ("%", "_", c)})
        return len(pattern) in states

    texts = ["".join(t) for n in range(5) for t in itertools.product("ab", repeat=n)]
    patterns = ["".join(t) for n in range(5) for t in itertools.product("ab%_", repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).cache()
    for at in range(0, len(patterns), 60):
        part = patterns[at : at + 60]
        for row in df.select("t", *[like(df.t, p).alias(f"p{i}") for i, p in enumerate(part)]).collect():
            for i, p in enumerate(part):
                assert row[f"p{i}"] == matches(row.t, p), (row.t, p)


@pytest.mark.parametrize(("text", "pattern", "fold", "want"), [("é", "_", False, False), ("é", "__", False, True), ("Ärger", "är%", True, True), ("a\\b", "a\\b", False, True), ("a\\b", "A\\B", True, True), ("xa\\b", "_a\\_", False, True), ("a" * 4096 + "b", "%a" * 256 + "c", False, False), ("", "%_%", False, False)])
def test_like_cases(spark, text, pattern, fold, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(like(df.t, pattern, fold)).first()[0] is want


def test_text_columns(engine):
    assert ids(engine, "SELECT id FROM typed WHERE val_memo LIKE '%memo%'") == [1]
    assert ids(engine, "SELECT id FROM typed WHERE val_text LIKE '%_%' ORDER BY id") == [1, 2]
    assert ids(engine, "SELECT id FROM chinese WHERE name LIKE '%张%'") == [1]
    assert ids(engine, "SELECT id FROM chinese WHERE name LIKE '张_'") == []
    assert ids(engine, "SELECT id FROM chinese WHERE name LIKE '张___'") == [1]
    assert ids(engine, "SELECT id FROM typed WHERE val_currency >= 1234.5678") == [1]
    assert ids(engine, "SELECT id FROM typed WHERE val_currency IN ('-99.99')") == [2]


def test_order_and_limits(engine):
    assert ids(engine, "SELECT id FROM nulltest ORDER BY val_int ASC") == [1, 2]
    assert ids(engine, "SELECT id FROM nulltest ORDER BY val_int DESC") == [2, 1]
    assert ids(engine, "SELECT TOP 1 id FROM nulltest ORDER BY id DESC") == [2]
    prefixes = ", ".join(f"'{x}'" for x in ("2", "2.4", "2.4.2", "2.4.2.2", "2.4.2.2.1", "2.4.2.2.1.1", "2.4.2.2.1.1.1", "2.4.2.2.1.1.1.9"))
    assert ids(engine, f"SELECT TOP 1 oid FROM mib WHERE oid IN ({prefixes}) ORDER BY Len(oid) DESC") == ["2.4.2.2.1.1.1"]
    assert ids(engine, "SELECT oid FROM mib WHERE oid LIKE '1.2.1%' ORDER BY oid DESC")[0] == "1.2.1.1.1.1"
    assert ids(engine, "SELECT TOP 3 oid FROM mib ORDER BY oid")[0] == "1"
    assert len(ids(engine, "SELECT TOP 50 PERCENT oid FROM mib WHERE line > 0")) == 4
    assert ids(engine, "SELECT oid FROM mib LIMIT 0") == []
    assert len(ids(engine, "SELECT oid FROM mib LIMIT -1")) == 9
    assert ids(engine, "SELECT oid FROM mib LIMIT 1 WHERE line > 3 ORDER BY line DESC") == ["2.4.2.2.1.1.1"]
    assert ids(engine, "SELECT COUNT(*) FROM mib") == ["9"]
    assert ids(engine, "SELECT COUNT(*) FROM mib WHERE is_leaf = 1") == ["4"]
    assert ids(engine, "SELECT TOP 0 COUNT(*) FROM mib") == []


def test_names(engine):
    df = engine.sql('SELECT ID, [Name], "ID" FROM [PEOPLE] ORDER BY id;')
    assert df.columns == ["ID", "Name", "ID"]
    assert [tuple(r) for r in df.collect()] == [(1, "Ada", 1), (2, "Grace", 2)]
    assert [d["type"] for d in describe_result(engine.sql("SELECT * FROM typed").schema)][:5] == ["Long Integer", "Boolean", "Byte", "Integer", "Long Integer"]
    assert {d["name"]: d["length"] for d in describe_result(engine.sql("SELECT val_text, val_memo, id FROM typed").schema)} == {"val_text": 100, "val_memo": None, "id": None}


def test_catalog(engine):
    assert ids(engine, "list tables please") == ["chinese", "mib", "nulltest", "people", "typed"]
    assert [tuple(r) for r in engine.sql("DESCRIBE TABLE People").collect()] == [("id", "Long Integer", "4"), ("name", "Text", "80"), ("active", "Boolean", "0"), ("nickname", "Text", "80"), ("created_at", "DateTime", "8")]
    engine.ping()
    engine.refresh()
    with pytest.raises(UnknownTable, match='table "nope" not found'):
        engine.sql("SELECT * FROM nope")


BAD = [
    "", "SELECT", "SELECT FROM people", "SELECT id people", "SELECT id FROM people WHERE", "SELECT id FROM people WHERE id", "SELECT id FROM people WHERE id IN ()", "SELECT id FROM people ORDER BY",
    "SELECT id FROM people ORDER BY LEN", "SELECT id FROM people ORDER BY LEN(id + 1)", "SELECT id FROM people GROUP BY id", "SELECT id FROM people, typed", "SELECT id FROM people WHERE (id = 1",
    "SELECT id FROM people WHERE id = 99999999999999999999", "SELECT COUNT(id) FROM people", "SELECT TOP 5 id FROM people LIMIT 3", "SELECT TOP 101 PERCENT id FROM people", "SELECT id FROM people WHERE id NOT IN (1)",
    "SELECT id FROM people WHERE id != 1", "SELECT id FROM people WHERE dt = strptime('x', '%Y')", "SELECT id FROM people; SELECT id FROM people", "SELECT [count FROM people", "SELECT id, * FROM people", "UPDATE people",
]


@pytest.mark.parametrize("query", BAD)
def test_syntax_errors(engine, query):
    with pytest.raises(QuerySyntaxError):
        engine.sql(query)


def test_other_errors(engine, spark):
    for query in ("SELECT nope FROM people", "SELECT id FROM people WHERE nope = 1", "SELECT id FROM people ORDER BY nope"):
        with pytest.raises(UnknownColumn, match="not found in table"):
            engine.sql(query)
    for query in ("SELECT id FROM people WHERE created_at = '2020'", "SELECT id FROM people ORDER BY Len(id)", "SELECT id FROM typed WHERE val_bin = 1", "SELECT id FROM typed ORDER BY val_bin", "SELECT id FROM people WHERE 1 = 'a'"):
        with pytest.raises(TypeMismatch):
            engine.sql(query)
    with pytest.raises(ReadOnlyError, match="read-only"):
        engine.execute("DELETE")
    with pytest.raises(ReadOnlyError, match="transactions"):
        engine.begin()
    with pytest.raises(DeskQueryError, match="empty"):
        Engine(spark, " ")


def test_parameters(engine):
    query = "SELECT name FROM people WHERE id = ? AND name = ?"
    assert engine.prepare(query).num_params == 2
    assert engine.prepare("SELECT id FROM people WHERE name = 'a?' AND [name] = \"b?\"").num_params == 0
    assert ids(engine, query, 1, "Ada") == ["Ada"]
    assert ids(engine, query, 1, b"Ada") == ["Ada"]
    assert ids(engine, "SELECT id FROM people WHERE active = ?", True) == [1]
    assert ids(engine, "SELECT id FROM people WHERE nickname = ?", None) == [2]
    assert ids(engine, "SELECT id FROM nulltest WHERE val_double = ?", 99.9) == [2]
    assert ids(engine, "SELECT id FROM nulltest WHERE val_dt = ?", datetime(2026, 6, 1)) == [2]
    assert ids(engine, "SELECT id FROM people WHERE name = ?", "O'Brien' OR 1 = 1") == []
    assert ids(engine, "SELECT id FROM nulltest WHERE val_int IN (?, ?)", None, 42) == [2]
    statement = engine.prepare("SELECT id FROM people WHERE id > ? ORDER BY id DESC")
    assert [list(statement.rows(0)) for _ in range(2)] == [[(2,), (1,)]] * 2
    for values, message in (((1,), "not enough"), ((1, 2, 3), "too many"), ((1, object()), "unsupported")):
        with pytest.raises(ParamError, match=message):
            engine.sql(query, *values)


def test_render_and_floats(engine, spark):
    row = render(engine.sql("SELECT flag, val_datetime, val_currency FROM typed WHERE id = 1")).first()
    assert tuple(row) == ("1", "2026-01-15 08:30:00", "1234.5678")
    rounded = Engine(spark, tables(spark), compat_floats=True).sql("SELECT val_single FROM typed WHERE id = 2").first()[0]
    assert rounded == -2.75


def test_plans(spark):
    engine = Engine(spark, "/root/testdata/sf0.001")
    shown = lambda q: engine.sql(q)._jdf.queryExecution().toString()
    assert "EqualTo(o_custkey,5)" in shown("SELECT o_orderkey FROM orders WHERE o_custkey = 5")
    assert "Or(Not(EqualTo(o_custkey,5)),IsNull(o_custkey))" in shown("SELECT o_orderkey FROM orders WHERE NOT o_custkey = 5")
    assert "StringStartsWith(o_orderpriority,1-)" in shown("SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1-%'")
    top = shown("SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC LIMIT 5")
    assert "TakeOrderedAndProject" in top and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in top
    assert "1998-07-09 16:00:00" in shown("SELECT o_orderkey FROM orders WHERE o_orderdate > 900000000")


def test_stream(spark):
    schema = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").schema
    stream = spark.readStream.schema(schema).parquet("/root/testdata/sf0.001/order*.parquet")
    out = stream_select(stream, "SELECT o_orderkey FROM orders WHERE o_totalprice > ?", 300000)
    query = out.writeStream.format("memory").queryName("large_orders").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("large_orders").count() == Engine(spark, "/root/testdata/sf0.001").sql("SELECT o_orderkey FROM orders WHERE o_totalprice > 300000").count()
    with pytest.raises(DeskQueryError):
        stream_select(stream, "SELECT TOP 5 o_orderkey FROM orders")


@pytest.mark.parametrize("where,want", [
    ("val_int = '4_2'", []), ("val_int = ' 42 '", []), ("val_int = '+42'", [2]), ("val_int = '\u0664\u0662'", []), ("val_double > 'NaN'", []), ("val_double > ' 1'", []),
    ("val_double > '9.99e1'", []), ("val_double >= '99.9'", [2]), ("val_double < '1e3'", [2]), ("val_double = 'inf'", []), ("val_double > '.5'", [2]),
])
def test_quoted_numbers(engine, where, want):
    assert ids(engine, f"SELECT id FROM nulltest WHERE {where}") == want


def test_quoted_decimals(engine):
    assert ids(engine, "SELECT id FROM typed WHERE val_currency > 'NaN'") == []
    assert ids(engine, "SELECT id FROM typed WHERE val_currency < '1e40'") == [1, 2, 3]
    assert ids(engine, "SELECT id FROM typed WHERE val_currency = '1234.5678'") == [1]


@pytest.mark.parametrize("text,pattern,want", [
    ("\u0391\u03a3\u0391", "\u0391\u03a3%", True), ("\u0391\u03a3", "\u03b1\u03c3", True), ("\u0391\u03a3", "%\u03a3", True), ("\u03b1\u03c2", "\u0391\u03a3", False),
    ("\u0130x", "\u0130X", True), ("\u0130", "I", True), ("\u00c4B", "\u00e4_", True),
])
def test_folding_of_single_characters(spark, text, pattern, want):
    assert spark.createDataFrame([(text,)], "t string").select(like(F.col("t"), pattern, True)).first()[0] is want


@pytest.mark.parametrize("query", ["SELECT TOP 2.5 id FROM typed", "SELECT TOP 2.5 PERCENT id FROM typed", "SELECT id FROM typed LIMIT 1.5"])
def test_row_numbers_are_whole(engine, query):
    with pytest.raises(QuerySyntaxError):
        engine.sql(query)


def test_wider_bare_names(spark):
    tables_ = {"t\u00e4ble#1": spark.createDataFrame([(1, 2, 3)], "`\u00fcnit` int, `a@b` int, `#x` int")}
    assert Engine(spark, tables_).sql("SELECT \u00fcnit, a@b, #x FROM t\u00e4ble#1 WHERE a@b = 2").collect() == [(1, 2, 3)]


def test_cursor_leaves_the_thread_alone(engine, spark):
    sc = spark.sparkContext
    cursor = engine.prepare("SELECT id FROM typed ORDER BY id").rows()
    assert [c["name"] for c in cursor.columns] == ["id"]
    assert next(cursor) == (1,) and sc.getLocalProperty("spark.jobGroup.id") is None
    cursor.close()
    assert list(cursor) == [] and spark.range(3).count() == 3


def test_cancellation(spark):
    slow = spark.range(4, numPartitions=4).select(F.udf(lambda i: time.sleep(30) or i, "long")("id").alias("id"))
    cursor, failed = Engine(spark, {"slow": slow}).prepare("SELECT id FROM slow").rows(), []

    def fetch():
        try:
            next(cursor)
        except Exception as error:  # whatever way Spark reports it
            failed.append(error)

    thread = threading.Thread(target=fetch)
    began = time.monotonic()
    thread.start()
    while thread.is_alive() and time.monotonic() - began < 25:
        time.sleep(1)
        cursor.cancel()
    thread.join(5)
    assert failed and time.monotonic() - began < 25 and spark.range(3).count() == 3


def test_connect(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/numbers.parquet")
    engine = Engine(spark, tables(spark))
    assert [r[0] for r in engine.sql(f"CONNECT TO '{tmp_path}'").collect()] == ["numbers"]
    assert engine.sql("SELECT COUNT(*) FROM numbers").first()[0] == "3"
    assert engine.sql("DISCONNECT;").collect() == []
    for query in ("LIST TABLES", "SELECT * FROM numbers"):
        with pytest.raises(DeskQueryError):
            engine.sql(query)
    with pytest.raises(QuerySyntaxError):
        engine.sql("CONNECT numbers")


def test_formats(spark):
    fields = T.StructType([T.StructField("d", T.TimestampNTZType(), True, {"access_type": "DateTime", "Format": "Short Date"}), T.StructField("g", T.StringType(), True, {"access_type": "Replication ID"}), T.StructField("b", T.BooleanType())])
    df = spark.createDataFrame([(datetime(2026, 5, 28, 1, 2, 3), "{A-1}", True)], fields)
    assert render(df).first() == ("2026-05-28", "{A-1}", "1")
    assert render(df, short_date_format="dd.MM.yy", true="Yes", false="No", guid_braces=False).first() == ("28.05.26", "A-1", "Yes")
    assert table_text(df.select("b", "g"), most=1) == "+-+-----+\n|b|g    |\n+-+-----+\n|1|{A-1}|\n+-+-----+"


def test_escaped_values(spark):
    df = spark.createDataFrame([('a"b\\c\r\n\td', bytearray(b"\x00\xffA"), 5), (None, None, None)], "t string, b binary, n int")
    assert escaped(df).collect() == [('"a""b\\c\r\n\td"', '"\x00\xffA"', "5"), (None, None, None)]
    assert escaped(df, escape="\\", binary="hex").first() == ('"a\\"b\\\\c\r\n\td"', '"00FF41"', "5")
    assert escaped(df, control=True, binary="octal").first() == ('"a""b\\\\c\\r\\n\\td"', '"\\000\\377\\101"', "5")
    assert escaped(df, quote_text=False, binary="strip").first() == ('a"b\\c\r\n\td', "", "5")
    with pytest.raises(DeskQueryError):
        escaped(df, binary="no")


@pytest.mark.parametrize("dialect", DIALECTS)
def test_create_table(engine, dialect):
    text = engine.create_table("typed", dialect, namespace="My", drop=True)
    assert text.count("\t\t\t") == 12 and text.startswith("DROP TABLE") and text.endswith(");\n") and "DEFAULT FALSE" in text and "NOT NULL" in text


def test_create_table_texts(spark):
    f = lambda name, kind, **meta: T.StructField(name, kind, True, meta)
    schema = T.StructType([
        f("Id", T.IntegerType(), Required="yes"), f("na`me", T.StringType(), access_type="Text", size=80, DefaultValue='"it\'s"', AllowZeroLength="no", Description="who"),
        f("at", T.TimestampNTZType(), DefaultValue="Date()", Format="Short Date"), f("n", T.DecimalType(10, 2)), f("on", T.BooleanType(), DefaultValue="Yes"),
    ])
    assert create_table("T", schema, "postgres") == (
        'CREATE TABLE IF NOT EXISTS "t"\n (\n\t"id"\t\t\tINTEGER NOT NULL, \n\t"na`me"\t\t\tVARCHAR (40) DEFAULT \'it\'\'s\', \n\t"at"\t\t\tDATE DEFAULT current_date, \n'
        '\t"n"\t\t\tNUMERIC (10, 2), \n\t"on"\t\t\tBOOLEAN NOT NULL DEFAULT TRUE\n);\nALTER TABLE "t" ADD CHECK ("na`me" <>\'\');\nCOMMENT ON COLUMN "t"."na`me" IS \'who\';\n'
    )
    assert "`My_T`" in create_table("T", schema, "mysql", namespace="My") and "`na``me`\t\t\tvarchar (40) DEFAULT 'it''s' COMMENT 'who'" in create_table("T", schema, "mysql")
    assert "[Id]\t\t\tLong Integer NOT NULL" in create_table("T", schema, "access") and "sysdate" not in create_table("T", schema, "oracle") and "DATE DEFAULT current_date" in create_table("T", schema, "oracle")
    with pytest.raises(DeskQueryError):
        create_table("T", schema, "other")
