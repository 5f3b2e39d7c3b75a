"""The dialect's registered queries, each with the SQL that gives the same rows elsewhere."""

from __future__ import annotations

from pyspark.sql import functions as F

from .engine import Engine
from .functions.dates import serial_column
from .functions.render import render
from .sinks.values import escaped

#: The table of events with every third user unknown: the given tables hold no nulls.
_GAPS = "(SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id FROM events) AS gaps"
# name: (dialect text, parameters, equivalent SQL or None for the same text)
_STATEMENTS: dict[str, tuple[str, tuple, str | None]] = {
    "project_star": ("SELECT * FROM region", (), None),
    "project_cols": ("SELECT c_custkey, c_name FROM customer", (), None),
    "project_case_fold": ("SELECT N_NAME FROM nation", (), 'SELECT n_name AS "N_NAME" FROM nation'),
    "project_bracketed": ("SELECT [c_custkey], \"c_acctbal\" FROM [customer] WHERE [c_nationkey] = 7", (), "SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = 7"),
    "scan_lineitem": ("SELECT * FROM lineitem", (), None),
    "scan_two_columns": ("SELECT l_orderkey, l_extendedprice FROM lineitem", (), None),
    "eq_text": ("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'", (), None),
    "eq_bare_word": ("SELECT c_custkey FROM customer WHERE c_mktsegment = BUILDING", (), "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"),
    "neq": ("SELECT p_partkey, p_size FROM part WHERE p_size <> 11", (), None),
    "lt": ("SELECT p_partkey, p_size FROM part WHERE p_size < 5", (), None),
    "gt": ("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000", (), None),
    "lteq": ("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity <= 3", (), None),
    "gteq": ("SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal >= 5000", (), None),
    "int_vs_decimal": ("SELECT p_partkey FROM part WHERE p_size > 24.5", (), None),
    "int_vs_quoted": ("SELECT p_partkey FROM part WHERE p_size = '11'", (), "SELECT p_partkey FROM part WHERE p_size = 11"),
    "text_vs_number": ("SELECT o_orderkey FROM orders WHERE o_orderpriority > 3", (), "SELECT o_orderkey FROM orders WHERE o_orderpriority > '3'"),
    "like_prefix": ("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%'", (), None),
    "like_suffix": ("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%bolt'", (), None),
    "like_contains": ("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ing%'", (), None),
    "like_underscore": ("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '_ed%'", (), None),
    "like_on_number": ("SELECT p_partkey FROM part WHERE p_size LIKE '1%' OR p_size > 45", (), "SELECT p_partkey FROM part WHERE p_size > 45"),
    "ilike": ("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'RED%'", (), None),
    "in_int": ("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey IN (1, 2, 3)", (), None),
    "in_text": ("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')", (), None),
    "in_large": ("SELECT p_partkey FROM part WHERE p_size IN (1, 3, 5, 7, 9, 11, 13, 15, 17, 19, 21, 23)", (), None),
    "in_quoted_number": ("SELECT n_name FROM nation WHERE n_nationkey IN ('1', '2', 'x')", (), "SELECT n_name FROM nation WHERE n_nationkey IN (1, 2)"),
    "in_with_null": ("SELECT n_name FROM nation WHERE n_nationkey IN (NULL, 4)", (), "SELECT n_name FROM nation WHERE n_nationkey IN (4)"),
    "is_null": ("SELECT event_id FROM gaps WHERE user_id IS NULL", (), f"SELECT event_id FROM {_GAPS} WHERE user_id IS NULL"),
    "is_not_null": ("SELECT event_id, user_id FROM gaps WHERE user_id IS NOT NULL", (), f"SELECT event_id, user_id FROM {_GAPS} WHERE user_id IS NOT NULL"),
    "compare_null": ("SELECT event_id FROM gaps WHERE user_id <> NULL", (), f"SELECT event_id FROM {_GAPS} WHERE user_id IS NULL"),
    "not_over_null": ("SELECT event_id FROM gaps WHERE NOT user_id > 50", (), f"SELECT event_id FROM {_GAPS} WHERE user_id IS NULL OR user_id <= 50"),
    "order_nulls": ("SELECT TOP 50 event_id, user_id FROM gaps ORDER BY user_id, event_id", (), f"SELECT event_id, user_id FROM {_GAPS} ORDER BY user_id NULLS FIRST, event_id LIMIT 50"),
    "and_or_precedence": ("SELECT p_partkey FROM part WHERE p_size = 1 OR p_size = 2 AND p_retailprice > 1000", (), None),
    "parens": ("SELECT p_partkey FROM part WHERE (p_size < 20 OR p_size = 22) AND p_retailprice > 905", (), None),
    "not": ("SELECT p_partkey FROM part WHERE NOT (p_size < 40 OR p_name LIKE 'red%')", (), None),
    "not_in": ("SELECT n_name FROM nation WHERE NOT n_nationkey IN (1, 2, 3)", (), "SELECT n_name FROM nation WHERE n_nationkey NOT IN (1, 2, 3)"),
    "date_unix_gt": ("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > 900000000", (), "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1998-07-09 16:00:00'"),
    "date_strptime": ("SELECT o_orderkey FROM orders WHERE o_orderdate = strptime('1998-10-03 00:00:00', '%Y-%m-%d %H:%M:%S')", (), "SELECT o_orderkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-10-03 00:00:00'"),
    "date_serial": ("SELECT o_orderkey FROM orders WHERE o_orderdate >= 36161.0", (), "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1899-12-30' + INTERVAL 36161 DAY"),
    "date_in": ("SELECT o_orderkey FROM orders WHERE o_orderdate IN (907372800)", (), "SELECT o_orderkey FROM orders WHERE o_orderdate = TIMESTAMP '1998-10-03 00:00:00'"),
    "literal_first": ("SELECT p_partkey FROM part WHERE 5 > p_size", (), "SELECT p_partkey FROM part WHERE p_size < 5"),
    "literal_literal": ("SELECT r_name FROM region WHERE 1 = 1 AND 'a' < 'b'", (), None),
    "order_multi_desc": ("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority ASC, o_orderkey DESC LIMIT 100", (), None),
    "order_len": ("SELECT TOP 20 p_partkey, p_name FROM part ORDER BY Len(p_name) DESC, p_partkey", (), "SELECT p_partkey, p_name FROM part ORDER BY length(p_name) DESC, p_partkey LIMIT 20"),
    "order_unprojected": ("SELECT p_name FROM part ORDER BY p_partkey DESC LIMIT 15", (), None),
    "top_n": ("SELECT TOP 10 o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey", (), "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
    "top_percent": ("SELECT TOP 1 PERCENT o_orderkey FROM orders WHERE o_totalprice > 1000 ORDER BY o_orderkey", (), "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders WHERE o_totalprice > 1000) WHERE n <= (SELECT trunc(count(*) / 100.0 * 1) FROM orders)"),
    "limit": ("SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 25", (), None),
    "clauses_any_order": ("SELECT c_custkey FROM customer LIMIT 25 ORDER BY c_custkey WHERE c_nationkey = 3", (), "SELECT c_custkey FROM customer WHERE c_nationkey = 3 ORDER BY c_custkey LIMIT 25"),
    "count_star": ("SELECT COUNT(*) FROM lineitem", (), 'SELECT CAST(count(*) AS VARCHAR) AS "count" FROM lineitem'),
    "count_star_where": ("SELECT COUNT(*) FROM lineitem WHERE l_quantity > 25", (), 'SELECT CAST(count(*) AS VARCHAR) AS "count" FROM lineitem WHERE l_quantity > 25'),
    "param_query": ("SELECT c_custkey, c_name FROM customer WHERE c_nationkey = ? AND c_mktsegment = ?", (7, "BUILDING"), "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'BUILDING'"),
    "param_quote": ("SELECT c_custkey FROM customer WHERE c_name <> ?", ("O'Brien",), "SELECT c_custkey FROM customer WHERE c_name <> 'O''Brien'"),
    "list_tables": ("LIST TABLES", (), "SELECT * FROM (VALUES ('benchmark'), ('conversations'), ('customer'), ('documents'), ('embeddings'), ('events'), ('labels'), ('lineitem'), ('nation'), ('orders'), ('pages'), ('part'), ('region'), ('supplier')) AS t(\"Tables\")"),
    "describe_table": ("DESCRIBE TABLE nation", (), "SELECT * FROM (VALUES ('n_nationkey', 'Long Integer', '4'), ('n_name', 'Text', '510'), ('n_regionkey', 'Long Integer', '4')) AS t(\"Column Name\", \"Type\", \"Size\")"),
}


def _ddl(spark, sf_dir: str):
    return spark.createDataFrame([(Engine(spark, sf_dir).create_table("region", "postgres"),)], "ddl string")


def _serials(spark, sf_dir: str):
    return Engine(spark, sf_dir).sql("SELECT o_orderkey, o_orderdate FROM orders").select("o_orderkey", serial_column(F.col("o_orderdate")).alias("serial"))


#: Calls beside the statements, and the SQL that gives the same rows.
_CALLS = {
    "connect": (lambda spark, sf_dir: Engine(spark, {}).sql(f"CONNECT TO '{sf_dir}'"), _STATEMENTS["list_tables"][2]),
    "export_values": (lambda spark, sf_dir: escaped(Engine(spark, sf_dir).sql("SELECT n_nationkey, n_name FROM nation"), quote="A"), "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, 'A' || replace(n_name, 'A', 'AA') || 'A' AS n_name FROM nation"),
    "export_ddl": (_ddl, """SELECT replace(replace('CREATE TABLE IF NOT EXISTS "region"| (|~"r_regionkey"~~~INTEGER, |~"r_name"~~~VARCHAR (255)|);|', '|', chr(10)), '~', chr(9)) AS ddl"""),
    "render_dates": (lambda spark, sf_dir: render(Engine(spark, sf_dir).sql("SELECT o_orderkey, o_orderdate FROM orders")), "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders"),
    "serial_dates": (_serials, "SELECT o_orderkey, (epoch(o_orderdate) + 2209161600) / 86400 AS serial FROM orders"),
}


def _source(spark, sf_dir: str, text: str):
    if " gaps" not in text:
        return sf_dir
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return {"gaps": events.select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"))}


def queries() -> dict:
    return {name: lambda spark, sf_dir, text=text, params=params: Engine(spark, _source(spark, sf_dir, text)).sql(text, *params) for name, (text, params, _) in _STATEMENTS.items()} | {name: call for name, (call, _) in _CALLS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: other or text for name, (text, _, other) in _STATEMENTS.items()} | {name: sql for name, (_, sql) in _CALLS.items()}
