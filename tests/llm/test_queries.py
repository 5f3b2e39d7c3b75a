"""The registered queries against DuckDB, and the pipeline against its stages' plain forms."""

import duckdb
import pytest

import corpus_pipeline
from deskquery.llm import registry
from deskquery.llm.queries_op01 import HITS_SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_same_rows(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    theirs = connection.sql(registry.oracle_sql()[name])
    ours = registry.queries()[name](spark, SF).select(*theirs.columns)
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, theirs.fetchall()))


LEAK = "the quick brown window of a benchmark item that leaks"


def odd_documents(spark):
    """Rows with nulls, empty and long texts, repeated rows, and names that operators use inside."""
    plain = " ".join(f"word{i}" for i in range(80)) + " end"
    texts = [(1, plain), (1, plain), (2, plain + " more"), (3, None), (4, ""), (None, "null id " + " ".join(f"n{i}" for i in range(70))), (5, " ".join(f"other{i}" for i in range(60)) + f" {LEAK} done"),
             (6, " ".join(f"mail{i}" for i in range(60)) + " a@b.org"), (7, " ".join(f"long{i} text" for i in range(40_000))), (8, None)]
    names = "doc_id long, text string, lang string, source string, n_chars int, n_words int, _m string, _c int, _s int, _id long, _hash long, _method string, `a.b` int, row string, failed long, spans int"
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), 7, "m", 1, 2, 3, 4, "x", 5, "r", 6, 8) for i, t in texts], names)


def test_stages_on_odd_documents(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, LEAK), (None, "xyz")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rules, near, clean, redacted, encoded = (f for _, f in corpus_pipeline.STAGES)
    docs = odd_documents(spark)
    own = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]

    def run(stage, df):
        out = stage(spark, df, sf)
        assert out.columns == df.columns and stage(spark, df.limit(0), sf).count() == 0
        rows = out.collect()
        assert all([r[c] for c in own] == [None, "s", 7, "m", 1, 2, 3, 4, "x", 5, "r", 6, 8] for r in rows)
        return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0))

    assert [r.doc_id for r in run(rules, docs)] == [None, 1, 1, 2, 5, 6, 7]
    assert [r.doc_id for r in run(near, docs)] == [None, 1, 3, 5, 6, 7]
    assert [r.doc_id for r in run(clean, docs)] == [None, 1, 1, 2, 3, 4, 6, 7, 8]  # a passage of one item is enough
    texts = {r.doc_id: (r.text, r.n_chars) for r in run(redacted, docs)}
    assert texts[6][0].endswith(" <email>") and texts[6][1] == len(texts[6][0]) and texts[3] == (None, None) and texts[4] == ("", 0)
    out = encoded(spark, docs, sf).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in docs.collect())
    assert all((r.n_pieces == 0) == (r.doc_id in (3, 4, 8)) for r in out)


def test_pipeline(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    rules, near, clean, redacted, _ = (f for _, f in corpus_pipeline.STAGES)
    kept = rules(spark, d, SF)
    assert kept.columns == d.columns and 0 < kept.count() < d.count()
    one = near(spark, kept, SF)
    assert one.columns == d.columns and one.count() <= kept.count()
    fit = clean(spark, one, SF)
    assert fit.columns == d.columns
    connection = duckdb.connect()
    for t in ("documents", "benchmark"):
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    leaked = {r[0] for r in connection.sql(f"WITH {HITS_SQL.format(docs='documents')} SELECT DISTINCT doc_id FROM hit").fetchall()}
    assert {r.doc_id for r in fit.collect()} == {r.doc_id for r in one.collect()} - leaked
    masked = redacted(spark, fit, SF)
    assert masked.columns == d.columns and masked.count() == fit.count()
    out = corpus_pipeline.run(spark, SF)
    texts = {r.doc_id: r.text for r in masked.collect()}
    rows = out.collect()
    assert {r.doc_id for r in rows} == set(texts)
    import zlib

    assert all(r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)


@pytest.mark.parametrize("name", registry.queries())
def test_every_document(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op9") else ("documents", "doc_id")
    want = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = [r[0] for r in registry.queries()[name](spark, SF).select(key).collect()]
    assert len(got) == len(want) and set(got) == want
