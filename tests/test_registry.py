import duckdb
import pytest

from deskquery import queries as dialect

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", dialect.queries())
def test_same_rows(spark, duck, name):
    ours = dialect.queries()[name](spark, SF)
    theirs = duck.sql(dialect.oracle_sql()[name])
    assert ours.columns == theirs.columns
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, theirs.fetchall()))
