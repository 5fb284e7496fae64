"""Every query with SQL gives DuckDB's rows; the others run."""

import duckdb
import pytest

from storyloom.plans import asset_queries, entity_queries, report_queries, sequence_queries, text_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = text_queries.Q | entity_queries.Q | sequence_queries.Q | asset_queries.Q | report_queries.Q
SQL = text_queries.SQL | entity_queries.SQL | sequence_queries.SQL | asset_queries.SQL | report_queries.SQL


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF).toPandas()
    if name in SQL:
        assert rows(found) == rows(duck.sql(SQL[name]).df())
