"""Every registered query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

from textloom.plans.catalog import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(pdf):
    cols = sorted(pdf.columns)
    plain = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    fix = lambda v: round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return cols, sorted(tuple(map(repr, map(fix, r))) for r in plain.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_statement(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert rows(got) == rows(duck.execute(ORACLE_SQL[name]).df())
