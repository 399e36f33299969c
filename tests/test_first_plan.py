"""Queries as the first plan of a session, whose columns have the lowest numbers."""

import subprocess
import sys

import duckdb
import pytest

from textloom.plans.catalog import ORACLE_SQL

RUN = """
import sys
from pyspark.sql import SparkSession
from textloom.plans.catalog import QUERIES

spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
print("ids", *(r["id"] for r in QUERIES[sys.argv[1]](spark, sys.argv[2]).collect()))
"""


@pytest.mark.parametrize("name", ["token_order_violations"])
def test_query_as_first_plan(sf_dir, tmp_path, name):
    done = subprocess.run([sys.executable, "-c", RUN, name, sf_dir], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = [r[0] for r in con.execute(ORACLE_SQL[name]).fetchall()]
    assert sorted(done.stdout.split("ids", 1)[1].split()) == sorted(want) and want
