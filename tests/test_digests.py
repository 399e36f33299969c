"""Digests of groups against plain ones."""

import hashlib
import random

from pyspark.sql import functions as F

from textloom.functions import digests as D
from textloom.sources import readers


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_digests_of_groups(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "", None]), rng.choice([1, 2]), i // 2, rng.choice(["é", "x\n", "", "long " * 50]), f"{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "k string, m int, ord long, line string, id string").repartition(7)
    for batch in ("10000", "3"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = {(r["k"], r["m"]): r["digest"] for r in D.ordered_digest(df, ["k", "m"], "ord", F.col("line"), between="|").collect()}
            one = [r["digest"] for r in D.ordered_digest(df, [], "ord", F.col("line")).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        groups = {}
        for k, m, o, line, _ in rows:
            groups.setdefault((k, m), []).append((o, line))
        assert got == {key: sha("|".join(t for _, t in sorted(v))) for key, v in groups.items()}
        assert one == [sha("".join(t for _, t in sorted((r[2], r[3]) for r in rows)))]
    assert D.ordered_digest(df.limit(0), ["k"], "ord", F.col("line")).count() == 0


def test_a_long_group_streams_by(spark):
    """A group of 400 MB, in a task that could not hold its lines twice over, beside small ones."""
    n = 400_000
    rows = spark.range(n + 100).select((F.col("id") >= n).alias("small"), "id", F.concat("id", F.repeat(F.lit("y"), 1000)).alias("line"))
    got = {r["small"]: r["digest"] for r in D.ordered_digest(rows, ["small"], "id", F.col("line")).collect()}
    whole = hashlib.sha256()
    for i in range(n):
        whole.update(f"{i}{'y' * 1000}".encode())
    assert got[False] == "sha256:" + whole.hexdigest() and got[True] == sha("".join(f"{i}{'y' * 1000}" for i in range(n, n + 100)))


def test_manifest_of_nothing(spark):
    empty = spark.createDataFrame([], "path string, size long, sha256 string")
    assert tuple(readers.manifest_totals(empty).first()) == (0, 0, hashlib.sha256().hexdigest())
