"""Cuts by buckets against a plain loop and against the folds."""

import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import cuts, planning


def plain_parts(lengths, most):
    part, held, out = 0, 0, []
    for i, n in enumerate(lengths):
        if i and held + n > most:
            part, held = part + 1, 0
        held += n
        out.append(part)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_maps_compose(seed):
    """Buckets of any size, put together, cut as one loop over all."""
    rng = random.Random(seed)
    import numpy as np

    most = rng.choice([1, 5, 20, 100])
    lengths = [rng.choice([0, 0, 1, rng.randint(0, most), most, most + rng.randint(1, 9)]) for _ in range(rng.randint(1, 80))]
    edges = sorted({0, len(lengths), *(rng.randint(0, len(lengths)) for _ in range(rng.randint(0, 12)))})
    buckets = [lengths[a:b] for a, b in zip(edges[:-1], edges[1:])]
    rows = [(("g",), b, *m) for b, part in enumerate(buckets) for m in cuts.bucket_map(np.array(part), most)]
    got = list(cuts.carried(iter(rows)))
    want, held, parts = plain_parts(lengths, most), [], []
    for a in edges[:-1]:
        start = want.index(want[a - 1]) if a else 0
        held.append(sum(lengths[start:a]) if a else None)
        parts.append(want[a - 1] if a else 0)
    assert [(g[2], g[3]) for g in got[:-1]] == list(zip(held, parts))
    assert got[-1] == (("g",), None, sum(n for n, p in zip(lengths, want) if p == want[-1]), want[-1] + 1)


def units(spark, seed, n=700):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), i * rng.choice([1, 1, 3]) + 5000 * (i // 100), f"e{i}", "x" * rng.choice([0, 1, 3, 9, rng.randint(0, 60)]), rng.random() < 0.3, f"s{i // rng.choice([3, 50])}") for i in range(n)]
    rows = list({r[1]: r for r in rows}.values())
    return spark.createDataFrame(rows, "grp int, ord long, id string, text string, boundary_before boolean, scene_id string").repartition(5)


@pytest.mark.parametrize(("seed", "most", "bucket"), [(1, 40, 10), (2, 7, 1), (3, 100_000, 50), (4, 25, 100_000)])
def test_long_groups_equal_folds(spark, seed, most, bucket):
    df = units(spark, seed)
    rows = lambda x: sorted(map(tuple, x.collect()), key=repr)
    assert rows(planning.greedy_parts(df, most, long=100, bucket=bucket)) == rows(planning.greedy_parts(df, most))
    chunks = ["grp", "ord", "id", "chunk", "forced"]
    assert rows(planning.chunk_rows(df, "grp", most, long=100, bucket=bucket).select(*chunks)) == rows(planning.chunk_rows(df, "grp", most).select(*chunks))


def test_one_group_of_many_records(spark):
    """No task and no row holds the group; cuts are where prefix sums say."""
    n, most = 2_000_000, 45_000
    rows = spark.range(n).select(F.lit("g").alias("grp"), F.col("id").alias("ord"), (F.pmod(F.xxhash64("id"), F.lit(200))).alias("n"), (F.col("id") % 11 == 0).alias("natural"))
    got = planning.bucketed_parts(rows, most, "grp", 100_000).groupBy("part").agg(F.min("ord").alias("a"), F.max("ord").alias("b"), F.count("*").alias("k"), F.max("forced").alias("f")).orderBy("part").collect()
    lengths = [r["n"] for r in rows.orderBy("ord").select("n").collect()]
    starts = [0]
    held = 0
    for i, x in enumerate(lengths):
        if held + x > most:
            starts.append(i)
            held = 0
        held += x
    assert [r["a"] for r in got] == starts and [r["b"] for r in got] == [*(s - 1 for s in starts[1:]), n - 1] and all(r["k"] == r["b"] - r["a"] + 1 for r in got)
    torn = [s % 11 != 0 and s > 0 for s in starts] + [False]
    assert [r["f"] for r in got] == [torn[i] or torn[i + 1] for i in range(len(starts))]
