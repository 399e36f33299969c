import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import clustering, rangejoin

SCHEMA = "vec_id long, embedding array<double>, label int, n string, cell string, h1 string"
NAN, INF = float("nan"), float("inf")


def table_of(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA).repartition(parts)


# near vectors


def cosine(a, b):
    total = lambda x, y: sum((p * q for p, q in zip(x, y)), 0.0)
    big = lambda v: [math.ldexp(x, -math.frexp(max(map(abs, v)))[1]) for x in v]
    a, b = big(a), big(b)
    return total(a, b) / (math.sqrt(total(a, a)) * math.sqrt(total(b, b)))


def plain_links(rows, least):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    near = {i: [j for j in range(len(rows)) if j != i and ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= least] for i in range(len(rows))}
    seen, out = set(), []
    for i in range(len(rows)):
        if i in seen:
            continue
        group, work = {i}, [i]
        while work:
            for j in near[work.pop()]:
                if j not in group:
                    group.add(j)
                    work.append(j)
        seen |= group
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            c = min(ids) if ids else None
            out.append((rows[j][0], len(near[j]), c, rows[j][0] is not None and rows[j][0] == c))
    return sorted(out, key=repr)


def mixed_rows(seed, n=140, dims=8):
    rng = random.Random(seed)
    point = lambda d: [rng.gauss(0, 1) for _ in range(d)]
    base = [point(dims) for _ in range(12)]
    rows = [(k, point(dims)) for k in range(40)]
    for k in range(40, n):
        b = rng.choice(base)
        rows.append((k, [x + rng.gauss(0, rng.choice([0.01, 0.1, 0.3])) for x in b]))
    rows += [(200 + k, list(base[0])) for k in range(15)] + [(230, [3 * x for x in base[0]]), (231, [-x for x in base[0]]), (5, list(base[1])), (5, list(base[1]))]
    rows += [(None, list(base[2])), (None, point(3)), (300, None), (301, []), (302, [0.0] * dims), (303, [NAN] + [1.0] * (dims - 1)), (304, [None] + [1.0] * (dims - 1)), (305, [INF] + [1.0] * (dims - 1)), (None, None)]
    rows += [(310, [1e200, 1e200]), (311, [1.0, 1.0]), (312, [1e-200, 1e-200]), (313, [-0.0, 1.0]), (314, [0.0, 1.0]), (315, [5.0]), (316, [2.0]), (317, [-2.0])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "least", "cell_rows"), [(1, 0.9, 8192), (2, 0.9, 16), (3, 0.5, 16)])
def test_links_equal_brute_force(spark, seed, least, cell_rows):
    rows = mixed_rows(seed)
    got = rangejoin.near_vectors(table_of(spark, rows), least, cell_rows=cell_rows, least_rows=min(128, cell_rows))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_links(rows, least)


def test_links_of_nothing(spark):
    assert rangejoin.near_vectors(table_of(spark, []).limit(0)).count() == 0
    assert [tuple(r) for r in rangejoin.near_vectors(table_of(spark, [(7, None)])).collect()] == [(7, 0, 7, True)]


def test_many_copies_and_chains(spark):
    """A third of the rows is one vector; a chain of near vectors is one component."""
    turn = lambda k: [math.cos(k * 0.4), math.sin(k * 0.4), 0.0]
    rows = [(k, turn(k)) for k in range(6)] + [(100 + k, [0.0, 0.0, 1.0]) for k in range(3000)]
    got = {r["vec_id"]: r for r in rangejoin.near_vectors(table_of(spark, rows)).collect()}
    assert [got[k]["n_links"] for k in range(6)] == [1, 2, 2, 2, 2, 1] and {got[k]["component_id"] for k in range(6)} == {0}
    assert all(got[k]["n_links"] == 2999 and got[k]["component_id"] == 100 for k in range(100, 3100))
    assert sorted(k for k in got if got[k]["kept"]) == [0, 100]


def test_cells_send_what_may_be_near_and_little_else():
    """No pair in range is lost; where vectors lie in groups, few are sent to other cells."""
    rng = np.random.default_rng(5)
    centres = rangejoin.units(rng.normal(size=(20, 16)))
    u = rangejoin.units(np.repeat(centres, 50, axis=0) + rng.normal(size=(1000, 16)) * 0.08)
    for least in (0.9, 0.7):
        cells = rangejoin.Cells({16: rangejoin.spread_out(u, 20)}, least)
        home, angle = cells.home(u)
        cells.radius = {(16, c): float(angle[home == c].max()) for c in np.unique(home).tolist()}
        together = np.zeros((20, 1000), dtype=bool)
        together[home, np.arange(1000)] = True
        sent = 0
        for c, at in cells.sent(u, home):
            together[c, at] = True
            sent += len(at)
        near = u @ u.T >= least
        assert not (near & ~(together.T.astype(int) @ together.astype(int) > 0)).any()
        for i, j in zip(*np.nonzero(near), strict=True):
            assert together[min(home[i], home[j]), i] and together[min(home[i], home[j]), j]
        if least == 0.9:
            assert sent < 0.5 * len(u)


def test_the_bound_decides_in_double_precision():
    x = np.array([[1.0, 0.0], [0.6, 0.8]])
    y = np.array([[0.9, math.sqrt(1 - 0.81)], [0.8999999, math.sqrt(1 - 0.8999999**2)], [0.9000001, math.sqrt(1 - 0.9000001**2)]])
    links_x, links_y, forest = rangejoin.tile_links(x, y, np.array([1, 2]), np.array([1, 10, 100]), 0.9, False)
    want = rangejoin.exact_cosines(np.repeat(x, 3, axis=0), np.tile(y, (2, 1))).reshape(2, 3) >= 0.9
    assert want[0].tolist() in ([True, False, True], [False, False, True])
    assert links_x.tolist() == (want @ [1, 10, 100]).tolist() and links_y.tolist() == ([1, 2] @ want).tolist()
    assert len(set(forest.roots(np.array([0, 4])).tolist())) == 1


# clustering


def plain_clusters(rows, k, rounds, dims, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    cs = [q for _, q in first]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda q: min((far(q, c), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        own = [best(q)[1] for _, q in kept]
        for c in range(len(cs)):
            mine = [q for (_, q), o in zip(kept, own) if o == c]
            if mine:
                cs[c] = [sum(x) // len(mine) for x in zip(*mine)]
        # all vectors were assigned before any centroid moved
    last = [best(q) for _, q in kept]
    held = lambda x: min(x, 2**63 - 1)
    return sorted(
        ((i, n, held(d), held(sum(held(e) for e, m in last if m == n)), held(sum(held(e) for e, _ in last)), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, last, strict=True)), key=repr
    )


@pytest.mark.parametrize(("size", "k"), [(1.0, 5), (1e5, 5), (1e7, 3), (1e15, 3)])
def test_clusters_equal_brute_force(spark, size, k):
    rng = random.Random(int(math.log10(size)))
    point = lambda: [rng.gauss(0, size) for _ in range(6)]
    base = [point() for _ in range(4)]
    rows = [(i, point()) for i in range(60)] + [(100 + i, list(base[i % 4])) for i in range(60)] + [(3, list(base[0])), (3, list(base[0]))]
    rows += [(None, point()), (400, None), (401, []), (402, [1.0] * 5), (403, [NAN] * 6), (404, [None] * 6), (405, [INF] * 6), (406, [-0.001] * 6), (407, [0.0] * 6)]
    got = clustering.cluster_vectors(table_of(spark, rows), k=k, rounds=4, dims=6)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, k, 4, 6)


def test_clusters_of_few_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0, 5.0])]
    got = clustering.cluster_vectors(table_of(spark, rows), k=40, rounds=5, dims=2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, 40, 5, 2)
    assert clustering.cluster_vectors(table_of(spark, rows), dims=3).count() == 0
    assert clustering.cluster_vectors(table_of(spark, rows).limit(0), dims=2).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert clustering.cluster_vectors(table_of(spark, [(None, [1.0, 2.0])]), dims=2).count() == 0


def test_a_hot_vector_is_one_row(spark):
    rows = [(i, [0.5, 0.25]) for i in range(2000)] + [(5000 + i, [float(i), 1.0]) for i in range(50)]
    got = clustering.cluster_vectors(table_of(spark, rows), k=4, rounds=3, dims=2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_clusters(rows, 4, 3, 2)


@pytest.mark.parametrize(("query", "sql"), [(rangejoin.op11_near_vectors, rangejoin.ORACLE_OP11), (clustering.op12_clustering, clustering.ORACLE_OP12)])
def test_vector_queries_equal_their_statements(spark, tmp_path, sf_dir, query, sql):
    """Over the given table, with near copies, copies and bad vectors added."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    near = e.filter("vec_id % 5 = 0").select((F.col("vec_id") + 10_000).alias("vec_id"), F.transform("embedding", lambda x: (x * (F.lit(1.0) + F.pmod(F.floor(x * 1000), F.lit(7)) / 20)).cast("float")).alias("embedding"), "label")
    bad = spark.createDataFrame([(20_000, None, 1), (20_001, [0.0] * 64, 1), (20_002, [NAN] * 64, 1), (20_003, [1.0] * 3, 1), (20_004, [], 1)], "vec_id long, embedding array<float>, label int")
    e.union(near).union(e.filter("vec_id < 40").withColumn("vec_id", F.col("vec_id") + 30_000)).union(bad).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(sql)
    columns = sorted(d[0] for d in want.description)
    expected = sorted(map(tuple, con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()), key=repr)
    got = query(spark, str(tmp_path))
    assert sorted(got.columns) == columns
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == expected
    if "n_links" in columns:
        assert got.filter("n_links > 0").count() > 100
