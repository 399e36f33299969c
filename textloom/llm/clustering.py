"""Centroid clustering by weighted deduplication.

Vectors become whole numbers; equal ones become one row with its multiplicity, so copies, however many,
cost what one vector costs. Lloyd's rounds run over the distinct vectors: tasks assign them, sum them up
by cluster as weighted whole numbers and hand on one row for each cluster; only sums of k clusters come
to the driver, where centroids are divided exactly. The assignments then join back to the ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_keys, join_heavy, table, tidy, written

KEY = ["h1", "h2"]
LARGEST = 2**63 - 1
CLUSTERED = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def nearest_centroid(q: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's nearest centroid (of equally near ones the smallest) and the squared distance, exact."""
    most = max(int(np.abs(q).max(initial=0)), max(abs(x) for c in centroids for x in c))
    bound = 4 * most * most * q.shape[1]  # of a squared distance and of each part of it
    if bound < 2**53:  # whole numbers that doubles hold, whatever the order of sums
        x, c = q.astype(np.float64), np.array(centroids, dtype=np.float64)
        d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    else:
        kind = np.int64 if bound < 2**63 else object
        x = q.astype(kind)
        d = np.stack([((x - np.array(c, dtype=kind)) ** 2).sum(axis=1) for c in centroids], axis=1)
    cluster = d.argmin(axis=1)
    best = d[np.arange(len(d)), cluster]
    return cluster.astype(np.int32), np.array([min(int(b), LARGEST) for b in best], dtype=np.int64) if best.dtype == object else best.astype(np.int64)


def cluster_sums(q: np.ndarray, n: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Weighted sums of each cluster's vectors, of whole numbers of any size."""
    small = int(np.abs(q).max(initial=0)) * int(n.sum()) < 2**62
    out = np.zeros((k, q.shape[1]), dtype=np.int64 if small else object)
    np.add.at(out, cluster, q * n[:, None] if small else q.astype(object) * n.astype(object)[:, None])
    return out.astype(object)


def matrix(batch: pa.RecordBatch, name: str, dims: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def moved(distinct: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floor(sum / count) of their vectors; those without any stay."""
    k, dims = len(centroids), len(centroids[0])

    @tidy
    def sums(batches):
        total, count = np.zeros((k, dims), dtype=object), [0] * k
        for batch in batches:
            if not len(batch):
                continue
            q, n = matrix(batch, "q", dims), batch.column("n").to_numpy()
            cluster, _ = nearest_centroid(q, centroids)
            total += cluster_sums(q, n, cluster, k)
            for c in np.unique(cluster).tolist():
                count[c] += int(n[cluster == c].sum())
        full = [c for c in range(k) if count[c]]
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([count[c] for c in full], pa.int64()), pa.array([[str(x) for x in total[c]] for c in full], pa.list_(pa.string()))], names=["cluster", "n", "sums"])

    parts = distinct.select("q", "n").mapInArrow(sums, "cluster int, n long, sums array<string>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    new = [list(c) for c in centroids]
    for r in each.collect():  # k * dims rows at most
        new[r["cluster"]][r["i"]] = int(r["s"]) // r["n"]
    return new


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2", id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector that takes part.

    Those are the vectors of exactly `dims` components, none of them null or non-finite; each component x
    becomes floor(scale * x). The first centroids are the k vectors with the smallest sha256 of
    `<seed>:<id>`, ties by the vector; rounds assign (ties to the smaller number) and move centroids to
    floor(sum / count); then vectors are assigned once more. distance is squared; the inertias are its
    sums over a cluster and over all.

    Repeated rows are several vectors, each with its row; null ids are clustered like others but start
    no centroid (without any other id there are none, and no rows). With fewer vectors than k there are
    as many centroids as vectors. Components that no 64-bit whole number holds when scaled (2**62 and
    more) count as non-finite; sums of squares beyond 64 bits are given as the largest long. Other
    columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < 2.0**62))
    rows = v.filter((F.size("v") == dims) & good).select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("q"))
    rows = rows.withColumns({"h1": F.xxhash64("q"), "h2": F.xxhash64(F.lit(1), F.col("q"))})
    first = rows.filter(F.col("vec_id").isNotNull()).orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256), "q").limit(k)
    centroids = [list(r["q"]) for r in first.select("q").collect()]
    if not centroids:
        return spark.createDataFrame([], CLUSTERED)
    distinct = written(rows.groupBy("q").agg(F.count("*").alias("n"), F.first("h1").alias("h1"), F.first("h2").alias("h2")))
    for _ in range(rounds):
        centroids = moved(distinct, centroids)

    @tidy
    def assign(batches):
        for batch in batches:
            if len(batch):
                cluster, distance = nearest_centroid(matrix(batch, "q", dims), centroids)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*KEY, "n")), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=[*KEY, "n", "cluster", "distance"])

    assigned = written(distinct.select("q", *KEY, "n").mapInArrow(assign, "h1 long, h2 long, n long, cluster int, distance long"))
    weighted = F.sum(F.col("distance").cast("decimal(38,0)") * F.col("n"))
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(weighted.alias("s")).collect()}  # k rows at most
    held = lambda x: min(x, LARGEST)
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    clusters = spark.createDataFrame([(c, held(s), held(sum(sums.values())), digest(c)) for c, s in sorted(sums.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    known = assigned.join(F.broadcast(clusters), "cluster")  # k rows
    heavy = heavy_keys(assigned.select(*KEY, "n"), KEY)
    back = join_heavy(rows.select("vec_id", *KEY), known.drop("n"), KEY, heavy, ["vec_id"])
    return back.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clustering(spark, sf_dir):
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


ROUND = """a{n} AS MATERIALIZED (
    SELECT r, q, c FROM (
        SELECT v.r, v.q, k.c, row_number() OVER (PARTITION BY v.r ORDER BY list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - k.q[i]) * (v.q[i] - k.q[i]))), k.c) AS place FROM v, c{n} k
    ) WHERE place = 1
), s{n} AS (
    SELECT c, i, sum(x) AS s, count(*) AS m FROM (SELECT c, unnest(q) AS x, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY c, i
), c{next} AS MATERIALIZED (
    SELECT c, q FROM c{n} WHERE c NOT IN (SELECT c FROM s{n})
    UNION ALL SELECT c, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) FROM s{n} GROUP BY c
)"""

ORACLE_OP12 = f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS c, q FROM v WHERE vec_id IS NOT NULL ORDER BY c LIMIT 40
), {', '.join(ROUND.format(n=n, next=n + 1) for n in range(5))}, d AS (
    SELECT v.r, v.vec_id, k.c, list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - k.q[i]) * (v.q[i] - k.q[i]))) AS d FROM v, c5 k
), b AS (
    SELECT vec_id, c, CAST(d AS BIGINT) AS d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM d) WHERE place = 1
)
SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(c5.q, ',')) AS centroid_sha256 FROM b JOIN c5 USING (c)
"""
