"""Nearest neighbours by a block matrix join of int8 tiles.

Distinct vectors are quantised once to int8 codes with a scale and the norm of what was lost; only
these are dealt out. For each pair of blocks one tile of int8 products gives every distance with a
bound on its quantisation error. Pairs whose lower bound beats the k-th upper bound of their query
survive, first in the tile and then, as heaps merge the tiles' bounds, in all; originals are fetched
for survivors alone, whose distances are computed in double precision. Results are exact, so recall
against brute force is 1.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import heavy_keys, join_heavy, shuffle_parts, table, tidy, written

KEY = ["h1", "h2"]
BOUNDS = "q1 long, q2 long, c1 long, c2 long, id long, low double, high double"


def quantised(x: np.ndarray):
    """int8 codes with one scale a row, the decoded rows' norms, the norms of what was lost, and the rows' own norms squared."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, np.sqrt((back**2).sum(axis=1)), np.sqrt(((x - back) ** 2).sum(axis=1)), (x**2).sum(axis=1)


def least_distinct(high: np.ndarray, ids: np.ndarray, need: int) -> float:
    """The least bound below which rows of `need` distinct ids lie; infinite with fewer."""
    order = np.argsort(high, kind="stable")
    _, at = np.unique(ids[order], return_index=True)
    return high[order[np.sort(at)[need - 1]]] if len(at) >= need else np.inf


def tile_bounds(q: tuple, c: tuple, ids: np.ndarray, need: int, strip: int = 256):
    """For each strip of queries: query and candidate places with lower and upper bounds of their
    squared distances, of the pairs that may be among the nearest of `need` ids.

    q and c are (codes, scale, norm, lost, size) of many rows.
    """
    (cq, sq, nq, eq, zq), (cc, sc, nc, ec, zc) = q, c
    # products of int8 codes summed over a row are whole numbers that float32 holds up to 2**24
    kind = np.float32 if cq.shape[1] * 127 * 127 < 2**24 else np.float64
    cc, single = cc.astype(kind), len(np.unique(ids)) == len(ids)
    for at in range(0, len(cq), strip):
        part = slice(at, at + strip)
        dots = (cq[part].astype(kind) @ cc.T).astype(np.float64) * sq[part, None] * sc[None, :]
        wrong = nq[part, None] * ec[None, :] + eq[part, None] * (nc + ec)[None, :]
        near = zq[part, None] + zc[None, :]
        slack = 1e-9 * near + 1e-290
        low, high = near - 2 * dots - 2 * wrong - slack, near - 2 * dots + 2 * wrong + slack
        if not single:
            limit = np.array([least_distinct(h, ids, need) for h in high])
        elif len(ids) >= need:
            limit = np.partition(high, need - 1, axis=1)[:, need - 1]
        else:
            limit = np.full(len(high), np.inf)
        i, j = np.nonzero(low <= limit[:, None])
        yield i + at, j, low[i, j], high[i, j]


def block_counts(n_queries: int, n_rows: int, block: int, parts: int) -> tuple[int, int]:
    """Blocks of queries and of candidates: no more rows than `block` in each, and tiles for all tasks."""
    n_q, n_c = max(1, -(-n_queries // block)), max(1, -(-n_rows // block))
    return n_q, max(n_c, min(-(-parts // n_q), -(-n_rows // 1024)))


def distance(a: Column, b: Column) -> Column:
    """Euclidean, summed in order as a plain loop would; scaled where squares would leave the range of doubles."""
    diffs = F.zip_with(a, b, lambda x, y: x - y)
    largest = F.array_max(F.transform(diffs, F.abs))
    plain = F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda s, x: s + x * x))
    scaled = largest * F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest)))
    return F.when(largest.between(1e-140, 1e140) | (largest == 0) | (largest == float("inf")), plain).otherwise(scaled)


def nearest(vectors: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", block: int = 65_536) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by Euclidean distance.

    queries is a boolean column that marks the query rows. Candidates are all rows but those of the
    query's own id; ties go to the smaller id. Null ids and vectors that are null, empty, zero or hold
    null or non-finite components take no part; a query meets candidates of its own length only.
    Repeated rows count once; an id with several vectors stands in a list once, by the nearest of
    them, and as a query gets the nearest to any of them. A query with fewer candidates than k
    returns all. Other columns are ignored; an empty table gives no rows.

    Of equal vectors k + 1 ids are candidates, which is all that a list can hold, so copies, however
    many, are one vector. Blocks of at most about `block` vectors are dealt out by a hash.
    """
    spark, need = vectors.sparkSession, k + 1
    whole = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("is_q"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = whole.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(~bad & F.exists("v", lambda x: x != 0))
    whole = whole.select("id", "is_q", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.col("v")).alias("h2"))
    asked = written(whole.filter("is_q").select(F.col("id").alias("query_id"), *KEY).distinct())
    rows = whole.groupBy("id", *KEY).agg(F.first("v").alias("v"))
    few = rows.withColumn("n", F.row_number().over(Window.partitionBy(*KEY).orderBy("id"))).filter(F.col("n") <= need)
    vecs = few.groupBy(*KEY).agg(F.first("v").alias("v"), F.sort_array(F.collect_list("id")).alias("ids"))
    vecs = written(vecs.join(asked.select(*KEY).distinct().withColumn("asked", F.lit(True)), KEY, "left").withColumn("asked", F.coalesce("asked", F.lit(False))))
    largest, n_rows, n_asked = vecs.agg(F.max(F.array_max(F.transform("v", F.abs))), F.count("*"), F.count_if("asked")).first()
    # a power of two that keeps squares in range; bounds are of scaled vectors
    factor = 2.0 ** -math.frexp(largest)[1] if largest and not 1e-100 < largest < 1e100 else 1.0

    @tidy
    def code(batches):
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy()
            flat, at = batch.column(3).flatten().to_numpy(), np.cumsum([0, *sizes])
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                x = flat[at[own][:, None] + np.arange(dim)] * factor
                codes, *rest = quantised(x)
                some = batch.select([0, 1, 2, 4]).take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(np.full(len(own), dim, dtype=np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), *(pa.array(r, pa.float64()) for r in rest)],
                    names=[*KEY, "id", "asked", "dim", "code", "scale", "norm", "lost", "size"],
                )

    coded = vecs.select(*KEY, F.col("ids")[0].alias("id"), "v", "asked").mapInArrow(code, "h1 long, h2 long, id long, asked boolean, dim int, code binary, scale double, norm double, lost double, size double")
    coded = written(coded)
    n_q, n_c = block_counts(n_asked, n_rows, block, shuffle_parts(spark))
    place = lambda n: F.pmod(F.col("h1"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = [*KEY, "id", "code", "scale", "norm", "lost", "size"]
    named = lambda side: [F.col(c).alias(f"{side}_{c}") for c in sent]  # noqa: E731  both sides come from one table, so columns need names of their own
    qs = coded.filter("asked").select(F.col("dim").alias("q_dim"), place(n_q).alias("q_qb"), every(n_c).alias("q_cb"), *named("q"))
    cs = coded.select(F.col("dim").alias("c_dim"), every(n_q).alias("c_qb"), place(n_c).alias("c_cb"), *named("c"))

    def arrays(side: pd.DataFrame, name: str) -> tuple:
        codes = np.frombuffer(b"".join(side[f"{name}_code"]), dtype=np.int8).reshape(len(side), -1)
        return codes, *(side[f"{name}_{c}"].to_numpy() for c in ("scale", "norm", "lost", "size"))

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in BOUNDS.split(", ")]
        if left.empty or right.empty:
            return pd.DataFrame({n: [] for n in names})
        ids = right["c_id"].to_numpy()
        found = [np.concatenate(x) for x in zip(*tile_bounds(arrays(left, "q"), arrays(right, "c"), ids, need), strict=True)]
        i, j = found[:2]
        columns = [left["q_h1"].to_numpy()[i], left["q_h2"].to_numpy()[i], right["c_h1"].to_numpy()[j], right["c_h2"].to_numpy()[j], ids[j], *found[2:]]
        return pd.DataFrame(dict(zip(names, columns, strict=True)))

    tiles = qs.groupBy("q_dim", "q_qb", "q_cb").cogroup(cs.groupBy("c_dim", "c_qb", "c_cb")).applyInPandas(tile, BOUNDS)

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, float] = {}
        for high, id_ in heapq.merge(*(sorted(zip(t["high"], t["id"], strict=True)) for _, t in rows.groupby(rows["c1"] % n_c))):
            best.setdefault(id_, high)
            if len(best) == need:
                break
        limit = max(best.values()) if len(best) == need else math.inf
        return rows.loc[rows["low"] <= limit, ["q1", "q2", "c1", "c2"]]

    pairs = tiles.groupBy("q1", "q2").applyInPandas(merged, "q1 long, q2 long, c1 long, c2 long")
    side = lambda a, b, *more: vecs.select(F.col("h1").alias(a), F.col("h2").alias(b), *more)
    pairs = pairs.join(side("c1", "c2", F.col("v").alias("cv"), "ids"), ["c1", "c2"]).join(side("q1", "q2", F.col("v").alias("qv")), ["q1", "q2"])
    each = pairs.select(F.col("q1").alias("h1"), F.col("q2").alias("h2"), distance(F.col("cv"), F.col("qv")).alias("score"), F.explode("ids").alias("vec_id"))
    by_score = ["score", "vec_id"]
    each = each.groupBy(*KEY, "vec_id").agg(F.min("score").alias("score"))
    each = each.withColumn("n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*by_score))).filter(F.col("n") <= need)
    lists = each.groupBy(*KEY).agg(F.collect_list(F.struct(*by_score)).alias("list"))
    heavy = heavy_keys(asked.groupBy(*KEY).agg(F.count("*").alias("n")), KEY)
    found = join_heavy(asked, lists, KEY, heavy, ["query_id"]).select("query_id", F.explode("list").alias("l")).select("query_id", "l.*").filter("query_id <> vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*by_score))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE_OP5 = """
WITH v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: (c.v[i] - q.v[i]) * (c.v[i] - q.v[i])))) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
