"""Near-duplicate vectors by an exact metric range join.

Equal vectors become one node. Nodes lie on the unit sphere, where a cosine of at least t is a chord of
at most sqrt(2 - 2t). A bounded sample gives pivots; each node's cell is that of its nearest pivot. A
node is also sent to those other cells in which, by the triangle inequality, a partner can lie: its angle
to the pivot is at most the cell's radius and the range together, and it is no farther than the range
from the plane between the two pivots. Cells then join independently, in tiles of bounded size.

A tile computes products in single precision with a bound on their error; what lies within the bound of
t is computed again in double precision. It gives out no pairs: for each node the number of its partners
and, from a union-find over the tile, one node of the same component.

Each of two cells could find the pairs between them; the one with the smaller number does. Vectors whose
angles tell nothing apart (independent coordinates, many of them) are sent to all cells: the join then
costs the square of the distinct vectors in products, which no exact method on a metric avoids.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_keys, join_heavy, shuffle_parts, table, tidy, written
from .graph import components

KEY = ["h1", "h2"]
MOST_PIVOTS, SAMPLE, SAMPLE_BYTES = 1024, 4096, 16 << 20
TILE_BYTES = 4 << 20
FOUND = "node long, links long, root long"


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two so that their largest components are about 1: no square leaves the range of doubles."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def exact_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows in pairs, in double precision, summed in order."""
    total = lambda x, y: np.add.accumulate(x * y, axis=1)[:, -1]
    return total(a, b) / (np.sqrt(total(a, a)) * np.sqrt(total(b, b)))


def spread_out(sample: np.ndarray, m: int) -> np.ndarray:
    """m rows of a sample of unit vectors, each far from those chosen before."""
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < min(m, len(sample)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


class Cells:
    """The pivots of each length of vectors, and what a place in space has to do with their cells."""

    def __init__(self, pivots: dict[int, np.ndarray], least: float):
        self.pivots, self.angle, self.chord = pivots, math.acos(max(-1.0, min(1.0, least))) + 1e-7, math.sqrt(2 - 2 * least) + 1e-7
        self.radius: dict[tuple[int, int], float] = {}

    def home(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot and angle to it; -1 and 0 for lengths without pivots."""
        p = self.pivots.get(u.shape[1])
        if p is None:
            return np.full(len(u), -1, dtype=np.int32), np.zeros(len(u))
        near = u @ p.T
        at = near.argmax(axis=1)
        return at.astype(np.int32), np.arccos(np.clip(near[np.arange(len(u)), at], -1, 1))

    def sent(self, u: np.ndarray, home: np.ndarray):
        """Cell by cell, of smaller number than home: the places of rows that may have partners there."""
        p = self.pivots.get(u.shape[1])
        if p is None:
            return
        near = u @ p.T
        own = near[np.arange(len(u)), home]
        apart = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0))
        for c in range(len(p) - 1):
            if (radius := self.radius.get((u.shape[1], c))) is None:
                continue  # an empty cell
            ok = (home > c) & (own - near[:, c] <= self.chord * apart[home, c] + 1e-9) & (np.arccos(np.clip(near[:, c], -1, 1)) <= radius + self.angle)
            if len(at := np.flatnonzero(ok)):
                yield c, at


class Forest:
    """Union-find over the places of an array."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while not np.array_equal(further := self.parent[up], up):
            up = further
        return up

    def join(self, at: np.ndarray) -> None:
        roots = np.unique(self.roots(at))
        self.parent[roots] = roots[0]
        self.parent[at] = roots[0]


def tile_links(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, least: float, same: bool, strip: int = 512):
    """Partners of each row of x in y and of y in x, counted by the multiplicities nx and ny, and a forest
    over the rows of both. same: y is x, and no row is its own partner."""
    a, b = units(x).astype(np.float32), units(y).astype(np.float32)
    wrong = (x.shape[1] + 8) * 2.0**-23
    links_x, links_y = np.zeros(len(x), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
    forest = Forest(len(x) + (0 if same else len(y)))
    shift = 0 if same else len(x)
    for at in range(0, len(x), strip):
        near = a[at : at + strip] @ b.T
        ok = near >= least - wrong
        if same:
            ok[np.arange(len(ok)), np.arange(at, at + len(ok))] = False
        if not ok.any():
            continue
        i, j = np.nonzero(ok & (near < least + wrong))
        for s in range(0, len(i), 4096):
            p, q = i[s : s + 4096], j[s : s + 4096]
            ok[p, q] = exact_cosines(x[at + p], y[q]) >= least
        links_x[at : at + len(ok)] = ok @ ny
        links_y += nx[at : at + len(ok)] @ ok
        for r in np.flatnonzero(ok.any(axis=1)).tolist():
            forest.join(np.append(np.flatnonzero(ok[r]) + shift, at + r))
    return links_x, links_y, forest


def near_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding", cell_rows: int = 8192, least_rows: int = 128) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Two vectors of one length are linked if their cosine in double precision is at least `least`
    (0 to 1). n_links counts the other rows that a row is linked to directly, copies each for one;
    component_id is the smallest id reachable over links, kept whether it is the row's own.

    Null vectors and those that are empty, zero or hold null or non-finite components link with nothing
    and keep their own id. Repeated rows are several rows, linked like other copies; rows of one id and
    different vectors are different nodes. A null id links like any other and never names a component;
    without other ids its component_id is null and it isn't kept. Other columns are ignored; an empty
    table gives no rows.

    Cells and tiles have about least_rows to cell_rows rows, in between as many as give all tasks some.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.withColumn("ok", F.coalesce(F.col("v").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    rows = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), F.col("v"))})
    counted = rows.filter("ok").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("h1").alias("h1"), F.first("h2").alias("h2"))
    nodes = written(counted.select(F.monotonically_increasing_id().alias("node"), F.size("v").alias("dim"), "*"))
    n_nodes, widest = nodes.agg(F.count("*"), F.max("dim")).first()
    blank = rows.filter(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    if not n_nodes:
        return blank
    # cells for all tasks of a small table; tiles whose vectors fit in TILE_BYTES
    block = max(least_rows, min(cell_rows, TILE_BYTES // (8 * widest), -(-n_nodes // math.isqrt(2 * shuffle_parts(spark)))))
    sample = nodes.orderBy("h1", "h2").select("v").limit(max(1, min(SAMPLE, SAMPLE_BYTES // (8 * widest)))).collect()  # a bounded sample
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    share = min(MOST_PIVOTS, -(-n_nodes // block)) / len(sample)
    cells = Cells({d: spread_out(units(scaled(np.array(x))), max(1, round(share * len(x)))) for d, x in by_dim.items()}, least)

    def whole(batch):
        """For each length of vectors: places, vectors."""
        sizes = batch.column("v").value_lengths().to_numpy()
        flat, at = batch.column("v").flatten().to_numpy(), np.cumsum([0, *sizes])
        for dim in np.unique(sizes):
            own = np.flatnonzero(sizes == dim)
            yield own, scaled(flat[at[own][:, None] + np.arange(dim)])

    @tidy
    def settle(batches):
        for batch in batches:
            for own, x in whole(batch) if len(batch) else ():
                home, angle = cells.home(units(x))
                some = batch.select(["node", "dim", "n"]).take(pa.array(own))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array([r.tobytes() for r in x], pa.binary()), pa.array(home, pa.int32()), pa.array(angle)], names=["node", "dim", "n", "vec", "cell", "angle"])

    homed = written(nodes.select("node", "dim", "n", "v").mapInArrow(settle, "node long, dim int, n long, vec binary, cell int, angle double"))
    sizes = homed.groupBy("dim", "cell").agg(F.count("*").alias("m"), F.max("angle").alias("radius"))
    cells.radius = {(r["dim"], r["cell"]): r["radius"] + 1e-7 for r in sizes.filter("cell >= 0").collect()}  # as many as pivots

    @tidy
    def send(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                x = np.frombuffer(b"".join(own.column("vec").to_pylist())).reshape(-1, dim)
                for c, at in cells.sent(units(x), own.column("cell").to_numpy()):
                    some = own.select(["node", "dim", "n", "vec"]).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(np.full(len(at), c, dtype=np.int32))], names=["node", "dim", "n", "vec", "cell"])

    copies = homed.drop("angle").mapInArrow(send, "node long, dim int, n long, vec binary, cell int")
    guests = copies.groupBy("dim", "cell").agg(F.count("*").alias("g"))
    blocks = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / block).cast("int")
    plan = written(sizes.join(guests, ["dim", "cell"], "left").select("dim", "cell", blocks(F.col("m")).alias("mb"), blocks(F.col("g")).alias("gb")))
    place = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    every = lambda a, b: F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))
    zero = F.lit(0)
    natives = homed.drop("angle").join(plan, ["dim", "cell"]).withColumn("at", place(F.col("mb")))
    pair = lambda guest, a, b: F.struct(F.lit(guest).alias("guest"), a.alias("a"), b.alias("b"))
    at, mb, gb = F.col("at"), F.col("mb"), F.col("gb")
    # natives meet natives of their own and later blocks, and all guests; guests meet all natives
    as_left = F.concat(F.transform(every(at, mb), lambda b: pair(0, at, b)), F.transform(every(zero, gb), lambda b: pair(1, at, b)))
    as_right = F.transform(every(zero, at + 1), lambda a: pair(0, a, at))
    visits = F.transform(every(zero, mb), lambda a: pair(1, a, at))
    dealt = lambda df, tiles: df.select("node", "n", "vec", "dim", "cell", F.explode(tiles).alias("t")).select("node", "n", "vec", "dim", "cell", "t.*")
    left = dealt(natives, as_left)
    right = dealt(natives, as_right).unionByName(dealt(copies.join(plan, ["dim", "cell"]).withColumn("at", place(F.col("gb"))), visits))
    left = left.select(*(F.col(c).alias(f"x_{c}") for c in left.columns))

    def tile(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        if x.empty or y.empty:
            return none
        same = not y["guest"].iloc[0] and y["a"].iloc[0] == y["b"].iloc[0]
        array = lambda vecs: np.frombuffer(b"".join(vecs)).reshape(len(vecs), -1)
        if same:  # both sides are the same rows, in one order
            y = x.rename(columns=lambda c: c.removeprefix("x_"))
        links_x, links_y, forest = tile_links(array(x["x_vec"]), array(y["vec"]), x["x_n"].to_numpy(), y["n"].to_numpy(), least, same)
        node = x["x_node"].to_numpy() if same else np.concatenate([x["x_node"].to_numpy(), y["node"].to_numpy()])
        links = links_x if same else np.concatenate([links_x, links_y])
        some = np.flatnonzero(links)
        return pd.DataFrame({"node": node[some], "links": links[some], "root": node[forest.roots(some)]})

    keys = ["dim", "cell", "guest", "a", "b"]
    found = written(left.groupBy(*(f"x_{k}" for k in keys)).cogroup(right.groupBy(*keys)).applyInPandas(tile, FOUND))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("node", "rep", "n", *KEY).join(comps, "node", "left").withColumn("component", F.coalesce("component", "node")).join(links, "node", "left")
    known = written(known)
    smallest = written(known.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("n")))
    named = join_heavy(known, smallest.drop("n"), ["component"], heavy_keys(smallest, ["component"]), ["node"])
    named = named.select(*KEY, "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    back = join_heavy(rows.filter("ok").select("vec_id", *KEY), named, KEY, heavy_keys(known.select(*KEY, "n"), KEY), ["vec_id"])
    kept = F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(False))
    return back.select("vec_id", "n_links", "component_id", kept.alias("kept")).unionByName(blank)


def op11_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_OP11 = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
    SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM v
), l AS MATERIALIZED (
    SELECT x.vec_id AS a, y.vec_id AS b FROM s x JOIN s y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
    WHERE list_sum(list_transform(range(1, len(x.v) + 1), lambda i: x.v[i] * y.v[i])) / (x.size * y.size) >= 0.9
), r AS (
    SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.vec_id
), n AS (
    SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a
)
SELECT vec_id, coalesce(any_value(n_links), 0) AS n_links, min(root) AS component_id, vec_id = min(root) AS kept FROM r LEFT JOIN n USING (vec_id) GROUP BY vec_id
"""
