"""Near-duplicate documents by an LSH forest of MinHash signatures.

Each tree is a sorted order of all distinct shingle sets by the tree's own min-hash values. Sets
whose longest common prefix with their neighbour has at least `base` values form a region. In a
small region all pairs are candidates; in a larger one each set is paired with its neighbour, with
which it shares the longest prefix: 5 values or all 6, so the depth hardly adapts. What larger regions
leave open is settled exactly afterwards: sets of different components are compared in blocks, and
what hasn't joined a large region's largest component then with the whole region, in tiles of
bounded size. All links are confirmed on full shingle sets; classes are connected components.

With J >= 0.85, base 5 and 24 trees a linked pair misses every region with a chance below 1e-6.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import portions
from .common import cut, heavy_keys, join_heavy, release_memory, shuffle_parts, small_batches, table, text_or_empty, tidy, written
from .graph import components
from .shingles import U, mix, set_key, shingle_sets

SOME_WORD = r"[^\x20\x09-\x0D]"
TREES, DEPTH, BASE_DEPTH = 24, 6, 5
WIDTH = DEPTH * 4


def hash_seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * n + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    return x[:n], x[n:] | U(1)


def signatures(sets: list[np.ndarray], n: int = TREES * DEPTH) -> np.ndarray:
    """n min-hash values of 32 bits for each set, none of them empty."""
    flat = np.concatenate(sets)
    at = np.cumsum([0, *map(len, sets[:-1])])
    salt, factor = hash_seeds(n)
    out = np.empty((len(sets), n), dtype=">u4")
    for i in range(n):
        out[:, i] = np.minimum.reduceat((flat ^ salt[i]) * factor[i], at) >> U(32)
    return out


def row_key():
    """A hash of a row's doc_id and text, by which a text of a class is found again; ids may be null or repeated."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_or_empty())


def narrow(df: DataFrame, most: int, per_part: int = 200_000) -> DataFrame:
    """df, checkpointed and of at most `most` narrow rows, in no more parts than these need; any more only cost tasks.

    Put round cut() and not into it, so that no task sorts or aggregates several parts in turn.
    """
    return df.coalesce(max(1, min(shuffle_parts(df.sparkSession), 1 + most // per_part)))


def sketches(docs: DataFrame, k: int, carried: list[str]) -> DataFrame:
    """doc_id, row (row_key), n_shingles, cls (the set's key; null if empty), sig (null if empty), and the carried columns."""

    @tidy
    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in portions(texts, 1 << 18):
                sets = shingle_sets(texts[start:stop], k)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows = iter(signatures([sets[i] for i in full]) if full else ())
                sig = [next(rows).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, stop - start) for c in batch.columns[1:]), pa.array(map(len, sets), pa.int64()), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()), pa.array(sig, pa.binary())],
                    names=names,
                )

    rows = docs.select(text_or_empty().alias("text"), F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), *carried)
    own = rows.drop("text").schema
    names = [*own.names, "n_shingles", "cls", "sig"]
    for name, kind in (("n_shingles", T.LongType()), ("cls", T.LongType()), ("sig", T.BinaryType())):
        own = own.add(name, kind)
    return rows.mapInArrow(run, own)


def alike(a, b, percent: int):
    """Whether set sizes allow the similarity."""
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


def run_pairs(cls: np.ndarray, n: np.ndarray, percent: int, whole: int):
    """Candidates of one region in its sorted order: all pairs, or beyond `whole` sets neighbours."""
    m = len(cls)
    if m <= whole:
        i, j = np.triu_indices(m, 1)
    else:
        j = np.arange(1, m)
        i = j - 1
    ok = (cls[i] != cls[j]) & alike(n[i], n[j], percent)
    return np.minimum(cls[i[ok]], cls[j[ok]]), np.maximum(cls[i[ok]], cls[j[ok]])


def forest(classes: DataFrame, percent: int, whole: int = 4, most: int = 50_000) -> DataFrame:
    """kind 0: a candidate pair (a, b). kind 1: set a is in region b, which run_pairs hasn't settled."""
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.substring(F.col("sig"), t * WIDTH + 1, F.lit(WIDTH)).alias("key")))
    rows = classes.select(F.explode(trees).alias("t"), "cls", "n").select("t.tree", "t.key", "cls", "n")
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, "tree", "key", "cls").sortWithinPartitions("tree", "key", "cls")

    @tidy
    def run(batches):
        held, first = None, True

        def emit(kind, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, dtype=np.int32)), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], names=["kind", "a", "b"])

        def closed(tree, key, cls, n, open_at_end):
            """Pairs of complete runs; at the partition's ends a run may go on elsewhere."""
            nonlocal first
            same = (key[1:] == key[:-1]) & (tree[1:] == tree[:-1])[:, None]
            lcp = np.concatenate(([0], np.cumprod(same, axis=1).sum(axis=1)))
            starts = np.flatnonzero(lcp < BASE_DEPTH)
            ends = np.append(starts[1:], len(cls))
            sizes = ends - starts
            lows, highs, members, regions = [], [], [], []
            for r in np.flatnonzero((sizes > 1) | (starts == 0) & first | (ends == len(cls)) & open_at_end).tolist():
                s, e = starts[r], ends[r]
                if e - s > 1:
                    lo, hi = run_pairs(cls[s:e], n[s:e], percent, whole)
                    lows.append(lo)
                    highs.append(hi)
                if e - s > whole or first and s == 0 or open_at_end and e == len(cls):
                    h = mix(np.array([tree[s] + 1], dtype=U))
                    for c in range(BASE_DEPTH):
                        h = mix(h * U(31) + key[s, c].astype(U))
                    members.append(cls[s:e])
                    regions.append(np.full(e - s, (int(h.view(np.int64)[0]) >> 5 << 5) + int(tree[s])))  # the tree is in the low bits
            first = False
            if lows and len(lo := np.concatenate(lows)):
                pair = np.unique(np.stack([lo, np.concatenate(highs)], axis=1), axis=0)
                yield emit(0, pair[:, 0], pair[:, 1])
            if members:
                yield emit(1, np.concatenate(members), np.concatenate(regions))

        for batch in batches:
            if not len(batch):
                continue
            keys = batch.column(1)
            at = np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset]
            key = np.frombuffer(keys.buffers()[2], dtype=">u4", count=len(batch) * DEPTH, offset=int(at)).reshape(-1, DEPTH).astype(np.uint32)
            now = (batch.column(0).to_numpy(), key, batch.column(2).to_numpy(), batch.column(3).to_numpy())
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            tree, key = now[0], now[1]
            new = np.flatnonzero((tree[1:] != tree[:-1]) | (key[1:, :BASE_DEPTH] != key[:-1, :BASE_DEPTH]).any(axis=1))
            cut_at = int(new[-1]) + 1 if len(new) else 0
            if cut_at:
                yield from closed(*(x[:cut_at] for x in now), False)
            held = tuple(x[cut_at:] for x in now)
            if len(held[0]) > most:  # a very large region is given out in parts, all of them open
                first = True
                yield from closed(*held, True)
                held, first = None, True
        if held is not None:
            yield from closed(*held, True)

    return rows.mapInArrow(run, "kind int, a long, b long")


def set_table(docs: DataFrame, ids: DataFrame, k: int, broadcast_ids: int = 1_000_000) -> DataFrame:
    """cls, members (its sorted hashes) for the classes of ids (cls, row: the key of one of its rows)."""
    only, mine = ids.select("row"), ids.select("cls")
    if ids.count() <= broadcast_ids:
        only, mine = F.broadcast(only), F.broadcast(mine)

    @tidy
    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, stop in portions(texts, 1 << 18):
                sets = shingle_sets(texts[start:stop], k)
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "members"])

    texts = docs.select(row_key().alias("row"), text_or_empty().alias("text")).join(only, "row", "left_semi").select("text")
    sets = texts.mapInArrow(run, "cls long, members binary").join(mine, "cls", "left_semi")
    return written(sets.groupBy("cls").agg(F.first("members").alias("members")))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    common = int((x[at] == y).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def similar(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int, k: int, n: int) -> DataFrame:
    """The pairs (a, b), distinct ones of n classes, that are linked."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = set_table(docs, narrow(cut(needed.join(classes, "cls").select("cls", "row")), n), k)
    left = pairs.join(sets.select(F.col("cls").alias("a"), F.col("members").alias("sa")), "a")
    both = left.join(sets.select(F.col("cls").alias("b"), F.col("members").alias("sb")), "b").select("a", "b", "sa", "sb")

    @tidy
    def confirm(batches):
        for batch in batches:
            keep = [linked(*(np.frombuffer(s.as_buffer(), dtype=U) for s in p), percent) for p in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return cut(both.mapInArrow(confirm, "a long, b long"))


def rest_links(docs: DataFrame, members: DataFrame, classes: DataFrame, comps: DataFrame, percent: int, k: int, n: int, within: bool, block: int = 512) -> DataFrame:
    """Links (a, b) between components inside regions; for a set, one to each other component.

    within: all pairs inside blocks of about `block` sets of a region, which costs in proportion to
    the region and is all of a small one. Otherwise, for regions of more than one block: every set
    outside the region's largest component against the whole region, in tiles.

    Pairs are passed over whose 144 values agree 0.2 below the threshold (the estimate's standard
    deviation is 0.03 there); the rest are compared by their full sets, each pair in the first tree
    that brings it together. No candidates leave a tile, only links. members are distinct, of n classes.
    """
    inside = members.select(F.col("b").alias("region"), F.col("a").alias("cls"))
    inside = inside.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    counts = inside.groupBy("region", "component").agg(F.count("*").alias("c"))
    regions = counts.groupBy("region").agg(F.sum("c").alias("m"), F.max("c").alias("top"), F.max_by("component", F.struct("c", "component")).alias("largest"), F.count("*").alias("comps")).filter("comps > 1")
    if not within:
        regions = regions.filter(F.col("m") > block)
    inside = narrow(cut(inside.join(regions.drop("comps"), "region")), TREES * n)
    if not inside.limit(1).count():
        return inside.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    ids = narrow(cut(inside.select("cls").distinct().join(classes, "cls").select("cls", "row")), n)
    known = set_table(docs, ids, k).join(classes.select("cls", "n", "sig"), "cls")
    lbs, rbs = F.ceil((F.col("m") - F.col("top")) / block).cast("int"), F.ceil(F.col("m") / block).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("cls", "region"), n).cast("int")
    def tile(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(x) and len(y):
            tree = int(y["region"].iloc[0]) & 31
            sy = np.frombuffer(b"".join(y["sig"]), dtype=np.uint32).reshape(len(y), TREES, DEPTH)
            sx = np.frombuffer(b"".join(x["x_sig"]), dtype=np.uint32).reshape(len(x), TREES, DEPTH)
            cy, ny, ky = y["cls"].to_numpy(), y["n"].to_numpy(), y["component"].to_numpy()
            sets = [np.frombuffer(m, dtype=U) for m in y["members"]]
            least = (percent / 100 - 0.2) * TREES * DEPTH
            for i, (cx, nx, kx, mx) in enumerate(zip(x["x_cls"], x["x_n"], x["x_component"], x["x_members"], strict=True)):
                near = np.flatnonzero((ky != kx) & alike(nx, ny, percent) & ((cy > cx) if within else True))
                same = sy[near] == sx[i]
                near = near[(same.sum(axis=(1, 2)) >= least) & (same[:, :, :BASE_DEPTH].all(axis=2).argmax(axis=1) == tree)]
                met, mine = set(), np.frombuffer(mx, dtype=U)
                for j in near.tolist():
                    if ky[j] not in met and linked(mine, sets[j], percent):
                        met.add(ky[j])
                        out.append((min(cx, cy[j]), max(cx, cy[j])))
        if len(x) + len(y) > block // 4:
            release_memory()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    cols = ["cls", "component"]
    if within:
        blocks = inside.select("region", spot(rbs).alias("lb"), *cols).join(known, "cls")
        found = blocks.groupBy("region", "lb").applyInPandas(lambda x: tile(x.add_prefix("x_"), x), "a long, b long")
        return cut(found.distinct())
    left = inside.filter("component <> largest").select("region", spot(lbs).alias("lb"), F.explode(F.sequence(F.lit(0), rbs - 1)).alias("rb"), *cols).join(known, "cls")
    right = inside.select("region", F.explode(F.sequence(F.lit(0), lbs - 1)).alias("lb"), spot(rbs).alias("rb"), *cols).join(known, "cls")
    left = left.select(*(F.col(c).alias(f"x_{c}") for c in left.columns))

    return cut(left.groupBy("x_region", "x_lb", "x_rb").cogroup(right.groupBy("region", "lb", "rb")).applyInPandas(tile, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, percent: int = 80, k: int = 5, carried: list[str] | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_links, group for every row, and the carried columns of docs.

    Documents are linked if 100 * intersection >= percent * union of their distinct k-word shingles
    (A-Z lower-cased, words parted by ASCII white space; with fewer words, all of them as one).
    component_id is the smallest doc_id reachable over links, kept whether it is the row's own;
    n_links counts the other distinct shingle sets that confirmed links join to the row's; links
    inside a component that is already joined aren't all looked for. group is a number that the rows
    of one component have in common.
    Null, empty and blank texts have no shingles, no group and no links: they keep their own id.
    Repeated rows fall in one class and share an outcome. A null doc_id links like any other row and
    never names a component; one without any other ids has a null component_id and isn't kept.
    Columns that aren't carried are ignored; an empty table gives an empty one. Sets are compared by
    64-bit hashes of their shingles.
    """
    small_batches(docs.sparkSession)
    carried = carried or []
    known = written(sketches(docs, k, carried))
    full = known.filter(F.col("cls").isNotNull())
    classes = written(full.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("row").alias("row"), F.count("*").alias("copies"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))
    n = classes.count()
    found = narrow(cut(forest(classes, percent).distinct()), 3 * TREES * n)  # with regions of 4 sets all paired, 2.5 rows a set and tree
    edges = narrow(similar(docs, classes, found.filter("kind = 0").select("a", "b"), percent, k, n), 3 * TREES * n)
    comps = components(edges)
    for within in (True, False):
        more = rest_links(docs, found.filter("kind = 1"), classes, comps, percent, k, n, within)
        if more.limit(1).count():
            edges = narrow(cut(edges.union(more).distinct()), 3 * TREES * n)
            comps = components(edges)
    degree = edges.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    joined = classes.select("cls", "rep").join(comps.withColumnRenamed("node", "cls"), "cls")
    least = narrow(cut(joined.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("n"))), n)
    joined = join_heavy(joined, least.drop("n"), ["component"], heavy_keys(least, ["component"]), ["cls"])
    placed = narrow(cut(joined.join(degree, "cls").select("cls", "component_id", "n_links", "component")), n)
    whole = classes.select("cls", "rep").join(placed, "cls", "left").select("cls", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "cls").alias("group"))
    copies = heavy_keys(classes.select("cls", F.col("copies").alias("n")), ["cls"])
    rows = join_heavy(full.drop("sig"), whole, ["cls"], copies, ["doc_id", "row"]).select("doc_id", "n_shingles", "component_id", "n_links", "group", *carried)
    blank = known.filter(F.col("cls").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).alias("n_links"), F.lit(None).cast("long").alias("group"), *carried)
    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(False))
    return rows.unionByName(blank).select("doc_id", "n_shingles", "component_id", kept.alias("kept"), F.col("n_links").cast("long").alias("n_links"), "group", *carried)


def op1_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("n_links", "group")


ORACLE_OP1 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w
), f AS (
    SELECT doc_id, unnest(sh) AS g FROM s
), n AS (
    SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), e AS (
    SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
    SELECT doc_id, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id
)
SELECT doc_id, any_value(n.n) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept FROM r JOIN n USING (doc_id) GROUP BY doc_id
"""
