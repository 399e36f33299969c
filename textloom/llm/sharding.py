"""Sharding by best-fit-decreasing bin packing.

Indivisible groups (rows with equal texts) are packed, largest first, each into the bin with the
tightest remaining capacity that still holds it. Best fit keeps choosing the same bin for items of
one size until it is full, so the packer works on (size, number of groups of that size) and places
whole runs. Sizes are told apart to a grain of a 10^10th of all bytes, so that the driver holds at most
2 * 10^5 of them: 10^5 multiples of the grain below a 10^5th of the bytes, and as many groups above it.
Below 10 GB the grain is one byte.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, heavy_keys, join_heavy, shuffle_parts, text_or_empty


class _Node:
    __slots__ = ("key", "left", "right", "level")

    def __init__(self, key):
        self.key, self.left, self.right, self.level = key, None, None, 1


class CapacityTree:
    """A balanced (AA) tree of (remaining capacity, bin) pairs."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _skew(n):
        if n and n.left and n.left.level == n.level:
            left = n.left
            n.left, left.right = left.right, n
            return left
        return n

    @staticmethod
    def _split(n):
        if n and n.right and n.right.right and n.level == n.right.right.level:
            right = n.right
            n.right, right.left = right.left, n
            right.level += 1
            return right
        return n

    def insert(self, key):
        def put(n):
            if n is None:
                return _Node(key)
            if key < n.key:
                n.left = put(n.left)
            else:
                n.right = put(n.right)
            return self._split(self._skew(n))

        self.root = put(self.root)

    def remove(self, key):
        def take(n, key):
            if n is None:
                return None
            if key < n.key:
                n.left = take(n.left, key)
            elif key > n.key:
                n.right = take(n.right, key)
            elif n.left is None:
                return n.right
            elif n.right is None:
                return n.left
            else:
                heir = n.right
                while heir.left:
                    heir = heir.left
                n.key = heir.key
                n.right = take(n.right, heir.key)
            least = min(x.level if x else 0 for x in (n.left, n.right)) + 1
            if least < n.level:
                n.level = least
                if n.right and n.right.level > least:
                    n.right.level = least
            n = self._skew(n)
            n.right = self._skew(n.right)
            if n.right:
                n.right.right = self._skew(n.right.right)
            n = self._split(n)
            n.right = self._split(n.right)
            return n

        self.root = take(self.root, key)

    def tightest(self, size):
        """The least key whose capacity is at least size, or None."""
        n, found = self.root, None
        while n:
            if n.key[0] >= size:
                found, n = n.key, n.left
            else:
                n = n.right
        return found


@dataclass
class Packing:
    capacity: int
    bins: int
    runs: list  # (size, first rank, bin): groups of that size from that rank on go to that bin


def best_fit_decreasing(histogram: list[tuple[int, int]], capacity: int, max_bins: int | None = None) -> Packing | None:
    """Packs n groups of each size. Opens bins as needed; None if more than max_bins are needed.

    A group larger than the capacity gets a bin of its own.
    """
    tree, bins, runs = CapacityTree(), 0, []
    for size, n in sorted(histogram, reverse=True):
        rank = 0
        while rank < n:
            spot = tree.tightest(size)
            if spot is None:
                if max_bins is not None and bins == max_bins:
                    return None
                spot, bins = (max(capacity, size), bins), bins + 1
            else:
                tree.remove(spot)
            fits = min(n - rank, spot[0] // size)
            runs.append((size, rank, spot[1]))
            rank += fits
            if left := spot[0] - fits * size:
                tree.insert((left, spot[1]))
    return Packing(capacity, bins, runs)


def least_capacity(histogram: list[tuple[int, int]], n_bins: int) -> Packing:
    """The least capacity found by bisection for which best fit decreasing needs at most n_bins."""
    total = sum(s * n for s, n in histogram)
    low = max([-(-total // n_bins), *(s for s, _ in histogram)], default=1) or 1
    best = best_fit_decreasing(histogram, low, n_bins)
    step = max(1, low // 1_000_000)
    lost = low - 1
    while best is None:
        lost, step = low, step * 2
        low += step
        best = best_fit_decreasing(histogram, low, n_bins)
    high = best.capacity
    while high - lost > max(1, high // 1_000_000):
        mid = (high + lost) // 2
        tried = best_fit_decreasing(histogram, mid, n_bins)
        if tried is None:
            lost = mid
        else:
            best, high = tried, mid
    return best


def pack_into(histogram: list[tuple[int, int]], n_bins: int) -> Packing:
    """At most n_bins bins, as near equal as the groups allow.

    A group above the mean of what is left is a bin by itself. The others are packed at the least
    capacity; while that still has to be above the mean, the fullest bin stands and what the other
    bins hold is packed anew for itself, which never takes more than they held.
    """
    left = dict(sorted(histogram, reverse=True))
    rest, bins, kept = sum(s * n for s, n in left.items()), 0, []
    for size in left:
        while left[size] and size * (n_bins - bins) > rest:
            kept.append((size, 1, bins))
            left[size], rest, bins = left[size] - 1, rest - size, bins + 1
        if left[size]:
            break
    capacity = max((s for s, _, _ in kept), default=1)
    while rest:
        best = least_capacity([(s, n) for s, n in left.items() if n], n_bins - bins)
        held: list[dict[int, int]] = [{} for _ in range(best.bins)]
        end = dict(left)
        for size, rank, b in reversed(best.runs):
            held[b][size] = held[b].get(size, 0) + end[size] - rank
            end[size] = rank
        held.sort(key=lambda h: -sum(s * n for s, n in h.items()))
        even = sum(s * n for s, n in held[0].items()) * (n_bins - bins) * 100 <= 101 * rest
        for h in held if even else held[:1]:
            for size, n in h.items():
                kept.append((size, n, bins))
                left[size], rest = left[size] - n, rest - size * n
            bins += 1
        capacity = max(capacity, best.capacity)
    runs, rank = [], dict.fromkeys(left, 0)
    for size, n, b in kept:
        runs.append((size, rank[size], b))
        rank[size] += n
    return Packing(capacity, bins, runs)


SIZES = 100_000  # of sizes below the split, and of groups above it, as a bound of the packer's list


def grain_of(total: int, sizes: int = SIZES) -> tuple[int, int]:
    """The grain of small sizes, and the least large size, for so many bytes in all."""
    return max(1, -(-total // sizes**2)), max(1, -(-total // sizes))


def shard_documents(docs: DataFrame, n_shards: int | None = 16, capacity: int | None = None, cells: int | None = None, rows_per_cell: int = 50_000, sizes: int = SIZES) -> DataFrame:
    """Adds size, text_crc32, shard and slot to doc_id; groups of equal texts stay together.

    Give n_shards for that many shards of near equal bytes (a group above the mean is a shard alone
    and the others are equal among themselves; fewer groups than shards leave shards empty), or
    capacity for the fewest shards of at most so many bytes (a larger group gets a shard alone).
    Null texts count as empty ones (size 1, crc 0) and form one group with them; repeated rows are
    placed like any others; null doc_ids come in any order; an empty table gives an empty one; other
    columns are dropped. Ties: groups of one size are ordered by their text's hash, rows in a shard by
    doc_id within cells.

    A text is hashed where it is read, so that texts aren't shuffled; sizes are summed before the
    shuffle. Small groups are packed by the mean size of their grain (by the largest one with a
    capacity, which then still holds). Ranks and slots are counted in cells (by a hash; for slots as
    many as rows_per_cell asks for), then offset by running totals of the cells' counts, so that no
    size and no shard is one task's work; rows of a heavy group are dealt out.
    """
    spark = docs.sparkSession
    cells = cells or max(64, shuffle_parts(spark))
    text = text_or_empty()
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("_group"),
    )
    groups = cut(rows.groupBy("_group").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_n")).withColumn("_cell", F.pmod(F.xxhash64("_group"), F.lit(cells)).cast("int")))
    grain, large = grain_of(groups.agg(F.sum("_bytes")).first()[0] or 0, sizes)
    upper = F.when(F.col("_bytes") >= large, F.col("_bytes")).otherwise(F.least(F.lit(large).cast("long"), F.ceil(F.col("_bytes") / grain) * grain))
    groups = groups.withColumn("_kind", F.when(F.col("_bytes") >= large, -F.col("_bytes")).otherwise(upper).cast("long"))
    counts = groups.groupBy("_kind", "_cell").agg(F.count("*").alias("_in_cell"), F.sum("_bytes").alias("_sum"), F.max("_bytes").alias("_max"))
    offsets = cut(counts.select("*", (F.sum("_in_cell").over(Window.partitionBy("_kind").orderBy("_cell")) - F.col("_in_cell")).alias("_offset")))
    kinds = offsets.groupBy("_kind").agg(F.sum("_in_cell"), F.sum("_sum"), F.max("_max")).collect()
    # distinct sizes, so that a run of the packing names its kind
    sized: dict[int, tuple[int, int]] = {}
    for kind, n, total, most in sorted(kinds, key=lambda r: (abs(r[0]), r[0])):
        size = int(most) if capacity else max(1, round(int(total) / int(n)))
        while size in sized and not capacity:
            size += 1
        sized[size] = (int(kind), int(n))
    histogram = [(size, n) for size, (_, n) in sized.items()]
    packing = best_fit_decreasing(histogram, capacity) if capacity else pack_into(histogram, n_shards or 1)

    schema = T.StructType([T.StructField("_kind", T.LongType()), T.StructField("_starts", T.ArrayType(T.LongType())), T.StructField("_bins", T.ArrayType(T.IntegerType()))])
    by_kind: dict[int, tuple[list, list]] = {}
    for size, rank, b in packing.runs:
        starts, bins = by_kind.setdefault(sized[size][0], ([], []))
        starts.append(rank)
        bins.append(b)
    plan = F.broadcast(spark.createDataFrame([(k, *x) for k, x in by_kind.items()], schema))  # of at most 2 * sizes kinds

    rank = (F.col("_offset") + F.row_number().over(Window.partitionBy("_kind", "_cell").orderBy("_group")) - 1).alias("_rank")
    placed = groups.join(offsets.select("_kind", "_cell", "_offset"), ["_kind", "_cell"]).select("_group", "_kind", "_n", rank).join(plan, "_kind")
    before = F.size(F.filter("_starts", lambda s: s <= F.col("_rank")))
    placed = cut(placed.select("_group", "_n", F.element_at("_bins", before).alias("shard")))

    most = placed.groupBy("shard").agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0] or 0
    n_cells = max(cells, -(-int(most) // rows_per_cell))
    spread = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("doc_id"))
    heavy = heavy_keys(placed.select("_group", F.col("_n").alias("n")), ["_group"])
    out = join_heavy(rows.withColumn("_spread", spread), placed.drop("_n"), ["_group"], heavy, ["_spread"])
    out = cut(out.withColumn("_slot_cell", F.pmod("_spread", F.lit(n_cells)).cast("int")).drop("_group", "_spread"))
    at = Window.partitionBy("shard").orderBy("_slot_cell")
    slots = out.groupBy("shard", "_slot_cell").agg(F.count("*").alias("_k")).select("shard", "_slot_cell", (F.sum("_k").over(at) - F.col("_k")).alias("_from"))
    order = Window.partitionBy("shard", "_slot_cell").orderBy("doc_id", "text_crc32", "size")
    return out.join(slots, ["shard", "_slot_cell"]).select("doc_id", "size", "text_crc32", "shard", (F.col("_from") + F.row_number().over(order) - 1).alias("slot"))


def shard_of(packing: Packing, size: int, rank: int) -> int:
    """Where a group of that size and rank goes; for tests and lookups on the driver."""
    runs = sorted((r, b) for s, r, b in packing.runs if s == size)
    return runs[bisect_right([r for r, _ in runs], rank) - 1][1]


def op9_sharding(spark, sf_dir):
    from .common import table

    out = shard_documents(table(spark, sf_dir, "documents"), n_shards=16)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
