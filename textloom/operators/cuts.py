"""Greedy cuts along the order of groups too long for one row or one task.

A cut falls before each record that would make its part longer than allowed, so where a part begins
depends on all before. But what a stretch of records does to the parts depends only on how long the
part is that runs into it. So each bucket of a group's order is summed up, apart from all others, as
its map: ranges of the length carried in, and for each the number of cuts and the length carried out.
Maps are small: only the first cut of a bucket differs with what comes in, and it lies within one
part's length of the bucket's begin. A pass over a group's maps, one after another, gives what is
carried into each bucket; then all buckets are cut, again apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MAP = "first boolean, low double, high double, cuts long, carry long, adds boolean"


def next_starts(sums: np.ndarray, most: int) -> np.ndarray:
    """For a part that begins at each record: where the next one begins, or the number of records."""
    before = np.concatenate(([0], sums[:-1]))
    return np.maximum(np.searchsorted(sums, before + most, side="right"), np.arange(1, len(sums) + 1))


def followed(starts: np.ndarray, nexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last part's begin and the number of parts when parts begin at each of starts and go on from there."""
    last, count = starts.copy(), np.ones(len(starts), dtype=np.int64)
    live = np.flatnonzero(nexts[last] < len(nexts))
    while len(live):
        last[live] = nexts[last[live]]
        count[live] += 1
        live = live[nexts[last[live]] < len(nexts)]
    return last, count


def bucket_map(n: np.ndarray, most: int) -> list[tuple]:
    """MAP rows of a bucket's lengths: by the length carried in, above low and up to high."""
    sums = np.cumsum(n)
    before = np.concatenate(([0], sums[:-1]))
    nexts = next_starts(sums, most)
    last, count = followed(np.zeros(1, dtype=np.int64), nexts)
    rows = [(True, None, None, int(count[0]) - 1, int(sums[-1] - before[last[0]]), False)]
    at = np.flatnonzero((before <= most) & ((sums > before) | (np.arange(len(n)) == 0)))  # records that something carried in can push out
    last, count = followed(at, nexts)
    high = np.where(at == 0, np.inf, most - before[at])
    for low, top, cuts, carry in zip((most - sums[at]).tolist(), high.tolist(), count.tolist(), (sums[-1] - before[last]).tolist(), strict=True):
        if len(rows) > 1 and rows[-1][3:5] == (cuts, carry):
            rows[-1] = (False, low, *rows[-1][2:])
        else:
            rows.append((False, low, top, cuts, carry, False))
    if sums[-1] <= most:
        rows.append((False, -np.inf, most - int(sums[-1]), 0, int(sums[-1]), True))
    return rows


def carried(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, bucket, carried in or None, parts before) for rows (key, bucket, *MAP) in order; and after a
    group's last bucket (key, None, carried out, number of parts)."""
    key = bucket = None
    into = out = parts = more = 0
    begun = False
    for k, b, first, low, high, cuts, carry, adds in rows:
        if not begun or k != key:
            if begun:
                yield key, None, out, parts + more + 1
            key, bucket, begun, into, parts = k, b, True, None, 0
            yield k, b, None, 0
        elif b != bucket:
            bucket, into, parts = b, out, parts + more
            yield k, b, into, parts
        if first if into is None else not first and low < into <= high:
            out, more = (into + carry if adds else carry), cuts
    if begun:
        yield key, None, out, parts + more + 1


def greedy_cuts(rows: DataFrame, by: list[str], most: int, bucket: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """rows (by..., ord, n and more) with part (from 0) and cut (whether it begins there by a cut); and
    by..., last (number of the last part), chars (its length).

    Parts hold at most `most` of n in all, but for longer records alone. No task holds more than a bucket
    of a group's order, or more than a few rows for each of a group's buckets. Groups with null keys are
    groups like others; n is not negative; most is positive.
    """
    dealt = rows.withColumn("_b", F.floor(F.col("ord") / bucket).cast("long"))
    keys = dealt.select(*by, "_b").schema
    named = keys.names
    types = [to_arrow_type(keys[c].dataType) for c in by]

    def summed(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("ord").to_numpy(), kind="stable")
        found = bucket_map(table.column("n").to_numpy()[order], most)
        own = table.select(named).slice(0, 1).take(pa.array([0] * len(found)))
        kinds = [pa.bool_(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
        for i, (f, kind) in enumerate(zip(MAP.split(", "), kinds, strict=True)):
            own = own.append_column(f.split()[0], pa.array([r[i] for r in found], kind))
        return own

    schema = dealt.select(*named).schema
    for f in MAP.split(", "):
        schema = schema.add(*f.split())
    maps = dealt.select(*by, "_b", "ord", F.col("n").cast("long").alias("n")).groupBy(*named).applyInArrow(summed, schema)
    maps = maps.repartition(*by).sortWithinPartitions(*by, "_b", F.desc("first"))

    def chained(batches):
        def flat():
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                yield from zip(zip(*columns[: len(by)], strict=True), *columns[len(by) :], strict=True)

        held: list[tuple] = []
        for row in carried(flat()):
            held.append(row)
            if len(held) == 10_000:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    def packed(held):
        columns = [pa.array([r[0][i] for r in held], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([r[i] for r in held], pa.int64()) for i in (1, 2, 3))], names=[*by, "_b", "_in", "_parts"])

    chain_schema = rows.select(*by).schema.add("_b", "long").add("_in", "long").add("_parts", "long")
    chain = maps.select(*named, *(f.split()[0] for f in MAP.split(", "))).mapInArrow(chained, chain_schema)
    ends = chain.filter(F.col("_b").isNull()).select(*by, (F.col("_parts") - 1).alias("last"), F.col("_in").alias("chars"))
    entries = chain.filter(F.col("_b").isNotNull())
    on = [dealt[c].eqNullSafe(entries[c]) for c in named]
    both = dealt.join(entries, on).select(*(dealt[c] for c in dealt.columns), "_in", "_parts")

    def cut(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("ord").to_numpy(), kind="stable")))
        n = table.column("n").to_numpy().astype(np.int64)
        sums = np.cumsum(n)
        nexts, into = next_starts(sums, most), table.column("_in")[0].as_py()
        begins = np.zeros(len(n), dtype=bool)
        at = int(nexts[0]) if into is None else int(np.searchsorted(sums, most - into, side="right"))
        while at < len(n):
            begins[at] = True
            at = int(nexts[at])
        part = table.column("_parts")[0].as_py() + np.cumsum(begins)
        return table.drop_columns(["_in", "_parts", "_b"]).append_column("part", pa.array(part, pa.int64())).append_column("cut", pa.array(begins))

    done = both.groupBy(*named).applyInArrow(cut, rows.schema.add("part", "long").add("cut", "boolean"))
    return done, ends
