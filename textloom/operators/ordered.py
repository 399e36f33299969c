"""Work along one global order without one task for all: buckets of the order and a small table of their ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_group_numbers(df: DataFrame, key: Column, order: str = "ord", bucket: int = 100_000, name: str = "grp", breaks: Column | None = None) -> DataFrame:
    """Adds the number (from 0) of each row's run of equal keys along the order.

    A run also ends before a row where breaks holds. Buckets of the order are sorted apart; only each
    bucket's first and last key and its count of changes meet in one small table.
    """
    rows = df.withColumn("_key", key).withColumn("_break", F.coalesce(breaks, F.lit(False)) if breaks is not None else F.lit(False)).withColumn("_bucket", F.floor(F.col(order) / bucket))
    inside = Window.partitionBy("_bucket").orderBy(order)
    first = F.row_number().over(inside) == 1
    change = F.when(first, 0).otherwise((~F.col("_key").eqNullSafe(F.lag("_key").over(inside)) | F.col("_break")).cast("int"))
    rows = rows.withColumn("_change", change)
    ends = rows.groupBy("_bucket").agg(F.min_by(F.struct("_key", "_break"), order).alias("head"), F.max_by("_key", order).alias("tail"), F.sum("_change").alias("n"))
    across = Window.orderBy("_bucket")  # one row for each bucket
    joins = F.when(F.row_number().over(across) == 1, 0).otherwise((~F.col("head._key").eqNullSafe(F.lag("tail").over(across)) | F.col("head._break")).cast("int"))
    ends = ends.withColumn("_joins", joins)
    base = F.sum(F.col("_joins")).over(across) + F.coalesce(F.sum("n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select("_bucket", base.alias("_base"))
    out = rows.join(ends, "_bucket")  # rows are dealt by bucket already
    return out.withColumn(name, (F.col("_base") + F.sum("_change").over(inside)).cast("long")).drop("_key", "_break", "_bucket", "_change", "_base")


def last_value_first_place(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """One row for each key: the last row's values at the first row's place."""
    value = F.struct(*df.columns)
    kept = df.groupBy(key).agg(F.max_by(value, order).alias("_v"), F.min(order).alias("_at"))
    return kept.select(*(F.col("_at").alias(c) if c == order else F.col(f"_v.{c}").alias(c) for c in df.columns))


def folded(rows: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]], kind: str, block: int = 512) -> tuple[Column, Column]:
    """A fold over an array that also gives out values: the values, and the last state.

    step(state, row) gives the next state, whether a value is given out here, and the value, which has
    the type `kind`. An array grows by copying, so values are gathered in blocks of rows first; the
    cost is in proportion to the rows.
    """
    none = F.array().cast(f"array<{kind}>")

    def within(acc, row):
        after, gives, value = step(acc["state"], row)
        return F.struct(after.alias("state"), F.when(gives, F.concat(acc["out"], F.array(value))).otherwise(acc["out"]).alias("out"))

    def one_block(acc, b):
        zero = F.struct(F.element_at(acc, -1)["state"].alias("state"), none.alias("out"))
        return F.concat(acc, F.array(F.aggregate(F.slice(rows, b * block + 1, F.lit(block)), zero, within)))

    first = F.array(F.struct(state.alias("state"), none.alias("out")))
    blocks = F.when(F.size(rows) > 0, F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / block).cast("int"))).otherwise(F.array().cast("array<int>"))
    done = F.aggregate(blocks, first, one_block)
    return F.flatten(F.transform(done, lambda x: x["out"])), F.element_at(done, -1)["state"]
