"""Which code points texts use, which fonts lack, and how much of a shared prefix a cache served."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X


def visible_texts(records: DataFrame, tokens_by_id: DataFrame | None = None, keep_tokens: bool = False) -> DataFrame:
    """records (ord, id, location, text, protected_tokens) with tokens taken out once each.

    A record's own tokens come first, then those listed for its id, then inherited_tokens if there.
    """
    none = F.lit(None).cast("array<string>")
    have = records.columns
    rows = records.withColumn("_own", F.col("protected_tokens") if "protected_tokens" in have else none)
    rows = rows.join(tokens_by_id.select("id", F.col("protected_tokens").alias("_listed")), "id", "left") if tokens_by_id is not None else rows.withColumn("_listed", none)
    tokens = F.coalesce("_own", "_listed", F.col("inherited_tokens") if "inherited_tokens" in have else none, F.array().cast("array<string>"))
    if not keep_tokens:
        rows = rows.withColumn("text", X.without_once(F.col("text"), tokens))
    return rows.drop("_own", "_listed")


def counted(batches):
    """cp, n of all texts of some Arrow batches, one row for each code point of a batch."""
    for batch in batches:
        found: Counter = Counter()
        for text in batch.column(0).to_pylist():
            found.update(text or "")
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["c", "n"])


def visible(df: DataFrame, exact: bool) -> DataFrame:
    return df.filter(X.is_visible_exact("c") if exact else X.is_visible(F.col("c")))


def characters(texts: DataFrame, exact: bool = False) -> DataFrame:
    """ord, location, cp, n: visible code points of each record, counted in the record.

    exact asks Python's Unicode tables for code points that newer versions name.
    """

    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                found = Counter(text or "")
                own = batch.select([0, 1]).take(pa.array([i] * len(found), pa.int64()))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["ord", "location", "c", "n"])

    kinds = texts.select("ord", "location").schema
    found = texts.select("ord", "location", "text").mapInArrow(run, kinds.add("c", "string").add("n", "long"))
    return visible(found, exact).select("ord", "location", F.ascii("c").alias("cp"), "n")


def histogram(texts: DataFrame, exact: bool = False) -> DataFrame:
    """cp, n of visible code points, counted in Arrow batches, so that few rows are shuffled."""
    chars = texts.select("text").mapInArrow(counted, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return visible(chars, exact).select(F.ascii("c").alias("cp"), "n")


def _first_places(batches):
    for batch in batches:
        first: dict = {}
        for location, place, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for c in set(text or ""):
                known = first.get((location, c))
                if known is None or place < known:
                    first[location, c] = place
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in first], pa.string()), pa.array(list(first.values()), pa.int64()), pa.array([k[1] for k in first], pa.string())], names=["location", "ord", "c"])


def first_locations(texts: DataFrame, most: int = 5) -> DataFrame:
    """cp, location, place (from 1): the first distinct locations of each code point in encounter order."""
    firsts = texts.select("location", "ord", "text").mapInArrow(_first_places, "location string, ord long, c string")
    at = visible(firsts.groupBy("c", "location").agg(F.min("ord").alias("ord")), False).select(F.ascii("c").alias("cp"), "location", "ord")
    w = Window.partitionBy("cp").orderBy("ord", "location")
    return at.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most).select("cp", "location", "place")


def uncovered(used: DataFrame, cmap: DataFrame) -> DataFrame:
    """cp, n, label of used code points that no font maps."""
    return used.join(cmap.select("cp").distinct(), "cp", "left_anti").withColumn("label", X.codepoint_label(F.col("cp")))


def coverage_report(used: DataFrame, cmap: DataFrame, probe: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """used, missing, probe_missing and errors counts and whether the fonts cover all.

    errors has a row for each font or input that can't be read; any of them fails the report, as do
    texts without a visible character and fonts without a character map.
    """
    counts = used.agg(F.count("*").alias("used")).join(uncovered(used, cmap).agg(F.count("*").alias("missing")))
    counts = counts.join(probe.select("cp").distinct().join(cmap.select("cp").distinct(), "cp", "left_anti").agg(F.count("*").alias("probe_missing")))
    counts = counts.join((errors if errors is not None else used.limit(0)).agg(F.count("*").alias("errors")))
    counts = counts.join(cmap.limit(1).agg((F.count("*") > 0).alias("mapped")))
    passed = (F.col("missing") == 0) & (F.col("probe_missing") == 0) & (F.col("errors") == 0) & (F.col("used") > 0) & F.col("mapped")
    return counts.withColumn("passed", passed).drop("mapped")


def cache_verdicts(usage: DataFrame, tolerance: int = 256) -> DataFrame:
    """usage (input_tokens, cached_input_tokens, expected_prefix_tokens) with threshold, rate, passed and verdict."""
    expected = F.col("expected_prefix_tokens")
    threshold = F.when(expected.isNotNull(), F.greatest(F.lit(0).cast("long"), expected - tolerance))
    passed = F.col("cached_input_tokens") >= threshold
    rows = usage.withColumn("minimum_cached_tokens", threshold).withColumn("noncached_input_tokens", F.col("input_tokens") - F.col("cached_input_tokens"))
    rows = rows.withColumn("cache_rate", F.try_divide(F.col("cached_input_tokens").cast("double"), F.col("input_tokens")))
    return rows.withColumn("passed", passed).withColumn("verdict", F.when(passed, "pass").when(~passed, "fail").otherwise("observed-only"))


def usage_problems(usage: DataFrame) -> DataFrame:
    """Rows whose counts can't be: negative, more cached than read, fewer than one call."""
    bad: Column = F.least("input_tokens", "cached_input_tokens", "output_tokens") < 0
    return usage.filter(bad | (F.col("cached_input_tokens") > F.col("input_tokens")) | (F.col("calls") < 1))
