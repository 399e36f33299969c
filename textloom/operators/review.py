"""Sparse review deltas over drafts, guarded merges of approved files into source order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.functions.digests import record_digest, source_digest
from textloom.operators.validate import order_breaks

SEVERITIES = ["minor", "major"]
#: A delta has these fields and no others.
DELTA_FIELDS = ["id", "reviewer_translation", "reason", "severity"]
#: What a report that exists already must have in common with the one of now.
FROZEN_FIELDS = ["job_id", "reviewed_source_digest", "reviewed_draft_digest", "review_delta_digest", "reviewed_entry_count", "coverage", "delta_count"]


class GuardError(ValueError):
    """A write that must not happen; says which guard fails and where."""


def delta_problems(source: DataFrame, draft: DataFrame, delta: DataFrame) -> DataFrame:
    """guard, id for each guard that a review's rows break; no rows if the review may be applied.

    Every row of the draft must have a translation of the source's shape, each row of the delta too.
    """
    tokens = F.coalesce("protected_tokens", F.array().cast("array<string>")) if "protected_tokens" in source.columns else F.array().cast("array<string>")
    shapes = source.select("id", F.col("text").alias("src"), tokens.alias("tokens"))
    absent = [c for c in DELTA_FIELDS if c not in delta.columns]
    given = delta.select("*", *(F.lit(None).cast("string").alias(c) for c in absent))

    def shape(out, prefix=""):
        found = [("empty", F.coalesce(out, F.lit("")) == ""), ("tokens", F.size(X.miscounted(out, F.col("tokens"))) > 0), ("token-order", (F.size("tokens") > 0) & ~X.in_order(out, F.col("tokens"))), ("newlines", X.newlines(out) != X.newlines(F.col("src"))), ("invalid", X.has_invalid(out))]
        return [(prefix + g, c) for g, c in found]

    def broken(pairs, rules):
        every = F.filter(F.array(*(F.when(c, F.lit(g)) for g, c in rules)), lambda g: g.isNotNull())
        return pairs.select("id", F.explode(every).alias("guard")).select("guard", "id")

    stated = [("reason", F.coalesce(X.strip(F.col("reason")), F.lit("")) == ""), ("severity", ~F.coalesce(F.col("severity").isin(SEVERITIES), F.lit(False)))]
    parts = [broken(given.join(shapes, "id"), [*shape(F.col("reviewer_translation")), *stated]), broken(draft.select("id", "translation").join(shapes, "id"), shape(F.col("translation"), "draft-"))]
    parts.append(source.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit("empty-job").alias("guard"), F.lit(None).cast("string").alias("id")))
    parts.append(delta.join(source.select("id"), "id", "left_anti").select(F.lit("unknown-id").alias("guard"), "id"))
    parts.append(delta.groupBy("id").count().filter("count > 1").select(F.lit("duplicate-id").alias("guard"), "id"))
    parts.append(order_breaks(source, delta).select(F.lit("delta-order").alias("guard"), "id"))
    both = source.select("id", F.lit(1).alias("s")).join(draft.select("id", F.lit(1).alias("t")), "id", "full_outer")
    parts.append(both.filter("s is null or t is null").select(F.lit("draft-ids").alias("guard"), "id"))
    parts.append(order_breaks(source, draft).select(F.lit("draft-order").alias("guard"), "id"))
    if "source_hash" in draft.columns and "source_hash" in source.columns:
        stale = draft.join(source.select("id", F.col("source_hash").alias("want")), "id").filter("source_hash is not null and source_hash <> want")
        parts.append(stale.select(F.lit("stale-hash").alias("guard"), "id"))
    extra = [c for c in delta.columns if c not in (*DELTA_FIELDS, "ord", "raw") and not c.startswith("__")]
    if extra or absent:
        parts.append(delta.limit(1).select(F.lit("fields").alias("guard"), F.lit(",".join([*extra, *(f"no {c}" for c in absent)])).alias("id")))
    return reduce(DataFrame.unionAll, parts)


def guard(problems: DataFrame, what: str) -> None:
    """Fails if there is any row, naming the first ten."""
    if some := problems.limit(10).collect():
        raise GuardError(f"{what}: " + "; ".join(" ".join(map(str, r)) for r in some))


def overlay(draft: DataFrame, delta: DataFrame, source: DataFrame) -> DataFrame:
    """The draft with reviewed texts in place of its own and source hashes restored; other fields stay."""
    changed = delta.select("id", F.col("reviewer_translation").alias("_new"))
    rows = draft.join(changed, "id", "left").withColumn("translation", F.coalesce("_new", "translation")).drop("_new")
    if "source_hash" in source.columns:
        rows = rows.drop("source_hash").join(source.select("id", "source_hash"), "id", "left")
    return rows


def review_report(delta: DataFrame, draft: DataFrame) -> DataFrame:
    """reviewed entries, deltas, major and minor ones, coverage and whether the report passes."""
    counts = delta.agg(F.count("*").alias("delta_count"), F.count_if(F.col("severity") == "major").alias("major_count"), F.count_if(F.col("severity") == "minor").alias("minor_count"))
    return draft.agg(F.count("*").alias("reviewed_entry_count")).join(counts).withColumn("coverage", F.lit("all-entries")).withColumn("passed", F.lit(True))


def job_review_report(job_id: str, source: DataFrame, draft: DataFrame, delta: DataFrame) -> DataFrame:
    """One row: a job's report with the digests of what was reviewed. draft and delta have their records in raw (JSON)."""
    out = review_report(delta, draft).withColumn("schema_version", F.lit(2)).withColumn("job_id", F.lit(job_id))
    for name, digest in (("reviewed_source_digest", source_digest(source, [], strict=False)), ("reviewed_draft_digest", record_digest(draft, [])), ("review_delta_digest", record_digest(delta, []))):
        out = out.crossJoin(digest.withColumnRenamed("digest", name))
    return out


def stale_fields(existing: dict, report: DataFrame) -> list[str]:
    """Frozen fields in which an existing report differs from the one of now."""
    now = report.first().asDict()
    return [f for f in FROZEN_FIELDS if existing.get(f) != now[f]]


def merge_problems(source: DataFrame, approved: DataFrame, allow_incomplete: bool = False) -> DataFrame:
    """guard, id: ids in two files (both named), unknown ids, empty texts, other hashes, untranslated ids."""
    twice = approved.groupBy("id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("path")).alias("paths")).filter("n > 1")
    parts = [
        twice.select(F.lit("overlap").alias("guard"), F.concat_ws(" ", F.col("id"), F.array_join("paths", " and ")).alias("id")), approved.join(source.select("id"), "id", "left_anti").select(F.lit("unknown-id").alias("guard"), "id"),
        approved.filter(F.coalesce("translation", F.lit("")) == "").select(F.lit("empty").alias("guard"), "id"),
    ]
    if "source_hash" in approved.columns:
        off = approved.join(source.select("id", F.col("source_hash").alias("want")), "id").filter("source_hash is not null and source_hash <> want")
        parts.append(off.select(F.lit("hash").alias("guard"), "id"))
    if not allow_incomplete:
        parts.append(source.join(approved.select("id"), "id", "left_anti").select(F.lit("incomplete").alias("guard"), "id"))
    return reduce(DataFrame.unionAll, parts)


def merge_in_order(source: DataFrame, approved: DataFrame) -> DataFrame:
    """Approved rows at their source places, with source hashes filled in; sort by ord when written."""
    keep = [c for c in approved.columns if c not in ("ord", "source_hash", "path")]
    return approved.select(*keep).join(source.select("id", "ord", "source_hash"), "id")
