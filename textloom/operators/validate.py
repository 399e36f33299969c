"""Checks of translations against their source: identity, order, tokens, characters, length, terms, repeats.

Every check gives rows (severity, code, id, message). Row rules are one projection over the matched
rows; structural rules are joins and aggregates over ids.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.functions.digests import is_digest
from textloom.operators.glossary import term_issues
from textloom.policy import Policy
from textloom.sources.typed import kind, parsed

# Issue codes and severities.
ERRORS = [
    "input-read", "source-id", "duplicate-source-id", "target-id", "duplicate-target-id", "missing-ids", "extra-ids", "id-order", "empty-translation", "source-hash",
    "protected-token-schema", "protected-token-count", "protected-token-order", "newline-count", "invalid-character", "issues-schema", "term_proposals-schema", "forbidden-term", "locked-term",
]
WARNINGS = ["unicode-normalization", "source-unchanged", "residual-source-script", "residual-kana", "length-ratio", "confidence", "preferred-term", "repeat-inconsistency"]
CONFIDENCE = ["high", "medium", "low"]


def severity_of(code: str) -> str:
    return "error" if code in ERRORS else "warning"


def issue(code: str, record_id: Column, message: Column) -> list[Column]:
    return [F.lit(severity_of(code)).alias("severity"), F.lit(code).alias("code"), record_id.cast("string").alias("id"), message.alias("message")]


def bad_ids(df: DataFrame, side: str) -> DataFrame:
    """Rows without an id, and ids that occur more than once (a row for each surplus one)."""
    blank = df.filter(F.coalesce(F.col("id"), F.lit("")) == "").select(*issue(f"{side}-id", F.col("id"), F.concat(F.lit("no id at "), F.col("ord"))))
    again = df.filter(F.coalesce(F.col("id"), F.lit("")) != "").groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    again = again.select("id", F.explode(F.sequence(F.lit(2).cast("long"), F.col("n"))).alias("k"))
    return blank.unionAll(again.select(*issue(f"duplicate-{side}-id", F.col("id"), F.lit("id occurs again"))))


def named(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("id"), F.lit("")) != "")


def missing_ids(source: DataFrame, target: DataFrame) -> DataFrame:
    return named(source).select("id").distinct().join(target.select("id"), "id", "left_anti")


def extra_ids(source: DataFrame, target: DataFrame) -> DataFrame:
    return named(target).select("id").distinct().join(source.select("id"), "id", "left_anti")


def order_breaks(source: DataFrame, target: DataFrame, bucket: int = 100_000) -> DataFrame:
    """Ids whose target row (duplicates too) isn't followed by rows of later source places only.

    Along the target's order, a row breaks if a source place before it is as late or later. The
    largest place so far is found in buckets of the order.
    """
    places = named(source).groupBy("id").agg(F.min("ord").alias("place"))
    return breaks_along(named(target).select("id", F.col("ord").alias("at")).join(places, "id"), bucket)


def breaks_along(rows: DataFrame, bucket: int = 100_000) -> DataFrame:
    """id, at of rows (id, at, place) that come after one with a place as late or later."""
    rows = rows.withColumn("b", F.floor(F.col("at") / bucket))
    inside = Window.partitionBy("b").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy("b").agg(F.max("place").alias("top"))
    tops = tops.select("b", F.max("top").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    rows = rows.withColumn("seen", F.max("place").over(inside)).join(tops, "b")
    return rows.filter(F.greatest("seen", "before") >= F.col("place")).select("id", "at")


def identified(source: DataFrame, target: DataFrame) -> DataFrame:
    """All rows of both sides, met by id in one exchange: id, ord, t (null for source rows), s (the last
    source row so far), place (the first one's), nth (among the side's rows of the id), last (of the id).

    Source rows come before target rows, each in order. A row without an id is alone.
    """
    blank = F.coalesce(F.col("id"), F.lit("")) == ""
    key = lambda side: F.when(blank, F.concat(F.lit(f"\0{side}:"), F.xxhash64("ord", F.monotonically_increasing_id()))).otherwise(F.col("id"))
    row = lambda s, t: F.struct("id", "ord", blank.alias("blank"), s.alias("s"), t.alias("t"))
    none = lambda df: F.lit(None).cast(df.schema)
    sides = source.select(key("s").alias("_key"), row(F.struct(*source.columns), none(target)).alias("_row")), target.select(key("t").alias("_key"), row(none(source), F.struct(*target.columns)).alias("_row"))
    # rows go as one column, and whole into each window, so that every use of the result needs the same exchange
    rows = sides[0].unionAll(sides[1]).repartition("_key")
    is_target, at = F.col("_row.t").isNotNull(), F.col("_row.ord")
    w = Window.partitionBy("_key").orderBy(is_target, at)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_source = F.when(~is_target, F.col("_row"))
    met = rows.select(
        "_row", F.last(from_source, ignorenulls=True).over(so_far).alias("_last"), F.first(from_source, ignorenulls=True).over(so_far).alias("_first"),
        F.row_number().over(Window.partitionBy("_key", is_target).orderBy(at)).alias("nth"), F.lead(F.lit(1)).over(w).isNull().alias("last"),
    )
    return met.select("_row.id", "_row.ord", "_row.t", F.col("_last.s").alias("s"), F.col("_first.ord").alias("place"), "nth", "last", "_row.blank")


def structural_issues(rows: DataFrame, allow_subset: bool = False) -> DataFrame:
    """Issues of ids, from identified rows: none or repeated ones, missing and extra ones."""
    is_target, known = F.col("t").isNotNull(), F.col("s").isNotNull()
    side = F.when(is_target, "target").otherwise("source")
    checks = [
        (F.col("blank"), F.concat(side, F.lit("-id")), F.concat(F.lit("no id at "), F.col("ord"))),
        (~F.col("blank") & (F.col("nth") > 1), F.concat(F.lit("duplicate-"), side, F.lit("-id")), F.lit("id occurs again")),
        (~F.col("blank") & is_target & ~known & (F.col("nth") == 1), F.lit("extra-ids"), F.lit("not in source")),
    ]
    if not allow_subset:
        checks.append((~F.col("blank") & ~is_target & F.col("last"), F.lit("missing-ids"), F.lit("not translated")))
    found = F.array(*(F.when(bad, F.struct(F.lit("error").alias("severity"), code.alias("code"), F.col("id"), message.alias("message"))) for bad, code, message in checks))
    return rows.select(F.explode(F.filter(found, lambda i: i.isNotNull())).alias("i")).select("i.*")


def matched(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows with their translation: id, ord, s.* and t.* as structs; of repeated ids the last rows at the first source place."""
    return pairs_of(identified(source, target))


def pairs_of(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("blank") & F.col("t").isNotNull() & F.col("last") & F.col("s").isNotNull()).select("id", F.col("place").alias("ord"), "s", "t")


def row_issues(pairs: DataFrame, policy: Policy) -> DataFrame:
    """Issues of matched rows; an empty translation hides the other checks of its row.

    Only visible text (without protected tokens, stripped) counts for ratio, residue and sameness.
    """
    has = lambda side, name: name in pairs.schema[side].dataType.names
    get = lambda side, name, kind: F.col(f"{side}.{name}") if has(side, name) else F.lit(None).cast(kind)
    rows = pairs.select(
        "id", "ord", F.coalesce(F.col("s.text"), F.lit("")).alias("src"), F.col("t.translation").alias("out"),
        F.coalesce(get("s", "protected_tokens", "array<string>"), F.array().cast("array<string>")).alias("given"),
        get("s", "source_hash", "string").alias("want_hash"), get("t", "source_hash", "string").alias("got_hash"), get("t", "confidence", "string").alias("confidence"),
        *(get("t", f"{f}_raw", "string").alias(f"{f}_raw") for f in ("issues", "term_proposals")),
    )
    torn = F.exists("given", lambda x: x.isNull())  # such an array is an issue, and none of its tokens counts
    rows = rows.withColumn("tokens", F.when(torn, F.array().cast("array<string>")).otherwise(F.col("given")))
    if policy.check_nfc:
        rows = rows.withColumn("nfc", X.is_nfc("out"))
    rows = rows.withColumn("src_seen", X.strip(X.without_all(F.col("src"), F.col("tokens")))).withColumn("out_seen", X.strip(X.without_all(F.col("out"), F.col("tokens"))))
    out, src, tokens = F.col("out"), F.col("src"), F.col("tokens")
    low, high = policy.ratios()
    ratio = F.length("out_seen") / F.length("src_seen")
    checks: list[tuple[str, Column, Column]] = [
        ("source-hash", (F.coalesce("want_hash", F.lit("")) != "") & F.col("got_hash").isNotNull() & (F.col("got_hash") != F.col("want_hash")), F.lit("source_hash differs")),
        ("protected-token-schema", torn, F.lit("protected_tokens must be strings")),
        ("protected-token-order", (F.size(tokens) > 0) & ~X.in_order(out, tokens), F.lit("tokens are missing or out of order")),
        ("newline-count", X.newlines(src) != X.newlines(out), F.concat(F.lit("expected "), X.newlines(src), F.lit(", found "), X.newlines(out))),
        ("invalid-character", X.has_invalid(out), F.lit("has U+FFFD or NUL")),
        ("source-unchanged", (out == src) & (src != "") & X.is_semantic(F.col("src_seen")), F.lit("translation equals source")),
        ("length-ratio", (F.col("src_seen") != "") & ((ratio < low) | (ratio > high)), F.format_string("ratio %.2f", ratio)),
        ("confidence", ~F.coalesce(F.col("confidence").isin(CONFIDENCE), F.lit(False)), F.lit("confidence should be high, medium or low")),
        *((f"{f}-schema", F.col(f"{f}_raw").isNotNull() & (kind(parsed(F.col(f"{f}_raw"))) != "array"), F.lit("must be an array")) for f in ("issues", "term_proposals")),
    ]
    if policy.check_nfc:
        checks.append(("unicode-normalization", ~F.col("nfc"), F.lit("not in normal form C")))
    if (residue := policy.residual()) is not None:
        left = F.regexp_extract_all("out_seen", F.lit(residue), F.lit(0))
        checks.append((policy.residual_code, F.col("out_seen").rlike(residue), F.concat(F.lit("residue: "), F.array_join(F.slice(left, 1, 12), ""))))
    full = F.coalesce(out, F.lit("")) != ""
    entry = lambda code, message: F.struct(F.lit(severity_of(code)).alias("severity"), F.lit(code).alias("code"), F.col("id").alias("id"), message.cast("string").alias("message"))
    single = [F.when(full & cond, entry(code, message)) for code, cond, message in checks]
    single.append(F.when(~full, entry("empty-translation", F.lit("translation is empty"))))
    counts = F.when(full, F.transform(X.miscounted(out, tokens), lambda t: entry("protected-token-count", t))).otherwise(F.array().cast("array<struct<severity:string,code:string,id:string,message:string>>"))
    every = F.concat(F.filter(F.array(*single), lambda i: i.isNotNull()), counts)
    return rows.select(F.explode(every).alias("i")).select("i.*")


def repeat_inconsistencies(pairs: DataFrame) -> DataFrame:
    """source text, number of different translations, for semantic texts with more than one."""
    rows = pairs.select(F.coalesce(F.col("s.text"), F.lit("")).alias("src"), F.col("t.translation").alias("out")).filter((F.col("src") != "") & (F.coalesce("out", F.lit("")) != ""))
    return rows.groupBy("src").agg(F.countDistinct("out").alias("n")).filter((F.col("n") > 1) & X.is_semantic(F.col("src")))


def validate(source: DataFrame, target: DataFrame, policy: Policy, glossary: DataFrame | None = None, allow_subset: bool = False) -> DataFrame:
    """All issues of a draft: severity, code, id, message."""
    rows = identified(source, target)
    pairs = pairs_of(rows)
    found = [structural_issues(rows, allow_subset)]
    shared = rows.filter(~F.col("blank") & F.col("t").isNotNull() & F.col("s").isNotNull()).select("id", F.col("ord").alias("at"), "place")
    broken = breaks_along(shared).agg(F.count("*").alias("n")).filter("n > 0")
    found.append(broken.select(*issue("id-order", F.lit(None), F.concat(F.col("n").cast("string"), F.lit(" rows out of order")))))
    found.append(row_issues(pairs, policy))
    found.append(repeat_inconsistencies(pairs).select(*issue("repeat-inconsistency", F.lit(None), F.substr("src", F.lit(1), F.lit(40)))))
    if glossary is not None:
        found.append(term_issues(pairs, glossary, policy).select(F.expr("CASE WHEN code = 'preferred-term' THEN 'warning' ELSE 'error' END").alias("severity"), "code", "id", F.col("source").alias("message")))
    return reduce(DataFrame.unionAll, found)


def summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity", "code").agg(F.count("*").alias("n"))


def verdict(issues: DataFrame) -> DataFrame:
    """errors, warnings and whether the draft passes."""
    counts = issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    return counts.withColumn("passed", F.col("errors") == 0)


def source_problems(source: DataFrame) -> DataFrame:
    """Records that an extraction must not have: severity, code, id, message."""
    bad_hash = source.filter(~is_digest(F.col("source_hash"))).select(F.lit("error").alias("severity"), F.lit("source-hash").alias("code"), "id", F.lit("invalid digest").alias("message"))
    no_text = source.filter(F.col("text").isNull()).select(F.lit("error").alias("severity"), F.lit("source-text").alias("code"), "id", F.lit("no text").alias("message"))
    return reduce(DataFrame.unionAll, [bad_ids(source, "source"), bad_hash, no_text])
