"""The project's stage machine, job statuses, plan and graph checks, and cross-artifact consistency."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.digests import is_digest, record_digest, source_digest
from textloom.functions.text import meaningful, strip
from textloom.operators.review import GuardError

# Stages in order, job statuses, research lanes and their aliases.
STAGES = ["initialized", "researched", "roundtrip-proven", "extracted", "bible-frozen", "plan-approved", "translating", "reviewed", "validated", "repacked", "playtested", "released"]
STATUSES = ["pending", "assigned", "translated", "validated", "reviewed", "approved", "merged", "failed"]
ACTIVE = ["assigned", "translated", "validated", "reviewed", "approved", "merged"]
LANES = {"engine": "engine", "unpack": "engine", "canon": "canon", "jp-canon": "canon", "target-locale": "target-locale", "zh-terminology": "target-locale"}
REQUIRED_LANES = ["engine", "canon", "target-locale"]
GLOSSARY_FIELDS = ["source", "target", "reading", "category", "status", "scope", "source_url", "notes"]


def problems(*parts: DataFrame) -> DataFrame:
    """gate, item, problem of all parts."""
    return reduce(DataFrame.unionAll, parts)


def problem(df: DataFrame, gate: str, item: str, text: str) -> DataFrame:
    return df.select(F.lit(gate).alias("gate"), F.expr(item).cast("string").alias("item"), F.lit(text).alias("problem"))


def whole(df: DataFrame, failed, gate: str, text: str) -> DataFrame:
    """A problem of a whole table: failed is a condition over its aggregates, also of an empty one."""
    return problem(df.agg(failed.alias("failed")).filter(F.coalesce("failed", F.lit(True))), gate, "NULL", text)


def history_problems(history: DataFrame) -> DataFrame:
    """item (project), problem: histories (project, n, stage, evidence array) that aren't the contiguous first
    stages with evidence, in order of n (from 0)."""
    order = F.array(*map(F.lit, STAGES))
    rows = history.withColumn("want", F.try_element_at(order, (F.col("n") + 1).cast("int")))
    gaps = rows.groupBy("project").agg(F.count_if(~F.col("want").eqNullSafe(F.col("stage"))).alias("off"), F.max("n").alias("top"), F.count("*").alias("k"))
    bad = gaps.filter((F.col("off") > 0) | (F.col("top") + 1 != F.col("k")))
    bare = rows.filter(F.coalesce(F.size("evidence"), F.lit(-1)) <= 0)
    return bad.select(F.col("project").alias("item"), F.lit("not contiguous").alias("problem")).unionAll(bare.select(F.col("project").alias("item"), F.concat(F.lit("no evidence for "), F.coalesce("stage", F.lit("?"))).alias("problem")))


def missing_evidence(history: DataFrame, existing: DataFrame) -> DataFrame:
    """item (project), problem: evidence of histories that is no path in existing (path, below the project or absolute)."""
    named = history.select(F.col("project").alias("item"), "stage", F.explode("evidence").alias("path")).filter("coalesce(path, '') <> ''")
    gone = named.join(existing.select("path").distinct(), "path", "left_anti")
    return gone.select("item", F.concat(F.lit("no evidence at "), "path", F.lit(" for "), F.coalesce("stage", F.lit("?"))).alias("problem"))


def failed_gates(through: str, found: dict[str, list[str]]) -> list[str]:
    """Problems of all gates up to a stage, earlier ones again too; a gate that wasn't evaluated fails."""
    return [f"{gate}: {text}" for gate in STAGES[: STAGES.index(through) + 1] for text in found.get(gate, ["not evaluated"])]


def may_advance(current: str, to: str, failed_gates: list[str]) -> list[str]:
    """Why a project may not go from one stage to another; every gate up to the new one must hold."""
    if current not in STAGES or to not in STAGES:
        return ["unknown stage"]
    out = [] if STAGES.index(to) == STAGES.index(current) + 1 else ["stages advance one by one"]
    return out + [f"gate {g} fails" for g in STAGES[: STAGES.index(to) + 1] if g in failed_gates]


def latest_status(log: DataFrame, by: str = "job_id") -> DataFrame:
    """The last status of each job in a log (by, seq, status)."""
    return log.groupBy(by).agg(F.max_by("status", "seq").alias("status"), F.count("*").alias("changes"))


def set_status(jobs: DataFrame, changes: DataFrame) -> DataFrame:
    """jobs with compare-and-set changes (job_id, from_status or null, to_status, note) applied where they hold.

    A change to no known status and one whose from_status isn't the job's leaves the job as it is;
    notes are appended. Fails on job_ids that occur twice in jobs or changes, and on changes to unknown jobs.
    """
    for name, rows in (("jobs", jobs), ("changes", changes)):
        if twice := rows.groupBy("job_id").count().filter("count > 1").first():
            raise GuardError(f"{name}: duplicate job_id {twice['job_id']}")
    if unknown := changes.join(jobs.select("job_id"), "job_id", "left_anti").first():
        raise GuardError(f"unknown job_id {unknown['job_id']}")
    joined = jobs.join(changes, "job_id", "left")
    holds = F.col("to_status").isin(STATUSES) & (F.col("from_status").isNull() | (F.col("from_status") == F.col("status")))
    notes = F.coalesce("status_notes", F.array().cast("array<string>")) if "status_notes" in jobs.columns else F.array().cast("array<string>")
    done = joined.withColumn("status_notes", F.when(holds & F.col("note").isNotNull(), F.concat(notes, F.array("note"))).otherwise(notes))
    return done.withColumn("status", F.when(F.coalesce(holds, F.lit(False)), F.col("to_status")).otherwise(F.col("status"))).drop("from_status", "to_status", "note")


def missing_lanes(sources: DataFrame) -> DataFrame:
    """Required research lanes that no source has, by the lanes' aliases, letter by letter."""
    spark = sources.sparkSession
    alias = F.create_map(*(F.lit(x) for pair in LANES.items() for x in pair))
    have = sources.select(alias[F.col("lane")].alias("lane"))
    return spark.createDataFrame([(x,) for x in REQUIRED_LANES], "lane string").join(have, "lane", "left_anti")


def research_problems(sources: DataFrame, rich: bool = True) -> DataFrame:
    alias = F.create_map(*(F.lit(x) for pair in LANES.items() for x in pair))
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    basic = blank("url") | blank("title") | alias[F.col("lane")].isNull() | (F.coalesce(F.size("claims"), F.lit(-1)) <= 0)
    parts = [problem(missing_lanes(sources), "researched", "lane", "missing lane"), problem(sources.filter(basic), "researched", "url", "needs url, title, lane and claims")]
    if rich:
        language = F.lit(True)
        for name in ("source_language", "language"):  # the older name counts where the newer one is blank
            language = language & blank(name) if name in sources.columns else language
        lacks = language | reduce(lambda a, b: a | b, map(blank, ("source_type", "authority", "retrieved_at", "scope"))) | ~F.coalesce(F.col("confidence").isin("high", "medium", "low"), F.lit(False))
        parts.append(problem(sources.filter(~basic & lacks), "researched", "url", "incomplete description"))
    return problems(*parts)


def initialization_problems(project: dict | None, schema_version: int = 3) -> list[str]:
    """Problems of the project's own record."""
    if not isinstance(project, dict) or not project.get("game_name"):
        return ["initialized: game_name is missing"]
    if schema_version < 3:
        return []
    given = [project.get(k) for k in ("source_locale", "target_locale")]
    out = [f"initialized: {k} is missing" for k, v in zip(("source_locale", "target_locale"), given, strict=True) if not isinstance(v, str) or not v]
    if all(isinstance(v, str) for v in given) and given[0].casefold() == given[1].casefold():
        out.append("initialized: source_locale and target_locale must be different")
    return out


def research_gate(manifest: dict | None, sources: DataFrame | None, documents: DataFrame, schema_version: int = 3) -> list[str]:
    """Problems of the researched gate: manifest totals, sources (None where they don't parse) and unpack notes."""
    out = [] if isinstance(manifest, dict) and manifest.get("file_count") else ["researched: manifest describes no file"]
    rows = document_problems(documents, ["unpack-notes"], "researched")
    if sources is None:
        out.append("researched: sources are invalid")
    else:
        rows = problems(research_problems(sources, schema_version >= 2), rows)
    return out + [f"{r['gate']}: {r['item']}: {r['problem']}" for r in rows.distinct().orderBy("problem", "item").collect()]


def roundtrip_problems(report: dict | None, files: dict[str, int]) -> list[str]:
    """Problems of the proof of a round trip: its report and the numbers of files in its three folders."""
    out = [] if isinstance(report, dict) and report.get("passed") is True else ["roundtrip-proven: report must have passed"]
    return out + [f"roundtrip-proven: folder {f} is empty" for f in ("input", "unpacked", "repacked") if not files.get(f)]


def inventory_problems(token_report: dict | None) -> list[str]:
    """Problem of the extracted gate besides extraction_problems: the control tokens' engines."""
    engines = token_report.get("engines") if isinstance(token_report, dict) else None
    return [] if isinstance(engines, list) and engines else ["extracted: no engine inventory"]


def bible_problems(
    version: dict | None, documents: DataFrame, characters: dict | None, voice: dict | None, route_knowledge: dict | None, calibration: DataFrame | None, glossary: DataFrame | None, schema_version: int = 3,
) -> list[str]:
    """Problems of the bible-frozen gate; None for a part that is missing or doesn't parse."""
    record = lambda x, *fields: isinstance(x, dict) and all(isinstance(x.get(f, {}), dict) for f in fields)
    number = version.get("version") if isinstance(version, dict) else None
    people = characters.get("characters") if isinstance(characters, dict) else None
    holds = {
        "must be frozen at version >= 1": isinstance(version, dict) and version.get("frozen") is True and isinstance(number, int) and number >= 1,
        "no characters": isinstance(people, list) and bool(people) and all(isinstance(x, dict) for x in people),
        "no voice definitions": record(voice, "characters", "narrator") and bool(voice.get("characters") or voice.get("narrator")),
        "route knowledge is invalid": record(route_knowledge, "global", "routes"),
        "no approved calibration examples": calibration is not None and not calibration.isEmpty(),
        "no terminology rows": glossary is not None and not glossary.isEmpty(),
        "glossary lacks required columns": glossary is not None and set(GLOSSARY_FIELDS) <= set(glossary.columns),
    }
    names = ["world", "honorifics", *(["language-profile"] if schema_version >= 3 else [])]
    empty = sorted(r["item"] for r in document_problems(documents, names).collect())
    return [f"bible-frozen: {text}" for text, good in holds.items() if not good] + [f"bible-frozen: {n}: no meaningful content" for n in empty]


def extraction_problems(source: DataFrame, nodes: DataFrame) -> DataFrame:
    gate = "extracted"
    dup = source.groupBy("id").count().filter("count > 1 and id is not null")
    return problems(
        whole(source, F.count("*") == 0, gate, "no records"), problem(source.filter("coalesce(id, '') = ''"), gate, "ord", "no id"), problem(dup, gate, "id", "id not unique"), problem(source.filter(~is_digest(F.col("source_hash"))), gate, "id", "invalid source_hash"),
        problem(source.filter("text is null"), gate, "id", "no text"), problem(source.filter("coalesce(file, '') = ''"), gate, "id", "no file"), problem(source.filter("ord is null"), gate, "id", "no order"),
        problem(source.filter("protected_tokens is null or exists(protected_tokens, t -> t is null)"), gate, "id", "protected_tokens must be strings"), whole(nodes, F.count("*") == 0, gate, "no scene nodes"),
    )


def document_problems(documents: DataFrame, names: list[str], gate: str = "bible-frozen") -> DataFrame:
    """Named Markdown documents (name, content) that are missing or say nothing."""
    want = documents.sparkSession.createDataFrame([(n,) for n in names], "name string")
    return problem(want.join(documents, "name", "left").filter(~meaningful(F.coalesce("content", F.lit("")))), gate, "name", "no meaningful content")


def symmetric(edges: DataFrame) -> DataFrame:
    e = edges.filter("coalesce(src, '') <> '' and coalesce(dst, '') <> ''").select("src", "dst")
    return e.unionAll(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def adjacency_violations(jobs: DataFrame, source: DataFrame, edges: DataFrame) -> DataFrame:
    """job_id, id of adjacent entries in no scene of the job or next to one; scene null if the id is unknown."""
    scenes = source.select("id", F.coalesce(F.nullif("scene_id", F.lit("")), F.nullif("file", F.lit("")), F.lit("")).alias("scene"))
    near = jobs.select("job_id", "scene_ids", F.explode("adjacent_entry_ids").alias("id")).join(scenes, "id", "left")
    far = near.filter(F.col("scene").isNull() | ~F.array_contains("scene_ids", F.col("scene")))
    pairs = symmetric(edges).select(F.col("src").alias("own"), F.col("dst").alias("scene"))
    linked = far.filter("scene is not null").select("job_id", "id", "scene", F.explode("scene_ids").alias("own")).join(pairs, ["own", "scene"]).select("job_id", "id")
    return far.select("job_id", "id", "scene").join(linked, ["job_id", "id"], "left_anti").distinct()


def unknown_predecessors(jobs: DataFrame) -> DataFrame:
    return jobs.select("job_id", F.explode("predecessors").alias("predecessor")).join(jobs.select(F.col("job_id").alias("predecessor")), "predecessor", "left_anti")


def plan_coverage(jobs: DataFrame, source: DataFrame) -> DataFrame:
    """One row: missing, extra and overlapping entry ids of a whole plan."""
    counts = jobs.select(F.explode("entry_ids").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    both = source.select("id").distinct().withColumn("s", F.lit(1)).join(counts, "id", "full_outer")
    return both.agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("s").isNull()).alias("extra"), F.count_if(F.col("n") > 1).alias("overlaps"))


def digest_mismatches(jobs: DataFrame, source: DataFrame) -> DataFrame:
    """Jobs whose source_digest isn't that of their entries (all of which must exist)."""
    planned = jobs.select("job_id", "source_digest", "entry_ids", F.xxhash64("entry_ids").alias("_list"))  # a job_id may be planned twice
    key = ["job_id", "_list"]
    listed = planned.select(*key, "entry_ids").distinct().select(*key, F.posexplode("entry_ids").alias("pos", "id")).join(source.select("id", "source_hash", "text"), "id", "left")
    found = source_digest(listed.withColumn("ord", F.col("pos")), key, strict=False)
    known = listed.groupBy(*key).agg(F.count_if(F.col("text").isNull()).alias("unknown"))
    both = planned.join(found, key, "left").join(known, key, "left")
    off = F.when(F.coalesce("unknown", F.lit(0)) == 0, ~F.col("source_digest").eqNullSafe(F.col("digest"))).otherwise(~is_digest(F.col("source_digest")))
    return both.filter(off).select("job_id")


def plan_problems(jobs: DataFrame, source: DataFrame, edges: DataFrame, version: int) -> DataFrame:
    gate = "plan-approved"
    covered = plan_coverage(jobs, source)
    arrays = []
    for field in ("entry_ids", "scene_ids", "source_files"):
        arrays.append(problem(jobs.filter(f"coalesce(size({field}), -1) <= 0 or exists({field}, x -> coalesce(x, '') = '')"), gate, "job_id", f"{field} must be non-empty strings"))
    for field in ("predecessors", "adjacent_entry_ids"):
        arrays.append(problem(jobs.filter(f"{field} is null or exists({field}, x -> coalesce(x, '') = '')"), gate, "job_id", f"{field} must be strings"))
    return problems(
        whole(jobs, F.count("*") == 0, gate, "no jobs"), problem(jobs.filter("coalesce(job_id, '') = ''"), gate, "NULL", "no job_id"), problem(jobs.groupBy("job_id").count().filter("count > 1"), gate, "job_id", "job_id not unique"),
        problem(jobs.filter("not coalesce(plan_approved, false)"), gate, "job_id", "not approved"), problem(jobs.filter(f"bible_version is distinct from {int(version)}"), gate, "job_id", "stale bible_version"), problem(digest_mismatches(jobs, source), gate, "job_id", "source_digest differs"),
        problem(jobs.filter(strip(F.coalesce("context_notes", F.lit(""))) == ""), gate, "job_id", "no context_notes"), *arrays, problem(unknown_predecessors(jobs), gate, "job_id", "unknown predecessor"), problem(adjacency_violations(jobs, source, edges), gate, "job_id", "adjacent id not connected"),
        problem(covered.filter("missing + extra > 0"), gate, "concat(missing, ' missing, ', extra, ' extra')", "coverage mismatch"), problem(covered.filter("overlaps > 0"), gate, "overlaps", "entries overlap"),
    )


def translation_problems(jobs: DataFrame, bundles: DataFrame, prefix_id: str, prefix_sha256: str) -> DataFrame:
    """Active jobs against their bundles (job_id, valid, source_digest, bible_version, shared_prefix_id, shared_prefix_sha256, coverage_valid)."""
    gate = "translating"
    active = jobs.filter(F.col("status").isin(ACTIVE))
    both = active.select("job_id", "source_digest", "bible_version").join(bundles.select("job_id", "valid", F.col("source_digest").alias("b_digest"), F.col("bible_version").alias("b_version"), "shared_prefix_id", "shared_prefix_sha256", "coverage_valid"), "job_id", "left")
    good = both.filter("coalesce(valid, false)")
    return problems(
        whole(active, F.count("*") == 0, gate, "no active job"), problem(both.filter("not coalesce(valid, false)"), gate, "job_id", "no valid bundle"), problem(good.filter("b_digest is distinct from source_digest"), gate, "job_id", "stale source_digest"),
        problem(good.filter("b_version is distinct from bible_version"), gate, "job_id", "stale bible_version"), problem(good.filter(~F.col("shared_prefix_id").eqNullSafe(F.lit(prefix_id))), gate, "job_id", "another shared prefix"),
        problem(good.filter(~F.col("shared_prefix_sha256").eqNullSafe(F.lit(prefix_sha256))), gate, "job_id", "stale shared prefix"), problem(good.filter("not coalesce(coverage_valid, false)"), gate, "job_id", "invalid coverage"),
    )


def review_problems(jobs: DataFrame, reports: DataFrame, drafts: DataFrame) -> DataFrame:
    """Jobs against their review reports and the digests of the drafts (job_id, ord, raw: each record's JSON) that they saw."""
    gate = "reviewed"
    r = reports.select("job_id", "passed", "coverage", "reviewed_source_digest", "reviewed_entry_count", "reviewed_draft_digest")
    both = jobs.select("job_id", "status", "source_digest", F.size("entry_ids").alias("n")).join(r, "job_id", "left").join(record_digest(drafts, ["job_id"]), "job_id", "left")
    off = "not coalesce(passed and coverage = 'all-entries' and reviewed_source_digest = source_digest and reviewed_entry_count = n and reviewed_draft_digest = digest, false)"
    return problems(problem(both.filter(~F.coalesce(F.col("status").isin("reviewed", "approved", "merged"), F.lit(False))), gate, "job_id", "not reviewed"), problem(both.filter(off), gate, "job_id", "no valid review report"))


def release_problems(jobs: DataFrame, global_errors: int | None, reports: dict[str, bool], files: dict[str, int]) -> list[str]:
    """Problems of the last gates: statuses, the global report, passed reports and non-empty folders."""
    out = []
    if jobs.filter(~F.coalesce(F.col("status").isin("approved", "merged"), F.lit(False))).limit(1).count():
        out.append("validated: all jobs must be approved or merged")
    if global_errors != 0:
        out.append("validated: errors must be 0")
    out += [f"{gate}: folder is empty" for gate, folder in (("repacked", "build"), ("released", "release")) if not files.get(folder)]
    return out + [f"{gate}: report must have passed" for gate, name in (("roundtrip-proven", "roundtrip"), ("repacked", "repack"), ("playtested", "playtest"), ("released", "release")) if not reports.get(name)]


def statuses_in_order(log: DataFrame, by: str = "job_id") -> DataFrame:
    """Each change with the status before it."""
    w = Window.partitionBy(by).orderBy("seq")
    return log.withColumn("from_status", F.lag("status").over(w))
