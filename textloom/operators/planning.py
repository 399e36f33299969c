"""Jobs from scenes, and chunks from jobs: consecutive groups, size-bounded splits, overlap, coverage proofs.

Groups along the global order are found in buckets (see ordered). A split inside a group depends on
all records before: it is a fold over the group's sorted array of lengths and ids, at a cost in
proportion to its records, and what a fold gives out are the places of cuts. Groups of more than LONG
records are split in buckets instead (see cuts), so that no row and no task holds them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as X
from textloom.functions.digests import record_line, sha256_of
from textloom.operators.cuts import greedy_cuts
from textloom.operators.ordered import folded, with_group_numbers

UNASSIGNED = "unassigned"
LONG = 100_000  # records of a group that a fold takes in one row


def text_of(name: str, df: DataFrame) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def filled(df: DataFrame, *names: str, last: str = UNASSIGNED) -> Column:
    """The first of the columns that isn't blank, or last."""
    return F.coalesce(*(F.nullif(text_of(n, df), F.lit("")) for n in names), F.lit(last))


def flag_of(name: str, df: DataFrame) -> Column:
    return F.coalesce(F.col(name).cast("boolean"), F.lit(False)) if name in df.columns else F.lit(False)


def scene_islands(source: DataFrame, bucket: int = 100_000) -> DataFrame:
    """source with grp: runs of one route and scene; a merge_group joins adjacent scenes of its route."""
    route, scene, group = filled(source, "route"), filled(source, "scene_id", "file"), text_of("merge_group", source)
    key = F.when(group != "", F.struct(route.alias("r"), F.concat(F.lit("merge:"), group).alias("s"), group.alias("g"))).otherwise(F.struct(route.alias("r"), scene.alias("s"), F.lit("").alias("g")))
    return with_group_numbers(source, key, bucket=bucket)


def by_length(rows: DataFrame, by: str, long: int, small: Callable, large: Callable) -> DataFrame:
    """small(rows of groups of up to `long` records) and large(rows of the other groups), together."""
    longer = rows.groupBy(by).agg(F.count("*").alias("n")).filter(F.col("n") > long).select(by)
    if not longer.limit(1).count():
        return small(rows)
    null = longer.filter(F.col(by).isNull()).limit(1).count()  # a group like others, that no join finds
    is_long = lambda df, how: df.filter(F.col(by).isNotNull()).join(longer, by, how)
    rest = rows.filter(F.col(by).isNull())
    few, many = is_long(rows, "left_anti"), is_long(rows, "left_semi")
    return small(few if null else few.unionByName(rest)).unionByName(large(many.unionByName(rest) if null else many))


def greedy_parts(grouped: DataFrame, most: int, by: str = "grp", long: int = LONG, bucket: int = 100_000) -> DataFrame:
    """by, ord, part, forced: records in parts of at most `most` characters, cut where the next would overflow.

    A part is forced if it begins or ends at a cut without boundary_before, or is the last and too
    long. A longer record stands alone; most <= 0 doesn't split; a null text has no characters.
    """
    rows = grouped.select(by, "ord", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), flag_of("boundary_before", grouped).alias("natural"))
    if most <= 0:
        return rows.select(by, "ord", F.lit(0).alias("part"), F.lit(False).alias("forced"))
    return by_length(rows, by, long, lambda r: folded_parts(r, most, by), lambda r: bucketed_parts(r, most, by, bucket))


def bucketed_parts(rows: DataFrame, most: int, by: str, bucket: int) -> DataFrame:
    """greedy_parts of (by, ord, n, natural) for groups of any length."""
    done, ends = greedy_cuts(rows, [by], most, bucket)
    torn = done.filter(F.col("cut") & ~F.col("natural")).select(by, "part")
    # a torn cut forces the parts on both sides
    forced = torn.select(by, F.explode(F.array(F.col("part") - 1, F.col("part"))).alias("part"))
    forced = forced.unionByName(ends.filter(F.col("chars") > most).select(by, F.col("last").alias("part"))).distinct()
    keyed = forced.select(F.col(by).alias("_by"), F.col("part").alias("_part"), F.lit(True).alias("forced"))
    found = done.join(keyed, done[by].eqNullSafe(F.col("_by")) & (done["part"] == F.col("_part")), "left")
    return found.select(by, "ord", F.col("part").cast("int").alias("part"), F.coalesce("forced", F.lit(False)).alias("forced"))


def folded_parts(rows: DataFrame, most: int, by: str) -> DataFrame:
    """greedy_parts of (by, ord, n, natural) for groups that fit in a row."""
    arrays = rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("ord", "n", "natural"))).alias("rs"))
    state = F.struct(F.lit(0).cast("long").alias("chars"), F.lit(0).alias("at"))

    def step(acc, r):
        cut = (acc["at"] > 0) & (acc["chars"] + r["n"] > most)
        after = F.struct(F.when(cut, r["n"]).otherwise(acc["chars"] + r["n"]).alias("chars"), (acc["at"] + 1).alias("at"))
        return after, cut, F.struct(acc["at"].alias("at"), (~r["natural"]).alias("torn"))

    cuts, last = folded(F.col("rs"), state, step, "struct<at:int,torn:boolean>")
    done = arrays.select(by, "rs", F.struct(cuts.alias("cuts"), (last["chars"] > most).alias("long")).alias("a"))
    edge = lambda at, torn: F.array(F.struct(at.alias("at"), torn.alias("torn")))
    edges = F.concat(edge(F.lit(0), F.lit(False)), F.col("a.cuts"), edge(F.size("rs"), F.col("a.long")))
    done = done.withColumn("edges", edges)

    done = done.withColumn("ords", F.transform("rs", lambda r: r["ord"]))

    def part(k):
        start, stop = F.element_at("edges", k + 1), F.element_at("edges", k + 2)
        return F.struct(k.alias("part"), (start["torn"] | stop["torn"]).alias("forced"), F.slice("ords", start["at"] + 1, stop["at"] - start["at"]).alias("ords"))

    # parts are made inside the array, so that no row carries a whole group along for each of them
    parts = done.select(by, F.explode(F.transform(F.sequence(F.lit(0), F.size("edges") - 2), part)).alias("p"))
    return parts.select(by, F.explode("p.ords").alias("ord"), F.col("p.part").alias("part"), F.col("p.forced").alias("forced"))


def distinct_in_order(rows: Column, value) -> Column:
    return F.array_distinct(F.transform(rows, value))


def plan_jobs(source: DataFrame, most: int, least: int = 1500, version: int = 1, per_char: float = 1.15) -> DataFrame:
    """A job for each part of each scene group, in order, with ids, counts, digest and review reasons.

    A part's suffix counts the earlier jobs with equal scenes, in groups that were split. Jobs are
    numbered along the order in buckets, like groups.
    """
    grouped = scene_islands(source)
    parts = greedy_parts(grouped, most)
    rows = grouped.join(parts.drop("grp"), "ord")
    record = F.struct(
        F.col("ord"), F.col("id"), filled(source, "scene_id", "file").alias("scene"), text_of("file", source).alias("file"), text_of("speaker", source).alias("speaker"),
        (text_of("scene_id", source) == "").alias("no_scene"), F.length("text").cast("long").alias("n"), filled(source, "route").alias("route"), record_line(F.col("id"), F.coalesce(F.nullif(text_of("source_hash", source), F.lit("")), F.col("text"))).alias("line"),
    )
    jobs = rows.groupBy("grp", "part").agg(F.array_sort(F.collect_list(record)).alias("rs"), F.first("forced").alias("forced"))
    jobs = jobs.select(
        "grp", "part", "forced", F.col("rs")[0]["route"].alias("route"), distinct_in_order(F.col("rs"), lambda r: r["scene"]).alias("scene_ids"), distinct_in_order(F.col("rs"), lambda r: r["file"]).alias("source_files"),
        F.transform("rs", lambda r: r["id"]).alias("entry_ids"), F.array_sort(F.array_distinct(F.filter(F.transform("rs", lambda r: r["speaker"]), lambda x: x != ""))).alias("speakers"),
        F.aggregate("rs", F.lit(0).cast("long"), lambda n, r: n + r["n"]).alias("source_char_count"), F.exists("rs", lambda r: r["no_scene"]).alias("no_scene"),
        sha256_of(F.array_join(F.transform("rs", lambda r: r["line"]), "")).alias("source_digest"), F.col("rs")[0]["ord"].alias("first_ord"),
    )
    jobs = with_group_numbers(jobs, F.struct("grp", "part"), "first_ord", name="before")  # every job is a run of its own
    jobs = jobs.withColumn("number", F.col("before") + 1).withColumn("n_parts", F.count("*").over(Window.partitionBy("grp"))).withColumn("nth", F.row_number().over(Window.partitionBy("scene_ids").orderBy("grp", "part")))
    small = F.col("source_char_count") < least
    reasons = F.filter(F.array(F.when(F.col("forced"), "size split was not at an explicit boundary"), F.when(F.col("no_scene"), "one or more records lack scene_id"), F.when(small, "scene is small; consider merging")), lambda r: r.isNotNull())
    suffix = F.when(F.col("n_parts") > 1, F.concat(F.lit("-p"), F.col("nth"))).otherwise("")
    return jobs.select(
        F.concat(F.format_string("job-%05d-", "number"), X.slug(F.col("scene_ids")[0]), suffix).alias("job_id"),
        F.lit("pending").alias("status"), "route", "scene_ids", "source_files", "entry_ids", "speakers", "source_char_count", X.estimated_tokens(F.col("source_char_count"), per_char).alias("estimated_source_tokens"), "source_digest",
        F.lit(version).cast("long").alias("bible_version"), F.lit(False).alias("plan_approved"), F.array().cast("array<string>").alias("predecessors"), F.array().cast("array<string>").alias("adjacent_entry_ids"), F.lit("").alias("context_notes"),
        (F.col("forced") | F.col("no_scene") | small).alias("needs_boundary_review"), reasons.alias("boundary_review_reasons"),
    )


def natural_units(rows: DataFrame, by: str) -> DataFrame:
    """rows with unit: within each `by`, a new one at each boundary_before and each change of scene."""
    w = Window.partitionBy(by).orderBy("ord")
    scene = filled(rows, "scene_id", "file", last="")
    starts = F.row_number().over(w) == 1
    change = F.when(starts, 0).otherwise((flag_of("boundary_before", rows) | (scene != F.lag(scene).over(w))).cast("int"))
    return rows.withColumn("_c", change).withColumn("unit", F.sum("_c").over(w).cast("long")).drop("_c")


def chunk_rows(rows: DataFrame, by: str, target: int, long: int = LONG, bucket: int = 100_000) -> DataFrame:
    """by, ord, id, chunk (from 1), forced: natural units packed in order into chunks of at most target.

    A longer unit is first cut into pieces of at most target, all forced; a chunk is forced if any of
    its pieces is. target <= 0 makes one chunk.
    """
    if target <= 0:
        return rows.select(by, "ord", "id", F.lit(1).alias("chunk"), F.lit(False).alias("forced"))
    return by_length(rows, by, long, lambda r: folded_chunks(r, by, target), lambda r: bucketed_chunks(r, by, target, bucket))


def bucketed_chunks(rows: DataFrame, by: str, target: int, bucket: int) -> DataFrame:
    """chunk_rows for jobs of any length: greedy cuts inside long units, then greedy cuts between pieces."""
    units = natural_units(rows, by).select(by, "ord", "id", "unit", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    sizes = units.groupBy(by, "unit").agg(F.sum("n").alias("unit_n")).select(F.col(by).alias("_by"), F.col("unit").alias("_unit"), "unit_n")
    units = units.join(sizes, units[by].eqNullSafe(F.col("_by")) & (units["unit"] == F.col("_unit"))).drop("_by", "_unit")
    pieces, _ = greedy_cuts(units, [by, "unit"], target, bucket)
    # in units that fit nothing is cut; a piece is found again by the unit and its number there
    pieces = pieces.withColumnRenamed("part", "piece").withColumn("torn", F.col("unit_n") > target)
    each = pieces.groupBy(by, "unit", "piece").agg(F.min("ord").alias("ord"), F.sum("n").alias("n"), F.first("torn").alias("torn"))
    packed, _ = greedy_cuts(each, [by], target, bucket)
    forced = packed.groupBy(by, "part").agg(F.max("torn").alias("forced")).select(F.col(by).alias("_by"), F.col("part").alias("_part"), "forced")
    packed = packed.join(forced, packed[by].eqNullSafe(F.col("_by")) & (packed["part"] == F.col("_part")))
    placed = packed.select(F.col(by).alias("_by"), F.col("unit").alias("_unit"), F.col("piece").alias("_piece"), (F.col("part") + 1).cast("int").alias("chunk"), "forced")
    same = pieces[by].eqNullSafe(F.col("_by")) & (pieces["unit"] == F.col("_unit")) & (pieces["piece"] == F.col("_piece"))
    return pieces.join(placed, same).select(by, "ord", "id", "chunk", "forced")


def folded_chunks(rows: DataFrame, by: str, target: int) -> DataFrame:
    """chunk_rows for jobs that fit in a row."""
    units = natural_units(rows, by).withColumn("n", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    units = units.withColumn("unit_n", F.sum("n").over(Window.partitionBy(by, "unit")))
    arrays = units.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("ord", "id", "unit", "n", "unit_n"))).alias("rs"))
    # first fold: where pieces begin (they never cross units), with the characters and length of what ends there
    state = F.struct(F.lit(-1).cast("long").alias("unit"), F.lit(0).cast("long").alias("chars"), F.lit(0).alias("at"))

    def piece_step(acc, r):
        fresh = (r["unit"] != acc["unit"]) | ((r["unit_n"] > target) & (acc["chars"] + r["n"] > target))
        after = F.struct(r["unit"].alias("unit"), F.when(fresh, r["n"]).otherwise(acc["chars"] + r["n"]).alias("chars"), (acc["at"] + 1).alias("at"))
        return after, fresh, F.struct(acc["at"].alias("at"), acc["chars"].alias("before"), (r["unit_n"] > target).alias("forced"))

    begins, last = folded(F.col("rs"), state, piece_step, "struct<at:int,before:bigint,forced:boolean>")
    arrays = arrays.select(by, "rs", begins.alias("begins"), last["chars"].alias("rest"))

    def piece(p, k):
        after = F.try_element_at("begins", k + 2)
        return F.struct(p["at"].alias("at"), F.coalesce(after["before"], F.col("rest")).alias("n"), p["forced"].alias("forced"))

    arrays = arrays.select(by, "rs", F.transform("begins", piece).alias("ps"))
    # second fold: where chunks of pieces begin, and how many forced pieces there are before
    start = F.struct(F.lit(0).cast("long").alias("chars"), F.lit(True).alias("first"), F.lit(0).alias("torn"))

    def pack(acc, p):
        cut = acc["first"] | (acc["chars"] + p["n"] > target)
        after = F.struct(F.when(cut, p["n"]).otherwise(acc["chars"] + p["n"]).alias("chars"), F.lit(False).alias("first"), (acc["torn"] + p["forced"].cast("int")).alias("torn"))
        return after, cut, F.struct(p["at"].alias("at"), acc["torn"].alias("torn"))

    opens, last = folded(F.col("ps"), start, pack, "struct<at:int,torn:int>")
    arrays = arrays.select(by, "rs", opens.alias("opens"), last["torn"].alias("torn"))

    def chunk(c, k):
        after = F.try_element_at("opens", k + 2)
        rows_of = F.slice("rs", c["at"] + 1, F.coalesce(after["at"], F.size("rs")) - c["at"])
        return F.struct((k + 1).alias("chunk"), (F.coalesce(after["torn"], F.col("torn")) > c["torn"]).alias("forced"), rows_of.alias("rs"))

    chunks = arrays.select(by, F.explode(F.transform("opens", chunk)).alias("c")).select(by, "c.*")
    return chunks.select(by, "chunk", "forced", F.explode("rs").alias("r")).select(by, "r.ord", "r.id", "chunk", "forced")


def chunk_plan(rows: DataFrame, by: str, target: int, overlap: int) -> DataFrame:
    """by, chunk_id, entry_ids, overlap_before_ids, overlap_after_ids, char_count, forced, scene_ids."""
    chunks = chunk_rows(rows, by, target)
    full = chunks.join(rows.select(by, "ord", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), filled(rows, "scene_id", "file", last="").alias("scene")), [by, "ord"])
    plan = full.groupBy(by, "chunk").agg(F.array_sort(F.collect_list(F.struct("ord", "id", "scene"))).alias("rs"), F.sum("n").alias("char_count"), F.first("forced").alias("forced"))
    ids = F.transform("rs", lambda r: r["id"])
    plan = plan.select(by, "chunk", ids.alias("entry_ids"), "char_count", "forced", distinct_in_order(F.col("rs"), lambda r: r["scene"]).alias("scene_ids"))
    w = Window.partitionBy(by).orderBy("chunk")
    none = F.array().cast("array<string>")
    before, after = F.lag("entry_ids").over(w), F.lead("entry_ids").over(w)
    plan = plan.withColumn("b", F.coalesce(before, none)).withColumn("a", F.coalesce(after, none))
    last = F.slice("b", F.greatest(F.lit(1), F.size("b") - overlap + 1), F.lit(max(overlap, 1)))
    return plan.select(
        by, F.format_string("chunk-%04d", "chunk").alias("chunk_id"), "entry_ids", (last if overlap > 0 else none).alias("overlap_before_ids"), (F.slice("a", 1, overlap) if overlap > 0 else none).alias("overlap_after_ids"),
        "char_count", "forced", "scene_ids",
    )


def coverage(planned: DataFrame, assigned: DataFrame, by: str) -> DataFrame:
    """by, missing, duplicated, extra: counts over planned (by, id) against assigned (by, id); valid if all are 0."""
    counts = assigned.groupBy(by, "id").agg(F.count("*").alias("n"))
    both = planned.select(by, "id").distinct().withColumn("p", F.lit(True)).join(counts, [by, "id"], "full_outer")
    out = both.groupBy(by).agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("duplicated"), F.count_if(F.col("p").isNull()).alias("extra"), F.count("p").alias("planned"))
    return out.withColumn("valid", (F.col("missing") == 0) & (F.col("duplicated") == 0) & (F.col("extra") == 0))
