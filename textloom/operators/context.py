"""What a job's translator gets to see: its entries, their neighbours, and the parts of the bible that apply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.automaton import occurring


def model_view(source: DataFrame) -> DataFrame:
    """Five fields without nulls; kind falls back to type."""
    has = source.columns
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")) if name in has else F.lit("")
    kind = F.when(blank("kind") != "", blank("kind")).otherwise(blank("type"))
    tokens = F.coalesce("protected_tokens", F.array().cast("array<string>")) if "protected_tokens" in has else F.array().cast("array<string>")
    return source.select("ord", blank("id").alias("id"), kind.alias("kind"), blank("speaker").alias("speaker"), blank("text").alias("text"), tokens.alias("protected_tokens"))


def machine_view(source: DataFrame) -> DataFrame:
    """Six fields as they are."""
    return source.select("id", "source_hash", "file", F.col("ord").alias("order"), "route", "scene_id")


def without_internal(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith("__")))


def job_entries(jobs: DataFrame, source: DataFrame, ids: str = "entry_ids") -> DataFrame:
    """job_id, pos and the source columns of each listed id that exists."""
    listed = jobs.select("job_id", F.posexplode(ids).alias("pos", "id"))
    return listed.join(source, "id")


def unknown_entries(jobs: DataFrame, source: DataFrame, ids: str = "entry_ids") -> DataFrame:
    return jobs.select("job_id", F.explode(ids).alias("id")).join(source.select("id"), "id", "left_anti")


def adjacent_entries(jobs: DataFrame, source: DataFrame) -> DataFrame:
    """The adjacent ids' rows, those of the job itself left out."""
    own = jobs.select("job_id", F.explode("entry_ids").alias("id"))
    return job_entries(jobs, source, "adjacent_entry_ids").join(own, ["job_id", "id"], "left_anti")


def scene_of(entries: DataFrame) -> DataFrame:
    """job_id, scene_text, speakers, route."""
    rows = entries.select("job_id", F.struct("pos", F.coalesce("text", F.lit("")).alias("text"), "speaker", "route").alias("r")).groupBy("job_id").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    speakers = F.array_distinct(F.filter(F.transform("rs", lambda r: r["speaker"]), lambda s: F.coalesce(s, F.lit("")) != ""))
    return rows.select("job_id", F.array_join(F.transform("rs", lambda r: r["text"]), "\n").alias("scene_text"), speakers.alias("speakers"), F.col("rs")[0]["route"].alias("route"))


def applying(scenes: DataFrame, items: DataFrame, key: str, names: Column) -> DataFrame:
    """job_id, key: items of which a name is a speaker or stands in the scene's text.

    Names are looked for in each text by one automaton, and among speakers by a join. As they go along with
    tasks for the first, they do for the second, and rows of a frequent name stay where they are.
    """
    called = items.select(F.col(key).alias("key"), F.explode(names).alias("word")).filter(F.coalesce("word", F.lit("")) != "").distinct()
    there = occurring(scenes.select("job_id", "scene_text"), "scene_text", called)
    speaking = scenes.select("job_id", F.explode("speakers").alias("word"))
    return there.unionAll(speaking).join(F.broadcast(called), "word").select("job_id", F.col("key").alias(key)).distinct()


def select_characters(scenes: DataFrame, characters: DataFrame) -> DataFrame:
    """job_id, name of each character one of whose names applies."""
    columns = [c for c in ("id", "name", "jp_name", "source_name", "zh_name", "target_name") if c in characters.columns]
    names = F.array(*columns)
    return applying(scenes, characters, "name", F.concat(names, F.coalesce("aliases", F.array().cast("array<string>"))) if "aliases" in characters.columns else names)


def select_terms(scenes: DataFrame, glossary: DataFrame) -> DataFrame:
    """job_id, source of each glossary row whose source or target is a speaker or whose source is in the text."""
    by_text = applying(scenes, glossary.filter("trim(source) <> ''"), "source", F.array("source"))
    speakers = scenes.select("job_id", F.explode("speakers").alias("target"))
    return by_text.unionAll(speakers.join(F.broadcast(glossary.filter("trim(source) <> ''").select("source", "target")), "target").select("job_id", "source")).distinct()


def select_voices(scenes: DataFrame, chosen: DataFrame, characters: DataFrame, voices: DataFrame) -> DataFrame:
    """job_id, name, voice for speakers and for all names of the chosen characters; the narrator for every job."""
    names = characters.select("name", F.explode(F.array_distinct(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("called"))
    wanted = scenes.select("job_id", F.explode("speakers").alias("called")).unionAll(chosen.join(names, "name").select("job_id", "called")).distinct()
    found = wanted.join(voices.withColumnRenamed("name", "called"), "called").select("job_id", F.col("called").alias("name"), "voice")
    return found.unionAll(scenes.select("job_id").join(F.broadcast(voices.filter("name = 'narrator'").limit(1)))).distinct()


def select_route(scenes: DataFrame, routes: DataFrame) -> DataFrame:
    """job_id, knowledge: the route's, or an empty object."""
    return scenes.select("job_id", "route").join(routes, "route", "left").select("job_id", F.coalesce("knowledge", F.lit("{}")).alias("knowledge"))


def select_calibration(scenes: DataFrame, terms: DataFrame, examples: DataFrame, limit: int = 50) -> DataFrame:
    """job_id, ord: the first `limit` examples in file order with a speaker or term of the job.

    Of a speaker's or term's examples the first `limit` are all that a job can get from it. These lists go
    along with tasks, and a job's words meet them where the job's rows are, so that no task gets all jobs
    that have a frequent word.
    """
    rows = examples.select("ord", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("speaker", F.lit("")).alias("speaker"))
    own = terms.select("job_id", F.col("source").alias("word"))
    by = lambda what, found: found.withColumn("by", F.lit(what))
    words = by("term", own).unionByName(by("speaker", scenes.select("job_id", F.explode("speakers").alias("word")))).repartition("job_id")
    found = by("term", occurring(rows.select("ord", "source"), "source", own)).unionByName(by("speaker", rows.select("ord", F.col("speaker").alias("word"))))
    first = found.withColumn("n", F.row_number().over(Window.partitionBy("by", "word").orderBy("ord"))).filter(F.col("n") <= limit).groupBy("by", "word").agg(F.collect_list("ord").alias("ords"))
    met = words.join(F.broadcast(first), ["by", "word"]).select("job_id", F.explode("ords").alias("ord")).distinct()
    return met.withColumn("n", F.row_number().over(Window.partitionBy("job_id").orderBy("ord"))).filter(F.col("n") <= limit).drop("n")
