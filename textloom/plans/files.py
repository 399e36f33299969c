"""Queries over sources and sinks: tables written to the shared folder and read again."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import digests as D
from textloom.operators.ordered import with_group_numbers
from textloom.plans import fixtures as fx
from textloom.plans.registry import query
from textloom.sources import readers, sinks

ID_TEXT = "id string, text string"
_made: WeakKeyDictionary = WeakKeyDictionary()  # session: folders made for it


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that all executors share; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="textloom-")
    path = f"{named}/files-{uuid.uuid4().hex}"
    _made.setdefault(spark, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Deletes the folders that queries of this session have made. Call it when their results have been read."""
    for path in _made.pop(spark, []):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "lang", "source")


NUMBERED = "n AS (SELECT row_number() OVER (ORDER BY doc_id) AS k, CAST(doc_id AS VARCHAR) AS id, coalesce(text, '') AS text, lang, source, doc_id FROM documents)"


@query(f"WITH {NUMBERED} SELECT CAST(k AS INTEGER) AS line, id, text FROM n")
def jsonl_round_trip(spark, sf_dir):
    path = scratch(spark)
    sinks.write_jsonl(docs(spark, sf_dir).select("ord", "id", "text"), path, single=False)
    return readers.jsonl_strict(spark, path, ID_TEXT, pattern="part-*", continued=True).select("line", "id", "text")


@query(f"""WITH {NUMBERED} SELECT CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS place, '{{"id":"' || id || '","lang":"' || lang || '","size":' || length(text) || '}}' AS raw, id FROM n""")
def jsonl_canonical_parts(spark, sf_dir):
    """Written by ranges with sorted keys, read again in parts."""
    path = scratch(spark)
    rows = docs(spark, sf_dir).select("ord", F.length("text").alias("size"), "lang", "id", F.lit("hidden").alias("__line"))
    sinks.write_jsonl(rows, path, single=False, canonical=True)
    got = readers.jsonl(spark, path, "id string, lang string, size long", pattern="part-*")
    placed = with_group_numbers(got, F.col("ord"), bucket=1 << 32)  # every line is a run of its own, every file a bucket
    return placed.select((F.col("grp") + 1).cast("int").alias("place"), "raw", "id")


BROKEN = "CASE doc_id % 7 WHEN 0 THEN 'not json' WHEN 1 THEN '[1, 2]' WHEN 2 THEN '' ELSE '{\"id\": \"' || id || '\"}' END"


#: Lines of records by doc_id % 18, with the id, its digest and the id before put in; and what is wrong with each.
RECORDS = {
    0: ('{"id": "@I", "text": "", "source_hash": "sha256:@D"}', None), 1: ('{"id": "@I", "text": "x", "source_hash": "sha256:@D"} trailing', "invalid JSON"), 2: ('{"id": "@I", "text": "x"', "invalid JSON"),
    3: ('["@I", "x"]', "not an object"), 4: ("null", "not an object"), 5: ('{"id": @I, "text": "x", "source_hash": "sha256:@D"}', "no string id"), 6: ('{"id": ["@I"], "text": "x", "source_hash": "sha256:@D"}', "no string id"),
    7: ('{"id": "", "text": "x", "source_hash": "sha256:@D"}', "no string id"), 8: ('{"id": null, "text": "x", "source_hash": "sha256:@D"}', "no string id"), 9: ('{"text": "x", "source_hash": "sha256:@D"}', "no string id"),
    10: ('{"id": "@I", "text": 7, "source_hash": "sha256:@D"}', "no string text"), 11: ('{"id": "@I", "text": null, "source_hash": "sha256:@D"}', "no string text"), 12: ('{"id": "@I", "text": "x", "source_hash": "nope"}', "source_hash is no digest"),
    13: ('{"id": "@I", "text": "x"}', "source_hash is no digest"), 14: ('{"id": "@I", "text": "x", "source_hash": "sha256:@D\\n"}', "source_hash is no digest"), 15: ('{"id": "@B", "text": "x", "source_hash": "sha256:@D"}', "duplicate id"),
    16: ('{"id": "@I", "text": ["x"], "source_hash": "sha256:@D"}, {}', "invalid JSON"), 17: ('  {"source_hash": "SHA256:@D", "id": "@I", "text": "x"}  ', "source_hash is no digest"),
}


@query(f"""WITH {NUMBERED} SELECT CAST(k AS INTEGER) AS line, CASE doc_id % 18 {' '.join(f"WHEN {k} THEN '{p}'" for k, (_, p) in RECORDS.items() if p and k != 15)} WHEN 15 THEN CASE WHEN doc_id IN (SELECT doc_id + 15 FROM documents) THEN 'duplicate id' END END AS problem
FROM n WHERE doc_id % 18 <> 0 AND (doc_id % 18 <> 15 OR doc_id IN (SELECT doc_id + 15 FROM documents))""")
def jsonl_record_problems(spark, sf_dir):
    """Each form that a strict reader must not take, and records that it must."""
    form = F.element_at(F.array(*(F.lit(line) for line, _ in RECORDS.values())), (F.col("ord") % 18 + 1).cast("int"))
    put = lambda c, name, value: F.replace(c, F.lit(name), value)
    value = put(put(put(form, "@I", F.col("id")), "@D", F.sha2(F.col("text").cast("binary"), 256)), "@B", (F.col("ord") - 15).cast("string"))
    path = write_lines(docs(spark, sf_dir).select("ord", value.alias("value")), scratch(spark))
    return readers.jsonl_problems(spark, path, pattern="part-*", continued=True).select("line", "problem")


@query(f"""WITH {NUMBERED} SELECT CAST(k AS INTEGER) AS line, CASE doc_id % 7 WHEN 0 THEN 'string' WHEN 1 THEN 'integer' WHEN 2 THEN 'null' WHEN 3 THEN 'missing' WHEN 4 THEN 'array' WHEN 5 THEN 'object' ELSE 'boolean' END AS kind,
CASE doc_id % 7 WHEN 0 THEN text END AS text, CASE doc_id % 7 WHEN 0 THEN lang WHEN 1 THEN id WHEN 6 THEN 'True' WHEN 4 THEN '["' || lang || '"]' WHEN 5 THEN '{{"a":' || id || '}}' END AS route, CASE doc_id % 7 WHEN 1 THEN doc_id WHEN 6 THEN 1 END AS "order",
doc_id % 7 IN (0, 4, 5, 6) OR (doc_id % 7 = 1 AND doc_id <> 0) AS boundary_before, CASE doc_id % 7 WHEN 4 THEN '[' || lang || ']' WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE '[NULL]' END AS tokens FROM n""")
def jsonl_typed_fields(spark, sf_dir):
    """One value of each kind in columns of every type."""
    d = docs(spark, sf_dir)
    k = F.col("ord") % 7
    quoted = lambda c: F.to_json(F.struct(c.alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("x")))) - 6)
    one = lambda text: F.when(k == 0, quoted(text)).when(k == 1, F.col("id")).when(k == 2, "null").when(k == 4, F.concat(F.lit('["'), "lang", F.lit('"]'))).when(k == 5, F.concat(F.lit('{"a": '), "id", F.lit("}"))).otherwise("true")
    line = lambda name, text: F.when(k == 3, "").otherwise(F.concat(F.lit(f', "{name}": '), one(text)))
    value = F.concat(F.lit('{"id": "x"'), line("text", F.col("text")), *(line(n, F.col("lang")) for n in ("route", "order", "boundary_before", "protected_tokens")), F.lit("}"))
    path = write_lines(d.select("ord", value.alias("value")), scratch(spark))
    got = readers.jsonl(spark, path, "text string, route string, `order` long, boundary_before boolean, protected_tokens array<string>", pattern="part-*", continued=True)
    tokens = F.when(F.col("protected_tokens").isNotNull(), F.concat(F.lit("["), F.array_join("protected_tokens", ",", "NULL"), F.lit("]")))
    return got.select("line", F.col("_kinds")["text"].alias("kind"), "text", "route", "order", "boundary_before", tokens.alias("tokens"))


def write_lines(rows: DataFrame, path: str, single: bool = False, **options: str) -> str:
    """Lines in files by ranges of ord, whose names sort in that order, or in one file."""
    (rows.repartition(1) if single else rows.repartitionByRange("ord")).sortWithinPartitions("ord").select("value").write.options(**options).text(path)
    return path


def broken_lines(spark, sf_dir):
    m = F.col("ord") % 7
    value = F.when(m == 0, "not json").when(m == 1, "[1, 2]").when(m == 2, "").otherwise(F.concat(F.lit('{"id": "'), "id", F.lit('"}')))
    return docs(spark, sf_dir).select("ord", value.alias("value"))


@query(f"""WITH {NUMBERED}, b AS (SELECT k, id, doc_id, {BROKEN} AS raw FROM n)
SELECT CAST(k AS INTEGER) AS line, raw, doc_id % 7 < 2 AS bad, CASE WHEN doc_id % 7 > 2 THEN id END AS id FROM b WHERE raw <> ''""")
def jsonl_lenient(spark, sf_dir):
    got = readers.jsonl(spark, write_lines(broken_lines(spark, sf_dir), scratch(spark)), "id string", pattern="part-*", continued=True)
    return got.select("line", "raw", F.col("_bad").alias("bad"), "id")


@query(f"WITH {NUMBERED} SELECT 'whole' AS file, id FROM n WHERE doc_id % 7 > 2")
def jsonl_or_nothing(spark, sf_dir):
    """All rows of a good file and none of one with broken lines."""
    rows = broken_lines(spark, sf_dir)
    parts = [readers.jsonl_or_nothing(spark, write_lines(r, scratch(spark)), "id string", pattern="part-*").select(F.lit(name).alias("file"), "id") for name, r in (("whole", rows.filter("ord % 7 > 2")), ("broken", rows))]
    return parts[0].unionAll(parts[1])


@query(f"WITH {NUMBERED} SELECT codec, id, text FROM n, (VALUES ('utf-16-le'), ('utf-16-be'), ('utf-8')) AS c(codec)")
def jsonl_codecs(spark, sf_dir):
    parts = []
    for codec, written in (("utf-16-le", "UTF-16LE"), ("utf-16-be", "UTF-16BE"), ("utf-8", "UTF-8")):
        path = scratch(spark)
        docs(spark, sf_dir).select("id", "text").write.option("encoding", written).json(path)
        parts.append(readers.jsonl(spark, path, ID_TEXT, pattern="part-*", encoding=codec).select(F.lit(codec).alias("codec"), "id", "text"))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


ENDS = "[ , \u0085, \x0b]"


@query(f"""WITH {NUMBERED}, v AS (SELECT k, regexp_replace(text, '[\n\r]', ' ', 'g') AS t, doc_id FROM n),
r AS (SELECT k, unnest(string_split(CASE doc_id % 3 WHEN 0 THEN replace(t, 'a', chr(8232)) WHEN 1 THEN replace(t, 'e', chr(133)) ELSE t END, CASE doc_id % 3 WHEN 0 THEN chr(8232) WHEN 1 THEN chr(133) ELSE chr(7) END)) AS value FROM v)
SELECT value, count(*) AS n FROM r GROUP BY value""")
def unicode_line_ends(spark, sf_dir):
    t = F.regexp_replace("text", "[\n\r]", " ")
    value = F.when(F.col("ord") % 3 == 0, F.replace(t, F.lit("a"), F.lit(" "))).when(F.col("ord") % 3 == 1, F.replace(t, F.lit("e"), F.lit("\u0085"))).otherwise(t)
    path = write_lines(docs(spark, sf_dir).select("ord", value.alias("value")), scratch(spark))
    return readers.text_lines(spark, path, "part-*", unicode_ends=True).groupBy("value").agg(F.count("*").alias("n"))


@query(f"""WITH {NUMBERED} SELECT id, CASE doc_id % 3 WHEN 0 THEN NULL ELSE lang END AS lang, CASE doc_id % 3 WHEN 2 THEN source || ' ' || chr(34) || chr(9) || '|' || id END AS surplus FROM n""")
def tsv_surplus(spark, sf_dir):
    """One, two and four cells under two headers."""
    path, k = scratch(spark), F.col("ord") % 3
    cells = F.when(k == 0, F.col("id")).when(k == 1, F.concat_ws("\t", "id", "lang")).otherwise(F.concat_ws("\t", "id", "lang", F.concat(F.lit('"'), "source", F.lit(' ""\t"')), "id"))
    head = spark.createDataFrame([(-1, "id\tlang")], "ord long, value string")
    write_lines(head.unionAll(docs(spark, sf_dir).select("ord", cells.alias("value"))), path, single=True)
    return readers.tsv(spark, f"{path}/part-*", surplus="more").select("id", "lang", F.array_join("more", "|").alias("surplus"))


@query(f"WITH {NUMBERED} SELECT id, lang || chr(9) || 'x' AS cell, CASE WHEN doc_id % 2 = 0 THEN source END AS source FROM n")
def tsv_round_trip(spark, sf_dir):
    path = scratch(spark)
    d = docs(spark, sf_dir)
    rows = d.select("id", F.concat("lang", F.lit("\tx")).alias("cell"), F.when(F.col("ord") % 2 == 0, F.col("source")).alias("source"))
    rows.write.option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)
    return readers.tsv(spark, path, required=("id", "cell")).select("id", "cell", "source")


LANGS = "l AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)"


@query(f"""WITH {LANGS} SELECT 'missing/' || lang AS name, n || chr(10) AS text FROM l UNION ALL SELECT 'same/' || lang, n || chr(10) || lang || chr(10) FROM l
UNION ALL SELECT 'replaced/' || lang, lang FROM l UNION ALL SELECT 'refused', CAST(count(*) AS VARCHAR) FROM l UNION ALL SELECT 'snapshot/' || lang, '2' FROM l""")
def sinks_twice(spark, sf_dir):
    """Each sink written to twice for each language, and what stays."""
    root = scratch(spark)
    refused = 0
    langs = fx.table(spark, sf_dir, "documents").filter("lang is not null").groupBy("lang").count()
    for r in langs.collect():  # languages are few
        lang, n = r["lang"], r["count"]
        sinks.write_if_missing(spark, f"{root}/missing/{lang}", f"{n}\n")
        sinks.write_if_missing(spark, f"{root}/missing/{lang}", "again")
        sinks.write_immutable(spark, f"{root}/same/{lang}", f"{n}\n{lang}\n")
        sinks.write_immutable(spark, f"{root}/same/{lang}", f"{n}\r\n{lang}\r\n")
        try:
            sinks.write_immutable(spark, f"{root}/same/{lang}", f"{n + 1}")
        except sinks.ImmutableError:
            refused += 1
        for text in ("old", lang):
            sinks.replace_atomically(spark, f"{root}/replaced/{lang}", text)
    for k in (1, 2):
        sinks.write_snapshot(langs.select("lang", F.lit(str(k)).alias("text")), f"{root}/snapshot")
    name = F.regexp_extract("path", "([a-z]+/[^/]+)$", 1)
    texts = [readers.whole_text(spark, f"{root}/{kind}").select(name.alias("name"), "text") for kind in ("missing", "same", "replaced")]
    snapshot = spark.read.parquet(f"{root}/snapshot").select(F.concat(F.lit("snapshot/"), "lang").alias("name"), "text")
    return texts[0].unionAll(texts[1]).unionAll(texts[2]).unionAll(snapshot).unionAll(spark.createDataFrame([("refused", str(refused))], "name string, text string"))


def by_language(spark, sf_dir):
    """A folder for each language with one file of its ids."""
    path = scratch(spark)
    docs(spark, sf_dir).select("lang", "ord", F.col("id").alias("value")).repartition(1).sortWithinPartitions("lang", "ord").select("lang", "value").write.partitionBy("lang").text(path)
    return path


def of_language():
    """The language in a file's path; made when asked for, as columns need a session."""
    return F.regexp_extract("path", "lang=([a-z]+)", 1).alias("lang")


FILES = "f AS (SELECT lang, string_agg(doc_id || chr(10), '' ORDER BY doc_id) AS t FROM documents GROUP BY lang)"


@query(f"WITH {FILES} SELECT lang, t AS text FROM f")
def text_files(spark, sf_dir):
    return readers.whole_text(spark, by_language(spark, sf_dir)).select(of_language(), "text")


@query(f"WITH {FILES} SELECT lang, CAST(length(t) AS BIGINT) AS size, sha256(t) AS sha256 FROM f")
def file_manifest(spark, sf_dir):
    return readers.manifest(spark, by_language(spark, sf_dir)).filter(F.col("path").contains("part-")).select(of_language(), "size", "sha256")


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, '$#' || doc_id || '.items[0]#' || doc_id || '.t' AS location, source AS text, lang AS tokens FROM documents
UNION ALL SELECT doc_id || 'x', '$#' || doc_id || '.items[1]#' || doc_id || 'x.t[0]', lang, 'own' FROM documents
UNION ALL SELECT doc_id || 'x', '$#' || doc_id || '.items[1]#' || doc_id || 'x.t[1]', source, 'own' FROM documents""")
def json_walk(spark, sf_dir):
    d = docs(spark, sf_dir)
    inner = F.struct(F.concat("id", F.lit("x")).alias("id"), F.array("lang", "source").alias("t"), F.array(F.lit("own")).alias("protected_tokens"))
    value = F.concat(
        F.lit('{"id":"'), "id", F.lit('","protected_tokens":'), F.to_json(F.array("lang")), F.lit(',"items":['), F.to_json(F.struct(F.col("source").alias("t"))), F.lit(","), F.to_json(inner), F.lit("]}"),
    )
    return readers.selected_fields(d.select(F.lit("p").alias("path"), value.alias("text")), {"t"}).select("id", "location", "text", F.array_join("protected_tokens", " ").alias("tokens"))


@query(f"""WITH {NUMBERED} SELECT lang, 'sha256:' || sha256(string_agg('{{"id":"' || id || '","lang":"' || lang || '"}}' || chr(10), '' ORDER BY doc_id)) AS digest FROM n GROUP BY lang""")
def record_digest(spark, sf_dir):
    raw = F.to_json(F.struct("lang", "id", F.lit(1).alias("__place")))
    return D.record_digest(docs(spark, sf_dir).withColumn("raw", raw), ["lang"])


@query("""SELECT CAST(doc_id AS VARCHAR) AS name, CASE doc_id % 4 WHEN 1 THEN 'missing' ELSE 'digest mismatch' END AS issue FROM documents WHERE doc_id % 4 IN (1, 2)""")
def integrity_check(spark, sf_dir):
    """Sections with other line ends are the same; missing and changed ones are found."""
    d = docs(spark, sf_dir)
    recorded = d.select(F.col("id").alias("name"), D.sha256_of(D.canonical_text(F.col("text"))).alias("digest"))
    content = F.when(F.col("ord") % 4 == 2, F.concat("text", F.lit("!"))).when(F.col("ord") % 4 == 3, F.concat(F.replace("text", F.lit("\n"), F.lit("\r\n")), F.lit("\r\n"))).otherwise(F.col("text"))
    return D.integrity_issues(recorded, d.filter("ord % 4 <> 1").select(F.col("id").alias("name"), content.alias("content")))
