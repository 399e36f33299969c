"""Queries over gates, statuses, selections and term modes, each branch derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import digests as D
from textloom.functions import text as X
from textloom.operators import audit, codepoints, context, glossary, stages, validate
from textloom.plans import fixtures as fx
from textloom.plans.registry import query
from textloom.policy import Policy

AFTER = r"(?!\w)"  # as patterns of terms say that no word goes on


def some_terms(spark, sf_dir):
    """Words of the benchmark as terms of all modes, with and without case, some for another locale."""
    words = fx.table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.split("text", "[ .,\n]+")).alias("w")).filter(F.col("w").rlike(r"^\p{L}+$")).groupBy("w").agg(F.min("item_id").alias("i"))
    mode = F.when(F.col("i") % 20 == 2, "regex").when(F.col("i") % 5 == 1, "word").when(F.col("i") % 5 == 3, " Word ").when(F.col("i") % 2 == 0, "substring").otherwise("")
    source = F.when(mode == "regex", F.concat(F.lit("(?P<x>"), "w", F.lit(f"){AFTER}"))).otherwise(F.when(F.contains("w", F.lit("ß")), F.col("w")).otherwise(F.upper("w")))
    locale = F.when(F.col("i") % 6 == 0, "ja").when(F.col("i") % 6 == 1, "EN").otherwise("")
    return words.select(
        source.alias("source"), F.concat(F.lit("t"), "i").alias("target"), F.lit("locked").alias("status"), F.lit("").alias("scope"), mode.alias("match_mode"),
        F.when(F.col("i") % 4 == 0, "yes").otherwise("").alias("case_sensitive"), locale.alias("source_locale"),
    )


FOLD = "replace(lower({}), 'ß', 'ss')"


@query(f"""WITH w AS (SELECT w, min(item_id) AS i FROM (SELECT item_id, unnest(regexp_split_to_array(text, '[ .,\n]+')) AS w FROM benchmark) WHERE regexp_full_match(w, '\\p{{L}}+') GROUP BY w),
t AS (SELECT w, i, CASE WHEN contains(w, 'ß') THEN w ELSE upper(w) END AS u, CASE WHEN i % 20 = 2 THEN 'regex' WHEN i % 5 IN (1, 3) THEN 'word' ELSE 'substring' END AS mode, i % 4 = 0 AS cased FROM w WHERE i % 6 <> 0),
d AS (SELECT CAST(doc_id AS VARCHAR) AS id, text AS src, ' ' || regexp_replace(text, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g') || ' ' AS words FROM documents WHERE text <> ''),
f AS (SELECT *, lower(words) AS low_words, {FOLD.format('src')} AS low FROM d)
SELECT id, CASE WHEN mode = 'regex' THEN '(?P<x>' || w || '){AFTER}' ELSE u END AS source FROM f JOIN t ON CASE
    WHEN mode = 'regex' AND cased THEN contains(words, w || ' ') WHEN mode = 'regex' THEN contains(low_words, lower(w) || ' ')
    WHEN mode = 'word' AND cased THEN contains(words, ' ' || u || ' ') WHEN mode = 'word' THEN contains(low_words, ' ' || lower(u) || ' ')
    WHEN cased THEN contains(src, u) ELSE contains(low, {FOLD.format('u')}) END""")
def term_modes(spark, sf_dir):
    """Which terms stand in which texts, in each mode; terms of another locale don't count."""
    s, t, _ = fx.documents(spark, sf_dir)
    return glossary.shadowed_hits(validate.matched(s, t), some_terms(spark, sf_dir), Policy("en", "fr")).select("id", "source")


ACCENTS = Policy("en", "fr", residual_class="À-ÿ")


@query(f"WITH {fx.DRAFT} SELECT id, 'residue: ' || array_to_string(regexp_extract_all(out_seen, '[À-ÿ]')[1:12], '') AS message FROM m WHERE translation <> '' AND regexp_matches(out_seen, '[À-ÿ]')")
def residual_script(spark, sf_dir):
    pairs = validate.matched(fx.units(spark, sf_dir), fx.draft(spark, sf_dir))
    return validate.row_issues(pairs, ACCENTS).filter(F.col("code") == ACCENTS.residual_code).select("id", "message")


@query(f"""WITH {fx.DRAFT} SELECT CASE WHEN h.h % 3 = 1 THEN 'issues-schema' ELSE 'term_proposals-schema' END AS code, m.id FROM m JOIN u h USING (id) WHERE translation <> '' AND h.h % 3 > 0""")
def array_schemas(spark, sf_dir):
    d = fx.draft(spark, sf_dir).join(fx.units(spark, sf_dir).select("id", "h"), "id", "left").withColumn("k", F.col("h") % 3)
    d = d.withColumn("issues_raw", F.when(F.col("k") == 1, F.when(F.col("h") % 2 == 0, '{"a": [1]}').otherwise("[1} x]")).otherwise(" [1, {}] ")).withColumn("term_proposals_raw", F.when(F.col("k") == 2, '"[]"').when(F.col("k") == 0, "[]"))
    issues = validate.row_issues(validate.matched(fx.units(spark, sf_dir), d.drop("h", "k")), fx.POLICY)
    return issues.filter(F.col("code").endswith("-schema")).select("code", "id")


@query("""SELECT CAST(page_id AS VARCHAR) AS id, CAST(length(list_reduce(list_concat([html], regexp_extract_all(html, '<[^>]+>')[1:3]), lambda s, t: substr(s, 1, instr(s, t) - 1) || substr(s, instr(s, t) + length(t)))) AS BIGINT) AS visible FROM pages""")
def without_three_tokens(spark, sf_dir):
    """Each of the first three tokens taken out once."""
    s, _ = fx.pages(spark, sf_dir)
    return s.select("id", F.length(X.without_once(F.col("text"), F.slice("protected_tokens", 1, 3))).cast("long").alias("visible"))


@query("""WITH r AS (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN [source] WHEN 1 THEN [lang] ELSE [] END AS tokens, source || ' ' || lang || ' ' || source AS t FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN len(tokens) = 0 THEN t ELSE substr(t, 1, instr(t, tokens[1]) - 1) || substr(t, instr(t, tokens[1]) + length(tokens[1])) END AS text FROM r""")
def token_lookup(spark, sf_dir):
    """A record's own tokens come first, then those listed for its id."""
    d = fx.table(spark, sf_dir, "documents")
    own = F.when(F.col("doc_id") % 3 == 0, F.array("source"))
    rows = d.select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), F.lit("l").alias("location"), F.concat_ws(" ", "source", "lang", "source").alias("text"), own.alias("protected_tokens"))
    listed = d.filter("doc_id % 3 < 2").select(F.col("doc_id").cast("string").alias("id"), F.array("lang").alias("protected_tokens"))
    return codepoints.visible_texts(rows, listed).select("id", "text")


CHARS = "c AS (SELECT unnest(regexp_split_to_array(text, '')) AS c FROM documents), v AS (SELECT unicode(c) AS cp FROM c WHERE c <> '' AND NOT regexp_matches(c, '[\\p{C}\\p{Z}\\t\\n\\v\\f\\r]'))"


@query(f"WITH {CHARS} SELECT cp, count(*) AS n FROM v GROUP BY cp")
def codepoint_histogram_exact(spark, sf_dir):
    return codepoints.histogram(fx.table(spark, sf_dir, "documents").select("text"), exact=True)


@query("""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)), lambda x: trim(x, ' ' || chr(9))), lambda x: x <> '' AND NOT starts_with(x, '#') AND x <> '```') AS ls FROM (SELECT doc_id, '# ' || source || chr(10) || '```' || CASE WHEN doc_id % 3 = 0 THEN lang ELSE '' END || chr(10) || CASE WHEN doc_id % 2 = 0 THEN text ELSE substr(text, 1, doc_id % 24) END || chr(10) || '```' AS text FROM documents))
SELECT doc_id, length(array_to_string(ls, '')) >= 10 AS says FROM l""")
def meaningful_documents(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    text = F.concat(F.lit("# "), "source", F.lit("\n```"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(""), F.lit("\n"), F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.substr("text", F.lit(1), (F.col("doc_id") % 24).cast("int"))), F.lit("\n```"))
    return d.select("doc_id", X.meaningful(text).alias("says"))


@query(f"""WITH {fx.UNITS}, e AS (SELECT ord, CASE WHEN h = 1 THEN '' ELSE id END AS id, h, scene_id FROM u)
SELECT CAST(ord AS VARCHAR) AS item, 'no id' AS problem FROM e WHERE h = 1
UNION ALL SELECT id, 'id not unique' FROM e WHERE h = 2 UNION ALL SELECT '', 'id not unique' FROM e WHERE h = 1 HAVING count(*) > 1
UNION ALL SELECT id, 'invalid source_hash' FROM e WHERE h = 3 UNION ALL SELECT id, 'no text' FROM e WHERE h = 4 UNION ALL SELECT id, 'no file' FROM e WHERE h = 5 UNION ALL SELECT id, 'protected_tokens must be strings' FROM e WHERE h IN (6, 7)
UNION ALL SELECT NULL, 'no scene nodes'""")
def extraction_gate(spark, sf_dir):
    h = F.col("h")
    u = fx.units(spark, sf_dir).withColumn("id", F.when(h == 1, "").otherwise(F.col("id"))).withColumn("source_hash", F.when(h == 3, "sha256:short").otherwise(F.col("source_hash"))).withColumn("text", F.when(h != 4, F.col("text")))
    u = u.withColumn("file", F.when(h != 5, F.col("file"))).withColumn("protected_tokens", F.when(h == 6, F.array(F.lit(None).cast("string"))).when(h != 7, F.array().cast("array<string>")))
    twice = u.filter("h = 2")
    return stages.extraction_problems(u.unionAll(twice), twice.limit(0)).select("item", "problem")


def planned(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    n = F.col("event_id")
    status = F.element_at(F.array(*map(F.lit, stages.STATUSES)), (n % 8 + 1).cast("int"))
    return e.select(n.cast("string").alias("job_id"), n, status.alias("status"), F.concat(F.lit("d"), n).alias("source_digest"), F.lit(3).cast("long").alias("bible_version"), F.array(F.lit("x"), F.lit("y")).alias("entry_ids"))


ACTIVE = "event_id % 8 BETWEEN 1 AND 6"


@query(f"""SELECT CAST(event_id AS VARCHAR) AS item, 'no valid bundle' AS problem FROM events WHERE {ACTIVE} AND event_id % 5 IN (0, 1)
UNION ALL SELECT CAST(event_id AS VARCHAR), 'stale source_digest' FROM events WHERE {ACTIVE} AND event_id % 5 > 1 AND event_id % 7 = 0
UNION ALL SELECT CAST(event_id AS VARCHAR), 'stale bible_version' FROM events WHERE {ACTIVE} AND event_id % 5 > 1 AND event_id % 7 = 1
UNION ALL SELECT CAST(event_id AS VARCHAR), 'another shared prefix' FROM events WHERE {ACTIVE} AND event_id % 5 > 1 AND event_id % 7 = 2
UNION ALL SELECT CAST(event_id AS VARCHAR), 'stale shared prefix' FROM events WHERE {ACTIVE} AND event_id % 5 > 1 AND event_id % 7 = 3
UNION ALL SELECT CAST(event_id AS VARCHAR), 'invalid coverage' FROM events WHERE {ACTIVE} AND event_id % 5 > 1 AND event_id % 7 = 4""")
def translation_gate(spark, sf_dir):
    jobs = planned(spark, sf_dir)
    k = F.col("event_id") % 7
    bundles = jobs.filter("event_id % 5 > 0").select(
        "job_id", (F.col("event_id") % 5 > 1).alias("valid"), F.when(k == 0, "old").otherwise(F.col("source_digest")).alias("source_digest"), F.when(k == 1, 2).otherwise(3).cast("long").alias("bible_version"),
        F.when(k == 2, "q").otherwise("p").alias("shared_prefix_id"), F.when(k == 3, None).otherwise("s").alias("shared_prefix_sha256"), (k != 4).alias("coverage_valid"),
    )
    return stages.translation_problems(jobs, bundles, "p", "s").select("item", "problem")


@query("""SELECT CAST(event_id AS VARCHAR) AS item, 'not reviewed' AS problem FROM events WHERE event_id % 8 NOT IN (4, 5, 6)
UNION ALL SELECT CAST(event_id AS VARCHAR), 'no valid review report' FROM events WHERE event_id % 7 < 6""")
def review_gate(spark, sf_dir):
    """Reports that are missing, failed, partial, stale or of another draft; whole records are digested."""
    jobs = planned(spark, sf_dir)
    k = F.col("event_id") % 7
    line = lambda note: F.concat(F.lit('{"id":"x","note":"'), note, F.lit('","translation":"'), "event_id", F.lit('"}'))
    drafts = jobs.select("job_id", F.lit(1).alias("ord"), F.concat(F.lit('{"translation":"'), "event_id", F.lit('","note":"n","id":"x"}')).alias("raw"))
    digest = lambda note: F.concat(F.lit("sha256:"), F.sha2(F.concat(line(F.lit(note)), F.lit("\n")).cast("binary"), 256))
    reports = jobs.filter(k != 0).select(
        "job_id", (k != 1).alias("passed"), F.when(k == 2, "some").otherwise("all-entries").alias("coverage"), F.when(k == 3, "old").otherwise(F.col("source_digest")).alias("reviewed_source_digest"),
        F.when(k == 4, 1).otherwise(2).alias("reviewed_entry_count"), F.when(k == 5, digest("other")).otherwise(digest("n")).alias("reviewed_draft_digest"),
    )
    return stages.review_problems(jobs, reports, drafts).select("item", "problem")


@query("""SELECT 'u' || event_id AS item, CASE WHEN event_id % 6 IN (0, 1, 2) THEN 'needs url, title, lane and claims' ELSE 'incomplete description' END AS problem FROM events WHERE event_id % 6 < 5
UNION ALL SELECT 'target-locale', 'missing lane'""")
def research_gate(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    k = F.col("event_id") % 6
    lane = F.when(k == 1, F.when(F.col("event_id") % 4 == 1, "elsewhere").otherwise(" JP-Canon ")).when(F.col("event_id") % 2 == 0, "jp-canon").otherwise("unpack")
    full = F.lit("x")
    sources = e.select(
        F.concat(F.lit("u"), "event_id").alias("url"), F.when(k == 0, "").otherwise(full).alias("title"), lane.alias("lane"), F.when(k == 2, F.array().cast("array<string>")).otherwise(F.array(full)).alias("claims"),
        F.when(F.col("event_id") % 4 < 2, "ja").alias("source_language"), F.when(k == 3, "").otherwise("ja").alias("language"), full.alias("source_type"), full.alias("authority"), full.alias("retrieved_at"),
        F.when(k == 3, "").otherwise(full).alias("scope"), F.when(k == 4, "sure").otherwise("high").alias("confidence"),
    )
    return stages.research_problems(sources).select("item", "problem")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 AND event_id % 8 = 1 THEN 'merged' WHEN event_id % 3 = 1 THEN 'failed' ELSE ['pending', 'assigned', 'translated', 'validated', 'reviewed', 'approved', 'merged', 'failed'][event_id % 8 + 1] END AS status,
CASE WHEN event_id % 3 = 0 AND event_id % 8 = 1 OR event_id % 3 = 1 THEN 'n' ELSE '' END AS notes FROM events""")
def status_changes(spark, sf_dir):
    """Compare-and-set: a change holds from the named status, from any without one, and never to an unknown one."""
    jobs = planned(spark, sf_dir)
    k = F.col("event_id") % 3
    changes = jobs.select("job_id", F.when(k == 0, "assigned").alias("from_status"), F.when(k == 0, "merged").when(k == 1, "failed").otherwise("gone").alias("to_status"), F.lit("n").alias("note"))
    return stages.set_status(jobs, changes).select("event_id", "status", F.array_join("status_notes", ",").alias("notes"))


@query(f"WITH {fx.UNITS} SELECT scene_id AS job_id, speaker AS name FROM u WHERE speaker <> '' UNION SELECT scene_id, name FROM u JOIN (VALUES ('Boss'), ('a-b')) AS c(name) ON contains(text, name)")
def character_selection(spark, sf_dir):
    u = fx.units(spark, sf_dir)
    scenes = context.scene_of(u.select(F.col("scene_id").alias("job_id"), F.col("ord").alias("pos"), "text", "speaker", "route"))
    people = u.select("speaker").distinct().filter("speaker <> ''").select(F.lit("").alias("id"), F.col("speaker").alias("name"), F.array().cast("array<string>").alias("aliases"))
    more = spark.createDataFrame([("", "Boss", None), ("", "a-b", None)], "id string, name string, aliases array<string>")
    return context.select_characters(scenes, people.unionAll(more))


@query(f"""WITH {fx.UNITS}, r AS (SELECT scene_id, arg_min(route, ord) AS route FROM u GROUP BY scene_id)
SELECT scene_id AS job_id, CASE WHEN CAST(route AS INTEGER) < 3 THEN '{{"r": ' || route || '}}' ELSE '{{}}' END AS knowledge FROM r""")
def route_selection(spark, sf_dir):
    u = fx.units(spark, sf_dir)
    scenes = context.scene_of(u.select(F.col("scene_id").alias("job_id"), F.col("ord").alias("pos"), "text", "speaker", "route"))
    routes = u.select("route").distinct().filter("route < 3").select("route", F.concat(F.lit('{"r": '), "route", F.lit("}")).alias("knowledge"))
    return context.select_route(scenes, routes)


@query(f"""WITH {fx.UNITS} SELECT 'own' AS kind, 'j' || scene_id AS job_id, id, text FROM u
UNION ALL SELECT 'next', 'j' || (conv_id - 1), id, text FROM u WHERE turn_of = 0 AND conv_id - 1 IN (SELECT conv_id FROM u)""".replace("h\n    FROM", "h, turn AS turn_of\n    FROM"))
def job_rows(spark, sf_dir):
    """Each job's entries and the first entry of the next job, looked up by id."""
    u = fx.units(spark, sf_dir)
    near = F.array(F.concat((F.col("conv_id") + 1).cast("string"), F.lit(":0")), F.concat(F.col("conv_id").cast("string"), F.lit(":0")))
    jobs = u.groupBy("conv_id").agg(F.collect_list("id").alias("entry_ids")).select(F.concat(F.lit("j"), "conv_id").alias("job_id"), "entry_ids", near.alias("adjacent_entry_ids"))
    own = context.job_entries(jobs, u).select(F.lit("own").alias("kind"), "job_id", "id", "text")
    return own.unionAll(context.adjacent_entries(jobs, u).select(F.lit("next").alias("kind"), "job_id", "id", "text"))


# What is delivered for a project, and by the project's number what is wrong with it, at which gate.
DOCUMENTS = {
    "project.json": '{"game_name": "g", "schema_version": 3, "source_locale": "ja", "target_locale": "en-GB"}', "source/file-manifest.json": '{"file_count": 2}', "research/unpack-notes.md": "# Notes\nArchives are plain.\n", "qa/roundtrip-report.json": '{"passed": true}',
    "extracted/script-map.json": '{"nodes": [1]}', "extracted/control-token-report.json": '{"engines": ["k"]}', "bible/version.json": '{"frozen": true, "version": 1}', "bible/world.md": "A world of islands.", "bible/honorifics.md": "They are kept as is.", "bible/language-profile.md": "Plain, short sentences.",
    "bible/characters.json": '{"characters": [{"id": "a"}]}', "bible/voice.json": '{"narrator": {"tone": "dry"}}', "bible/route-knowledge.json": "{}", "bible/calibration.jsonl": '{"source": "x"}\n', "bible/glossary.tsv": "\t".join(stages.GLOSSARY_FIELDS) + "\na\tb\n",
    "qa/global.json": '{"errors": 0}', "qa/repack-report.json": '{"passed": true}', "qa/playtest-report.json": '{"passed": true}', "qa/release-report.json": '{"passed": true}',
}
FOLDERS = ["staging/roundtrip/input", "staging/roundtrip/unpacked", "staging/roundtrip/repacked", "build", "release"]
WRONG = [
    ("project.json", None, "initialized", "project.json must contain game_name"), ("project.json", '{"game_name": "g", "schema_version": 3, "target_locale": 5}', "initialized", "project.json must contain source_locale,project.json must contain target_locale"),
    ("project.json", '{"game_name": "g", "schema_version": 3, "source_locale": "EN", "target_locale": "en"}', "initialized", "source_locale and target_locale must be different"), ("project.json", '{"game_name": "g", "schema_version": 2}', None, None),
    ("source/file-manifest.json", '{"file_count": 0}', "researched", "manifest describes no file"), ("research/unpack-notes.md", "# A long heading only\n```\nshort\n", "researched", "unpack-notes.md has no meaningful content"),
    ("qa/roundtrip-report.json", '{"passed": "true"}', "roundtrip-proven", "roundtrip-report.json must contain passed=true"), ("staging/roundtrip/unpacked", 0, "roundtrip-proven", "staging/roundtrip/unpacked is empty"),
    ("extracted/script-map.json", '{"nodes": {}}', "extracted", "script-map.json has no scene nodes"), ("extracted/control-token-report.json", '{"engines": []} x', "extracted", "control-token-report.json has no engine inventory"),
    ("bible/version.json", '{"frozen": true, "version": 0}', "bible-frozen", "version.json must be frozen at version >= 1"), ("bible/version.json", '{"frozen": 1, "version": 1}', "bible-frozen", "version.json must be frozen at version >= 1"), ("bible/world.md", "x", "bible-frozen", "world.md has no meaningful content"),
    ("bible/honorifics.md", None, "bible-frozen", "honorifics.md has no meaningful content"), ("bible/language-profile.md", "", "bible-frozen", "language-profile.md has no meaningful content"), ("bible/characters.json", '{"characters": [{"id": "a"}, "b"]}', "bible-frozen", "characters.json has no characters"),
    ("bible/voice.json", '{"narrator": {}, "characters": {}}', "bible-frozen", "voice.json has no voice definitions"), ("bible/voice.json", '{"narrator": "dry"}', "bible-frozen", "voice.json has no voice definitions"), ("bible/route-knowledge.json", '{"routes": []}', "bible-frozen", "route-knowledge.json is invalid"),
    ("bible/calibration.jsonl", "\n", "bible-frozen", "calibration.jsonl has no approved examples"), ("bible/calibration.jsonl", '{"source": "x"}\n[]\n', "bible-frozen", "calibration.jsonl has no approved examples"), ("bible/glossary.tsv", "source\ttarget\na\tb\n", "bible-frozen", "glossary.tsv lacks required columns"),
    ("bible/glossary.tsv", "\t".join(stages.GLOSSARY_FIELDS) + "\n", "bible-frozen", "glossary.tsv has no terminology rows"), ("jobs", "reviewed", "validated", "all jobs must be approved or merged"), ("qa/global.json", '{"errors": 1}', "validated", "global.json must report errors=0"),
    ("qa/global.json", '{"errors": false}', None, None), ("build", 0, "repacked", "build is empty"), ("qa/repack-report.json", "[]", "repacked", "repack-report.json must contain passed=true"), ("qa/playtest-report.json", None, "playtested", "playtest-report.json must contain passed=true"),
    ("release", 0, "released", "release is empty"), ("qa/release-report.json", '{"passed": false}', "released", "release-report.json must contain passed=true"), ("jobs", "merged", None, None),
]


@query(f"""WITH w AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{gate}', '{one}')" for k, (_, _, gate, problems) in enumerate(WRONG) if gate for one in problems.split(','))}) AS t(k, gate, problem))
SELECT o_orderkey AS project, gate, problem FROM orders JOIN w ON o_orderkey % {len(WRONG)} = w.k""")
def project_gates(spark, sf_dir):
    """A project for each order, each with one thing wrong at most: every rule of the gates on a project's documents."""
    o = fx.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("project"), (F.col("o_orderkey") % len(WRONG)).alias("k"))
    at = lambda name: [(k, bad) for k, (what, bad, _, _) in enumerate(WRONG) if what == name]

    def delivered(name, good):
        out = F.lit(good)
        for k, bad in at(name):
            out = F.when(F.col("k") == k, F.lit(bad)).otherwise(out)
        return out

    docs = F.map_filter(F.create_map(*(x for name, good in DOCUMENTS.items() for x in (F.lit(name), delivered(name, good)))), lambda _, v: v.isNotNull())
    files = F.create_map(*(x for name in FOLDERS for x in (F.lit(name), delivered(name, 3).cast("long"))))
    jobs = o.select("project", delivered("jobs", "approved").alias("status"))
    return audit.gate_problems(o.select("project", docs.alias("documents"), files.alias("files")), jobs).select("project", "gate", "problem")


@query("""WITH e AS (SELECT user_id, event_id FROM events) SELECT CAST(user_id AS VARCHAR) AS item, 'no evidence at log/' || event_id || ' for researched' AS problem FROM e WHERE event_id % 9 = 0""")
def evidence_paths(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events")
    path = F.concat(F.lit("log/"), "event_id")
    history = e.select(F.col("user_id").cast("string").alias("project"), F.lit(1).alias("n"), F.lit("researched").alias("stage"), F.array(path, F.lit("")).alias("evidence"))
    return stages.missing_evidence(history, e.filter("event_id % 9 > 0").select(path.alias("path"))).select("item", "problem")


PLAN_RULES = {0: "not approved", 1: "stale bible_version", 2: "source_digest differs", 3: "no context_notes", 4: "scene_ids must be non-empty strings", 5: "source_files must be non-empty strings", 6: "predecessors must be strings", 7: "unknown predecessor", 8: "adjacent id not connected", 9: "job_id not unique"}


@query(f"""WITH {fx.UNITS}, j AS (SELECT DISTINCT conv_id FROM u), w AS (SELECT * FROM (VALUES {', '.join(f"({k}, '{v}')" for k, v in PLAN_RULES.items())}) AS t(k, problem)), n AS (SELECT count(*) AS n FROM u WHERE conv_id % 12 = 9)
SELECT 'j' || conv_id AS item, problem FROM j JOIN w ON conv_id % 12 = w.k UNION ALL SELECT 'j' || conv_id, 'unknown predecessor' FROM j WHERE conv_id % 12 = 6
UNION ALL SELECT (SELECT count(*) FROM j WHERE conv_id % 12 = 10) || ' missing, ' || (SELECT count(*) FROM j WHERE conv_id % 12 = 10) || ' extra', 'coverage mismatch' FROM j WHERE conv_id % 12 = 10 HAVING count(*) > 0
UNION ALL SELECT CAST(n AS VARCHAR), 'entries overlap' FROM n WHERE n > 0""")
def plan_gate(spark, sf_dir):
    """Jobs of conversations with one thing wrong each: every rule of an approved plan."""
    u = fx.units(spark, sf_dir)
    k = F.col("conv_id") % 12
    rows = u.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id"))).alias("rs")).join(D.source_digest(u, ["conv_id"]), "conv_id")
    ids = F.transform("rs", lambda r: r["id"])
    job = F.concat(F.lit("j"), "conv_id")
    one, none = F.array(F.col("conv_id").cast("string")), F.array().cast("array<string>")
    jobs = rows.select(
        job.alias("job_id"), (k != 0).alias("plan_approved"), F.when(k == 1, 2).otherwise(3).cast("long").alias("bible_version"), F.when(k == 2, F.sha2(F.lit("x").cast("binary"), 256)).otherwise(F.col("digest")).alias("source_digest"), F.when(k == 3, " \t").otherwise("n").alias("context_notes"),
        F.when(k == 4, none).otherwise(one).alias("scene_ids"), F.when(k == 5, F.array(F.lit("f"), F.lit(""))).otherwise(F.array(F.lit("f"))).alias("source_files"), F.when(k == 6, F.array(F.lit(None).cast("string"))).when(k == 7, F.array(F.lit("j-"))).otherwise(none).alias("predecessors"),
        F.when(k == 8, F.array(F.lit("far"))).otherwise(none).alias("adjacent_entry_ids"), F.when(k == 10, F.concat(F.slice(ids, 2, F.size(ids)), F.array(F.concat(F.lit("new:"), job)))).otherwise(ids).alias("entry_ids"), k.alias("k"),
    )
    edges = spark.createDataFrame([], "src string, dst string")
    jobs = jobs.unionAll(jobs.filter("k = 9"))
    found = stages.plan_problems(jobs.drop("k"), u, edges, 3)
    return found.select("item", "problem").distinct()
