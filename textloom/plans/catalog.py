"""The registered queries of the library's own operators and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import digests as D
from textloom.functions import text as X
from textloom.operators import codepoints, context, glossary, planning, review, stages, validate
from textloom.operators.ordered import with_group_numbers
from textloom.plans import faces, files, gates, runs  # noqa: F401  register their queries
from textloom.plans import fixtures as fx
from textloom.plans.registry import ORACLE_SQL, QUERIES, query  # noqa: F401
from textloom.sources import readers
from textloom.streaming import status

def drafted(spark, sf_dir):
    return fx.units(spark, sf_dir), fx.draft(spark, sf_dir)


ROW_RULES = """
    SELECT 'empty-translation' AS code, id FROM m WHERE translation = ''
    UNION ALL SELECT 'source-hash', id FROM m WHERE translation <> '' AND got <> want
    UNION ALL SELECT 'newline-count', id FROM m WHERE translation <> '' AND length(text) - length(replace(text, chr(10), '')) <> length(translation) - length(replace(translation, chr(10), ''))
    UNION ALL SELECT 'invalid-character', id FROM m WHERE contains(translation, chr(65533))
    UNION ALL SELECT 'unicode-normalization', id FROM m WHERE translation <> '' AND translation <> nfc_normalize(translation)
    UNION ALL SELECT 'source-unchanged', id FROM m WHERE translation <> '' AND translation = text AND regexp_matches(seen, '[\\p{L}\\p{N}_]')
    UNION ALL SELECT 'length-ratio', id FROM m WHERE translation <> '' AND seen <> '' AND (length(out_seen) / CAST(length(seen) AS DOUBLE) < 0.08 OR length(out_seen) / CAST(length(seen) AS DOUBLE) > 8.0)
    UNION ALL SELECT 'confidence', id FROM m WHERE translation <> '' AND (confidence IS NULL OR confidence NOT IN ('high', 'medium', 'low'))
""".replace("0.08", "0.2").replace("8.0)", "5.0)")
BREAKS = """o AS (
    SELECT d.id, d.ord AS place_at, max(u.ord) OVER (ORDER BY d.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen, u.ord AS place FROM d JOIN u USING (id)
)"""


@query(f"""WITH {fx.DRAFT}, {BREAKS}, i AS ({ROW_RULES}
    UNION ALL SELECT 'missing-ids', id FROM u WHERE id NOT IN (SELECT id FROM d)
    UNION ALL SELECT DISTINCT 'extra-ids', id FROM d WHERE id NOT IN (SELECT id FROM u)
    UNION ALL SELECT 'duplicate-target-id', id FROM u WHERE h = 2
    UNION ALL SELECT 'id-order', NULL FROM o WHERE seen >= place HAVING count(*) > 0
    UNION ALL SELECT 'repeat-inconsistency', NULL FROM m WHERE translation <> '' AND regexp_matches(text, '[\\p{{L}}\\p{{N}}_]') GROUP BY text HAVING count(DISTINCT translation) > 1
) SELECT CASE WHEN code IN ('unicode-normalization', 'source-unchanged', 'length-ratio', 'confidence', 'repeat-inconsistency') THEN 'warning' ELSE 'error' END AS severity, code, count(*) AS n FROM i GROUP BY 1, 2""")
def validate_issue_summary(spark, sf_dir):
    return validate.summary(validate.validate(*drafted(spark, sf_dir), fx.POLICY))


@query(f"WITH {fx.DRAFT} {ROW_RULES}")
def validate_row_issues(spark, sf_dir):
    return validate.row_issues(validate.matched(*drafted(spark, sf_dir)), fx.POLICY).select("code", "id")


@query(f"WITH {fx.UNITS} SELECT id FROM u WHERE h = 0")
def validate_missing_ids(spark, sf_dir):
    return validate.missing_ids(*drafted(spark, sf_dir))


@query(f"WITH {fx.UNITS} SELECT 'x:' || id AS id FROM u WHERE h = 1")
def validate_extra_ids(spark, sf_dir):
    return validate.extra_ids(*drafted(spark, sf_dir))


@query(f"WITH {fx.DRAFT} SELECT 'duplicate-target-id' AS code, id FROM d GROUP BY id HAVING count(*) > 1")
def validate_duplicate_ids(spark, sf_dir):
    return validate.bad_ids(fx.draft(spark, sf_dir), "target").select("code", "id")


@query(f"WITH {fx.DRAFT}, {BREAKS} SELECT id, place_at FROM o WHERE seen >= place")
def validate_order_breaks(spark, sf_dir):
    return validate.order_breaks(*drafted(spark, sf_dir), bucket=20_000).withColumnRenamed("at", "place_at")


@query(f"WITH {fx.DRAFT}, i AS ({ROW_RULES}) SELECT count(*) FILTER (code <> 'x' AND code IN ('empty-translation', 'source-hash', 'newline-count', 'invalid-character')) AS errors, count(*) FILTER (code NOT IN ('empty-translation', 'source-hash', 'newline-count', 'invalid-character')) AS warnings, errors = 0 AS passed FROM i")
def validate_verdict(spark, sf_dir):
    return validate.verdict(validate.row_issues(validate.matched(*drafted(spark, sf_dir)), fx.POLICY))


def one_code(name: str, code: str):
    def run(spark, sf_dir):
        return validate.row_issues(validate.matched(*drafted(spark, sf_dir)), fx.POLICY).filter(F.col("code") == code).select("id")

    run.__name__ = name
    return query(f"WITH {fx.DRAFT}, i AS ({ROW_RULES}) SELECT id FROM i WHERE code = '{code}'")(run)


for _name, _code in (("newline_parity", "newline-count"), ("invalid_characters", "invalid-character"), ("source_unchanged", "source-unchanged"), ("length_ratio_outliers", "length-ratio"), ("nfc_violations", "unicode-normalization"), ("confidence_values", "confidence"), ("stale_source_hashes", "source-hash")):
    one_code(_name, _code)


@query(f"""WITH {fx.PAGES}, t AS (SELECT id, translation, tokens, unnest(list_distinct(tokens)) AS token FROM m),
n AS (SELECT id, token, CAST(len(list_filter(tokens, lambda x: x = token)) AS BIGINT) AS expected, CAST((length(translation) - length(replace(translation, token, ''))) / length(token) AS BIGINT) AS found FROM t)
SELECT * FROM n WHERE expected <> found""")
def token_count_violations(spark, sf_dir):
    s, t = fx.pages(spark, sf_dir)
    rows = s.join(t, "id").select("id", "translation", "protected_tokens", F.explode(X.miscounted(F.col("translation"), F.col("protected_tokens"))).alias("token"))
    return rows.select("id", "token", F.size(F.filter("protected_tokens", lambda x: x == F.col("token"))).cast("long").alias("expected"), X.count_of(F.col("translation"), F.col("token")).cast("long").alias("found"))


@query(f"""WITH RECURSIVE {fx.PAGES}, w AS (
    SELECT id, translation, tokens, 0 AS i, CAST(1 AS BIGINT) AS pos FROM m WHERE len(tokens) > 0
    UNION ALL SELECT id, translation, tokens, i + 1, CASE WHEN instr(substr(translation, pos), tokens[i + 1]) = 0 THEN 0 ELSE pos + instr(substr(translation, pos), tokens[i + 1]) - 1 + length(tokens[i + 1]) END FROM w WHERE i < len(tokens) AND pos > 0
) SELECT DISTINCT id FROM w WHERE pos = 0""")
def token_order_violations(spark, sf_dir):
    s, t = fx.pages(spark, sf_dir)
    return s.join(t, "id").filter((F.size("protected_tokens") > 0) & ~X.in_order(F.col("translation"), F.col("protected_tokens"))).select("id")


@query("SELECT CAST(page_id AS VARCHAR) AS id, CAST(length(html) - coalesce(list_sum(list_transform(regexp_extract_all(html, '<[^>]+>'), lambda t: length(t))), 0) AS BIGINT) AS visible FROM pages")
def visible_without_tokens(spark, sf_dir):
    s, _ = fx.pages(spark, sf_dir)
    return s.select("id", F.length(X.without_all(F.col("text"), F.col("protected_tokens"))).cast("long").alias("visible"))


@query("SELECT text AS src, count(DISTINCT source) AS n FROM documents WHERE text <> '' GROUP BY text HAVING count(DISTINCT source) > 1")
def repeat_inconsistency(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents").select(F.struct("text").alias("s"), F.struct(F.col("source").alias("translation")).alias("t"))
    return validate.repeat_inconsistencies(d)


@query(f"WITH {fx.DOCUMENTS} SELECT id, source, shadowed FROM hits WHERE source <> ''")
def glossary_shadowed(spark, sf_dir):
    s, t, g = fx.documents(spark, sf_dir)
    return glossary.shadowed_hits(validate.matched(s, t), g, fx.PLAIN_TERMS)


@query(f"""WITH {fx.DOCUMENTS} SELECT id, CASE WHEN status = 'locked' THEN 'locked-term' ELSE 'preferred-term' END AS code, source, target FROM hits
WHERE status IN ('locked', 'preferred') AND NOT shadowed AND NOT contains(out, target) AND source <> ''
UNION ALL SELECT id, 'forbidden-term', source, target FROM a WHERE status = 'forbidden' AND contains(out, target)""")
def term_violations(spark, sf_dir):
    s, t, g = fx.documents(spark, sf_dir)
    return glossary.term_issues(validate.matched(s, t), g, fx.PLAIN_TERMS)


@query("""WITH e AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY event_id) AND event_id > (SELECT min(event_id) FROM events) THEN 1 ELSE 0 END AS c FROM events),
g AS (SELECT event_id, event_type, sum(c) OVER (ORDER BY event_id) AS grp FROM e)
SELECT CAST(grp AS BIGINT) AS grp, event_type, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM g GROUP BY grp, event_type""")
def scene_islands(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), F.col("event_type").alias("scene_id"))
    grouped = planning.scene_islands(e, bucket=1000)
    return grouped.groupBy("grp", F.col("scene_id").alias("event_type")).agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.count("*").alias("n"))


SPLIT = """r AS (SELECT conv_id AS grp, row_number() OVER (PARTITION BY conv_id ORDER BY ord) AS i, ord, length(text) AS n, boundary_before AS b FROM u),
k AS (SELECT grp, max(i) AS k FROM r GROUP BY grp),
w AS (
    SELECT grp, i, ord, CAST(n AS BIGINT) AS chars, 0 AS part, false AS was_cut, false AS nat FROM r WHERE i = 1
    UNION ALL SELECT r.grp, r.i, r.ord, CASE WHEN w.chars + r.n > MOST THEN r.n ELSE w.chars + r.n END, CASE WHEN w.chars + r.n > MOST THEN w.part + 1 ELSE w.part END, w.chars + r.n > MOST, r.b FROM w JOIN r ON r.grp = w.grp AND r.i = w.i + 1
), ends AS (SELECT grp, part, bool_or(was_cut AND NOT nat) AS forced_start, max(i) AS last, arg_max(chars, i) AS chars FROM w GROUP BY grp, part),
f AS (SELECT e.grp, e.part, e.forced_start OR coalesce(n.forced_start, false) OR (e.last = k.k AND e.chars > MOST) AS forced FROM ends e JOIN k USING (grp) LEFT JOIN ends n ON n.grp = e.grp AND n.part = e.part + 1)"""


@query(f"WITH RECURSIVE {fx.UNITS}, {SPLIT.replace('MOST', '1200')} SELECT w.grp, w.ord, w.part, f.forced FROM w JOIN f USING (grp, part)")
def greedy_job_split(spark, sf_dir):
    return planning.greedy_parts(fx.units(spark, sf_dir).withColumnRenamed("conv_id", "grp"), 1200)


LINES = """l AS (SELECT row_number() OVER (ORDER BY event_id) AS i, event_id AS ord, user_id % 60 AS n, event_id % 5 = 0 AS nat FROM events),
p AS MATERIALIZED (SELECT *, CAST(sum(n) OVER (ORDER BY i) AS BIGINT) AS s FROM l)"""


@query(f"""WITH RECURSIVE {LINES}, c AS (SELECT 0 AS part, CAST(1 AS BIGINT) AS at UNION ALL SELECT part + 1, (SELECT min(i) FROM p WHERE s > (SELECT s - n FROM p WHERE i = c.at) + 3000 AND i > c.at) FROM c WHERE (SELECT max(s) FROM p) > (SELECT s - n FROM p WHERE i = c.at) + 3000),
e AS (SELECT c.part, c.at, coalesce(lead(c.at) OVER (ORDER BY c.part), (SELECT max(i) + 1 FROM p)) AS stop, c.part > 0 AND NOT p.nat AS torn FROM c JOIN p ON p.i = c.at),
f AS (SELECT *, torn OR coalesce(lead(torn) OVER (ORDER BY part), false) AS forced FROM e)
SELECT p.ord, f.part, f.forced FROM p JOIN f ON p.i >= f.at AND p.i < f.stop""")
def greedy_split_of_one_group(spark, sf_dir):
    """All events as one group, cut by buckets of its order."""
    rows = fx.table(spark, sf_dir, "events").select(F.lit(1).alias("grp"), F.col("event_id").alias("ord"), (F.col("user_id") % 60).alias("n"), (F.col("event_id") % 5 == 0).alias("natural"))
    return planning.bucketed_parts(rows, 3000, "grp", bucket=2000).select("ord", "part", "forced")


@query(f"""WITH RECURSIVE {fx.UNITS}, {SPLIT.replace('MOST', '1200')}, j AS (
    SELECT w.grp, w.part, f.forced, count(*) AS entries, CAST(sum(length(u.text)) AS BIGINT) AS source_char_count, 'sha256:' || sha256(string_agg(u.id || chr(0) || u.source_hash || chr(10), '' ORDER BY u.ord)) AS source_digest
    FROM w JOIN f USING (grp, part) JOIN u USING (ord) GROUP BY w.grp, w.part, f.forced
) SELECT 'job-' || lpad(CAST(row_number() OVER (ORDER BY grp, part) AS VARCHAR), 5, '0') || '-' || grp || CASE WHEN count(*) OVER (PARTITION BY grp) > 1 THEN '-p' || (part + 1) ELSE '' END AS job_id,
    CAST(grp % 5 AS VARCHAR) AS route, entries AS n_entries, source_char_count, CAST(ceil(CAST(source_char_count AS DOUBLE) * CAST(1.15 AS DOUBLE)) AS BIGINT) AS estimated_source_tokens, source_digest, forced OR source_char_count < 1500 AS needs_boundary_review FROM j""")
def job_plan(spark, sf_dir):
    jobs = planning.plan_jobs(fx.units(spark, sf_dir), 1200)
    return jobs.select("job_id", "route", F.size("entry_ids").cast("long").alias("n_entries"), "source_char_count", "estimated_source_tokens", "source_digest", "needs_boundary_review")


NATURAL = """c AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 0 WHEN boundary_before OR scene_id <> lag(scene_id) OVER w THEN 1 ELSE 0 END AS c FROM u WINDOW w AS (PARTITION BY route ORDER BY ord)),
n AS (SELECT route, ord, id, text, CAST(sum(c) OVER (PARTITION BY route ORDER BY ord) AS BIGINT) AS unit FROM c)"""


@query(f"WITH {fx.UNITS}, {NATURAL} SELECT route, ord, unit FROM n")
def natural_units(spark, sf_dir):
    return planning.natural_units(fx.units(spark, sf_dir), "route").select("route", "ord", "unit")


CHUNKS = f"""{fx.UNITS}, {NATURAL}, z AS (SELECT *, length(text) AS len, sum(length(text)) OVER (PARTITION BY route, unit) AS total, row_number() OVER (PARTITION BY route ORDER BY ord) AS i FROM n),
pieces AS (
    SELECT route, i, ord, id, unit, CAST(len AS BIGINT) AS chars, len, total, 0 AS piece FROM z WHERE i = 1
    UNION ALL SELECT z.route, z.i, z.ord, z.id, z.unit, CASE WHEN z.unit <> p.unit OR (z.total > 3000 AND p.chars + z.len > 3000) THEN z.len ELSE p.chars + z.len END, z.len, z.total,
        CASE WHEN z.unit <> p.unit OR (z.total > 3000 AND p.chars + z.len > 3000) THEN p.piece + 1 ELSE p.piece END FROM pieces p JOIN z ON z.route = p.route AND z.i = p.i + 1
), ps AS (SELECT route, piece, sum(len) AS len, max(total) > 3000 AS forced FROM pieces GROUP BY route, piece),
packed AS (
    SELECT route, piece, CAST(len AS BIGINT) AS chars, 1 AS chunk, forced FROM ps WHERE piece = 0
    UNION ALL SELECT ps.route, ps.piece, CAST(CASE WHEN k.chars + ps.len > 3000 THEN ps.len ELSE k.chars + ps.len END AS BIGINT), CASE WHEN k.chars + ps.len > 3000 THEN k.chunk + 1 ELSE k.chunk END, ps.forced FROM packed k JOIN ps ON ps.route = k.route AND ps.piece = k.piece + 1
), rows AS (SELECT p.route, p.ord, p.id, k.chunk, bool_or(k.forced) OVER (PARTITION BY p.route, k.chunk) AS forced, p.len FROM pieces p JOIN packed k USING (route, piece))"""


@query(f"WITH RECURSIVE {CHUNKS} SELECT route, ord, id, chunk, forced FROM rows")
def chunk_rows(spark, sf_dir):
    return planning.chunk_rows(fx.units(spark, sf_dir), "route", 3000)


@query(f"""WITH RECURSIVE {CHUNKS}, pl AS (SELECT route, chunk, list(id ORDER BY ord) AS ids, CAST(sum(len) AS BIGINT) AS char_count, bool_or(forced) AS forced FROM rows GROUP BY route, chunk)
SELECT route, 'chunk-' || lpad(CAST(chunk AS VARCHAR), 4, '0') AS chunk_id, array_to_string(ids, ' ') AS entries, coalesce(array_to_string(list_slice(lag(ids) OVER w, -2, -1), ' '), '') AS before, coalesce(array_to_string(list_slice(lead(ids) OVER w, 1, 2), ' '), '') AS after, char_count, forced
FROM pl WINDOW w AS (PARTITION BY route ORDER BY chunk)""")
def chunk_plan(spark, sf_dir):
    plan = planning.chunk_plan(fx.units(spark, sf_dir), "route", 3000, 2)
    return plan.select("route", "chunk_id", F.array_join("entry_ids", " ").alias("entries"), F.array_join("overlap_before_ids", " ").alias("before"), F.array_join("overlap_after_ids", " ").alias("after"), "char_count", "forced")


@query("""WITH p AS (SELECT DISTINCT l_returnflag AS flag, l_orderkey AS id FROM lineitem WHERE l_orderkey % 10 > 0), a AS (SELECT l_returnflag AS flag, l_orderkey AS id, count(*) AS n FROM lineitem WHERE l_linenumber BETWEEN 2 AND 4 AND l_returnflag <> 'R' GROUP BY 1, 2
    UNION ALL SELECT *, 1 FROM p WHERE flag = 'R'), b AS (SELECT flag, id, p.id AS planned, n FROM (SELECT *, id AS k FROM p) p FULL JOIN a USING (flag, id))
SELECT flag, count(*) FILTER (n IS NULL) AS missing, count(*) FILTER (n > 1) AS duplicated, count(*) FILTER (planned IS NULL) AS extra, count(planned) AS planned, missing = 0 AND duplicated = 0 AND extra = 0 AS valid FROM b GROUP BY flag""".replace("p.id AS planned", "k AS planned"))
def coverage_proof(spark, sf_dir):
    """Flags with missing, repeated and extra ids, and one where each id is there once."""
    rows = fx.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_orderkey").alias("id"), "l_linenumber")
    planned = rows.filter("id % 10 > 0")
    return planning.coverage(planned, rows.filter("l_linenumber between 2 and 4 and flag <> 'R'").select("flag", "id").unionAll(planned.filter("flag = 'R'").select("flag", "id").distinct()), "flag")


def reviewed(spark, sf_dir):
    s, t, _ = fx.documents(spark, sf_dir)
    labels = fx.table(spark, sf_dir, "labels").filter("quality = 0").select(F.col("doc_id").cast("string").alias("id"), "toxic")
    delta = s.join(labels, "id").select("ord", "id", F.concat(F.lit("R:"), F.substring("text", 1, 20)).alias("reviewer_translation"), F.lit("edit").alias("reason"), F.when(F.col("toxic") == 1, "major").otherwise("minor").alias("severity"))
    return s, t, delta


@query("""SELECT CAST(d.doc_id AS VARCHAR) AS id, sha256(CASE WHEN l.doc_id IS NULL THEN d.text || ' T' || (d.doc_id % 40) ELSE 'R:' || substr(d.text, 1, 20) END) AS translation_sha, 'sha256:' || sha256(d.text) AS source_hash
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 0) l USING (doc_id)""")
def review_overlay(spark, sf_dir):
    s, t, delta = reviewed(spark, sf_dir)
    return review.overlay(t, delta, s).select("id", F.sha2(F.col("translation").cast("binary"), 256).alias("translation_sha"), "source_hash")


@query("""SELECT (SELECT count(*) FROM documents) AS reviewed_entry_count, count(*) AS delta_count, count(*) FILTER (toxic = 1) AS major_count, count(*) FILTER (toxic <> 1) AS minor_count, 'all-entries' AS coverage, true AS passed
FROM labels JOIN documents USING (doc_id) WHERE quality = 0""")
def review_report(spark, sf_dir):
    _, t, delta = reviewed(spark, sf_dir)
    return review.review_report(delta, t)


@query("""SELECT 'newlines' AS guard, CAST(doc_id AS VARCHAR) AS id FROM documents JOIN labels USING (doc_id) WHERE quality = 0 AND length(text) - length(replace(text, chr(10), '')) <> length(substr(text, 1, 20)) - length(replace(substr(text, 1, 20), chr(10), ''))""")
def review_guards(spark, sf_dir):
    return review.delta_problems(*reviewed(spark, sf_dir))


@query("SELECT doc_id AS ord, CAST(doc_id AS VARCHAR) AS id, sha256(text || ' T' || (doc_id % 40)) AS translation_sha, 'sha256:' || sha256(text) AS source_hash FROM documents")
def merge_in_order(spark, sf_dir):
    s, t, _ = fx.documents(spark, sf_dir)
    approved = t.join(s.select("id", F.col("route").alias("path")), "id")
    return review.merge_in_order(s, approved).select("ord", "id", F.sha2(F.col("translation").cast("binary"), 256).alias("translation_sha"), "source_hash")


@query("""SELECT 'incomplete' AS guard, CAST(doc_id AS VARCHAR) AS id FROM documents WHERE lang = 'de'
UNION ALL SELECT 'overlap', doc_id || ' again and fr' FROM documents WHERE lang = 'fr' AND doc_id % 10 = 0""")
def merge_guards(spark, sf_dir):
    s, t, _ = fx.documents(spark, sf_dir)
    approved = t.join(s.select("id", F.col("route").alias("path")), "id").filter("path <> 'de'")
    again = approved.filter((F.col("path") == "fr") & (F.col("ord") % 10 == 0)).withColumn("path", F.lit("again"))
    return review.merge_problems(s, approved.unionByName(again))


DIGEST = "'sha256:' || sha256(string_agg(id || chr(0) || source_hash || chr(10), '' ORDER BY ord))"


@query(f"WITH {fx.UNITS} SELECT scene_id, {DIGEST} AS digest FROM u GROUP BY scene_id")
def scene_digest(spark, sf_dir):
    return D.source_digest(fx.units(spark, sf_dir), ["scene_id"])


@query(f"WITH {fx.UNITS} SELECT route, {DIGEST} AS digest FROM u GROUP BY route")
def job_digest(spark, sf_dir):
    return D.source_digest(fx.units(spark, sf_dir), ["route"], strict=False)


@query("""WITH e AS (SELECT 'F' || doc_id AS path, octet_length(CAST(encode(text) AS BLOB)) AS size, sha256(text) AS sha FROM documents)
SELECT count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_bytes, sha256(string_agg(path || chr(0) || size || chr(0) || sha, chr(10) ORDER BY lower(path), path)) AS entries_sha256 FROM e""")
def manifest_totals(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return readers.manifest_totals(d.select(F.concat(F.lit("F"), "doc_id").alias("path"), F.octet_length("text").cast("long").alias("size"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256")))


def scenes(spark, sf_dir):
    u = fx.units(spark, sf_dir)
    return context.scene_of(u.select(F.col("scene_id").alias("job_id"), F.col("ord").alias("pos"), "text", "speaker", "route"))


def names(spark, sf_dir):
    b = fx.table(spark, sf_dir, "benchmark")
    words = b.select(F.explode(F.split("text", "[ .,\n]+")).alias("source")).filter("source <> ''").distinct()
    return words.select("source", F.lit("").alias("target")).unionAll(spark.createDataFrame([("", "x"), ("Boss", "system")], "source string, target string"))


TERMS = f"""{fx.UNITS}, b AS (SELECT DISTINCT source FROM (SELECT unnest(regexp_split_to_array(text, '[ .,\n]+')) AS source FROM benchmark) WHERE source <> ''),
sc AS (SELECT scene_id AS job_id, string_agg(text, chr(10) ORDER BY ord) AS t, bool_or(speaker = 'system') AS sys FROM u GROUP BY scene_id),
terms AS (SELECT job_id, source FROM sc JOIN b ON contains(t, source) UNION SELECT job_id, 'Boss' FROM sc WHERE sys OR contains(t, 'Boss'))"""


@query(f"WITH {TERMS} SELECT job_id, source FROM terms")
def context_selection(spark, sf_dir):
    return context.select_terms(scenes(spark, sf_dir), names(spark, sf_dir))


@query(f"""WITH {TERMS}, x AS (SELECT item_id AS ord, text AS source FROM benchmark), h AS (SELECT DISTINCT job_id, ord FROM terms JOIN x ON contains(x.source, terms.source))
SELECT job_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY ord) AS n FROM h) WHERE n <= 50""")
def calibration_selection(spark, sf_dir):
    examples = fx.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ord"), F.col("text").alias("source"), F.lit("").alias("speaker"))
    s = scenes(spark, sf_dir)
    return context.select_calibration(s, context.select_terms(s, names(spark, sf_dir)), examples)


def jobs(spark, sf_dir):
    u = fx.units(spark, sf_dir)
    rows = u.groupBy("conv_id").agg(F.array_sort(F.collect_list("id")).alias("entry_ids"), F.count("*").alias("n"))
    near = F.array(F.concat((F.col("conv_id") + 1).cast("string"), F.lit(":0")))
    return rows.select("conv_id", F.concat(F.lit("j"), "conv_id").alias("job_id"), F.array(F.col("conv_id").cast("string")).alias("scene_ids"), "entry_ids", near.alias("adjacent_entry_ids"), F.array(F.concat(F.lit("j"), F.col("conv_id") - 1)).alias("predecessors"))


@query("""WITH c AS (SELECT DISTINCT conv_id FROM conversations), t AS (SELECT DISTINCT conv_id FROM conversations WHERE turn = 0)
SELECT 'j' || conv_id AS job_id, (conv_id + 1) || ':0' AS id, CASE WHEN conv_id + 1 IN (SELECT conv_id FROM t) THEN CAST(conv_id + 1 AS VARCHAR) END AS scene FROM c
WHERE NOT (conv_id + 1 IN (SELECT conv_id FROM t) AND conv_id % 3 = 0)""")
def adjacency_violations(spark, sf_dir):
    u = fx.units(spark, sf_dir)
    edges = u.filter("conv_id % 3 = 0").select((F.col("conv_id") + 1).cast("string").alias("src"), F.col("conv_id").cast("string").alias("dst")).distinct()
    return stages.adjacency_violations(jobs(spark, sf_dir), u, edges)


@query("SELECT 'j' || conv_id AS job_id, 'j' || (conv_id - 1) AS predecessor FROM (SELECT DISTINCT conv_id FROM conversations) WHERE conv_id - 1 NOT IN (SELECT conv_id FROM conversations)")
def unknown_predecessors(spark, sf_dir):
    return stages.unknown_predecessors(jobs(spark, sf_dir)).select("job_id", "predecessor")


@query("""SELECT count(*) FILTER (conv_id % 7 = 0) AS missing, CAST(0 AS BIGINT) AS extra, count(*) FILTER (conv_id % 11 = 0 AND conv_id % 7 <> 0) AS overlaps FROM conversations""")
def plan_coverage(spark, sf_dir):
    planned = jobs(spark, sf_dir).filter("conv_id % 7 <> 0")
    return stages.plan_coverage(planned.unionAll(planned.filter("conv_id % 11 = 0")), fx.units(spark, sf_dir))


@query(f"WITH {fx.UNITS} SELECT 'j' || conv_id AS job_id FROM u GROUP BY conv_id HAVING conv_id % 4 = 0")
def digest_mismatches(spark, sf_dir):
    u = fx.units(spark, sf_dir)
    digest = D.source_digest(u, ["conv_id"])
    planned = jobs(spark, sf_dir).withColumn("entry_ids", F.array_sort("entry_ids", lambda a, b: (F.split_part(a, F.lit(":"), F.lit(2)).cast("int") - F.split_part(b, F.lit(":"), F.lit(2)).cast("int"))))
    planned = planned.join(digest, "conv_id").withColumn("source_digest", F.when(F.col("conv_id") % 4 == 0, "sha256:0").otherwise(F.col("digest")))
    return stages.digest_mismatches(planned.drop("digest"), u)


STAGE_LIST = ", ".join(f"'{s}'" for s in stages.STAGES)


@query(f"""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k FROM events), p AS (SELECT user_id || '-' || (k // 12) AS project, k % 12 AS n, user_id, event_id FROM e),
h AS (SELECT project, user_id, n, event_id, [{STAGE_LIST}][n + 1 + CASE WHEN user_id % 4 = 0 AND n = 2 THEN 1 ELSE 0 END] AS stage FROM p)
SELECT project AS item, 'not contiguous' AS problem FROM h WHERE user_id % 4 = 0 AND n = 2
UNION ALL SELECT project, 'no evidence for ' || stage FROM h WHERE event_id % 13 = 0""")
def stage_history_check(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select("user_id", "event_id", (F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1).alias("k"))
    e = e.select(F.concat_ws("-", "user_id", F.floor(F.col("k") / 12)).alias("project"), (F.col("k") % 12).alias("n"), "user_id", "event_id")
    at = F.col("n") + 1 + F.when((F.col("user_id") % 4 == 0) & (F.col("n") == 2), 1).otherwise(0)
    evidence = F.when(F.col("event_id") % 13 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("log")))
    return stages.history_problems(e.select("project", "n", F.element_at(F.array(*map(F.lit, stages.STAGES)), at.cast("int")).alias("stage"), evidence.alias("evidence")))


@query("SELECT user_id AS job_id, arg_max(event_type, event_id) AS status, count(*) AS changes FROM events GROUP BY user_id")
def job_status_latest(spark, sf_dir):
    return stages.latest_status(fx.table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("status")))


@query("SELECT date_trunc('hour', ts) AS start, event_type AS status, count(*) AS n FROM events GROUP BY 1, 2")
def status_changes_per_hour(spark, sf_dir):
    return status.changes_per_window(fx.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("status")))


def document_texts(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), F.col("source").alias("location"), "text")


CHARS = "c AS (SELECT doc_id, source, unnest(regexp_split_to_array(text, '')) AS c FROM documents), v AS (SELECT doc_id, source, unicode(c) AS cp FROM c WHERE c <> '' AND NOT regexp_matches(c, '[\\p{C}\\p{Z}\\t\\n\\v\\f\\r]'))"


@query(f"WITH {CHARS} SELECT cp, count(*) AS n FROM v GROUP BY cp")
def codepoint_histogram(spark, sf_dir):
    return codepoints.histogram(document_texts(spark, sf_dir))


@query(f"WITH {CHARS} SELECT cp, count(*) AS n, 'U+' || CASE WHEN length(to_hex(cp)) < 4 THEN lpad(to_hex(cp), 4, '0') ELSE to_hex(cp) END AS label FROM v WHERE cp NOT BETWEEN 32 AND 126 GROUP BY cp")
def codepoint_missing(spark, sf_dir):
    ascii_map = spark.range(32, 127).select(F.col("id").cast("int").alias("cp"))
    return codepoints.uncovered(codepoints.histogram(document_texts(spark, sf_dir)), ascii_map)


@query(f"""WITH {CHARS}, f AS (SELECT cp, source AS location, min(doc_id) AS ord FROM v GROUP BY cp, source)
SELECT cp, location, CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY cp ORDER BY ord, location) AS place FROM f) WHERE place <= 5""")
def codepoint_locations(spark, sf_dir):
    return codepoints.first_locations(document_texts(spark, sf_dir))


USAGE = "SELECT event_id, CAST(event_id % 900 AS BIGINT) AS input_tokens, CAST(event_id % 900 * 3 // 4 AS BIGINT) AS cached_input_tokens, CAST(CASE WHEN event_id % 5 > 0 THEN 700 END AS BIGINT) AS expected_prefix_tokens FROM events"


@query(f"""WITH g AS ({USAGE}) SELECT event_id, coalesce(expected_prefix_tokens - 256, -1) AS minimum_cached_tokens, input_tokens - cached_input_tokens AS noncached_input_tokens, CASE WHEN input_tokens > 0 THEN CAST(cached_input_tokens AS DOUBLE) / input_tokens END AS cache_rate,
CASE WHEN expected_prefix_tokens IS NULL THEN 'observed-only' WHEN cached_input_tokens >= expected_prefix_tokens - 256 THEN 'pass' ELSE 'fail' END AS verdict FROM g""")
def cache_probe(spark, sf_dir):
    e = F.col("event_id")
    usage = fx.table(spark, sf_dir, "events").select("event_id", (e % 900).alias("input_tokens"), F.floor((e % 900) * 3 / 4).alias("cached_input_tokens"), F.when(e % 5 > 0, F.lit(700).cast("long")).alias("expected_prefix_tokens"))
    return codepoints.cache_verdicts(usage).select("event_id", F.coalesce("minimum_cached_tokens", F.lit(-1)).cast("long").alias("minimum_cached_tokens"), "noncached_input_tokens", "cache_rate", "verdict")


@query("""WITH s AS (SELECT doc_id, substr(trim(regexp_replace(text, '[^\\p{L}\\p{N}_.-]+', '-', 'g'), '-._'), 1, 60) AS slug, length(text) AS n FROM documents)
SELECT doc_id, CASE WHEN slug = '' THEN 'scene' ELSE slug END AS slug, CAST(ceil(CAST(n AS DOUBLE) * CAST(1.15 AS DOUBLE)) AS BIGINT) AS tokens FROM s""")
def slugs_and_tokens(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", X.slug(F.col("text")).alias("slug"), X.estimated_tokens(F.length("text")).alias("tokens"))


@query(f"WITH {fx.UNITS} SELECT ord, id, '' AS kind, speaker, text FROM u")
def model_view(spark, sf_dir):
    return context.model_view(fx.units(spark, sf_dir)).drop("protected_tokens")


@query(f"WITH {fx.UNITS} SELECT id, source_hash, 'conversations' AS file, ord AS \"order\", route, scene_id FROM u")
def machine_view(spark, sf_dir):
    return context.machine_view(fx.units(spark, sf_dir))


@query("""WITH e AS (SELECT event_id, event_type, CASE WHEN event_id > (SELECT min(event_id) FROM events) AND (event_type IS DISTINCT FROM lag(event_type) OVER (ORDER BY event_id) OR event_id % 10 = 0) THEN 1 ELSE 0 END AS c FROM events)
SELECT event_id AS ord, CAST(sum(c) OVER (ORDER BY event_id) AS BIGINT) AS grp FROM e""")
def runs_with_breaks(spark, sf_dir):
    e = fx.table(spark, sf_dir, "events").select(F.col("event_id").alias("ord"), "event_type")
    return with_group_numbers(e, F.col("event_type"), bucket=777, breaks=F.col("ord") % 10 == 0).select("ord", "grp")
