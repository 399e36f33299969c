"""The jobs as queries: each runs twice into one new folder, and its whole output is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobs import intake, term_audit
from jobs.common import config_of
from textloom.operators.stages import STATUSES
from textloom.plans import fixtures as fx
from textloom.plans.files import scratch
from textloom.plans.registry import query
from textloom.streaming import changes


@query(f"""WITH d AS (SELECT coalesce(nullif(lang, ''), 'und') AS lang, doc_id, regexp_split_to_array(text, '\\r\\n|\\n|\\r') AS lines FROM documents WHERE text IS NOT NULL),
l AS (SELECT lang, doc_id, unnest(lines) AS text, unnest(range(1, len(lines) + 1)) AS line FROM d),
u AS (SELECT lang, doc_id, CAST(line AS INTEGER) AS line, doc_id || ':' || line AS id, 'sha256:' || sha256(text) AS source_hash, length(text) AS chars, CAST(ceil(CAST(length(text) AS DOUBLE) * CAST(1.15 AS DOUBLE)) AS BIGINT) AS tokens,
    CAST(len(regexp_extract_all(text, '\\{{[^{{}}]*\\}}|%[sd]|<[^<>]+>')) AS BIGINT) AS protected,
    concat_ws(',', CASE WHEN contains(text, chr(65533)) OR contains(text, chr(0)) THEN 'invalid-character' END, CASE WHEN NOT regexp_matches(text, '[\\p{{L}}\\p{{N}}_㐀-鿿]') THEN 'no-words' END,
        CASE WHEN length(text) > 2000 THEN 'too-long' END, CASE WHEN text <> nfc_normalize(text) THEN 'unicode-normalization' END) AS problems, text FROM l WHERE trim(text, '{fx.STRIP_SQL}') <> '')
SELECT 'unit' AS kind, lang, doc_id, line, id, source_hash, chars, tokens, protected, problems, text FROM u
UNION ALL SELECT DISTINCT 'text', lang, CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), NULL, source_hash, chars, tokens, CAST(NULL AS BIGINT), problems, text FROM u""")
def job1_intake(spark, sf_dir):
    """Units of all documents and the texts that they brought; the second run finds nothing new."""
    folder = scratch(spark)
    for _ in range(2):
        intake.run(spark, f"{sf_dir}/documents.parquet", f"{folder}/out", f"{folder}/checkpoint", config_of("intake"))
    units, texts = (intake.read(spark, f"{folder}/out", name).drop("batch") for name in ("units", "texts"))
    texts = texts.withColumns({c: F.lit(None).cast(units.schema[c].dataType) for c in units.columns if c not in texts.columns})
    return units.withColumn("kind", F.lit("unit")).unionByName(texts.withColumn("kind", F.lit("text")))


@query(f"""WITH {fx.DOCUMENTS}, k AS (SELECT *, row_number() OVER (ORDER BY source, target, status) - 1 AS term FROM (SELECT DISTINCT source, target, status FROM g WHERE source <> '')),
d AS MATERIALIZED (SELECT lang, doc_id, source AS origin, replace(lower(text), 'ß', 'ss') AS low FROM documents), t AS MATERIALIZED (SELECT DISTINCT *, replace(lower(source), 'ß', 'ss') AS low FROM g),
h AS (SELECT DISTINCT d.lang, d.doc_id, k.* FROM d JOIN t ON (t.scope = '' OR t.scope = d.lang OR t.scope = d.origin) AND contains(d.low, t.low) JOIN k USING (source, target, status))
SELECT 'hit' AS kind, lang, doc_id, term, source, target, status, CAST(NULL AS BIGINT) AS documents FROM h
UNION ALL SELECT 'term', NULL, NULL, term, source, target, status, (SELECT count(*) FROM h WHERE h.term = k.term) FROM k""")
def job2_term_audit(spark, sf_dir):
    """Terms made of the benchmark's texts, delivered as a tab-separated file, in all documents."""
    folder = scratch(spark)
    _, _, terms = fx.documents(spark, sf_dir)
    terms.write.option("sep", "\t").option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{folder}/glossary.tsv")
    for _ in range(2):
        term_audit.run(spark, f"{sf_dir}/documents.parquet", f"{folder}/glossary.tsv", f"{folder}/out", config_of("term_audit"))
    hits = spark.read.schema(term_audit.HIT).parquet(f"{folder}/out/hits").withColumn("kind", F.lit("hit")).withColumn("documents", F.lit(None).cast("long"))
    used = spark.read.parquet(f"{folder}/out/terms").withColumns({"kind": F.lit("term"), "doc_id": F.lit(None).cast("long"), "lang": F.lit(None).cast("string")})
    return hits.unionByName(used)


STATUS_LIST = ", ".join(f"'{s}'" for s in STATUSES)


@query(f"""WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS job_id, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k, [{STATUS_LIST}, 'gone'][event_id % 9 + 1] AS to_status,
    CASE WHEN event_id % 3 > 0 THEN [{STATUS_LIST}][event_id // 3 % 8 + 1] END AS from_status, event_id % 2 AS note FROM events),
w AS (SELECT job_id, CAST(0 AS BIGINT) AS seq, CAST(0 AS BIGINT) AS k, false AS held, 'pending' AS status, CAST(0 AS BIGINT) AS n FROM e GROUP BY job_id
    UNION ALL SELECT e.job_id, e.seq, e.k, e.to_status <> 'gone' AND coalesce(e.from_status = w.status, true), CASE WHEN e.to_status <> 'gone' AND coalesce(e.from_status = w.status, true) THEN e.to_status ELSE w.status END,
        CASE WHEN e.to_status <> 'gone' AND coalesce(e.from_status = w.status, true) THEN w.n + e.note ELSE w.n END FROM w JOIN e ON e.job_id = w.job_id AND e.k = w.k + 1)
SELECT job_id, seq, held, status, CAST(n AS INTEGER) AS n_notes FROM w WHERE k > 0""")
def status_compare_and_set(spark, sf_dir):
    """Each event as a change of its user's status, taken as a stream from the table's files."""
    folder, n = scratch(spark), F.col("event_id")
    of = lambda names, at: F.element_at(F.array(*map(F.lit, names)), (at + 1).cast("int"))
    with changes.with_states(spark):
        events = spark.readStream.schema("event_id long, user_id long").parquet(intake.as_pattern(f"{sf_dir}/events.parquet"))
        rows = events.select(F.col("user_id").cast("string").alias("job_id"), n.alias("seq"), F.when(n % 3 > 0, of(STATUSES, F.floor(n / 3) % 8)).alias("from_status"), of([*STATUSES, "gone"], n % 9).alias("to_status"), F.when(n % 2 == 1, "n").alias("note"))
        stream = changes.applied(rows).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append").trigger(availableNow=True).start()
        stream.awaitTermination()
    return spark.read.schema(changes.OUTCOME).parquet(f"{folder}/out")
