"""Text units, drafts, terms and plans derived from the test tables, for queries and their DuckDB statements.

Each derivation is written twice: as a DataFrame and as a DuckDB common table expression. Drafts are
mutated by a residue h of the unit's key, one residue for each kind of mistake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.digests import sha256_of
from textloom.functions.text import SPACES
from textloom.policy import Policy

POLICY = Policy("en", "fr")
PLAIN_TERMS = Policy("en", "fr", term_modes=False)
BAD, ACCENT = "\ufffd", "e\u0301"
STRIP_SQL = SPACES.replace("'", "''")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), F.concat_ws(":", "conv_id", "turn").alias("id"), F.col("conv_id").cast("string").alias("scene_id"), (F.col("conv_id") % 5).cast("string").alias("route"),
        F.lit("conversations").alias("file"), F.col("role").alias("speaker"), "text", sha256_of(F.col("text")).alias("source_hash"), (F.col("turn") % 4 == 0).alias("boundary_before"), "conv_id", ((F.col("conv_id") * 7 + F.col("turn") * 3) % 23).alias("h"),
    )


UNITS = """u AS (
    SELECT conv_id * 1000 + turn AS ord, conv_id || ':' || turn AS id, CAST(conv_id AS VARCHAR) AS scene_id, CAST(conv_id % 5 AS VARCHAR) AS route, role AS speaker, text,
        'sha256:' || sha256(text) AS source_hash, turn % 4 = 0 AS boundary_before, conv_id, (conv_id * 7 + turn * 3) % 23 AS h
    FROM conversations
)"""


def draft(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = units(spark, sf_dir)
    h, text = F.col("h"), F.col("text")
    out = F.when(h == 3, "").when(h == 4, F.concat(text, F.lit("\n"))).when(h == 5, F.concat(text, F.lit(BAD))).when(h == 6, F.concat(text, F.lit(ACCENT))).when(h == 7, text).when(h == 8, F.substring(text, 1, 1)).otherwise(F.concat(text, F.lit(" ok")))
    confidence = F.when(h == 10, "maybe").otherwise("high")
    own = F.when(h == 11, "sha256:0").when(h == 12, F.col("source_hash"))
    base = u.filter("h <> 0").select(F.when(h == 9, F.col("ord") + 1700).otherwise(F.col("ord")).alias("ord"), "id", out.alias("translation"), confidence.alias("confidence"), own.alias("source_hash"))
    again = u.filter("h = 2").select((F.col("ord") + 500).alias("ord"), "id", F.concat(text, F.lit(" dup")).alias("translation"), F.lit("high").alias("confidence"), F.lit(None).cast("string").alias("source_hash"))
    extra = u.filter("h = 1").select((F.col("ord") + 400).alias("ord"), F.concat(F.lit("x:"), "id").alias("id"), text.alias("translation"), F.lit("high").alias("confidence"), F.lit(None).cast("string").alias("source_hash"))
    return base.unionAll(again).unionAll(extra)


DRAFT = f"""{UNITS}, d AS (
    SELECT CASE WHEN h = 9 THEN ord + 1700 ELSE ord END AS ord, id,
        CASE h WHEN 3 THEN '' WHEN 4 THEN text || chr(10) WHEN 5 THEN text || '{BAD}' WHEN 6 THEN text || '{ACCENT}' WHEN 7 THEN text WHEN 8 THEN substr(text, 1, 1) ELSE text || ' ok' END AS translation,
        CASE WHEN h = 10 THEN 'maybe' ELSE 'high' END AS confidence, CASE WHEN h = 11 THEN 'sha256:0' WHEN h = 12 THEN source_hash END AS source_hash
    FROM u WHERE h <> 0
    UNION ALL SELECT ord + 500, id, text || ' dup', 'high', NULL FROM u WHERE h = 2
    UNION ALL SELECT ord + 400, 'x:' || id, text, 'high', NULL FROM u WHERE h = 1
), m AS (
    SELECT u.id, u.text, u.source_hash AS want, t.translation, t.confidence, t.source_hash AS got,
        trim(u.text, '{STRIP_SQL}') AS seen, trim(t.translation, '{STRIP_SQL}') AS out_seen
    FROM u JOIN (SELECT id, arg_max(translation, ord) AS translation, arg_max(confidence, ord) AS confidence, arg_max(source_hash, ord) AS source_hash FROM d GROUP BY id) t USING (id)
)"""


def pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = table(spark, sf_dir, "pages").withColumn("tokens", F.regexp_extract_all("html", F.lit("<[^>]+>"), F.lit(0)))
    half = F.floor(F.length("html") / 2).cast("int")
    out = F.when(F.col("page_id") % 5 == 0, F.concat("html", F.coalesce(F.try_element_at("tokens", F.lit(1)), F.lit("")))).when(F.col("page_id") % 5 == 1, F.concat(F.substr("html", half + 1), F.substr("html", F.lit(1), half))).otherwise(F.col("html"))
    source = p.select(F.col("page_id").alias("ord"), F.col("page_id").cast("string").alias("id"), F.col("html").alias("text"), F.col("tokens").alias("protected_tokens"))
    return source, p.select(F.col("page_id").alias("ord"), F.col("page_id").cast("string").alias("id"), out.alias("translation"))


PAGES = """p AS (
    SELECT CAST(page_id AS VARCHAR) AS id, html, regexp_extract_all(html, '<[^>]+>') AS tokens, page_id FROM pages
), m AS (
    SELECT id, tokens, CASE page_id % 5 WHEN 0 THEN html || coalesce(tokens[1], '') WHEN 1 THEN substr(html, length(html) // 2 + 1) || substr(html, 1, length(html) // 2) ELSE html END AS translation FROM p
)"""


def documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Source units, draft and glossary over documents and benchmark prefixes."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    key = [F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id")]
    source = d.select(*key, "text", F.col("source").alias("speaker"), F.col("lang").alias("route"), sha256_of(F.col("text")).alias("source_hash"))
    out = d.select(*key, F.concat("text", F.lit(" T"), (F.col("doc_id") % 40).cast("string")).alias("translation"), F.lit("high").alias("confidence"))
    status = F.element_at(F.array(F.lit("locked"), F.lit("preferred"), F.lit("forbidden")), (F.col("item_id") % 3 + 1).cast("int"))
    scope = F.when(F.col("item_id") % 4 == 0, "en").otherwise("")
    long = b.select(F.substring("text", 1, 40).alias("source"), F.concat(F.lit("T"), "item_id").alias("target"), status.alias("status"), scope.alias("scope"))
    short = b.select(F.substring("text", 1, 20).alias("source"), F.concat(F.lit("P"), "item_id").alias("target"), F.lit("locked").alias("status"), F.lit("").alias("scope"))
    return source, out, long.unionAll(short)


DOCUMENTS = f"""g AS (
    SELECT trim(source, '{STRIP_SQL}') AS source, target, status, scope FROM (
        SELECT substr(text, 1, 40) AS source, 'T' || item_id AS target, ['locked', 'preferred', 'forbidden'][item_id % 3 + 1] AS status, CASE WHEN item_id % 4 = 0 THEN 'en' ELSE '' END AS scope FROM benchmark
        UNION ALL SELECT substr(text, 1, 20), 'P' || item_id, 'locked', '' FROM benchmark
    )
), e AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS src, text || ' T' || (doc_id % 40) AS out, lang FROM documents
), a AS (
    SELECT e.id, e.src, e.out, g.* FROM e JOIN g ON (g.scope = '' OR g.scope = e.lang)
), hits AS (
    SELECT a.*, EXISTS (SELECT 1 FROM g o WHERE (o.scope = '' OR o.scope = 'en' AND a.id IN (SELECT id FROM e WHERE lang = 'en')) AND length(o.source) > length(a.source) AND contains(o.source, a.source) AND contains(a.src, o.source) AND contains(a.out, o.target)) AS shadowed
    FROM a WHERE contains(src, source)
)"""
