"""A corpus cleaned in stages: quality, near duplicates, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of docs. Rows with null or empty texts pass through; so do null doc_ids, but for
the near copies of another row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import bpe, decontaminate, neardup, pii, quality
from textloom.llm.common import heavy_keys, table, text_or_empty, written

KEEP_FROM = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rule ensemble scores below KEEP_FROM."""
    rules = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, rules, "_quality_score").filter(F.col("_quality_score") >= KEEP_FROM).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of similar texts: the one with the smallest doc_id.

    Rows without a doc_id come after the others; ties go by a hash of all columns, and of rows that
    are equal in all columns one stays. Rows of one doc_id and different texts are different documents.
    Rows without words are in no group and stay.
    """
    key = ["_k1", "_k2"]
    marked = docs.select("*", F.xxhash64(*docs.columns).alias("_k1"), F.xxhash64(F.lit(1), *docs.columns).alias("_k2"))
    grouped = neardup.near_duplicates(marked, carried=key).filter(F.col("group").isNotNull())
    rows = grouped.groupBy("group", "doc_id", *key).agg(F.count("*").alias("n"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", *key, "n")).alias("first"))
    chosen = written(first.select("first._k1", "first._k2", "first.n"))
    stay = marked.join(chosen, key, "left_semi").dropDuplicates(key)
    heavy = heavy_keys(chosen, key)
    if heavy.limit(1).count():  # so many equal rows that tasks must drop them before they meet
        few = F.broadcast(heavy)
        light = marked.join(few, key, "left_anti").join(chosen, key, "left_semi").dropDuplicates(key)
        stay = light.unionByName(marked.join(few, key, "left_semi").dropDuplicates(key))
    return stay.select(*docs.columns).unionByName(docs.filter(~text_or_empty().rlike(neardup.SOME_WORD)))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark item stands."""
    names = {c: f"_kept_{i}" if c == "matches" else c for i, c in enumerate(docs.columns)}  # an input column of that name is set aside
    found = decontaminate.find_contamination(docs.withColumnsRenamed(names), table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("matches") == 0).drop("matches").withColumnsRenamed({v: k for k, v in names.items()})


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in texts by its kind; n_chars follows."""
    found = pii.redact(pii.find_pii(docs))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the bytes that the ids decode to, as a count."""
    path, pattern = bpe.vocabulary()
    got = bpe.decode_ids(bpe.encode_documents(docs, path, pattern), path)
    return got.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.octet_length("decoded").cast("long").alias("n_bytes"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("pii", redact_personal_data),
    ("byte_bpe", encode_tokens),
]

#: No single statement can express these stages; they are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs
