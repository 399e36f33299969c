"""Finds which glossary terms stand in which texts, for translators' packets and to tell terms that nothing uses.

    python -m jobs.term_audit --documents DIR --glossary FILE --out DIR [--config FILE]

Documents (doc_id, text, lang, source) are Parquet; the glossary is a tab-separated file with a header
(.tsv, or a folder of such files) or Parquet, with source, target and, where wanted, status, scope,
match_mode, case_sensitive, source_locale and target_locale. Written are, as Parquet:

* hits, in partitions of lang: doc_id, term (from 0, in the order of the glossary's terms by source,
  target and status), source, target, status, for each term of the project's locales that stands in a
  text and whose scope is the text's;
* terms: term, source, target, status, documents: how many texts it stands in, 0 for unused ones.

A whole run replaces both tables. With langs in the settings only these languages are read, only their
partitions replaced, and terms counted anew over all partitions. A run over the same input leaves the
same rows. Null texts hold no terms; a null or empty lang is the language `und`.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, main
from textloom.operators import glossary as G
from textloom.policy import Policy
from textloom.sources import readers

HIT = "doc_id long, term long, source string, target string, status string, lang string"


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    return readers.tsv(spark, path, required=("source", "target")) if path.rstrip("/").endswith(".tsv") else spark.read.parquet(path)


def numbered(spark: SparkSession, terms: list[dict]) -> DataFrame:
    """The policy's distinct terms with their numbers; a glossary is small, as its reader checks."""
    keys = sorted({(t["source"], t["target"], t["status"]) for t in terms if t["source"]})
    return spark.createDataFrame([(i, *k) for i, k in enumerate(keys)], "term long, source string, target string, status string")


def hits_of(documents: DataFrame, terms: list[dict], config: dict) -> DataFrame:
    """lang, doc_id, source, target, status of each term in each text."""
    one, two = (F.col(c).cast("string") if c in documents.columns else F.lit(None) for c in config["scope_by"])
    # the row's own values ride along in the id, so that they needn't be joined again
    entry = F.to_json(F.struct("lang", "doc_id"))
    entries = documents.filter("text <> ''").select(entry.alias("id"), F.col("text").alias("src"), F.lit("").alias("out"), one.alias("route"), F.lit(None).alias("scene_id"), two.alias("speaker"))
    found = G.term_hits(entries, terms).filter(F.col("found") & (F.col("source") != "")).select(F.from_json("id", "lang string, doc_id long").alias("d"), "source", "target", "status")
    return found.select("d.lang", "d.doc_id", "source", "target", "status").distinct()


def run(spark: SparkSession, documents: str, glossary: str, out: str, config: dict) -> dict[str, int]:
    """Audits and writes: how many documents, terms, hits and unused terms."""
    policy = Policy(config["source_locale"], config["target_locale"], term_modes=config["match_modes"])
    rows = read_glossary(spark, glossary)
    terms = G.prepared(rows, policy)
    known = numbered(spark, terms)
    docs = spark.read.parquet(documents).withColumn("lang", F.coalesce(F.nullif("lang", F.lit("")), F.lit("und")))
    if config["langs"] is not None:
        docs = docs.filter(F.col("lang").isin(config["langs"]))
    seen, wrote = Observation(), Observation()
    hits = hits_of(docs.observe(seen, F.count("*").alias("n")), terms, config).join(F.broadcast(known), ["source", "target", "status"])  # the glossary once more
    how = "static" if config["langs"] is None else "dynamic"
    to_write = hits.select("doc_id", "term", "source", "target", "status", "lang").observe(wrote, F.count("*").alias("n"))
    to_write.write.partitionBy("lang").option("partitionOverwriteMode", how).mode("overwrite").parquet(f"{out}/hits")
    counts = spark.read.schema(HIT).parquet(f"{out}/hits").groupBy("term").agg(F.count("*").alias("documents"))
    used = known.join(counts, "term", "left").select("term", "source", "target", "status", F.coalesce("documents", F.lit(0)).alias("documents"))
    used.write.mode("overwrite").parquet(f"{out}/terms")
    unused = spark.read.parquet(f"{out}/terms").filter("documents = 0").count()
    totals = {"documents": seen.get["n"], "terms": known.count(), "hits": wrote.get["n"], "unused": unused}
    LOG.info("term_audit: read %d documents of %s and %d terms of %s; wrote %d hits to %s; %d terms are unused", totals["documents"], documents, totals["terms"], glossary, totals["hits"], out, unused)
    return totals


if __name__ == "__main__":
    sys.exit(main("term_audit", ["documents", "glossary", "out"], run, __doc__))
