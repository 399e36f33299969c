"""Takes newly delivered documents in: a ledger of text units, and the texts that are new to translators.

    python -m jobs.intake --documents DIR --out DIR --checkpoint DIR [--config FILE]

Documents (doc_id, text, lang and more) are Parquet files that a delivery adds to a folder. A file stream
with a checkpoint takes only files that it hasn't taken; it ends when all that is there is taken.
Every line that isn't blank is a unit. Written are, as Parquet in partitions of lang and batch:

* units: doc_id, line, id, source_hash, chars, tokens (an estimate), protected (how many placeholders),
  problems (codes of what a translator can't work with, comma-joined);
* texts: source_hash, text, chars, tokens, problems, once for each text of a language, in the batch
  that brought it first.

A batch writes its own partitions only and compares with those of earlier batches only, so a batch that
is run again after a failure replaces what it has left and gives the same rows. Null texts have no
units; a null or empty lang is the language `und`; a document that is delivered twice is in the ledger twice.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs.common import LOG, main
from textloom.functions import text as X
from textloom.functions.digests import sha256_of

DOCUMENT = "doc_id long, text string, lang string"
TEXT = ["lang", "source_hash", "text", "chars", "tokens", "problems"]


def problems_of(text: Column, chars: Column, nfc: Column, most: int) -> Column:
    """Codes in the order of their names, comma-joined."""
    codes = {"invalid-character": X.has_invalid(text), "no-words": ~X.is_semantic(text), "too-long": chars > most, "unicode-normalization": ~nfc}
    return F.concat_ws(",", *(F.when(found, code) for code, found in codes.items()))


def units_of(documents: DataFrame, config: dict) -> DataFrame:
    """lang, doc_id, line (from 1), id, source_hash, chars, tokens, protected, problems, text of every line that isn't blank."""
    lines = documents.select(F.coalesce(F.nullif("lang", F.lit("")), F.lit("und")).alias("lang"), "doc_id", F.posexplode(F.split("text", config["line_ends"], -1)).alias("at", "text"))
    rows = lines.filter(X.strip(F.col("text")) != "").withColumn("nfc", X.is_nfc("text")).withColumn("chars", F.length("text").cast("long"))
    return rows.select(
        "lang", "doc_id", (F.col("at") + 1).alias("line"), F.concat_ws(":", "doc_id", F.col("at") + 1).alias("id"), sha256_of(F.col("text")).alias("source_hash"), "chars",
        X.estimated_tokens(F.col("chars"), config["tokens_per_char"]).alias("tokens"), F.regexp_count("text", F.lit(config["protected"])).cast("long").alias("protected"),
        problems_of(F.col("text"), F.col("chars"), F.col("nfc"), config["most_chars"]).alias("problems"), "text",
    )


def put(rows: DataFrame, path: str, batch: int) -> None:
    """Replaces the batch's partitions."""
    rows.withColumn("batch", F.lit(batch)).write.partitionBy("lang", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A written table, with lang as text whatever its values look like."""
    kinds = {"units": "doc_id long, line int, id string, source_hash string, chars long, tokens long, protected long, problems string, text string", "texts": "source_hash string, text string, chars long, tokens long, problems string"}
    return spark.read.schema(f"{kinds[name]}, lang string, batch long").parquet(f"{out}/{name}")


def as_pattern(path: str) -> str:
    """The path as a pattern that nothing else fits: file streams read a folder by its path, a single file only by a pattern."""
    path = path.rstrip("/")
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


def take(out: str, config: dict, totals: dict):
    """What is done with each batch of the stream."""

    def run(documents: DataFrame, batch: int) -> None:
        spark = documents.sparkSession
        seen = Observation()
        put(units_of(documents.observe(seen, F.count("*").alias("n")), config), f"{out}/units", batch)
        units = read(spark, out, "units").filter(F.col("batch") == batch)  # as written, so that nothing is computed twice
        texts = units.groupBy("lang", "source_hash").agg(F.first("text").alias("text"), *(F.first(c).alias(c) for c in TEXT[3:]))
        put(texts.limit(0).select(*TEXT), f"{out}/texts", batch)  # the folder is there to be read
        known = read(spark, out, "texts").filter(F.col("batch") < batch).select("lang", "source_hash")
        put(texts.join(known, ["lang", "source_hash"], "left_anti").select(*TEXT), f"{out}/texts", batch)
        n, bad = units.agg(F.count("*"), F.count_if(F.col("problems") != "")).first()
        new = read(spark, out, "texts").filter(F.col("batch") == batch).count()
        LOG.info("intake: batch %d: read %d documents; wrote %d units, %d with problems, and %d new texts", batch, seen.get["n"], n, bad, new)
        for k, v in (("documents", seen.get["n"]), ("units", n), ("problems", bad), ("texts", new)):
            totals[k] += v

    return run


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, config: dict) -> dict[str, int]:
    """Takes what is new in a folder or file of documents and waits until it is written: how many documents, units, problems and texts."""
    totals = {"documents": 0, "units": 0, "problems": 0, "texts": 0}
    stream = spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", config["files_per_batch"]).parquet(as_pattern(documents))
    query = stream.writeStream.foreachBatch(take(out, config, totals)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    LOG.info("intake: read %d new documents of %s; wrote %d units and %d texts to %s", totals["documents"], documents, totals["units"], totals["texts"], out)
    return totals


if __name__ == "__main__":
    sys.exit(main("intake", ["documents", "out", "checkpoint"], run, __doc__))
