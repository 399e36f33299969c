"""Writing: ordered JSON lines, idempotent and immutable files, atomic replacement."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.digests import canonical_json


class ImmutableError(ValueError):
    """A content-addressed file that is there with other content."""


def write_jsonl(df: DataFrame, path: str, order: str = "ord", single: bool = True, canonical: bool = False) -> None:
    """One JSON object a line in the given order, without the order column.

    In one file, or range-partitioned into files whose names sort in that order. canonical sorts
    keys and drops fields that begin with two underscores.
    """
    line = F.to_json(F.struct(*(c for c in df.columns if c != order)), {"ignoreNullFields": "false"})
    rows = df.select(order, line.alias("value"))
    if canonical:
        rows = rows.withColumn("value", canonical_json("value"))
    rows = rows.repartition(1) if single else rows.repartitionByRange(order)
    rows.sortWithinPartitions(order).select("value").write.mode("overwrite").text(path)


def opened(spark: SparkSession, path: str):
    """The path and its file system, as the session knows them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def put(stream, content: str) -> None:
    try:
        stream.write(bytearray(content.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    where, system = opened(spark, path)
    stream = system.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_if_missing(spark: SparkSession, path: str, content: str) -> bool:
    """Creates the file on whatever store has the path; leaves one that is there. Whether it was created."""
    where, system = opened(spark, path)
    try:
        stream = system.create(where, False)  # fails if the file exists, whoever made it
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    put(stream, content)
    return True


def write_immutable(spark: SparkSession, path: str, content: str) -> None:
    """Creates the file; one that is there must have the same text up to line ends."""
    lf = lambda t: t.replace("\r\n", "\n").replace("\r", "\n")
    if not write_if_missing(spark, path, content) and lf(read_text(spark, path)) != lf(content):
        raise ImmutableError(path)


def replace_atomically(spark: SparkSession, path: str, content: str) -> None:
    """Writes beside the file and renames over it, so that readers see the old text or the new one."""
    beside, system = opened(spark, f"{path}.{uuid.uuid4().hex}")
    try:
        put(system.create(beside, False), content)
        fs = spark._jvm.org.apache.hadoop.fs
        how = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
        how[0] = fs.Options.Rename.OVERWRITE
        fs.FileContext.getFileContext(beside.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, fs.Path(path), how)
    except BaseException:
        system.delete(beside, False)
        raise


def write_snapshot(df: DataFrame, path: str) -> None:
    """A table that replaces what an earlier run left there."""
    df.write.mode("overwrite").parquet(path)
