"""What the corpus operators share: reading tables, cutting lineage, picking partition counts."""

from __future__ import annotations

import gc
import tempfile
import uuid
from functools import wraps
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, read by Spark so that any store will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: WeakKeyDictionary = WeakKeyDictionary()  # session: (table name or None, path) of what is kept for it


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only in local mode where the session names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="textloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The same rows from a compressed table in the shared folder; survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.setdefault(spark, []).append((None, path))
    return spark.read.schema(df.schema).parquet(path)


def shared_table(df: DataFrame, buckets: int, *keys: str) -> DataFrame:
    """The same rows from a table in the shared folder in buckets of keys, which joins needn't shuffle."""
    spark = df.sparkSession
    name = f"textloom_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, *keys).saveAsTable(name)
    _made.setdefault(spark, []).append((name, path))
    return spark.table(name)


def clear(spark: SparkSession) -> None:
    """Deletes the tables that operators keep in the shared folder. Call it when results have been read or written."""
    for name, path in _made.pop(spark, []):
        if name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def heavy_keys(counts: DataFrame, keys: list[str], most: int = 100_000, at_most: int = 1000) -> DataFrame:
    """keys and salts: in how many parts the rows of each key that has too many are to be dealt out.

    counts has n rows for each key. A key is heavy with more than `most` rows and more than one
    at_most-th of all, so there are fewer than at_most heavy keys: a bound for their broadcast.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(most, -(-int(total) // at_most))
    return counts.filter(F.col("n") > limit).select(*keys, F.ceil(F.col("n") / limit).cast("int").alias("salts"))


def join_heavy(rows: DataFrame, side: DataFrame, keys: list[str], heavy: DataFrame, spread: list[str], how: str = "inner") -> DataFrame:
    """rows joined with side, which has one row for each key; rows of heavy keys are dealt out by spread."""
    heavy = F.broadcast(heavy)
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("salts"))).cast("int")
    salted = rows.join(heavy, keys, "left").withColumn("_salt", salt).drop("salts")
    copies = side.join(heavy, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Lowers the session's rows in an Arrow batch to what whole texts need to stay small in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def release_memory() -> None:
    """Gives a worker's freed memory back to the system, as workers outlive their tasks."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not the GNU C library


def tidy(run):
    """A function over a task's batches that releases its memory at the end and now and then.

    Meanwhile the collector of cycles rests: batches make many objects and no cycles.
    """

    @wraps(run)
    def tidied(batches, *args):
        gc.disable()
        try:
            for i, out in enumerate(run(batches, *args)):
                yield out
                if i % 64 == 63:
                    release_memory()
        finally:
            gc.enable()
            release_memory()

    return tidied
