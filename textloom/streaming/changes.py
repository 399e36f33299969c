"""Compare-and-set changes of job statuses as a stream with state: an extension.

Each job's status and notes are state of their own, which Spark keeps and recovers. A change holds if its
new status is a known one and its from_status is the job's status at that time (or isn't given).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from textloom.operators.stages import STATUSES

OUTCOME = "job_id string, seq long, held boolean, status string, n_notes int"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Statuses(StatefulProcessor):
    """A job's status, which begins as pending, and how many notes it has."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getValueState("status", StructType([StructField("status", StringType()), StructField("n", IntegerType())]))

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator[Row]:
        now, n = self.status.get() if self.status.exists() else ("pending", 0)
        for seq, wanted, to, note in sorted(((r["seq"], r["from_status"], r["to_status"], r["note"]) for r in rows), key=lambda r: r[0]):
            held = to in STATUSES and (wanted is None or wanted == now)
            if held:
                now, n = to, n + (note is not None)
            yield Row(job_id=key[0], seq=seq, held=held, status=now, n_notes=n)
        self.status.update((now, n))

    def close(self) -> None:
        pass


def applied(changes: DataFrame) -> DataFrame:
    """job_id, seq, held, status (of the job after it), n_notes for each change (job_id, seq, from_status, to_status, note).

    For batch and streaming input (append mode; start it inside with_states). A micro-batch's changes
    of a job are taken in order of seq, after those of earlier batches.
    """
    rows = changes.select("job_id", "seq", "from_status", "to_status", "note")
    return rows.groupBy("job_id").transformWithState(statefulProcessor=Statuses(), outputStructType=OUTCOME, outputMode="Append", timeMode="None")


class with_states:
    """While it holds, queries that start keep their state in RocksDB, as this kind of state needs; the setting is put back."""

    def __init__(self, spark):
        self.conf = spark.conf

    def __enter__(self):
        self.was = self.conf.get(PROVIDER, None)
        self.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *_):
        if self.was is None:
            self.conf.unset(PROVIDER)
        else:
            self.conf.set(PROVIDER, self.was)
