"""Changes of statuses as a stream, over several batches and two runs, and as a batch."""

import random

from textloom.operators.stages import STATUSES
from textloom.streaming import changes

CHANGE = "job_id string, seq long, from_status string, to_status string, note string"


def plain(rows):
    now, out = {}, []
    for job, seq, wanted, to, note in sorted(rows, key=lambda r: r[1]):
        status, n = now.get(job, ("pending", 0))
        held = to in STATUSES and (wanted is None or wanted == status)
        now[job] = (to, n + (note is not None)) if held else (status, n)
        out.append((job, seq, held, *now[job]))
    return sorted(out)


def test_stream_and_batch_agree(spark, tmp_path):
    rng = random.Random(2)
    pick = lambda: rng.choice([*STATUSES, "gone"])
    rows = [(f"j{rng.randint(0, 9)}", i, rng.choice([None, pick(), pick()]), pick(), rng.choice([None, "n"])) for i in range(300)]
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    provider = spark.conf.get(changes.PROVIDER)
    for part in (rows[:100], rows[100:180], rows[180:]):
        spark.createDataFrame(part, CHANGE).coalesce(1).write.mode("append").parquet(folder)
        with changes.with_states(spark):
            stream = spark.readStream.schema(CHANGE).parquet(folder)
            changes.applied(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert spark.conf.get(changes.PROVIDER) == provider
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == plain(rows)
    assert sorted(map(tuple, changes.applied(spark.createDataFrame(rows, CHANGE)).collect())) == plain(rows)
