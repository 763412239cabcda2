import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from locuswave.operators import islands, reads
from locuswave.params import Params
from locuswave.schema import ALIGNMENTS
from locuswave.streaming import counts
from locuswave.streaming.islands import running_islands
from tests.conftest import rows


def test_arriving_files_give_the_batch_counts(spark, tmp_path):
    data = [("s", f"r{i}", "chr1", 100 + i % 7, 0, 40, "50M", None) for i in range(60)]
    folder = str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame(data[part::3], ALIGNMENTS).write.mode("append").parquet(folder)
    stream = counts.running_counts(counts.arriving_alignments(spark, folder, 1), Params())
    started = counts.write_counts(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    started.awaitTermination(120)
    batch = reads.read_start_counts(reads.classify(spark.createDataFrame(data, ALIGNMENTS), Params()))
    assert rows(counts.latest_counts(spark, str(tmp_path / "out")).select("pos", "n")) == rows(batch.select("pos", "n"))


def test_shuffled_arrival_gives_the_batch_islands(spark, tmp_path):
    rng = random.Random(9)
    schema = "user bigint, event bigint, value double, ts timestamp"
    start = datetime(2024, 1, 1)
    times = {}
    for user in range(4):
        at = 0.0
        for _ in range(60):
            at += rng.choice([0, 1, 30, 59, 60, 61, 300])
            times.setdefault(user, []).append(at)
    data = [(u, 1000 * u + k, float(rng.randint(0, 5)), start + timedelta(seconds=t)) for u, ts in times.items() for k, t in enumerate(ts)]
    batch = islands.island_best(
        spark.createDataFrame(data, schema).withColumn("t", F.unix_micros("ts")), ["user"], 60_000_000,
        [F.col("value"), F.col("event")], ["event", "value"], start="t", stop="t", tile=10 ** 9)
    # Events arrive up to 500 seconds late.
    arriving = sorted(data, key=lambda r: r[3] + timedelta(seconds=rng.random() * 500))
    folder = tmp_path / "in"
    for part in range(6):
        rows_ = arriving[part * 40:(part + 1) * 40] if part < 5 else arriving[200:]
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    # A last event far ahead moves the watermark past all islands; one behind it is too late for any.
    spark.createDataFrame([(99, 0, 0.0, start + timedelta(days=9))], schema).coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.05)
    spark.createDataFrame([(0, 77, 9.0, start)], schema).coalesce(1).write.mode("append").parquet(str(folder))
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    found = running_islands(events, ["user"], 60_000_000, "ts", "600 seconds", ["value", "event"], ["event", "value"])
    query = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert query.awaitTermination(300) and query.exception() is None
    got = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    columns = ["user", "island_start", "island_stop", "members", "event", "value"]
    assert rows(got.select(columns)) == rows(batch.select(columns)) and got.count() > 20
