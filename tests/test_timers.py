"""Streaming windows with timers against the batch fold, the last window of each key included."""

import datetime as dt
import random

from pyspark.sql import functions as F

from chunkwright.operators import fold
from chunkwright.streaming import jobs

START = dt.datetime(2024, 1, 1)


def test_last_windows_and_late_rows(spark, tmp_path):
    r = random.Random(2)
    rows = [(f"k{r.randrange(5)}", START + dt.timedelta(seconds=r.randrange(20_000))) for _ in range(300)]
    rows.sort(key=lambda x: x[1])
    # within blocks of time rows come in any order, up to the delay
    files = [rows[i : i + 60] for i in range(0, 300, 60)]
    late = ("k0", START + dt.timedelta(seconds=5))
    for i, f in enumerate(files):
        held = f + ([late] if i == 4 else []) + ([rows[i * 60 - 3]] if i else [])
        r.shuffle(held)
        spark.createDataFrame(held, "k string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/f{i}")
        for part in (tmp_path / f"f{i}").glob("*.parquet"):
            (tmp_path / "in").mkdir(exist_ok=True)
            part.rename(tmp_path / "in" / f"{i}.parquet")
    spark.createDataFrame([("end", START + dt.timedelta(days=3))], "k string, ts timestamp").coalesce(1).write.parquet(f"{tmp_path}/last")
    next((tmp_path / "last").glob("*.parquet")).rename(tmp_path / "in" / "9.parquet")
    events = jobs.stream(spark, str(tmp_path), "in", "k string, ts timestamp")
    got = jobs.run_once(jobs.idle_windows(events, "k", "ts", 600.0, 7, 900.0, "1 hour"), "append").where("k <> 'end'")
    counted = rows + [rows[i * 60 - 3] for i in range(1, 5)]  # the row that is hours late is lost, those within the delay are not
    batch = spark.createDataFrame(counted, "k string, ts timestamp").select("k", (F.unix_micros("ts") / 1e6).alias("s"), F.lit(1).alias("one"))
    want = fold.threshold_windows(batch.withColumn("e", F.col("s")), "k", "s", "e", "one", 600.0, 7, idle=900.0)
    assert sorted(map(tuple, got.select("k", "start", "end", "n").collect())) == sorted(map(tuple, want.select("k", "start", "end", "n").collect()))
