"""Windows inside long keys, block by block, against the plain fold."""

import random

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import fold, longfold


@pytest.mark.parametrize("block, span, size", [(7, 60.0, 9), (16, 1e9, 25), (5, 400.0, 1000), (64, 30.0, 3), (1, 50.0, 4)])
def test_against_the_fold(spark, tmp_path, block, span, size):
    r = random.Random(block)
    rows = []
    for k, n in (("a", 150), ("b", 64), ("c", 1), (None, 40), ("d", 7)):
        t = 0.0
        for i in range(n):
            t += r.choice([0, 1, 2, 5, 80 if r.random() < 0.1 else 3])
            rows.append((k, i, t, t + r.choice([0.5, 1, 9]), r.choice([0, 0, 1, 2, 4])))
    df = spark.createDataFrame(rows, "k string, i long, s double, e double, w long")
    want = fold.threshold_windows(df, "k", "s", "e", "w", span, size, ["s", "i"])
    got = longfold.threshold_windows(df.repartition(3), "k", "s", "e", "w", span, size, ["s", "i"], str(tmp_path / "f"), block)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_empty(spark, tmp_path):
    df = spark.createDataFrame([], "k long, s double, w long")
    assert longfold.threshold_windows(df.withColumn("e", F.col("s")), "k", "s", "e", "w", 1.0, 1, ["s"], str(tmp_path / "f")).count() == 0
