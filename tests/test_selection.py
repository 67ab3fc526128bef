"""Exact percentiles by refined histograms against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import audit

PS = {"low": 0.0, "p50": 0.5, "p90": 0.9, "p99": 0.99, "top": 1.0}


def pick(values):
    s = sorted(values)
    return (len(s), *[s[min(len(s) - 1, int(len(s) * p))] for p in PS.values()])


@pytest.mark.parametrize("bins, spread", [(4096, 50), (8, 10**6), (4, 2**62)])
def test_against_sorting(spark, monkeypatch, bins, spread):
    monkeypatch.setattr(audit, "BINS", bins)
    r = random.Random(bins)
    rows = [(r.choice(["a", "b", None]), r.randint(-spread, spread) if r.random() < 0.9 else 7) for _ in range(700)] + [("one", 5), ("same", 3), ("same", 3), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {x["k"]: tuple(x)[1:] for x in audit.rank_percentiles(df, ["k"], "v", PS).collect()}
    assert got == {k: pick([v for g, v in rows if g == k and v is not None]) for k in ("a", "b", None, "one", "same")}
    assert [tuple(x) for x in audit.rank_percentiles(df, [], "v", PS).collect()] == [pick([v for _, v in rows if v is not None])]
    assert audit.rank_percentiles(df.limit(0), ["k"], "v", PS).count() == 0 == audit.rank_percentiles(df.limit(0), [], "v", PS).count()


def test_no_task_gets_all_values(spark):
    """A million distinct values in one group: what a pass leaves is a row a bin."""
    df = spark.range(1_000_000).select((F.col("id") * 1_000_003 % 999_999_937).alias("v"), F.lit("g").alias("k"))
    got = audit.rank_percentiles(df, ["k"], "v", {"p50": 0.5, "p99": 0.99}).first()
    want = df.selectExpr("sort_array(collect_list(v)) AS s").selectExpr("s[500000]", "s[990000]").first()
    assert (got["p50"], got["p99"]) == tuple(want)
    plan = audit.rank_percentiles(df, [], "v", {"p50": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [sum(c" in plan and plan.count("Window") == 3  # over bins only: ranges of 10^9 take three passes
