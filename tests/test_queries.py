"""Every registered query that has SQL against DuckDB; the others run and keep their schema."""

import decimal
import math

import pytest
from pyspark.sql import functions as F

from chunkwright.plans import catalog


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return tuple(v) if isinstance(v, list) else v


def rows(columns, data):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in at) for r in data), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_sql(name, spark, small, duck):
    df = catalog.QUERIES[name](spark, small)
    want = duck.sql(catalog.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, df.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(name, spark, small):
    df = catalog.QUERIES[name](spark, small)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_pages_of_parts_are_dealt_to_tasks(spark, small):
    """One small file is one split; parsing its pages must not be one task."""
    for name in ("html_tables", "html_cards", "html_sections", "html_without_footers", "html_charts"):
        tasks = catalog.QUERIES[name](spark, small).withColumn("_task", F.spark_partition_id())
        assert tasks.select("_task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions")), name
