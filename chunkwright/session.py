"""Session defaults."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(name: str = "chunkwright", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; further settings by keyword, dots written as two underscores."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if partitions or master:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions or os.cpu_count() or 8))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
