"""Writers [K1-K10]."""

from __future__ import annotations

import io
import tarfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CHUNK


def write_jsonl(chunks: DataFrame, path: str, by: list[str]) -> None:
    """[K1] JSON lines in one folder for each value of ``by``, dealt by it so that a folder gets few files."""
    chunks.repartition(*[F.col(c) for c in by]).write.partitionBy(*by).mode("overwrite").json(path)


def write_sidecars(parts: DataFrame, path: str, doc_col: str, all_docs: DataFrame) -> None:
    """[K2] Sidecars of documents with two parts or more; those of the other documents in ``all_docs`` are deleted.

    Dynamic overwrite replaces the folders written and leaves the others alone; stale folders are removed after it.
    """
    spark = parts.sparkSession
    split = parts.where("part_count > 1").select(doc_col).distinct()
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        parts.join(split, doc_col, "left_semi").write.partitionBy(doc_col).mode("overwrite").json(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    fs = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in all_docs.select(doc_col).distinct().join(split, doc_col, "left_anti").toLocalIterator():
        fs.delete(jpath(f"{path}/{doc_col}={r[0]}"), True)


def meta_table(chunks: DataFrame) -> DataFrame:
    """[P1, D7] The 36 columns in one schema; values that don't fit become null, missing text becomes empty."""
    have = {c.lower(): c for c in chunks.columns}
    cols = []
    for f in CHUNK.fields:
        c = F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)
        kind = f.dataType.simpleString()
        c = c.cast("string") if kind == "string" else c.cast("string").try_cast(kind)
        cols.append((F.coalesce(c, F.lit("")) if f.name == "text" else c).alias(f.name))
    return chunks.select(*cols)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """[K4, K6]"""
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*by) if by else w).parquet(path)


def index_manifest(meta: DataFrame, model: str, built: str) -> DataFrame:
    """[K7] One JSON row: counts by corpus, the total, model and build time."""
    counted = meta.groupBy("corpus").agg(F.count("*").alias("n"))
    return counted.agg(F.to_json(F.struct(F.map_from_entries(F.array_sort(F.collect_list(F.struct("corpus", "n")))).alias("counts"), F.sum("n").alias("total"), F.lit(model).alias("model"), F.lit(built).alias("built"))).alias("manifest"))


def archive(folder: str, target: str, level: int = 10) -> None:
    """[K8] A finished local folder as tar.zst."""
    import zstandard

    with open(target, "wb") as out, zstandard.ZstdCompressor(level=level).stream_writer(out) as z, tarfile.open(fileobj=z, mode="w|") as tar:
        tar.add(folder, arcname=Path(folder).name)


def archive_names(target: str) -> list[str]:
    import zstandard

    with open(target, "rb") as f:
        data = zstandard.ZstdDecompressor().stream_reader(f).read()
    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
        return tar.getnames()


def write_inventory(paths: DataFrame, target: str) -> None:
    """[K9] Sorted distinct paths as text, in one ordered set of files."""
    paths.select("path").distinct().orderBy("path").write.mode("overwrite").text(target)


def delete_files(spark: SparkSession, files: DataFrame, apply: bool = False) -> int:
    """[K10] How many files match; they are deleted only with ``apply``."""
    if not apply:
        return files.count()
    n = 0
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    for r in files.select("path").toLocalIterator():
        p = jpath(r["path"])
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, False))
    return n
