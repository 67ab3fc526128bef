"""Shared pieces of the training-data operators: tables, durable intermediates, connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_BLANKS = " \t\n\x0b\x0c\r"
ONE_TASK_EDGES, BROADCAST_ROWS = 1_000_000, 2_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; a null becomes the empty string."""
    return F.translate(F.coalesce(column, F.lit("")), UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_OWN: dict[str, str] = {}
_PATHS: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one is made only where the setting is absent on a local master, as in tests.

    On a cluster a local folder would scatter tables over the executors' disks, so the absence is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="chunkwright-")
        base = _OWN[app]
    return base.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
    except Exception:  # noqa: BLE001  the session may be gone when the interpreter ends
        pass


class Stored:
    """A table written to the shared folder: lineage ends there, so a lost executor costs a re-read and no more."""

    def __init__(self, df: DataFrame):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/chunkwright-{uuid.uuid4().hex}"
        schema = df.schema
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(schema).parquet(self.path)
        if not _PATHS:
            atexit.register(release)
        _PATHS[self.path] = self.spark

    def drop(self) -> None:
        _remove(self.spark, self.path)
        _PATHS.pop(self.path, None)


def beside(small: DataFrame, most: int | None = None) -> DataFrame:
    """A stored table of a few numbers a row, marked for a join: up to ``BROADCAST_ROWS`` (16 MB a number) it goes to the other side's tasks."""
    return F.broadcast(small) if small.count() <= (BROADCAST_ROWS if most is None else most) else small.hint("merge")


def release() -> None:
    """Deletes all intermediate tables of this process; results that still read them must be written before."""
    for path, spark in list(_PATHS.items()):
        _remove(spark, path)
        _PATHS.pop(path, None)


def stored(df: DataFrame) -> DataFrame:
    return Stored(df).df


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node but the least of each component to that least node: as many edges as nodes at most."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before, label)
        label = label[label]
        if (label == before).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _one_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        node, root = forest(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        own = np.unique(root)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node, own])), pa.array(np.concatenate([root, own]))], names=["node", "component"])


def components(edges: DataFrame, src: str = "src", dst: str = "dst", one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """Connected components of an undirected edge list as ``(node, component)``, component being the least node.

    Up to ``one_task`` edges (16 MB) are joined by one task, on an executor. Beyond that alternating large-star and
    small-star rounds follow: every round is two aggregations by key whose rows never exceed the edges, so a hub of any
    degree is a sum over partial minima and no neighbourhood is ever gathered in one task.
    Rounds end when the edge set no longer changes; the edges of each round are written to the shared folder.
    Null ends and self loops are ignored; an empty edge list gives an empty result.
    """
    current = Stored(
        edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
        .where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )

    def summary(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = summary(current.df)
    if before[0] <= one_task:
        return current.df.coalesce(1).mapInArrow(_one_forest, "node long, component long")
    while before[0]:  # rounds shrink the longest path geometrically, so this ends after about log2 of it
        e = current.df
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least2, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        fresh = Stored(small.where("u <> v").distinct())
        after = summary(fresh.df)
        current.drop()
        current, done = fresh, after == before
        before = after
        if done:
            break
    stars = current.df
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """An invertible scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(32))
    x = x * _M1
    x = x ^ (x >> np.uint64(32))
    x = x * _M1
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words in order, repeats kept; fewer words than ``k`` make one run, none make none."""
    n = len(words)
    if n == 0:
        return words
    k_used = min(k, n)
    h = np.full(n - k_used + 1, np.uint64(k_used), dtype=np.uint64)
    for i in range(k_used):
        h = mix64(h * _M2 + words[i : n - k_used + 1 + i])
    return h
