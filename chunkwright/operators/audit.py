"""Audits, inventories and set-oriented bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bytes_label

CAP, BINS = 800, 4096


def rank_percentiles(df: DataFrame, by: list[str], value: str, ps: dict[str, float]) -> DataFrame:
    """[A3] sorted[min(n - 1, floor(n * p))] for each name and p in ``ps``, and ``n``; neither interpolated nor percentile_disc.

    Values are whole numbers (others are cut to them); null values don't count, and a group without any has no row.
    """
    held = df.select(*by, F.col(value).cast("long").alias("_value")).where("_value IS NOT NULL")
    return _picked(held.groupBy(*by, "_value").agg(F.count("*").alias("_c")), by, "_value", ps)


def _picked(counted: DataFrame, by: list[str], value: str, ps: dict[str, float], *more: Column) -> DataFrame:
    """Exact selection by refined histograms: no group's values are ever sorted together, however many are distinct.

    A rank is looked for among ``BINS`` equal bins of the whole range, then among as many of the bin that holds it, until a bin is one value: two
    passes over the counted values up to a range of 2^24, six for all 64-bit numbers. A pass leaves at most ``BINS`` rows a group and rank.
    """
    low, high = counted.agg(F.min(value), F.max(value)).first()
    passes, width = 1, BINS
    while low is not None and width < high - low + 1:
        passes, width = passes + 1, width * BINS
    whole = counted.groupBy(*by).agg(F.sum("_c").cast("long").alias("n"), *more)
    keys = {c: f"_by{i}" for i, c in enumerate(by)}
    ranks = F.array(*[F.struct(F.lit(name).alias("name"), F.least(F.col("n") - 1, F.floor(F.col("n") * p)).cast("long").alias("rank")) for name, p in ps.items()])
    sought = whole.select(*[F.col(c).alias(k) for c, k in keys.items()], F.inline(ranks)).withColumn("low", F.lit(low or 0).cast("decimal(38,0)"))
    values = counted.select(*by, F.col(value).cast("decimal(38,0)").alias("_v"), "_c")
    for _ in range(passes):
        width //= BINS
        inside = (F.col("_v") >= F.col("low")) & (F.col("_v") < F.col("low") + F.lit(str(width * BINS)).cast("decimal(38,0)"))
        for c, k in keys.items():
            inside = inside & F.col(c).eqNullSafe(F.col(k))
        hit = values.join(sought if by else F.broadcast(sought), inside)  # without groups a row a rank
        bins = hit.groupBy(*keys.values(), "name", "rank", "low", F.floor((F.col("_v") - F.col("low")) / F.lit(str(width)).cast("decimal(38,0)")).cast("long").alias("bin")).agg(F.sum("_c").alias("c"))
        before = Window.partitionBy(*keys.values(), "name").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        found = bins.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("c")))
        sought = found.select(*keys.values(), "name", (F.col("rank") - F.col("before")).alias("rank"), (F.col("low") + F.col("bin") * F.lit(str(width)).cast("decimal(38,0)")).cast("decimal(38,0)").alias("low"))
    picks = [F.max(F.when(F.col("name") == name, F.col("low"))).cast("long").alias(name) for name in ps]
    got = sought.groupBy(*keys.values()).agg(*picks) if by else sought.agg(*picks)
    if not by:
        return got.join(F.broadcast(whole)).where("n IS NOT NULL").select("n", *ps, *[c for c in whole.columns if c != "n"])  # one row each
    same = None
    for c, k in keys.items():
        test = F.col(c).eqNullSafe(F.col(k))
        same = test if same is None else same & test
    return whole.join(got, same).select(*by, "n", *ps, *[c for c in whole.columns if c not in by and c != "n"])


def distribution(df: DataFrame, size: str, by: list[str], cap: int = CAP) -> DataFrame:
    """[A2-A5, C12] n, p50, p90, p99, max and rows over the cap, at every level of ``by`` and in all.

    Sizes are counted once by value; every level adds up those counts.
    """
    counted = df.where(F.col(size).isNotNull()).groupBy(*by, size).agg(F.count("*").alias("_c"))
    out = None
    for level in [by[:i] for i in range(len(by), -1, -1)]:
        at = counted.groupBy(*level, size).agg(F.sum("_c").alias("_c"))
        over = F.coalesce(F.sum(F.when(F.col(size) > cap, F.col("_c"))), F.lit(0)).cast("long").alias("over_cap")
        got = _picked(at, level, size, {"p50": 0.5, "p90": 0.9, "p99": 0.99}, F.max(size).cast("long").alias("max"), over)
        got = got.select(*[F.col(c) if c in level else F.lit(None).cast("string").alias(c) for c in by], "n", "p50", "p90", "p99", "max", "over_cap")
        out = got if out is None else out.unionByName(got)
    return out


def first_largest(df: DataFrame, by: list[str], size: str, order: str, fields: list[str]) -> DataFrame:
    """[A5] The row of the largest size in each group, the first of equals."""
    return df.groupBy(*by).agg(F.max_by(F.struct(size, *fields), F.struct(F.col(size), -F.col(order))).alias("r")).select(*by, "r.*")


def counts(df: DataFrame, by: str) -> DataFrame:
    """[A1, K7] Rows by value and in all (null)."""
    return df.rollup(by).agg(F.count("*").alias("n"))


def unshadowed(originals: DataFrame, sidecars: DataFrame, by_stem: bool = False) -> DataFrame:
    """[J5] Originals (dir, stem) without a sidecar, and all sidecars; ``by_stem`` compares stems across folders."""
    keys = ["stem"] if by_stem else ["dir", "stem"]
    return originals.join(sidecars.select(*keys).distinct(), keys, "left_anti").withColumn("kind", F.lit("chunks")).unionByName(sidecars.withColumn("kind", F.lit("rechunked")))


def cache_misses(keys: DataFrame, cache: DataFrame, key: str = "key") -> DataFrame:
    """[J6] Distinct keys that the cache lacks."""
    return keys.select(key).distinct().join(cache.select(key), key, "left_anti")


def with_cache(texts: DataFrame, cache: str, encoder, key: str = "key", text: str = "text") -> DataFrame:
    """[C11] ``texts`` with ``embedding``, from the Parquet folder ``cache``; what it lacks is encoded once and appended first.

    Appending is one commit: a crash leaves the cache as it was or with the new rows. Keys that two writers append at a
    time are read once.
    """
    spark = texts.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    missing = texts.select(key, text).dropDuplicates([key])
    if known:
        missing = missing.join(spark.read.parquet(cache).select(key), key, "left_anti")
    missing.select(key, encoder(F.col(text)).alias("embedding")).write.mode("append").option("compression", "zstd").parquet(cache)
    # only the wanted vectors are read on: the cache keeps those of all texts that ever were
    wanted = spark.read.parquet(cache).join(texts.select(key).distinct(), key, "left_semi")
    return texts.join(wanted.dropDuplicates([key]), key)


def write_status(current: DataFrame, previous: DataFrame, key: str, sha: str) -> DataFrame:
    """[K3] ``wrote`` where the content's hash is new or differs, else ``unchanged``."""
    old = previous.select(F.col(key), F.col(sha).alias("_old"))
    return current.join(old, key, "left").withColumn("status", F.when(F.col("_old").eqNullSafe(F.col(sha)), "unchanged").otherwise("wrote")).drop("_old")


def latest(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """[W12] The first n rows of each group."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rn") <= n)


def cleanup_report(files: DataFrame, rules: DataFrame) -> DataFrame:
    """[K10, A6] Files, bytes and their label by rule and in all; nothing is deleted."""
    return files.join(rules, "rule").rollup("rule").agg(F.count("*").alias("n_files"), F.sum("bytes").cast("long").alias("n_bytes")).withColumn("label", bytes_label(F.col("n_bytes")))


def run_report(df: DataFrame, by: list[str], failed: Column, skipped: Column, thin: Column) -> DataFrame:
    """[A13, P5] Totals of a run."""
    return df.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(failed).alias("failed"), F.count_if(skipped).alias("skipped"), F.count_if(thin).alias("thin"))


def missing_files(expected: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    """[J12, A7] Distinct expected paths that aren't there; rows that lead to no file (null) are none."""
    return expected.select(key).where(F.col(key).isNotNull()).distinct().join(present.select(key), key, "left_anti")


def expected_path() -> Column:
    """[J12] The chunk file that a manifest row (corpus, doc_id, ticker, form, report_date) should lead to."""
    c = F.col("corpus")
    tail = (
        F.when(c == "edgar", F.concat_ws("/", F.lit("edgar"), "ticker", F.concat("form", F.lit("_"), "report_date")))
        .when(c == "memes", F.lit("memes/memes"))
        .when(c == "epoch_models", F.lit("epoch_models/notable"))
        .when(c.isNotNull(), F.concat_ws("/", c, "doc_id"))
    )
    return F.when(tail.isNotNull(), F.concat(F.lit("data/processed/"), tail, F.lit(".chunks.jsonl")))
