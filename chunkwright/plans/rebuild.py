"""[C8, C13, K1-K7] From JSON-lines chunks to a searchable folder, in one application."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.citations import citation
from ..functions.encode import HashEncoder, encoder_udf
from ..functions.text import cache_key, words
from ..operators import lsa, segments
from ..operators.audit import with_cache
from ..operators.retrieve import Engine
from ..operators.segment import sliding_windows
from ..operators.vectors import store_vectors
from ..sources.readers import jsonl_chunks
from ..sources.sinks import index_manifest, write_parquet


THIN = 1000  # a shorter text is thin (fixed value)


def split_chunks(chunks: DataFrame, cap: int = 800, overlap: int = 100) -> DataFrame:
    """Chunks over the cap become parts that keep their parent's fields; the others keep their text."""
    keyed = chunks.withColumnRenamed("id", "_parent").drop("part_of", "part_index", "part_count", "n_tokens")
    parts = sliding_windows(keyed.withColumnRenamed("row_id", "_row"), "_row", words(F.coalesce("text", F.lit(""))), cap, overlap)
    joined = parts.withColumnRenamed("text", "_part").join(keyed.withColumnRenamed("row_id", "_row"), "_row")
    tail = F.regexp_extract("id", "::p[0-9]+$", 0)
    return joined.select(
        F.concat(F.coalesce("_parent", F.lit("")), tail).alias("id"),
        *[c for c in keyed.columns if c not in ("row_id", "_parent", "text")],
        F.when(F.col("part_of").isNotNull(), F.col("_parent")).alias("part_of"), "part_index", "part_count", "n_tokens",
        F.when(F.col("part_of").isNull(), F.col("text")).otherwise(F.col("_part")).alias("text"), "_row",
    )


BUILD = "build string, seq long, built string, commit long, metrics map<string,long>, encoder string"
STRIDE_BITS = 20


def ordinals(parts: DataFrame) -> DataFrame:
    """[W11, T4] ``ordinal``: rows in the order of path, line and part, as one number: 2^20 places a line, more parts are an error."""
    part = F.coalesce(F.col("part_index").cast("long"), F.lit(0))
    checked = F.when(part < 1 << STRIDE_BITS, part).otherwise(F.raise_error(F.lit("a text has 2^20 parts or more")).cast("long"))
    return parts.withColumn("ordinal", F.shiftleft("_row", STRIDE_BITS) + checked)


def kept_numbers(parts: DataFrame, before: DataFrame | None) -> DataFrame:
    """``row_id``: a chunk of the same id and text keeps its number from one build to the next, others get new ones above all that were.

    Chunks that agree in both are as good as one another and are matched in order.
    """
    if before is None:
        return parts.withColumn("row_id", F.col("ordinal"))
    base = (before.agg(F.max("row_id")).first()[0] or 0) + 1
    if base > 1 << 61:
        raise ValueError("numbers run out: build anew in an empty folder")
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    nth = lambda order: F.row_number().over(Window.partitionBy("_i", "_s").orderBy(order))
    old = before.select(F.coalesce("id", F.lit("")).alias("_i"), sha.alias("_s"), F.col("row_id").alias("_old")).withColumn("_n", nth("_old"))
    new = parts.withColumn("_i", F.coalesce("id", F.lit(""))).withColumn("_s", sha).withColumn("_n", nth("ordinal"))
    return new.join(old, ["_i", "_s", "_n"], "left").withColumn("row_id", F.coalesce("_old", F.lit(base) + F.col("ordinal"))).drop("_i", "_s", "_n", "_old")


def _builds(spark: SparkSession, out: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/builds")
    return spark.read.schema(BUILD).json(f"{out}/builds") if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else None


def rebuild(spark: SparkSession, root: str, out: str, built: str, model: str = "hash-64", encoder=None, cap: int = 800, overlap: int = 100) -> str:
    """Writes meta, vectors and manifest to a new folder under ``out``, brings the index in step, and names the build in ``out/builds``; returns the folder.

    The lexical index and the cache of vectors are shared by all builds: only chunks whose text is new or changed are tokenised and encoded. Each
    build names its own commit of the index, so a build that dies is never seen: readers go on with the one before it. Totals are observed
    while meta is written, without a job of their own. With ``encoder="fit"`` the first build fits an encoder to its chunks and later ones
    go on with it; its content key names its vectors in the cache.
    """
    folder = f"{out}/build-{uuid.uuid4().hex}"
    known = _builds(spark, out)
    last = known.orderBy(F.desc("seq"), F.desc("build")).first() if known is not None else None
    parts = ordinals(split_chunks(jsonl_chunks(spark, root, extras=True), cap, overlap))
    cite = citation(F.col("corpus"), F.col("doc_title"), F.col("source_url"), F.col("slide_number"), F.col("t_start_seconds"))
    cited = parts.withColumn("_c", cite).withColumn("citation_url", F.col("_c.url")).withColumn("citation_text", F.col("_c.text")).withColumn("citation_html", F.col("_c.html"))
    numbered = kept_numbers(cited, spark.read.parquet(f"{out}/{last['build']}/meta") if last else None)
    size = F.length(F.coalesce("text", F.lit("")))
    seen = Observation("build")
    meta = numbered.select("row_id", "ordinal", *[c for c in numbered.columns if c not in ("row_id", "ordinal", "_row", "_c")])
    # sorted by row: a search fetches the few rows that it returns without reading the others' text
    ordered = meta.repartitionByRange("row_id").sortWithinPartitions("row_id")
    write_parquet(ordered.observe(seen, F.count("*").alias("chunks"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.count_if(F.col("part_of").isNotNull()).alias("parts"), F.count_if(size == 0).alias("empty"), F.count_if(size < THIN).alias("thin")), f"{folder}/meta")
    meta = spark.read.parquet(f"{folder}/meta")
    commit = segments.upsert(spark, f"{out}/index", meta, whole=True, unique=True)
    fitted = None
    if isinstance(encoder, str):
        fitted = last["encoder"] if last and last["encoder"] else lsa.store_encoder(spark, lsa.fit(meta), f"{out}/encoders")
        encoder = lsa.load_encoder(spark, fitted)
        model = encoder.name
    keyed = meta.select("row_id", "text", cache_key(model, F.coalesce("text", F.lit(""))).alias("key"))
    write_parquet(with_cache(keyed, f"{out}/cache", encoder_udf(encoder)).select("row_id", "embedding"), f"{folder}/vectors")
    store_vectors(spark.read.parquet(f"{folder}/vectors"), f"{folder}/near")
    index_manifest(meta, model, built).write.mode("overwrite").text(f"{folder}/manifest")
    row = (folder.rsplit("/", 1)[1], last["seq"] + 1 if last else 0, built, commit.number, {k: int(v) for k, v in seen.get.items()}, fitted)
    spark.createDataFrame([row], BUILD).coalesce(1).write.mode("append").json(f"{out}/builds")
    return folder


def current_build(spark: SparkSession, out: str) -> str:
    last = _builds(spark, out).orderBy(F.desc("seq"), F.desc("build")).first()
    return f"{out}/{last['build']}"


def open_engine(spark: SparkSession, out: str, encoder=None) -> Engine:
    """The last finished build under ``out``, searched by its own commit of the index and its stored vectors."""
    last = _builds(spark, out).orderBy(F.desc("seq"), F.desc("build")).first()
    folder = f"{out}/{last['build']}"
    model = encoder or (lsa.load_encoder(spark, last["encoder"]) if last["encoder"] else HashEncoder())
    return Engine(spark.read.parquet(f"{folder}/meta"), spark.read.parquet(f"{folder}/vectors"), lambda texts: model.encode(texts), segments.open_commit(spark, f"{out}/index", last["commit"]), f"{folder}/near")
