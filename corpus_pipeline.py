"""The corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as Parquet to the shared
folder and reads it again as the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkwright.llm import line_dedup, mixing, ngram_join, packing, quality
from chunkwright.llm.common import Stored, beside, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    The verdict travels with its row, so repeated and null ids are judged row by row. Null and empty texts are judged by
    their form; without labels, or labels that meet no document, all stay. No rows give none; further columns stay.
    """
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), carry=True).where("keep")
    return judged.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents of different lines hold go; ``n_chars`` follows the text.

    Copies count once, so that a group of them keeps its lines and the join decides which one stays. A document that is
    left without text, blank lines aside, consists of lines that stand in ten others and goes. Rows are changed one by one,
    whatever their ids; null and empty texts stay, further columns, too. No rows give none.
    """
    cut = line_dedup.drop_hot_lines(docs, copies=False)
    n = len(docs.columns)
    lines, dropped = cut.columns[n], cut.columns[n + 1]
    left = cut.where((F.col(dropped) == 0) | F.coalesce("text", F.lit("")).rlike(r"(?U)\S"))
    return left.withColumn("n_chars", F.when(F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def row_hash(docs: DataFrame) -> Column:
    """A 64-bit hash of all columns; maps and variants, which have no hash, go in as JSON."""
    plain = lambda kind: not any(x in kind for x in ("map<", "variant"))
    columns = [F.col(f"`{c}`") if plain(kind) else F.to_json(F.struct(F.col(f"`{c}`").alias("x"))) for c, kind in docs.dtypes]
    return F.xxhash64(*columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) one row stays: the one of least id, ties by a hash of the row.

    Rows are known by a hash of all their columns, never by their id alone; of rows that agree in every column one is as
    good as another, and one stays. Null ids come after others. Rows without words belong to no group and stay, repeated
    ones, too. No rows give none; further columns stay.
    """
    names = docs.columns
    key = line_dedup.fresh("_row_key", names)
    marked = docs.withColumn(key, row_hash(docs))
    groups = Stored(ngram_join.near_duplicates(marked.select("doc_id", "text", key), row_col=key)).df.where("root IS NOT NULL")
    best = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("b"))
    kept = Stored(best.select(F.col("b.row").alias(key))).df
    seen = groups.groupBy(F.col("row").alias(key)).count()
    gone = Stored(seen.join(kept, key, "left_anti").select(key)).df
    left = marked.join(beside(gone), key, "left_anti")
    # a kept row that stands more than once in the table
    twice = Stored(seen.where("count > 1").join(kept, key, "left_semi").select(key)).df
    if not twice.limit(1).count():
        return left.select(*names)
    once = left.join(beside(twice), key, "left_anti").select(*names)
    return once.unionByName(left.join(beside(twice), key, "left_semi").dropDuplicates([key]).select(*names))


def sample_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities stay: half of the tokens, sources, languages and topics raked to targets.

    Draws go by the id: rows of one id are drawn together where their cells' rates agree, null ids draw as 0. Rows without
    words are never drawn. No rows give none; further columns stay.
    """
    used = ["doc_id", "text", "lang", "source"]
    held = {c: f"held{i}" for i, c in enumerate(docs.columns) if c not in used}  # so that no name meets those of the sampling
    mixed = mixing.mix(docs.select(*used, *[F.col(f"`{c}`").alias(h) for c, h in held.items()])).where("_sampled")
    return mixed.select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document: its bucket, batch and slot.

    Null and repeated ids are rows like others; a text without words, or null, is one piece of length 0. No rows give none.
    """
    return packing.pack(docs)


STAGES = [("quality", keep_good), ("lines", drop_lines), ("near_duplicates", one_of_each), ("mix", sample_to_targets), ("pack", pack_batches)]

ORACLE_SQL = None  # a fitted classifier and a dynamic program: tested stage by stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir)).df
    return docs
