"""A stored index of vectors [C2, J10, K6]: clustered parts with a centre and a radius, searched exactly.

Centres come from Lloyd's steps over a bounded sample; every vector goes to its nearest centre, and a centre's vectors are cut into blocks of
about ``BLOCK`` rows by a hash of the row, however many it has. A block keeps its own mean and the largest distance from it, so for any query q and vector v in it
q.v <= q.mean + |q| * radius. Ids and vectors are packed matrices; products are matrix products of a block and the queries that may find something in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .index import TOP, ranked

BLOCK, SAMPLE, CENTRES, STEPS, ASKED = 2048, 20_000, 1024, 8, 4096
SCHEMA = "part long, block long, n long, centre binary, radius double, ids binary, vectors binary"
SLACK = 1e-9


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), dim)


def centres_of(sample: np.ndarray, most: int) -> np.ndarray:
    """Lloyd's steps from evenly spaced rows of the sample; a centre that nothing is near keeps its place."""
    if not len(sample):
        return sample
    centres = sample[np.linspace(0, len(sample) - 1, min(most, len(sample))).astype(int)].astype(np.float64)
    for _ in range(STEPS):
        near = _nearest(sample, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres * centres).sum(1) / 2
    return np.concatenate([(x[i : i + 4096] @ centres.T - half).argmax(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def store_vectors(vectors: DataFrame, folder: str, id_col: str = "row_id", vector: str = "embedding", block: int = BLOCK) -> None:
    """Writes the index. Null ids and vectors are left out; vectors of another length than the first sampled one are an error."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("row_id"), F.col(vector).cast("array<float>").alias("v")).where("row_id IS NOT NULL AND v IS NOT NULL")
    total = rows.count()
    got = rows.orderBy(F.xxhash64("row_id"), "row_id").limit(SAMPLE).toArrow().column("v").combine_chunks()
    dim = len(got[0]) if len(got) else 0
    centres = centres_of(_matrix(got, dim), max(1, min(CENTRES, total // block))) if dim else np.zeros((1, 0))
    sent = spark.sparkContext.broadcast(centres.tobytes())  # at most CENTRES rows
    many = len(centres)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(sent.value).reshape(many, dim)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_nearest(_matrix(b.column(1), dim), held)), b.column(0), b.column(1)], names=["part", "row_id", "v"])

    def pack(t: pa.Table) -> pa.Table:
        ids, x = t.column("row_id").to_numpy(), _matrix(t.column("v").combine_chunks(), dim)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        mean = x.mean(0, dtype=np.float64)
        radius = float(np.sqrt(((x - mean) ** 2).sum(1)).max()) * (1 + 1e-12) + 1e-12
        one = lambda v, kind: pa.array([v], kind)
        return pa.table({"part": t.column("part").slice(0, 1), "block": t.column("block").slice(0, 1), "n": one(len(ids), pa.int64()), "centre": one(mean.tobytes(), pa.binary()), "radius": one(radius, pa.float64()), "ids": one(ids.tobytes(), pa.binary()), "vectors": one(x.tobytes(), pa.binary())})

    dealt = rows.mapInArrow(deal, "part long, row_id long, v array<float>")
    sizes = dealt.groupBy("part").agg(F.ceil(F.count("*") / block).alias("blocks"))  # a row a centre
    cut = dealt.join(F.broadcast(sizes), "part").withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("blocks"))).select("part", "block", "row_id", "v")
    made = cut.groupBy("part", "block").applyInArrow(pack, SCHEMA)
    made.sortWithinPartitions("part", "block").write.mode("overwrite").option("compression", "zstd").parquet(folder)


def _asked(queries: DataFrame, query_id: str, vector: str) -> tuple[np.ndarray, np.ndarray]:
    got = queries.select(F.col(query_id).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL").limit(ASKED + 1).toArrow()
    if got.num_rows > ASKED:
        raise ValueError(f"more than {ASKED} query vectors in one batch: search in several")
    ids = got.column("q").to_numpy()
    return ids, np.array(got.column("v").to_pylist(), np.float64).reshape(len(ids), -1 if len(ids) else 0)


def _heads(batch: pa.RecordBatch, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of (block, query), and (block, query) products with the centres."""
    c = np.array([np.frombuffer(x.as_py()) for x in batch.column("centre")]).reshape(batch.num_rows, -1)
    near = c @ q.T
    return near + np.outer(batch.column("radius").to_numpy(), np.sqrt((q * q).sum(1))) + SLACK, near


def _rows(sent, floors: np.ndarray, k: int):
    """Each block's best rows for the queries whose floor its bound reaches, and the products made (query null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = sent.value
        for batch in batches:
            query, row, score, made = [], [], [], 0
            bound, _ = _heads(batch, q)
            for i in range(batch.num_rows):
                want = np.flatnonzero(bound[i] >= floors)
                if not len(want):
                    continue
                own = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                x = np.frombuffer(batch.column("vectors")[i].as_py(), np.float32).reshape(len(own), -1).astype(np.float64)
                s = x @ q[want].T
                made += s.size
                for j, w in enumerate(want):
                    at = np.flatnonzero(s[:, j] >= floors[w])
                    if len(at) > k:
                        kth = np.partition(s[at, j], len(at) - k)[len(at) - k]
                        at = at[s[at, j] >= kth - 1e-8]  # ties at the last place stay
                    query.append(np.full(len(at), ids[w]))
                    row.append(own[at])
                    score.append(s[at, j])
            join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
            a, b, c = join(query, np.int64), join(row, np.int64), join(score, np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c), pa.nulls(len(a), pa.int64())], names=["query_id", "row_id", "score", "made"])
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), pa.array([made], pa.int64())], names=["query_id", "row_id", "score", "made"])

    return run


def search_vectors(queries: DataFrame, folder: str, query_id: str, query_vector: str = "embedding", k: int = TOP, report: bool = False) -> DataFrame:
    """[C2, T2] (query_id, row_id, rank, score) as ``dense_topk`` gives it; with ``report`` one row (pairs, products): all pairs and those multiplied.

    The blocks whose centres lie nearest a query are multiplied first and give its floor; then the blocks whose bound reaches it. A batch holds at most ``ASKED``
    queries; null vectors find nothing.
    """
    spark = queries.sparkSession
    ids, q = _asked(queries, query_id, query_vector)
    if not len(ids):
        return spark.createDataFrame([(0, 0)], "pairs long, products long") if report else spark.createDataFrame([], "query_id long, row_id long, rank long, score double")
    sent = spark.sparkContext.broadcast((ids, q))
    stored = spark.read.schema(SCHEMA).parquet(folder)
    heads = stored.select("part", "block", "n", "centre", "radius")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value[1]
        for b in batches:
            _, near = _heads(b, asked)
            n, order = b.column("n").to_numpy(), np.argsort(-near, axis=0, kind="stable")
            enough = np.minimum((np.cumsum(n[order], axis=0) < k).sum(0) + 1, len(n))  # the nearest blocks that hold k rows
            at = [(order[i, j], j) for j in range(near.shape[1]) for i in range(enough[j])]
            block, query = (np.array(x, np.int64) for x in zip(*at, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(query), b.column("part").take(pa.array(block)), b.column("block").take(pa.array(block)), pa.array(n[block]), pa.array(near[block, query])], names=["q", "part", "block", "n", "near"])

    order = Window.partitionBy("q").orderBy(F.desc("near"), "part", "block")
    seeds = heads.mapInArrow(nearest, "q long, part long, block long, n long, near double").withColumn("_to", F.sum("n").over(order) - F.col("n")).where(F.col("_to") < k).select("part", "block").distinct()
    best = stored.join(F.broadcast(seeds), ["part", "block"], "left_semi").mapInArrow(_rows(sent, np.full(len(ids), -np.inf), k), "query_id long, row_id long, score double, made long").where("query_id IS NOT NULL")
    down = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = best.withColumn("_r", F.row_number().over(down)).where(F.col("_r") <= k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k).collect()
    known = {r["query_id"]: r["s"] - 1e-8 for r in kth}  # a little below: rounding never decides
    floors = np.array([known.get(i, -np.inf) for i in ids.tolist()])

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = pa.array((_heads(b, sent.value[1])[0] >= floors).any(1))
            yield pa.RecordBatch.from_arrays([b.column("part").filter(want), b.column("block").filter(want)], names=["part", "block"])

    wanted = heads.mapInArrow(reached, "part long, block long")
    found = stored.join(wanted.hint("broadcast") if heads.count() <= 1_000_000 else wanted, ["part", "block"], "left_semi").mapInArrow(_rows(sent, floors, k), "query_id long, row_id long, score double, made long")
    if report:
        return found.agg(F.sum("made").alias("products")).crossJoin(heads.agg((F.sum("n") * len(ids)).alias("pairs"))).select("pairs", F.coalesce("products", F.lit(0)).alias("products"))
    return ranked(found.where("query_id IS NOT NULL").select("query_id", "row_id", "score"), k)
