"""Exact top-k by inner product over norm-sorted, rotated vectors.

Components are floor(1024 * x), so scores are integers. One pass sums the Gram matrix; its eigenvectors (the right
singular vectors of the whole table) rotate every vector so that leading coordinates carry most of the energy. Vectors
are dealt to blocks of bounded size by descending length. Queries meet the block of the longest vectors first, which
gives every query a score that its k-th best can't fall below. A query then goes only to the blocks whose longest vector
can still reach that score: blocks fall in length, so these are the first few, and where lengths differ most pairs of
query and block never meet. Inside a block a task skips every vector whose length cannot reach the score, then adds up
rotated coordinates a few at a time and drops a vector as soon as the partial sum plus the product of both residual
lengths (Cauchy-Schwarz) stays below it. Survivors get the exact integer score.

A vector is shuffled once a round; queries stream past the block in batches, so a task holds one block and one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, mix64, shuffle_partitions, table

K, BLOCK, QUERY_BATCH, QUERY_PART, SLAB = 10, 16384, 1024, 65536, 16
SCALE = 1024


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(1024 * x) of each vector; rows with a null id, vector or component or a non-finite one are left out."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for b in batches:
        if b.num_rows:
            m = _matrix(b.column(0)).astype(np.float64)
            total = m.T @ m if total is None else total + m.T @ m
            n += len(m)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["n", "g"])


def rotation(v: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of the whole table, largest singular value first; the driver gets one d x d matrix a task, summed."""
    parts = v.select("v").mapInArrow(_gram, "n long, g array<double>")
    summed = parts.select(F.posexplode("g").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()
    g = np.array([r["x"] for r in summed]).reshape(dim, dim)
    values, vectors = np.linalg.eigh(g)
    return np.ascontiguousarray(vectors[:, ::-1])


def search_block(rows: np.ndarray, ids: np.ndarray, base: np.ndarray, qrows: np.ndarray, queries: np.ndarray, floors: np.ndarray, rot: np.ndarray, k: int, slab: int = SLAB) -> tuple[list, list, list]:
    """(query's row, id, score): the k best of one block for each query, without what is certain to fall below its floor (ties stay)."""
    length = np.sqrt((base.astype(np.float64) ** 2).sum(1))
    order = np.lexsort((ids, -length))
    rows, ids, base, length = rows[order], ids[order], base[order], length[order]
    rb, rq = base @ rot, queries @ rot
    cuts = [*range(0, base.shape[1], slab), base.shape[1]]
    rest_b = np.sqrt(np.maximum(0, np.cumsum((rb**2)[:, ::-1], 1)[:, ::-1]))
    rest_q = np.sqrt(np.maximum(0, np.cumsum((rq**2)[:, ::-1], 1)[:, ::-1]))
    out_q, out_v, out_s = [], [], []
    wide = np.abs(base).max(initial=0) * np.abs(queries).max(initial=0) * max(1, base.shape[1]) >= 2**52
    exact = base if wide else base.astype(np.float64)
    for qi in range(len(queries)):
        slack = 1e-6 * (1.0 + rest_q[qi, 0] * (length[0] if len(length) else 0))
        floor = floors[qi]
        reach = int(np.searchsorted(-length * rest_q[qi, 0], -(floor - slack), side="right")) if np.isfinite(floor) else len(ids)
        alive = np.arange(reach)
        if np.isfinite(floor):
            partial = np.zeros(reach)
            for a, b in zip(cuts, cuts[1:], strict=False):
                partial = partial + rb[alive, a:b] @ rq[qi, a:b]
                if b < base.shape[1]:
                    keep = partial + rest_b[alive, b] * rest_q[qi, b] >= floor - slack
                else:
                    keep = partial >= floor - slack
                alive, partial = alive[keep], partial[keep]
                if not len(alive):
                    break
        alive = alive[rows[alive] != qrows[qi]]
        if not len(alive):
            continue
        score = (exact[alive] @ (queries[qi] if wide else queries[qi].astype(np.float64))).astype(np.int64)
        best = np.lexsort((ids[alive], -score))[:k]
        out_q += [int(qrows[qi])] * len(best)
        out_v += ids[alive[best]].tolist()
        out_s += score[best].tolist()
    return out_q, out_v, out_s


BASE, ASK = 0, 1
MEET = "b int, part int, kind int, row long, id long, v array<long>, floor double"
HIT = "row long, vec_id long, score long"


def _place(cuts: list[float], sizes: list[int], block: int):
    """Each row's block: its class among falling borders, wide classes (many equal lengths) split by row number."""
    parts = np.array([max(1, -(-n // block)) for n in sizes])
    first = np.cumsum(parts) - parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = np.searchsorted(-np.array(cuts), -b.column(3).to_numpy(), "left")
            at = first[cls] + mix64(b.column(0).to_numpy().view(np.uint64)) % parts.astype(np.uint64)[cls]
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *b.columns], names=["b", "row", "vec_id", "v", "norm"])

    return run


def _stream(rot_list: list, k: int, batch: int):
    """Rows by block and query part, the block's vectors first: the block is held, queries pass in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rot = np.array(rot_list)
        now, held, base, asked = None, [], None, []

        def search() -> Iterator[pa.RecordBatch]:
            nonlocal base, asked
            if asked and (held or base):
                if base is None:
                    base = [np.concatenate(x) for x in zip(*held, strict=True)]
                    held.clear()
                rows, _, v, floors = (np.concatenate(x) for x in zip(*asked, strict=True))
                found = search_block(*base, rows, v, floors, rot, k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["row", "vec_id", "score"])
            asked = []

        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)], 1)
            edges = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
            for at, to in zip(edges, [*edges[1:], len(key)], strict=True):
                if now != (here := tuple(key[at, :2].tolist())):
                    yield from search()
                    now, base = here, None
                    held.clear()
                floors = b.column(6).slice(at, to - at).to_numpy(zero_copy_only=False).astype(np.float64)
                part = (b.column(3).slice(at, to - at).to_numpy(), b.column(4).slice(at, to - at).to_numpy(), _matrix(b.column(5).slice(at, to - at)))
                if key[at, 2] == BASE:
                    held.append(part)
                else:
                    asked.append((*part, np.where(np.isnan(floors), -np.inf, floors)))
                    if sum(len(x[0]) for x in asked) >= batch:
                        yield from search()
        yield from search()

    return run


def top_k(vectors: DataFrame, queries: DataFrame | None = None, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, query_batch: int = QUERY_BATCH) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for each query, ties to the smaller id, the query's own row left out.

    ``queries`` holds id and vector columns of the same names (by default the rows whose id is divisible by 100; queries of
    another table have no own row among the vectors). Vectors of different lengths count as padded with zeros. Repeated ids
    are rows of their own, as queries and as hits. No rows or no queries give an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    raw = Stored(integer_vectors(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id())).df
    dim = raw.agg(F.max(F.size("v"))).first()[0] or 0
    if queries is not None:
        foreign = Stored(integer_vectors(queries, id_col, vector_col).withColumn("row", -1 - F.monotonically_increasing_id())).df
        dim = max(dim, foreign.agg(F.max(F.size("v"))).first()[0] or 0)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not dim:
        return empty

    def padded(df: DataFrame) -> DataFrame:
        v = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v")))
        return df.select("row", "vec_id", v.alias("v")).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))

    sized = padded(raw)
    q = sized.where("vec_id % 100 = 0") if queries is None else padded(foreign)
    total, n_queries = raw.count(), q.count()
    if not n_queries or not total:
        return empty
    rot = rotation(sized, dim).tolist()
    n_blocks, parts = -(-total // block), -(-n_queries // QUERY_PART)
    cuts = sorted(set(sized.approxQuantile("norm", [i / n_blocks for i in range(1, n_blocks)], 0.1 / n_blocks)), reverse=True) if n_blocks > 1 else []
    # class c holds the lengths from its border up to the one before: at most 2 classes a block, one number each
    cls = F.col("cls")
    counts = sized.select(F.lit(0).alias("cls")) if not cuts else sized.mapInArrow(_classes(cuts), "cls int")
    heads = {r["cls"]: r["count"] for r in counts.groupBy(cls).count().collect()}
    sizes = [heads.get(c, 0) for c in range(len(cuts) + 1)]
    dealt = Stored(sized.mapInArrow(_place(cuts, sizes, block), "b int, row long, vec_id long, v array<long>, norm double")).df
    reach = dealt.groupBy("b").agg(F.max("norm").alias("longest"))
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    none = F.lit(None).cast("double")
    asked = q.select(part.alias("part"), "row", "v", "norm")
    spread = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")

    def meet(base: DataFrame, ask: DataFrame, blocks: int) -> DataFrame:
        left = base.select("b", spread, F.lit(BASE).alias("kind"), "row", F.col("vec_id").alias("id"), "v", none.alias("floor"))
        right = ask.select("b", "part", F.lit(ASK).alias("kind"), "row", F.lit(0).cast("long").alias("id"), "v", "floor")
        both = left.union(right).repartition(max(1, min(blocks * parts, 4 * shuffle_partitions(spark))), "b", "part")
        return both.sortWithinPartitions("b", "part", "kind").mapInArrow(_stream(rot, k, query_batch), HIT)

    hits = meet(dealt.where("b = 0"), asked.select(F.lit(0).alias("b"), "part", "row", "v", none.alias("floor")), 1)
    if (last := sum(max(1, -(-n // block)) for n in sizes)) > 1:
        hits = Stored(hits).df
        top = hits.withColumn("r", F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") == k)
        floors = asked.join(top.select("row", F.col("score").cast("double").alias("floor")), "row", "left").select("part", "row", "v", "norm", "floor")
        # blocks fall in length: a query needs those up to the last whose longest vector reaches its floor, a count by range
        ladder = [r["longest"] for r in reach.orderBy("b").collect()]
        ladder = np.maximum.accumulate(np.array(ladder)[::-1])[::-1].tolist()
        needed = floors.mapInArrow(_needed(ladder), "part int, row long, v array<long>, floor double, last int").where("last > 0")
        wanted = needed.select(F.explode(F.sequence(F.lit(1), F.col("last"))).alias("b"), "part", "row", "v", "floor")
        hits = hits.union(meet(dealt.where("b > 0"), wanted, last))
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)
    return ranked.join(q.select("row", F.col("vec_id").alias("query_id")), "row").select("query_id", "rank", "vec_id", "score")


def _classes(cuts: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(-np.array(cuts), -b.column(3).to_numpy(), "left").astype(np.int32))], names=["cls"])

    return run


def _needed(ladder: list[float]):
    """The last block that may hold a vector of score ``floor`` or more; without a floor all blocks count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rungs = -np.array(ladder)
        for b in batches:
            norm, floor = (b.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (3, 4))
            low = np.where(np.isnan(floor), -np.inf, floor)
            least = np.where(low <= 0, 0.0, low / np.maximum(norm, 1e-300)) * (1 - 1e-9) - 1e-6
            last = np.searchsorted(rungs, -least, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(4), pa.array(last.astype(np.int32))], names=["part", "row", "v", "floor", "last"])

    return run


def op8(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.k <> c.k WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
