"""Hybrid retrieval: dense leg, rank fusion, boosts, filter, final top-k, fetch."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.citations import citation
from ..functions.text import l2_normalize, snippet
from . import segments
from . import vectors as stored_vectors
from .index import TOP, bm25_topk, ranked

RRF_K, DEFAULT_K, QUERY_BLOCK, VECTOR_PART = 60, 6, 256, 16384

# multipliers by corpus; all others have 1 (fixed values)
BOOSTS = {"lecturer/lectures": 1.40, "edgar": 1.20, "earnings": 1.20, "letters": 1.20, "consulting": 1.05, "essays": 1.05, "vendors": 1.05, "ai_index": 1.05}


def _block_topk(k: int):
    """A part of the vectors and a block of the queries: one matrix product, and each query's k best, ties at the last place included."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        query, row, score = [], [], []
        if left.num_rows and right.num_rows:
            v, q = (np.array(t.column(c).combine_chunks().flatten(), np.float64).reshape(t.num_rows, -1) for t, c in ((left, "v"), (right, "q")))
            ids, asked = left.column("row_id").to_numpy(), right.column("query_id").to_numpy()
            s = v @ q.T
            for j in range(len(asked)):
                at = np.arange(len(ids))
                if len(at) > k:
                    at = np.flatnonzero(s[:, j] >= np.partition(s[:, j], len(ids) - k)[len(ids) - k] - 1e-8)
                query.append(np.full(len(at), asked[j]))
                row.append(ids[at])
                score.append(s[at, j])
        join = lambda x, kind: pa.array(np.concatenate(x) if x else np.zeros(0, kind))
        return pa.table({"query_id": join(query, np.int64), "row_id": join(row, np.int64), "score": join(score, np.float64)})

    return run


def dense_topk(queries: DataFrame, vectors: DataFrame, query_id: str, id_col: str, query_vector: str = "embedding", vector: str = "embedding", k: int = TOP, normalize: bool = False) -> DataFrame:
    """[J10, C2] (query_id, row_id, rank, score) by exact inner product.

    Vectors are dealt to parts of about 16,384, queries to blocks of 256, and every part meets every block as one matrix product, so
    no key holds more of either however many there are, and no pair of a query and a vector becomes a row. Null vectors take no part.
    """
    q = queries.select(F.col(query_id).cast("long").alias("query_id"), (l2_normalize(F.col(query_vector)) if normalize else F.col(query_vector).cast("array<double>")).alias("q")).where("q IS NOT NULL")
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    parts = max(1, -(-vectors.count() // VECTOR_PART))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    dealt = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n))
    asked = q.withColumn("block", dealt("query_id", blocks)).withColumn("part", every(parts)).select(F.col("part").alias("p"), F.col("block").alias("b"), "query_id", "q")
    v = vectors.select(F.col(id_col).cast("long").alias("row_id"), F.col(vector).alias("v")).where("v IS NOT NULL")
    v = v.withColumn("part", dealt("row_id", parts)).withColumn("block", every(blocks))
    scored = v.groupBy("part", "block").cogroup(asked.groupBy("p", "b")).applyInArrow(_block_topk(k), "query_id long, row_id long, score double")
    return ranked(scored, k)


def rrf(*legs: DataFrame, k: int = RRF_K) -> DataFrame:
    """[C3, J3, A11] Legs of (query_id, row_id, rank) to (query_id, row_id, score, places): one sum, no outer join.

    ``places`` holds the rank in each leg, null where a leg lacks the row; it settles ties as the legs' own order does.
    """
    tagged = [leg.select("query_id", "row_id", "rank", F.lit(i).alias("leg")) for i, leg in enumerate(legs)]
    both = reduce(DataFrame.unionByName, tagged)
    parts = [F.max(F.when(F.col("leg") == i, F.col("rank"))) for i in range(len(legs))]
    score = reduce(lambda a, b: a + b, [F.coalesce(1.0 / (k + p + 1), F.lit(0.0)) for p in parts])
    return both.groupBy("query_id", "row_id").agg(score.alias("score"), F.struct(*[p.alias(f"leg{i}") for i, p in enumerate(parts)]).alias("places"))


def boost_of(spark: SparkSession, boosts: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(sorted(boosts.items()) or [("", 1.0)], "corpus string, boost double")


def boosted(fused: DataFrame, corpora: DataFrame, boosts: dict[str, float] | None = None, corpus: str | list[str] | None = None) -> DataFrame:
    """[P3, J4, J8, C4] Fused rows in the wanted corpora, score times the corpus's multiplier (1 by default).

    ``corpora`` is (row_id, corpus). The filter stands above both legs' limits, so fewer than k rows may be left.
    """
    spark = fused.sparkSession
    known = fused.join(corpora, "row_id")
    if corpus is not None:
        known = known.where(F.col("corpus").isin([corpus] if isinstance(corpus, str) else list(corpus)))
    return known.join(boost_of(spark, BOOSTS if boosts is None else boosts), "corpus", "left").withColumn("score", F.col("score") * F.coalesce("boost", F.lit(1.0))).drop("boost")


def final_topk(rows: DataFrame, k: int = DEFAULT_K, tie: str = "reference") -> DataFrame:
    """[T1] The k best rows a query; ties by the lexical leg's order, then the dense one's (or by row)."""
    ties = [F.col("places.leg0").asc_nulls_last(), F.col("places.leg1").asc_nulls_last()] if tie == "reference" else []
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 12)), *ties, "row_id")
    return rows.withColumn("rank", (F.row_number().over(order) - 1).cast("long")).where(F.col("rank") < k)


def search_batch(queries: DataFrame, chunks: DataFrame, vectors: DataFrame, query_id: str, id_col: str, corpus_col: str, boosts: dict[str, float] | None = None, corpus: str | list[str] | None = None, k: int = DEFAULT_K, per_leg: int = TOP, prefilter: bool = False, index: segments.Commit | None = None, stored: str | None = None) -> DataFrame:
    """[C5] (query_id, rank, row_id, corpus, snippet, score) for many queries in one plan.

    ``queries`` has ``text`` and ``embedding``; ``vectors`` (row_id, embedding). Text is joined after the final limit, so the
    scoring plan never carries it; with ``index``, a commit of the segmented index, no text at all is read before that limit, and with
    ``stored``, the folder of a vector index, no vector that can't be among the best. ``prefilter`` applies the corpus
    filter before ranking (an extension); its statistics are those of the rows left, so it takes neither.
    """
    if prefilter and (index is not None or stored is not None):
        raise ValueError("prefilter ranks by the statistics of the rows it leaves; an index holds those of all")
    if prefilter and corpus is not None:
        chunks = chunks.where(F.col(corpus_col).isin([corpus] if isinstance(corpus, str) else list(corpus)))
        vectors = vectors.join(chunks.select(F.col(id_col).alias("row_id")), "row_id", "left_semi")
    lexical = bm25_topk(queries, chunks, query_id, id_col, k=per_leg) if index is None else segments.search(queries, index, query_id, k=per_leg)
    dense = dense_topk(queries, vectors, query_id, "row_id", k=per_leg) if stored is None else stored_vectors.search_vectors(queries, stored, query_id, k=per_leg)
    corpora = chunks.select(F.col(id_col).cast("long").alias("row_id"), F.col(corpus_col).alias("corpus"))
    top = final_topk(boosted(rrf(lexical, dense), corpora, boosts, corpus), k)
    texts = chunks.select(F.col(id_col).cast("long").alias("row_id"), "text")
    return top.join(texts, "row_id").select("query_id", "rank", "row_id", "corpus", snippet(F.col("text")).alias("snippet"), F.round("score", 6).alias("score"))


def hits(top: DataFrame, meta: DataFrame) -> DataFrame:
    """[P14, J1] Hit rows: (query_id, rank) and the ten fields, from (query_id, rank, row_id, score) and chunk metadata."""
    cited = citation(F.col("corpus"), F.col("doc_title"), F.col("source_url"), F.col("slide_number"), F.col("t_start_seconds"))
    rows = top.select("query_id", "rank", "row_id", "score").join(meta.withColumn("cite", cited), "row_id")
    return rows.select("query_id", "rank", "id", "corpus", F.col("doc_title").alias("title"), F.col("source_url").alias("source"), "section_path", F.col("cite.url").alias("citation_url"), F.col("cite.text").alias("citation_text"), F.col("cite.html").alias("citation_html"), snippet(F.col("text")).alias("snippet"), F.round("score", 6).alias("score"))


class Engine:
    """An index over one table of chunks, kept between queries [S15, C14].

    A search reads the postings of its own tokens, the vectors near the query, and the text of the k rows that it returns. Without a stored ``lexical`` or ``stored``
    vector index it reads all texts or vectors.
    """

    def __init__(self, chunks: DataFrame, vectors: DataFrame, encode=None, lexical: segments.Commit | None = None, stored: str | None = None):
        self.chunks, self.vectors, self.encode, self.lexical, self.stored = chunks, vectors, encode, lexical, stored
        self.spark = chunks.sparkSession
        self.names = chunks.select("row_id", "corpus").persist()

    def warm_up(self) -> dict[str, float]:
        import time

        out, start = {}, time.perf_counter()
        for name, step in (("chunks", self.names.count), ("vectors", self.vectors.count), ("first_query", lambda: self.search("warm up", k=1).collect())):
            t = time.perf_counter()
            step()
            out[name] = time.perf_counter() - t
        out["_total"] = time.perf_counter() - start
        return out

    def search(self, query: str, corpus: str | list[str] | None = None, k: int = DEFAULT_K) -> DataFrame:
        """The k best hits, in order. Their rows are fetched by number, so the scan of the text skips what holds none of them."""
        vector = self.encode([query])[0] if self.encode else None
        q = self.spark.createDataFrame([(0, query, [float(x) for x in vector] if vector is not None else None)], "query_id long, text string, embedding array<double>")
        lexical = bm25_topk(q, self.chunks, "query_id", "row_id") if self.lexical is None else segments.search(q, self.lexical)
        dense = dense_topk(q, self.vectors, "query_id", "row_id") if self.stored is None else stored_vectors.search_vectors(q, self.stored, "query_id")
        top = final_topk(boosted(rrf(lexical, dense), self.names, corpus=corpus), k).select("query_id", "rank", "row_id", "score").collect()
        found = self.spark.createDataFrame(top, "query_id long, rank long, row_id long, score double")
        return hits(found, self.chunks.where(F.col("row_id").isin([r["row_id"] for r in top]))).orderBy("rank")

    def fetch_doc(self, chunk_id: str) -> dict:
        """[C6, J2] The last row of the id; KeyError if there is none."""
        row = last_of_id(self.chunks.where(F.col("id") == chunk_id), order="ordinal" if "ordinal" in self.chunks.columns else "row_id").first()
        if row is None:
            raise KeyError(f"Unknown chunk id: {chunk_id}")
        return row.asDict()


def last_of_id(meta: DataFrame, id_col: str = "id", order: str = "row_id") -> DataFrame:
    """[C6] One row for each id, that of the greatest ``order``: text, title, source and citation."""
    cited = citation(F.col("corpus"), F.col("doc_title"), F.col("source_url"), F.col("slide_number"), F.col("t_start_seconds"))
    fields = [F.col("doc_title").alias("title"), F.col("source_url").alias("source"), cited.alias("cite"), F.col("text").alias("full_text")]
    last = meta.groupBy(id_col).agg(F.max_by(F.struct(*fields), F.col(order)).alias("r"))
    return last.select(F.col(id_col).alias("id"), "r.title", "r.source", F.col("r.cite.url").alias("citation_url"), F.col("r.cite.text").alias("citation_text"), F.col("r.cite.html").alias("citation_html"), "r.full_text")


def validate_names(asked: list[str], known: list[str]) -> None:
    """[P12, U2] Unknown names are an error that lists them."""
    if unknown := sorted(set(asked) - set(known)):
        raise ValueError(f"unknown: {', '.join(unknown)}; known: {', '.join(known)}")
