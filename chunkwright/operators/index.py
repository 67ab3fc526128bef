"""Inverted index and BM25 [A10, J9, C1, K5]."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens

K1, B, TOP = 1.5, 0.75, 50
SENT_TOKENS, BLOCK_CELLS, SLICE_ROWS = 1 << 18, 1 << 21, 1024


def token_rows(chunks: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(row_id, tok): one row for each token."""
    return chunks.select(F.col(id_col).cast("long").alias("row_id"), F.explode(tokens(F.col(text_col))).alias("tok"))


def postings(chunks: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(tok, row_id, tf)"""
    return token_rows(chunks, id_col, text_col).groupBy("tok", "row_id").agg(F.count("*").alias("tf"))


def doc_lengths(chunks: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(row_id, dl): tokens of each row, 0 included; no shuffle."""
    return chunks.select(F.col(id_col).cast("long").alias("row_id"), F.size(tokens(F.col(text_col))).cast("long").alias("dl"))


def document_frequency(index: DataFrame) -> DataFrame:
    """(tok, df)"""
    return index.groupBy("tok").agg(F.count("*").alias("df"))


def frequencies(chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """(tok, df) straight from the texts: a row's own repeats go before the count, so only partial counts by token are shuffled."""
    return chunks.select(F.explode(F.array_distinct(tokens(F.col(text_col)))).alias("tok")).groupBy("tok").agg(F.count("*").alias("df"))


@dataclass(frozen=True)
class Lexical:
    """An index ready for search: postings (tok, row_id, tf, dl), frequencies (tok, df), rows and tokens a row on average."""

    postings: DataFrame
    frequencies: DataFrame
    n: int
    avgdl: float


class _Asked:
    """The distinct tokens of a batch of queries, and the queries in blocks of a bounded number of weights."""

    def __init__(self, rows: list):
        self.tok = pa.array(sorted({r["tok"] for r in rows}), pa.string())
        at = {t: i for i, t in enumerate(self.tok.to_pylist())}
        held: dict[int, list[tuple[int, int]]] = {}
        for r in rows:
            held.setdefault(r["query_id"], []).append((at[r["tok"]], r["qtf"]))
        self.blocks, now, seen = [], [], set()
        for query, toks in sorted(held.items()):
            seen |= {c for c, _ in toks}
            if now and len(seen) * (len(now) + 1) > BLOCK_CELLS:
                self.blocks.append(now)
                now, seen = [], {c for c, _ in toks}
            now.append((query, toks))
        self.blocks += [now] if now else []

    def weights(self, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(queries, tokens, tokens x queries) of each block."""
        out = []
        for block in self.blocks:
            tok = np.array(sorted({c for _, toks in block for c, _ in toks}))
            w = np.zeros((len(tok), len(block)))
            for j, (_, toks) in enumerate(block):
                c, qtf = np.array(toks).T
                w[np.searchsorted(tok, c), j] = qtf * idf[c]
            out.append((np.array([q for q, _ in block], np.int64), tok, w))
        return out


def _counted(lists: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, tf) of the tokens that are asked for."""
    code = pc.index_in(lists.flatten(), vocabulary)
    row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    had = code.is_valid().to_numpy(zero_copy_only=False)
    key, tf = np.unique(row[had] * len(vocabulary) + pc.drop_null(code).to_numpy(), return_counts=True)
    return key // len(vocabulary), key % len(vocabulary), tf


def _best(query: np.ndarray, row: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best and what ties with the last of them; of rows of one score only the k least can count."""
    if not len(query):
        return query, row, score
    order = np.lexsort((row, -score, query))
    query, row, score = query[order], row[order], score[order]
    place = lambda new: np.arange(len(new)) - np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    new = np.concatenate([[True], query[1:] != query[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(query)))
    last = np.where(size > k, score[first + np.minimum(size, k) - 1] - 1e-8, -np.inf)
    keep = (score >= np.repeat(last, size)) & (place(new | np.concatenate([[True], score[1:] != score[:-1]])) < k)
    return query[keep], row[keep], score[keep]


def _scan_topk(asked: _Asked, chunks: DataFrame, id_col: str, text_col: str, k: int, k1: float, b: float) -> DataFrame:
    """(query_id, row_id, score): the best rows of each task for all queries, so that neither postings nor pairs are shuffled.

    One scan counts rows, tokens and the df of the asked tokens, one scores: rows x tokens times tokens x queries, in blocks.
    """
    spark = chunks.sparkSession
    words = spark.sparkContext.broadcast(asked.tok)
    held = chunks.select(F.col(id_col).cast("long").alias("row_id"), tokens(F.col(text_col)).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, known, total = np.zeros(len(words.value), np.int64), 0, 0, 0  # null texts are rows, but have no length
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                lists = batch.column(0).slice(at, SLICE_ROWS)
                n, known = n + len(lists), known + len(lists) - lists.null_count
                total += int(pc.sum(pc.list_value_length(lists)).as_py() or 0)
                df += np.bincount(_counted(lists, words.value)[1], minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-3, -2, -1], some]), pa.int64()), pa.array(np.concatenate([[n, known, total], df[some]]), pa.int64())], names=["i", "n"])

    got = {r["i"]: r["n"] for r in held.select("t").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    n, known, df = got.get(-3, 0), got.get(-2, 0), np.array([got.get(i, 0) for i in range(len(asked.tok))], np.float64)
    avgdl = (got.get(-1, 0) / known if known else 0) or 1.0
    sent = spark.sparkContext.broadcast(asked.weights(np.log(1 + (n - df + 0.5) / (df + 0.5))))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged = lambda: _best(*map(np.concatenate, zip(*found, strict=True)), k)
        found, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0
        most = max(1 << 18, 4 * k * sum(len(q) for q, _, _ in sent.value))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                ids, lists = batch.column(0).slice(at, SLICE_ROWS).to_numpy(), batch.column(1).slice(at, SLICE_ROWS)
                row, tok, tf = _counted(lists, words.value)
                dl = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.float64)
                part = tf / (tf + k1 * (1 - b + b * dl[row] / avgdl))
                for queries, cols, w in sent.value:
                    col = np.minimum(np.searchsorted(cols, tok), len(cols) - 1)
                    mine = cols[col] == tok
                    rows = np.zeros((len(ids), len(cols)))
                    rows[row[mine], col[mine]] = part[mine]
                    s = rows @ w
                    floor = np.partition(s, len(ids) - k, axis=0)[len(ids) - k] - 1e-8 if len(ids) > k else np.zeros(len(queries))
                    r, q = np.nonzero((s > 0) & (s >= floor))
                    found.append((queries[q], ids[r], s[r, q]))
                    size += len(r)
                if size >= most:
                    found = [merged()]
                    size = len(found[0][0])
        out = merged()
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "row_id", "score"])

    return held.mapInArrow(score, "query_id long, row_id long, score double")


def bm25_topk(queries: DataFrame, chunks: DataFrame | None, query_id: str, id_col: str = "row_id", query_text: str = "text", text_col: str = "text", k: int = TOP, k1: float = K1, b: float = B, index: Lexical | None = None) -> DataFrame:
    """(query_id, row_id, rank, score) of the k best matching rows for each query, 0-based ranks.

    Repeated query tokens count as often as they occur; a query without tokens has no rows; rows that share no token with
    the query have none either. Ranks go by the score to nine places, then by row. With ``index`` no text is read; without,
    the texts are scanned twice and each task sends its best rows alone. Where that can't be (ids that repeat or are null, whose texts count as one, or more than
    ``SENT_TOKENS`` query tokens), postings of the queries' own tokens are aggregated: the semi-join on them comes before the count. ``segments`` holds an index that is stored.
    """
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.explode(tokens(F.col(query_text))).alias("tok")).groupBy("query_id", "tok").agg(F.count("*").alias("qtf"))
    if index is None:
        sent = asked.where("query_id IS NOT NULL").limit(SENT_TOKENS + 1).collect()
        if sent and len(sent) <= SENT_TOKENS and asked.where("query_id IS NULL").isEmpty():
            ids = chunks.select(F.col(id_col).cast("long").alias("i")).groupBy("i").agg(F.count("*").alias("n"))
            if ids.where("i IS NULL OR n > 1").isEmpty():
                return ranked(_scan_topk(_Asked(sent), chunks, id_col, text_col, k, k1, b), k)
        stats = doc_lengths(chunks, id_col, text_col).agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).first()
        held = chunks.select(F.col(id_col).cast("long").alias("row_id"), tokens(F.col(text_col)).alias("t"))
        rows = held.select("row_id", F.size("t").cast("long").alias("dl"), F.explode("t").alias("tok"))
        found = rows.join(asked.select("tok").distinct(), "tok", "left_semi").groupBy("tok", "row_id").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))
        index = Lexical(found, document_frequency(found), stats["n"], stats["avgdl"] or 1.0)
    found, frequencies = index.postings, index.frequencies
    # the query's side of the sum is small and is finished before it meets the postings
    idf = F.log(1 + (F.lit(index.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.join(frequencies, "tok").select("query_id", "tok", "qtf", idf.alias("idf"))
    part = F.col("qtf") * (F.col("idf") * F.col("tf") / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.lit(float(index.avgdl or 1.0)))))
    scored = found.join(weighed, "tok").groupBy("query_id", "row_id").agg(F.sum(part).alias("score"))
    return ranked(scored, k)


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """[T2, W1] The k best of (query_id, row_id, score), 0-based ``rank``."""
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "row_id")
    return scored.withColumn("rank", (F.row_number().over(order) - 1).cast("long")).where(F.col("rank") < k).select("query_id", "row_id", "rank", F.round("score", 6).alias("score"))
