"""A fitted encoder [C11]: latent semantic vectors by a randomised singular value decomposition over hashed tf-idf.

Tokens fall into ``SLOTS`` slots, so the model's size doesn't grow with the corpus. The rows of the matrix A are texts, brought to unit length. Each pass over the
texts adds up A'(A Q) for a block Q of a few more directions than wanted: a task sums its own texts, the partial sums are added by range of
slots, and only the sum, SLOTS x directions numbers, reaches the driver, which makes its columns orthogonal. Texts are never gathered.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens

SLOTS, DIM, SPARE, PASSES, SEED, RANGES, SLICE_ROWS = 1 << 14, 64, 16, 3, 7, 16, 2048


def slot(token: str) -> int:
    return zlib.crc32(token.encode()) % SLOTS


def sparse(texts: pa.ListArray | list[list[str] | None], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the texts' rows: (1 + log tf) idf, brought to unit length. A distinct token is hashed once."""
    texts = pa.array(texts, pa.list_(pa.string())) if isinstance(texts, list) else texts
    words = texts.flatten().dictionary_encode()
    slots = np.fromiter((slot(t) for t in words.dictionary.to_pylist()), np.int64, len(words.dictionary))
    at = pc.list_parent_indices(texts).to_numpy().astype(np.int64) * SLOTS + slots[words.indices.to_numpy()]
    at, tf = np.unique(at, return_counts=True)
    row, col = np.divmod(at, SLOTS)
    val = (1 + np.log(tf)) * idf[col]
    norm = np.sqrt(np.bincount(row, val * val, minlength=len(texts)))[row]
    had = norm > 0
    return row[had], col[had], val[had] / norm[had]


def times(row: np.ndarray, col: np.ndarray, val: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    """The sparse rows times q, row by row in order."""
    out = np.zeros((n, q.shape[1]))
    if len(row):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        for lo in range(0, len(first), 16):  # a few rows at a time stay in a core's cache
            a, b = first[lo], first[lo + 16] if lo + 16 < len(first) else len(row)
            out[row[first[lo : lo + 16]]] = np.add.reduceat(val[a:b, None] * q[col[a:b]], first[lo : lo + 16] - a, axis=0)
    return out


class LsaEncoder:
    """Texts to vectors of unit length; a text without known tokens is the zero vector."""

    def __init__(self, idf: np.ndarray, basis: np.ndarray, values: np.ndarray):
        self.idf, self.basis, self.values, self.dim = idf, basis, values, basis.shape[1]

    def encode(self, texts: list[str]) -> np.ndarray:
        import re

        out = times(*sparse([re.findall("[a-z0-9]{2,}", (t or "").lower()) for t in texts], self.idf), self.basis, len(texts))
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm > 0, norm, 1)).astype(np.float32)

    def to_bytes(self) -> bytes:
        held = io.BytesIO()
        np.savez_compressed(held, idf=self.idf, basis=self.basis, values=self.values)
        return held.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> LsaEncoder:
        held = np.load(io.BytesIO(data))
        return cls(held["idf"], held["basis"], held["values"])

    @property
    def name(self) -> str:
        """The content key: vectors of another model are never taken from the cache."""
        digest = hashlib.sha256()
        for x in (self.idf, self.basis):
            digest.update(np.ascontiguousarray(x).tobytes())
        return f"lsa-{self.dim}-{digest.hexdigest()[:16]}"


def gram_times(texts: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(A q) for the texts (one column of token lists): a slots x directions sum."""
    spark, width = texts.sparkSession, q.shape[1]
    sent = spark.sparkContext.broadcast((idf, q))
    step = SLOTS // RANGES

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, held = sent.value
        total = np.zeros((SLOTS, width))
        for b in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            row, col, val = sparse(b.column(0), weights)
            y = times(row, col, val, held, b.num_rows)
            order = np.argsort(col, kind="stable")
            row, col, val = row[order], col[order], val[order]
            first = np.flatnonzero(np.concatenate([[True], col[1:] != col[:-1]])) if len(col) else np.zeros(0, np.int64)
            for lo in range(0, len(first), 64):
                a, z = first[lo], first[lo + 64] if lo + 64 < len(first) else len(col)
                total[col[first[lo : lo + 64]]] += np.add.reduceat(val[a:z, None] * y[row[a:z]], first[lo : lo + 64] - a, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array([total[i * step : (i + 1) * step].tobytes() for i in range(RANGES)], pa.binary())], names=["i", "x"])

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(step * width)
        for b in batches:
            for x in b.column("x"):
                total += np.frombuffer(x.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "x"])

    made = texts.mapInArrow(part, "i int, x binary").groupBy("i").applyInArrow(add, "i int, x binary")
    got = {r["i"]: np.frombuffer(r["x"]) for r in made.collect()}  # RANGES rows, whatever the corpus
    return np.concatenate([got.get(i, np.zeros(step * width)) for i in range(RANGES)]).reshape(SLOTS, width)


def fit(chunks: DataFrame, text_col: str = "text", dim: int = DIM, passes: int = PASSES) -> LsaEncoder:
    """The first ``dim`` right singular directions and values. Null texts have no tokens; a corpus of fewer texts than directions gives zero values at the end."""
    held = chunks.select(tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    once = held.select(F.explode(F.array_distinct(F.transform("t", lambda x: F.crc32(x.cast("binary")) % SLOTS))).alias("s"))
    df = np.zeros(SLOTS)
    for r in once.groupBy("s").count().collect():  # a row a slot at most
        df[r["s"]] = r["count"]
    n = held.count()
    idf = np.log((1 + n) / (1 + df)) + 1
    q = np.linalg.qr(np.random.default_rng(SEED).normal(size=(SLOTS, dim + SPARE)))[0]
    for _ in range(passes):
        q = np.linalg.qr(gram_times(held, idf, q))[0]
    small = q.T @ gram_times(held, idf, q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:dim]
    basis = q @ turn[:, best]
    sign = np.sign(basis[np.abs(basis).argmax(0), np.arange(basis.shape[1])])
    return LsaEncoder(idf, basis * np.where(sign == 0, 1, sign), np.sqrt(np.maximum(values[best], 0)))


def store_encoder(spark: SparkSession, encoder: LsaEncoder, folder: str) -> str:
    path = f"{folder}/{encoder.name}"
    spark.createDataFrame([(encoder.name, bytearray(encoder.to_bytes()))], "name string, model binary").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_encoder(spark: SparkSession, path: str) -> LsaEncoder:
    return LsaEncoder.from_bytes(bytes(spark.read.parquet(path).first()["model"]))
