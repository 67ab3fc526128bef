"""Packing into optimal length buckets.

Texts longer than ``max_tokens`` are cut into pieces, so the histogram of lengths over all documents has at most
``max_tokens`` cells and fits the driver whatever the input. A dynamic program over it picks the bucket boundaries with the
least padding; the optimum for c boundaries is monotone in its last cut, so divide and conquer needs
n log n steps a bucket. Inside a bucket every batch takes as many pieces as ``budget`` padded tokens hold.

Batches are numbered without bringing a bucket to one task: pieces fall into shards by a hash of their id, the shard sizes of
each bucket (known from one count) give every shard its first place, and a place divided by the batch's capacity is its
batch. Shards are as many as keep each to about ``shard_rows`` rows, so a bucket of any size is dealt evenly.

``pack`` counts words, or takes counts; ``token_batches`` encodes the texts by a vocabulary file and returns the batches themselves.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, table

MAX_TOKENS, BUDGET, BUCKETS, SHARD_ROWS = 4096, 65536, 16, 20000


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` buckets over sorted distinct lengths with the least total padding."""
    n = len(lengths)
    if n == 0:
        return []
    length = lengths.astype(np.int64)
    ahead = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    tokens = np.concatenate([[0], np.cumsum(counts.astype(np.int64) * length)])

    def cost(i: np.ndarray, j: int) -> np.ndarray:
        """Padding of one bucket over lengths i..j."""
        return length[j] * (ahead[j + 1] - ahead[i]) - (tokens[j + 1] - tokens[i])

    best = np.array([int(cost(np.array([0]), j)[0]) for j in range(n)], np.int64)
    cuts = []
    for _ in range(min(buckets, n) - 1):
        fresh, cut = np.empty(n, np.int64), np.zeros(n, np.int64)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j) + 1)
            total = cost(i, j) + np.where(i > 0, best[i - 1], 0)
            k = int(np.argmin(total))
            fresh[j], cut[j] = total[k], i[k]
            todo += [(low, j - 1, first, int(i[k])), (j + 1, high, int(i[k]), last)]
        best = fresh
        cuts.append(cut)
    ends, j = [], n - 1
    for cut in reversed(cuts):
        ends.append(int(length[j]))
        j = int(cut[j]) - 1
        if j < 0:
            return ends[::-1]
    return [int(length[j]), *ends[::-1]]


def token_count(text: str = "text"):
    """Words between blanks (09-0D and 20), the tokens that need no vocabulary file; null or empty text has none."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokens=None, max_tokens: int = MAX_TOKENS, budget: int = BUDGET, buckets: int = BUCKETS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(doc_id, piece, n_tokens, bucket, bucket_tokens, batch, slot)``, a row for each piece of each document.

    Piece p holds tokens p * max_tokens and on. ``bucket_tokens`` is the padded length, ``batch`` counts from 0 inside its
    bucket, ``slot`` inside its batch; batch * padded length never exceeds ``budget`` unless one piece alone does. ``tokens`` is
    a column that counts tokens (by default words). A document without tokens has one piece of length 0. Null ids and
    repeated ids are rows like others. No rows give none. Other columns are ignored, whatever their names.
    """
    counted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(tokens if tokens is not None else token_count(text_col), F.lit(0)).cast("long").alias("all_tokens"))
    pieces = counted.select("doc_id", "all_tokens", _pieces(F.col("all_tokens"), max_tokens))
    pieces = pieces.select("doc_id", "piece", F.least(F.lit(max_tokens).cast("long"), F.col("all_tokens") - F.col("piece") * max_tokens).alias("n_tokens"))
    return _placed(pieces, budget, buckets, shard_rows)


def _pieces(tokens, max_tokens: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(tokens / F.lit(max_tokens)).cast("long"), F.lit(1)) - 1)).alias("piece")


def token_batches(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, budget: int = BUDGET, buckets: int = BUCKETS, shard_rows: int = SHARD_ROWS, pad: int = -1) -> DataFrame:
    """``(bucket, batch, bucket_tokens, doc_ids, pieces, lengths, tokens)``: a row for each batch, its texts encoded by the
    byte-pair vocabulary file and padded to the bucket's length with ``pad``.

    A batch holds at most ``budget`` padded tokens unless one piece alone has more, so no row is larger. Slots are the
    places in the arrays. Null and empty texts have one piece without tokens. No rows give none.
    """
    from ..functions.bpe import Bpe

    encode = Bpe(docs.sparkSession, vocabulary).encode
    encoded = docs.select(F.col(id_col).cast("long").alias("doc_id"), encode(F.col(text_col).cast("string")).alias("t"))
    cut = encoded.select("doc_id", "t", _pieces(F.size("t"), max_tokens))
    ids = F.slice("t", (F.col("piece") * max_tokens + 1).cast("int"), F.lit(max_tokens))
    held = Stored(cut.select("doc_id", "piece", ids.alias("tokens")).withColumn("n_tokens", F.size("tokens").cast("long"))).df  # encoded once
    placed = _placed(held, budget, buckets, shard_rows)
    whole = F.concat("tokens", F.array_repeat(F.lit(pad), (F.col("bucket_tokens") - F.col("n_tokens")).cast("int")))
    rows = F.array_sort(F.collect_list(F.struct("slot", "doc_id", "piece", "n_tokens", whole.alias("tokens"))))
    batches = placed.groupBy("bucket", "batch", "bucket_tokens").agg(rows.alias("r"))
    return batches.select("bucket", "batch", "bucket_tokens", F.col("r.doc_id").alias("doc_ids"), F.col("r.piece").alias("pieces"), F.col("r.n_tokens").alias("lengths"), F.col("r.tokens").alias("tokens"))


def _placed(pieces: DataFrame, budget: int, buckets: int, shard_rows: int) -> DataFrame:
    """Pieces (doc_id, piece, n_tokens and what else they have) with bucket, bucket_tokens, batch and slot."""
    histogram = sorted((r["n_tokens"], r["n"]) for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    ends = boundaries(np.array([x for x, _ in histogram], np.int64), np.array([n for _, n in histogram], np.int64), buckets) or [0]
    sizes = [sum(n for x, n in histogram if (b == 0 or x > ends[b - 1]) and x <= end) for b, end in enumerate(ends)]
    shards = [max(1, -(-n // shard_rows)) for n in sizes]
    bucket = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e < F.col("n_tokens")))

    def of(values: list[int]):
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("bucket") + 1)

    placed = pieces.withColumn("bucket", bucket).withColumn("h", F.xxhash64("doc_id", "piece")).withColumn("shard", F.pmod("h", of(shards)))
    counts = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    # a bucket has n / shard_rows shards: few numbers, one window a bucket
    first = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", "shard", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket", "shard").orderBy("h", "doc_id", "piece", "n_tokens")
    ranked = placed.withColumn("r", F.row_number().over(inside)).join(starts, ["bucket", "shard"])
    capacity = of([max(1, budget // max(1, e)) for e in ends])
    place = F.col("start") + F.col("r") - 1
    return ranked.select(*pieces.columns, "bucket", of(ends).alias("bucket_tokens"), F.floor(place / capacity).cast("long").alias("batch"), (place % capacity).alias("slot"))


def op5(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
