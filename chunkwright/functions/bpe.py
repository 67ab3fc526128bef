"""[X18] Byte-pair tokens from a vocabulary file of ranks. The file is read once on the driver and sent to the workers."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.segment import CAP, OVERLAP, sliding_windows

# how public byte-level vocabularies cut text before merging (fixed value)
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_OPEN: dict[int, object] = {}


class Bpe:
    """Expressions over one vocabulary: ``encode`` (array of ids), ``decode`` and ``count``. Null text has no tokens."""

    def __init__(self, spark: SparkSession, path: str, pattern: str = PATTERN):
        sent = spark.sparkContext.broadcast((Path(path).read_bytes(), pattern))

        def encoding():
            key = id(sent)
            if key not in _OPEN:
                import tiktoken

                data, cut = sent.value
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
                _OPEN[key] = tiktoken.Encoding("vocabulary", pat_str=cut, mergeable_ranks=ranks, special_tokens={})
            return _OPEN[key]

        @F.pandas_udf("array<int>")
        def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            e = encoding()
            for s in texts:
                yield s.map(lambda t: e.encode_ordinary(t) if t else [])

        @F.pandas_udf("bigint")
        def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            e = encoding()
            for s in texts:
                yield s.map(lambda t: len(e.encode_ordinary(t)) if t else 0)

        @F.pandas_udf("string")
        def decode(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
            e = encoding()
            for s in ids:
                yield s.map(lambda x: e.decode([int(i) for i in x]))

        self.encode, self.decode, self.count = encode, decode, count


def rechunk(df: DataFrame, id_col: str, bpe: Bpe, text_col: str = "text", cap: int = CAP, overlap: int = OVERLAP) -> DataFrame:
    """[C8, W10] Windows of ``cap`` tokens by a real vocabulary; texts under the cap keep their own text.

    A window that starts or ends inside a character decodes to the replacement character there.
    """
    keyed = df.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_whole"))
    parts = sliding_windows(keyed.select("_key", bpe.encode(F.col("_whole")).alias("_ids")), "_key", F.col("_ids"), cap, overlap, join=" ")
    ids = F.transform(F.filter(F.split("text", " "), lambda x: x != ""), lambda x: x.cast("int"))
    read = parts.withColumn("text", bpe.decode(ids)).join(keyed, "_key")
    text = F.when(F.col("part_of").isNull(), F.coalesce("_whole", F.lit(""))).otherwise(F.col("text"))
    return read.select("id", "part_of", "part_index", "part_count", "n_tokens", text.alias("text"))
