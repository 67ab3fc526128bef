"""[C11, Y11] Text to vectors. Any object with ``encode(list[str])`` can stand in for the default."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

DIM = 64


class HashEncoder:
    """Tokens hashed to signed slots, summed and brought to unit length; a text without tokens is the zero vector."""

    def __init__(self, dim: int = DIM):
        self.dim = dim

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for row, text in zip(out, texts, strict=True):
            for token in re.findall("[a-z0-9]{2,}", (text or "").lower()):
                h = zlib.crc32(token.encode())
                row[h % self.dim] += 1 if h >> 31 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)


def encoder_udf(encoder=None):
    model = encoder or HashEncoder()

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(list(model.encode(s.fillna("").tolist())), index=s.index)

    return run
