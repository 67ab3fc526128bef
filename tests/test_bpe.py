from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chunkwright.functions.bpe import Bpe, rechunk

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary file here")


def test_round_trip(spark):
    bpe = Bpe(spark, VOCABULARY)
    texts = ["Hello world, it's 2025.", "déjà vu — ünïcode\n\n x", "", None]
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = d.select("text", bpe.count("text").alias("n"), bpe.decode(bpe.encode("text")).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in got) and [r["n"] > 0 for r in got] == [True, True, False, False]


def test_rechunk(spark):
    bpe = Bpe(spark, VOCABULARY)
    text = " ".join(f"word{i}" for i in range(700))
    d = spark.createDataFrame([(1, text), (2, "short"), (3, None)], "id long, text string")
    n = d.where("id = 1").select(bpe.count("text")).first()[0]
    got = rechunk(d, "id", bpe).orderBy("id", "part_index").collect()
    parts = [r for r in got if r["part_of"] == "1"]
    assert len(parts) == 1 + -(-(n - 800) // 700) and all(r["n_tokens"] <= 800 for r in parts)
    assert parts[0]["text"] == text[: len(parts[0]["text"])] and text.endswith(parts[-1]["text"].strip())
    assert [r["text"] for r in got if r["part_of"] is None] == ["short", ""]
    assert [r["id"] for r in got][:2] == ["1::p00", "1::p01"]
