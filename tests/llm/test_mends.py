"""Digits of all scripts, sites with slashes, columns named as the operators name theirs, labels beyond the bound."""

import unicodedata

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chunkwright.llm import pii, quality

ZEROS = [c for c in range(0x660, 0x1FBFA) if unicodedata.decimal(chr(c), None) == 0 and all(unicodedata.decimal(chr(c + i), None) == i for i in range(10))]
SAMPLES = ["4111 1111 1111 1111", "219-09-9999", "+44 20 7946 0958", "(415) 555-0132", "192.168.10.24", "GB82 WEST 1234 5698 7654 32", "token=abc12345xyz", "jo.smith77@example.com"]


def in_script(text, zero):
    return "".join(chr(zero + int(c)) if c in "0123456789" else c for c in text)


@pytest.mark.parametrize("sample", SAMPLES)
def test_digits_of_every_script(sample):
    s = pii.Surrogates(b"k")
    plain = [(a, b, kind) for a, b, kind, _ in pii.find(f"see {sample} there")]
    assert plain
    assert len(ZEROS) > 40
    for zero in ZEROS:
        text = f"see {in_script(sample, zero)} there"
        found = pii.find(text)
        assert [(a, b, kind) for a, b, kind, _ in found] == plain, hex(zero)
        for a, b, kind, value in found:
            assert value == text[a:b]
            made = s.of(kind, value)
            assert made != value and made == in_script(s.of(kind, pii.fold(value)), zero) or not any(c.isdecimal() for c in value)
            assert s.form(kind, value) == s.form(kind, pii.fold(value))


def test_crash_of_other_digits(spark):
    card = in_script("4111 1111 1111 1111", 0x660)
    df = spark.createDataFrame([(1, f"pay {card} now"), (2, "nothing here")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in pii.surrogates(df, b"key").collect()}
    assert got[2] == "nothing here" and card not in got[1] and got[1].startswith("pay ") and any(0x660 <= ord(c) <= 0x669 for c in got[1])


def test_sites_with_slashes(spark):
    rows = [(1, "some text", "c", "a/b"), (2, "other text", "b/c", "a"), (3, "third", None, None), (4, "x", "", "")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(r["doc_id"] for r in quality.classify(d, labels).collect()) == [1, 2, 3, 4]


def test_labels_beyond_the_bound(spark):
    """Only labels that meet documents count, and the bound is kept where ids repeat."""
    good = "the house on the hill was old and quiet in the evening light of autumn"
    rows = [(i, "BUY!! NOW!! CHEAP!! " * 20 if i % 2 else f"{good} {i}") for i in range(200)] + [(0, good), (1, "BUY!! NOW!! CHEAP!! " * 20)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.range(100_000).select(F.col("id").alias("doc_id"), (1 - F.col("id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    low, _ = quality.fit(d, labels, max_labelled=60)
    odds = [low.odds(*quality.features(t)) for _, t in rows[:40]]
    assert min(odds[1::2]) > max(odds[::2])
    assert quality.fit(d, labels.where("doc_id > 5000")) is None


def test_pipeline_keeps_columns_of_its_own_names(spark, tmp_path):
    """Input columns named as working columns, and a map, come out as they went in."""
    names = ["_row_key", "_tokens", "_rate", "_sampled", "_topic", "_source", "_lang", "held0", "_lines", "low"]
    text = "a plain line of words that says nothing new but goes on for some while number"
    rows = [(i, f"{text} {'abcdefghijklmnop'[i] * 9} {'qrstuvwxyz'[i % 10] * 8}" if i < 15 else f"{text} {'a' * 9} {'q' * 8}", "en", "s", 10, *[f"{n} {i}" for n in names], {"k": str(i)}) for i in range(16)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names) + ", m map<string,string>")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, d, str(tmp_path)).collect()
        assert got and all(r[n] == f"{n} {r['doc_id']}" for r in got for n in names) and all(r["m"] == {"k": str(r["doc_id"])} for r in got), name
        assert len(got) == {"quality": 16, "lines": 16, "near_duplicates": len(got), "mix": len(got)}[name]
    assert corpus_pipeline.one_of_each(spark, d.union(d), str(tmp_path)).count() == corpus_pipeline.one_of_each(spark, d, str(tmp_path)).count() < 16
