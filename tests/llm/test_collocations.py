"""Phrase collocations against a plain count of every run of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkwright.llm import collocations
from chunkwright.llm.common import Stored

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, most=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UP)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    return f, n


def expected(rows, least, most=5):
    f, n = counted(rows, most)
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    lost = set()
    for (lang, w), a in cands.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * a >= 100 * f[lang, w[i:j]]:
                    lost.add((lang, w[i:j]))
    out = {}
    for (lang, w), a in cands.items():
        if (lang, w) in lost:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rs in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rs))]


def texts(seed, n=120):
    r = random.Random(seed)
    words = ["the", "of", "A", "b", "É", "c-d", "'", " x", "日本", "\x1c"]
    seps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!?"]
    out = [(r.choice(["en", "de", None, ""]), "".join(r.choice(words) + r.choice(seps) for _ in range(r.randint(0, 60)))) for _ in range(n)]
    phrase = "once upon a time in the"
    out += [("en", f"{phrase} {r.choice(words)}") for _ in range(30)] + [out[3]] * 25
    return [*out, ("en", None), (None, None), ("en", ""), ("en", " .\n"), ("en", "a b " * 3000), ("en", "y " * 2000)]


@pytest.mark.parametrize("least, most", [(5, 5), (20, 3), (2, 2), (10, 1)])
def test_against_brute_force(spark, least, most):
    rows = texts(least)
    df = spark.createDataFrame([(lang, t, "mine") for lang, t in rows], "lang string, text string, phrase string").repartition(3)
    got = [tuple(r) for r in collocations.collocations(df, least=least, most=most, block=50).collect()]
    assert sorted(got) == sorted(expected(rows, least, most)) and (got or most == 1)


def test_first_and_empty(spark):
    rows = texts(1)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = [tuple(r) for r in collocations.collocations(df, least=3, first=4).collect()]
    assert sorted(got) == sorted(x for x in expected(rows, 3) if x[1] <= 4)
    assert collocations.collocations(df.limit(0)).count() == 0


def test_full_bits_and_small_memory(spark, monkeypatch):
    """Bits that are all set and buckets that go to disk leave the counts as they are."""
    rows = texts(2)
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "LEAST_BITS", 1 << 17)
    monkeypatch.setattr(collocations, "MOST_BITS", 1 << 17)
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 500)
    got = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in collocations.frequencies(df, least=1).collect() if r["phrase"]}
    assert got == dict(counted(rows)[0])
    many = spark.range(3_000_000).select(F.concat(F.lit("some long phrase number "), F.col("id") % 1_000_000).alias("phrase"), F.lit("en").alias("lang"), F.lit(2).cast("long").alias("n")).select("lang", "phrase", "n")
    monkeypatch.setattr(collocations, "MEMORY", "24MB")
    sums = collocations.bucket_counts(many, 6, 2)
    assert sums.agg(F.count("*"), F.min("n"), F.max("n")).first() == (1_000_000, 6, 6)


def test_bits(spark):
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    bits = collocations.Bits(Stored(spark.createDataFrame([(int(x),) for x in h], "h long")).df)
    other = np.random.default_rng(2).integers(0, 2**64 - 1, 100_000, dtype=np.uint64)
    assert bits.test()(h.view(np.uint64)).all() and bits.test()(other).mean() < 0.05


def test_texts_are_cut_in_slices():
    """A batch's text is never copied as a whole: pieces come slice by slice, each from its own rows."""
    import pyarrow as pa

    rows = [("en" if i % 2 else "de", None if i % 7 == 0 else f"A  b{i % 5}. c\td!") for i in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    made = list(collocations._cut(iter([batch.slice(3)])))
    assert len(made) == -(-2497 // collocations.CUT_ROWS)
    got, want = {}, {}
    for b in made:
        for r in b.to_pylist():
            got[r["lang"], r["piece"]] = got.get((r["lang"], r["piece"]), 0) + r["m"]
    for lang, text in rows[3:]:
        for piece in (f"a {text.split()[1][:-1]}", "c d") if text else ():
            want[lang, piece] = want.get((lang, piece), 0) + 1
    assert got == want
