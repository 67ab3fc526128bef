"""The pipeline stage by stage: what each may do to its input, and the whole run on a small corpus."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chunkwright.llm import common, mixing, ngram_join, quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    body = [" ".join(word() for _ in range(60)) for _ in range(80)]
    texts = [f"{b}\nCommon line of the site.\n{word()}" for b in body]
    texts += texts[:10] + [t.replace(t.split()[3], "zzz", 1) for t in texts[10:20]]
    texts += ["Common line of the site."] * 12 + ["BUY!! NOW!! " * 30 + word() for _ in range(20)] + [None, ""]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    p = tmp_path_factory.mktemp("pipe")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{p}/documents.parquet")
    spark.createDataFrame([(i, int("BUY" not in (t or "")), 0) for i, t in enumerate(texts) if i % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{p}/labels.parquet")
    return str(p)


def test_stages(spark, home):
    d = spark.read.parquet(f"{home}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mix", "pack"]
    good = corpus_pipeline.keep_good(spark, d, home)
    bad = {r[0] for r in quality.classify(d, spark.read.parquet(f"{home}/labels.parquet")).where("NOT keep").select("doc_id").collect()}
    assert good.columns == COLUMNS and {r[0] for r in good.select("doc_id").collect()} == set(range(d.count())) - bad
    assert sum("BUY" in (r["text"] or "") for r in good.collect()) <= 1
    lines = corpus_pipeline.drop_lines(spark, d, home)
    assert lines.columns == COLUMNS and lines.where(F.col("text").contains("Common line")).count() == 0
    assert lines.where("text IS NOT NULL AND n_chars <> length(text)").count() == 0 and lines.where("text IS NULL OR text = ''").count() == 2
    one = corpus_pipeline.one_of_each(spark, d, home)
    kept = {r["component_id"] for r in ngram_join.near_duplicates(d).collect()}
    assert one.columns == COLUMNS and {r[0] for r in one.select("doc_id").collect()} == kept
    mixed = corpus_pipeline.sample_to_targets(spark, d, home)
    assert mixed.columns == COLUMNS and mixed.count() == mixing.mix(d).where("_sampled").count() < d.count()
    packed = corpus_pipeline.pack_batches(spark, d, home)
    assert packed.select("doc_id").distinct().count() == d.count()


def test_copies_reach_the_join(spark):
    """Of a large group of exact copies one stays; documents of hot lines alone go, with blank lines or without."""
    many = [f"Shared line.\nown text number {i} of many" for i in range(12)]
    texts = ["first of the copies\nsecond of the copies"] * 15 + ["one more copy\n\nwith a gap"] * 15 + many + ["Shared line.", "Shared line.\n\n \t\n"]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    lines = corpus_pipeline.drop_lines(spark, d, "")
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == {i: t.removeprefix("Shared line.\n") for i, t in enumerate(texts[:42])}
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each(spark, lines, "").collect()} >= {0, 15} and corpus_pipeline.one_of_each(spark, lines, "").where("doc_id < 30").count() == 2


@pytest.mark.parametrize("most", [1000, -1])
def test_rows_of_one_id(spark, tmp_path, monkeypatch, most):
    """Repeated and null ids, clashing columns, ties and long texts: decisions go by row."""
    r = random.Random(4)
    text = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))
    a, b, c, e, long = text(50), text(50), text(50), text(50), text(30_000)
    rows = [(1, a), (2, a), (2, b), (7, c), (7, c), (None, e), (None, e), (None, b + " more"), (9, "BUY!! NOW!! " * 30 + "x"), (9, e + " x"), (11, long), (12, long + " tail"), (13, None), (13, None), (14, "")]
    d = spark.createDataFrame([(i, t, "en", "s", len(t or ""), f"mine {k % 2}", "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, row string, keep string")
    home = str(tmp_path)
    spark.createDataFrame([(i, int(i >= 120), 0) for i in range(100, 140)], "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    told = spark.createDataFrame([(i, text(60) if i >= 120 else "BUY!! NOW!! " * 30 + text(1), "en", "s", 0, "", "") for i in range(100, 140)], d.schema)
    both = d.union(told)
    good = corpus_pipeline.keep_good(spark, both, home)
    every = both.collect()
    alone = spark.createDataFrame([(x["doc_id"] if 100 <= (x["doc_id"] or 0) < 140 else 1000 + k, *x[1:]) for k, x in enumerate(every)], d.schema)
    verdict = {x["doc_id"]: x["keep"] for x in quality.classify(alone, spark.read.parquet(f"{home}/labels.parquet")).collect()}
    want = [str(x) for k, x in enumerate(every) if verdict[x["doc_id"] if 100 <= (x["doc_id"] or 0) < 140 else 1000 + k]]
    assert good.columns == d.columns and sorted(map(str, good.collect())) == sorted(want)
    assert sum("BUY" in x for x in want) <= 2 and any("doc_id=9," in x for x in want)
    monkeypatch.setattr(common, "BROADCAST_ROWS", most)
    one = corpus_pipeline.one_of_each(spark, d, home)
    assert one.columns == d.columns
    kept = sorted(((x["doc_id"], x["text"]) for x in one.collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (7, c), (9, "BUY!! NOW!! " * 30 + "x"), (9, e + " x"), (11, long), (13, None), (13, None), (14, "")], key=str)
    same = d.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id = 7")  # equal in every column
    assert corpus_pipeline.one_of_each(spark, same, home).count() == 1
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, d, home).columns == d.columns
    assert corpus_pipeline.pack_batches(spark, d, home).count() >= len(rows)


def test_run(spark, home):
    got = corpus_pipeline.run(spark, home)
    docs = spark.read.parquet(f"{home}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((x := stage(spark, docs, home)).collect(), x.schema)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
