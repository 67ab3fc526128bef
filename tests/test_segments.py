"""The segmented index against a fresh BM25 over the live rows."""

import random

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import index, segments

CHUNK = "row_id long, text string"


def words(r, n):
    return " ".join(f"w{min(int(r.paretovariate(0.6)), 400)}" for _ in range(n))


def hits(df):
    return sorted((r["query_id"], r["row_id"], r["rank"], r["score"]) for r in df.collect())


def same(spark, folder, rows, queries, k=5):
    commit = segments.open_commit(spark, folder)
    live = spark.createDataFrame(sorted(rows.items()) or [], CHUNK)
    assert commit.n == len(rows)
    got = hits(segments.search(queries, commit, k=k))
    want = hits(index.bm25_topk(queries, live, "query_id", "row_id", k=k)) if rows else []
    assert got == want
    df = {r["tok"]: r["df"] for r in commit.frequencies().collect()}
    assert df == {r["tok"]: r["df"] for r in index.frequencies(live).collect()}
    return got


@pytest.fixture(scope="module")
def queries(spark):
    r = random.Random(3)
    return spark.createDataFrame([(i, words(r, r.randint(1, 12))) for i in range(12)] + [(12, ""), (13, None), (14, "nowhere"), (15, "w1 w1 w2")], "query_id long, text string")


def test_upserts_deletes_and_compaction(spark, tmp_path, queries, monkeypatch):
    monkeypatch.setattr(segments, "SHARD_ROWS", 64)
    monkeypatch.setattr(segments, "BLOCK", 8)
    r, folder = random.Random(1), str(tmp_path / "index")
    rows = {i: words(r, r.randint(0, 60)) for i in range(400)}
    rows |= {401: rows[1], 402: rows[1], 403: ""}  # ties
    put = lambda d, **kw: segments.upsert(spark, folder, spark.createDataFrame(sorted(d.items()), CHUNK), **kw)
    assert put(rows).number == 0
    first = same(spark, folder, rows, queries)
    assert first
    assert put(rows).number == 0  # nothing changed: no commit
    changed = {i: words(r, 30) for i in range(0, 40)} | {1000 + i: words(r, 20) for i in range(30)}
    rows |= changed
    assert put(changed).number == 1
    same(spark, folder, rows, queries)
    put(changed)  # a replayed batch
    assert segments.open_commit(spark, folder).number == 1
    gone = spark.createDataFrame([(i,) for i in range(100, 180)] + [(99999,)], "row_id long")
    segments.upsert(spark, folder, spark.createDataFrame([], CHUNK), removed=gone)
    rows = {k: v for k, v in rows.items() if not 100 <= k < 180}
    before = same(spark, folder, rows, queries)
    live = segments.compact(spark, folder)
    assert len(live.segments) == 1 and not live.deletes and same(spark, folder, rows, queries) == before
    rows = {k: v for k, v in rows.items() if k % 2}
    put(rows, whole=True)  # what isn't there any more goes
    same(spark, folder, rows, queries)
    put({}, whole=True)
    same(spark, folder, {}, queries)


def test_only_changed_rows_are_tokenised(spark, tmp_path):
    folder = str(tmp_path / "index")
    rows = spark.range(200).select(F.col("id").alias("row_id"), F.concat(F.lit("some text "), "id").alias("text"))
    segments.upsert(spark, folder, rows, unique=True)
    later = segments.upsert(spark, folder, rows.withColumn("text", F.when(F.col("row_id") == 7, "new").otherwise(F.col("text"))), unique=True)
    assert spark.read.parquet(f"{folder}/{later.segments[-1]}/rows").count() == 1


def test_repeated_and_null_ids(spark, tmp_path, queries):
    folder = str(tmp_path / "index")
    rows = spark.createDataFrame([(1, "w1 a"), (1, "w1 b"), (None, "w1"), (2, None)], CHUNK)
    assert segments.upsert(spark, folder, rows).n == 2 == segments.upsert(spark, folder, rows.limit(0)).n


def test_blocks_stay_packed(spark, tmp_path):
    """Rare words set the floor; the long lists of frequent words are then unpacked only where a row already met lies."""
    folder = str(tmp_path / "index")
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(("the", "of", "and", "to")) for _ in range(30)) + (f" rare{i % 40} rarer{i % 40}" if i < 400 else "")) for i in range(6000)]
    chunks = spark.createDataFrame(rows, CHUNK)
    commit = segments.upsert(spark, folder, chunks, unique=True)
    queries = spark.createDataFrame([(i, f"the rare{i} of rarer{i} and") for i in range(40)], "query_id long, text string")
    assert hits(segments.search(queries, commit, k=3)) == hits(index.bm25_topk(queries, chunks, "query_id", "row_id", k=3))
    used = segments.search(queries, commit, k=3, report=True).first()
    assert 0 < used["unpacked"] < 0.2 * used["postings"]


def test_shards_are_bounded_by_tokens_and_texts_stay_in_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "SHARD_TOKENS", 100)
    monkeypatch.setattr(segments, "SLICE_ROWS", 3)
    rows = [(i, " ".join(f"t{j % (i + 2)}" for j in range(i * 3))) for i in range(40)] + [(40, None), (41, "")]
    spark.createDataFrame(rows, "row_id long, text string").repartition(4).write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    commit = segments.upsert(spark, str(tmp_path / "index"), docs, unique=True)
    held = commit.table("rows").groupBy("shard").agg(F.sum("dl").alias("dl"), F.count("*").alias("n"), F.max("place").alias("p"), F.min("dl").alias("least")).collect()
    assert len(held) > 10 and all(r["dl"] <= 100 or r["n"] == 1 for r in held) and all(r["p"] == r["n"] - 1 for r in held)
    queries = spark.createDataFrame([(1, "t0 t1 t1"), (2, "t30"), (3, "t5 t17 none")], "query_id long, text string")
    assert sorted(map(tuple, segments.search(queries, commit).collect())) == sorted(map(tuple, index.bm25_topk(queries, docs.fillna(""), "query_id").collect()))
    assert commit.n == 42 and commit.total == docs.select(F.sum(F.size(F.filter(F.split("text", " "), lambda t: t != "")))).first()[0]
