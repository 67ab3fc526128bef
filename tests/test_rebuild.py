import json

import numpy as np

from chunkwright.functions.encode import HashEncoder
from chunkwright import serve
from chunkwright.operators import retrieve
from chunkwright.plans import rebuild


def test_encoder():
    v = HashEncoder().encode(["alpha beta", "beta alpha", "", "gamma"])
    assert np.allclose(v[0], v[1]) and not v[2].any() and abs(np.linalg.norm(v[3]) - 1) < 1e-6


def test_rebuild(spark, tmp_path):
    row = lambda i, corpus, text, **more: json.dumps({"id": i, "corpus": corpus, "doc_title": i.upper(), "source_url": f"http://x/{i}.pdf", "text": text, **more})
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.chunks.jsonl").write_text("\n".join([row("a", "letters", "shareholder letter " * 600, slide_number=3), row("b", "essays", "must not be encoded again")]))
    out = f"{tmp_path}/out"
    folder = rebuild.rebuild(spark, str(tmp_path / "in"), out, "t0")
    assert rebuild.current_build(spark, out) == folder
    meta = spark.read.parquet(f"{folder}/meta")
    ids = sorted(r["id"] for r in meta.collect())
    assert ids == ["a::p00", "a::p01", "b"]
    part = meta.where("id = 'a::p01'").first()
    assert part["part_of"] == "a" and part["n_tokens"] == 500 and part["citation_url"] == "http://x/a.pdf#page=3"
    manifest = json.loads(spark.read.text(f"{folder}/manifest").first()[0])
    assert manifest["counts"] == {"letters": 2, "essays": 1} and manifest["total"] == 3
    engine = rebuild.open_engine(spark, out)
    assert engine.search("shareholder letter", k=2).first()["corpus"] == "letters"
    assert engine.fetch_doc("b")["full_text"] == "must not be encoded again"
    asked = ['{"tool": "search", "query": "shareholder letter", "corpus": "letters", "k": 1, "request_id": 7}', "", '{"tool": "fetch_doc", "id": "b"}', '{"tool": "fetch_doc", "id": "zz"}', '{"tool": "x"}', "[1]", "{"]
    got = [json.loads(x) for x in serve.serve(engine, asked)]
    assert len(got) == 6 and got[0]["request_id"] == 7 and [h["corpus"] for h in got[0]["result"]] == ["letters"] and got[1]["result"]["id"] == "b"
    assert all("error" in x for x in got[2:])
    (tmp_path / "in/c.chunks.jsonl").write_text(row("c", "essays", "new text"))

    class Strict(HashEncoder):  # defined here, so that it travels with the plan
        def encode(self, texts):
            assert "must not be encoded again" not in texts
            return super().encode(texts)

    again = Strict()
    rebuild.rebuild(spark, str(tmp_path / "in"), out, "t1", encoder=again)
    latest = rebuild.current_build(spark, out)
    assert latest != folder and spark.read.parquet(f"{latest}/vectors").count() == 4 and spark.read.parquet(f"{folder}/vectors").count() == 3


def test_last_of_repeated_ids_extras_and_kept_numbers(spark, tmp_path):
    """Twenty ids, each twice, in two files: the later row counts. Unchanged chunks keep their numbers, so only new text enters the index."""
    (tmp_path / "in").mkdir()
    row = lambda i, text, **more: json.dumps({"id": f"d{i}", "corpus": "letters", "doc_title": "T", "text": text, **more})
    (tmp_path / "in/a.chunks.jsonl").write_text("\n".join(row(i, f"first {i}", ticker="XYZ", fancy={"n": i}, tags=["a", i]) for i in range(20)))
    (tmp_path / "in/b.chunks.jsonl").write_text("\n".join(row(i, f"last {i}") for i in reversed(range(20))))
    out = f"{tmp_path}/out"
    folder = rebuild.rebuild(spark, str(tmp_path / "in"), out, "t0", cap=5, overlap=1)
    engine = rebuild.open_engine(spark, out)
    meta = spark.read.parquet(f"{folder}/meta")
    last = {r["id"]: r["full_text"] for r in retrieve.last_of_id(meta, order="ordinal").collect()}
    assert last == {f"d{i}": f"last {i}" for i in range(20)} and all(engine.fetch_doc(f"d{i}")["full_text"] == f"last {i}" for i in (0, 7, 19))
    assert [r["i"] for r in meta.selectExpr("try_variant_get(extra, '$.fancy.n', 'int') AS i", "text").where("i >= 18").orderBy("i").collect()] == [18, 19]
    assert meta.where("extra IS NULL").count() == 20 and meta.where("variant_get(extra, '$.ticker', 'string') IS NOT NULL").count() in (0, 20)
    (tmp_path / "in/a.chunks.jsonl").write_text("\n".join(row(i, f"first {i}" if i != 4 else "quite other words than before, many of them") for i in range(1, 20)))
    later = rebuild.rebuild(spark, str(tmp_path / "in"), out, "t1", cap=5, overlap=1)
    now = spark.read.parquet(f"{later}/meta")
    kept = meta.join(now, ["id", "text"]).select(meta["row_id"], now["row_id"].alias("new")).collect()
    assert len(kept) == 38 and all(r["row_id"] == r["new"] for r in kept)
    commit = rebuild.segments.open_commit(spark, f"{out}/index")
    assert spark.read.parquet(f"{out}/index/{commit.segments[-1]}/rows").count() == now.where("id LIKE 'd4::p%'").count() == 2
    assert commit.n == now.count() == 40 and rebuild.segments.open_commit(spark, f"{out}/index", 0).n == 40
    record = spark.read.schema(rebuild.BUILD).json(f"{out}/builds").orderBy("seq").collect()
    assert [r["commit"] for r in record] == [0, 1] and record[1]["metrics"]["chunks"] == 40 and record[1]["metrics"]["parts"] == 2 and record[0]["metrics"]["thin"] == 40
    assert rebuild.open_engine(spark, out).search("quite other words", k=1).first()["id"].startswith("d4::p")


def test_fitted_encoder_is_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = lambda i, text: json.dumps({"id": f"d{i}", "corpus": "letters", "doc_title": "T", "text": text})
    (tmp_path / "in/a.chunks.jsonl").write_text("\n".join(row(i, f"{'river water boat' if i % 2 else 'court judge law'} word{i}") for i in range(30)))
    out = f"{tmp_path}/out"
    rebuild.rebuild(spark, str(tmp_path / "in"), out, "t0", encoder="fit")
    (tmp_path / "in/b.chunks.jsonl").write_text(row(99, "judge and river"))
    rebuild.rebuild(spark, str(tmp_path / "in"), out, "t1", encoder="fit")
    record = spark.read.schema(rebuild.BUILD).json(f"{out}/builds").orderBy("seq").collect()
    assert record[0]["encoder"] == record[1]["encoder"] and spark.read.parquet(f"{out}/cache").count() == 31
    engine = rebuild.open_engine(spark, out)
    assert int(engine.search("boat on the water", k=1).first()["id"][1:]) % 2 == 1
