import io
import json
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkwright.schema import CHUNK
from chunkwright.sources import readers, sinks
from chunkwright.streaming import jobs


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines))


def test_jsonl_scan(spark, tmp_path):
    row = lambda i: json.dumps({"id": i, "text": i})
    write(tmp_path / "a/x.chunks.jsonl", [row("old")])
    write(tmp_path / "a/x.rechunked.jsonl", [row("a1"), "", row("a2")])
    write(tmp_path / "b/x.chunks.jsonl", [row("b1")])
    write(tmp_path / "b/y.chunks.jsonl", [row("b2")])
    got = readers.jsonl_chunks(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [(r["row_id"], r["id"]) for r in got] == [(0, "a1"), (1, "a2"), (2, "b1"), (3, "b2")]
    compat = readers.jsonl_chunks(spark, str(tmp_path), by_stem=True).orderBy("row_id").collect()
    assert [r["id"] for r in compat] == ["a1", "a2", "b2"]


def test_manifests_csv_catalog(spark, tmp_path):
    write(tmp_path / "m/1/manifest.json", [json.dumps({"corpus": "c", "doc_id": "d", "files": [{"path": "p", "sha256": "s", "bytes": 3}]}, indent=1)])
    r = readers.manifests(spark, f"{tmp_path}/m/*/manifest.json").first()
    assert r["doc_id"] == "d" and r["files"][0]["bytes"] == 3
    write(tmp_path / "t.csv", ["Model,Note", 'M1,"a\nb"', " ,x"])
    assert [(r["Model"], r["Note"]) for r in readers.csv_rows(spark, f"{tmp_path}/t.csv", "Model").collect()] == [("M1", "a\nb")]
    write(tmp_path / "c.json", [json.dumps({"data": [{"id": "a"}, {"id": "b"}]})])
    got = readers.json_catalog(spark, f"{tmp_path}/c.json", T.StructType([T.StructField("id", T.StringType())]))
    assert sorted(r["m"]["id"] for r in got.collect()) == ["a", "b"]


def test_vtt(spark):
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.500 align:start position:0%\n<c>Hello</c>\nthere\n\nnote\n00:00:03.000 --> 00:00:04.000\n\n00:00:05.000 --> 00:00:06.000\nEnd"
    got = readers.vtt_cues(spark.createDataFrame([("v", vtt)], "k string, text string"), "k").orderBy("start").collect()
    assert [(r["start"], r["end"], r["text"]) for r in got] == [(1.0, 2.5, "Hello there"), (5.0, 6.0, "End")]


def office(files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return b.getvalue()


def test_office(spark, tmp_path):
    a = "http://schemas.openxmlformats.org/drawingml/2006/main"
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    slide = lambda t: f'<s xmlns:a="{a}"><a:p><a:r><a:t>{t}</a:t></a:r><a:r><a:t>!</a:t></a:r></a:p><a:p/></s>'
    (tmp_path / "x.pptx").write_bytes(office({"ppt/slides/slide1.xml": slide("One"), "ppt/notesSlides/notesSlide1.xml": slide("Note"), "ppt/slides/slide2.xml": slide("Two")}))
    (tmp_path / "x.docx").write_bytes(office({"word/document.xml": f'<d xmlns:w="{w}"><w:p><w:t> A </w:t></w:p><w:p><w:t> </w:t></w:p><w:p><w:t>B</w:t></w:p></d>'}))
    slides = readers.office_rows(readers.payloads(spark, f"{tmp_path}/*.pptx"), "pptx").orderBy("n").collect()
    assert [(r["n"], r["text"], r["notes"]) for r in slides] == [(1, "One!", "Note!"), (2, "Two!", "")]
    assert [r["text"] for r in readers.office_rows(readers.payloads(spark, f"{tmp_path}/*.docx"), "docx").orderBy("n").collect()] == ["A", "B"]


def test_sinks(spark, tmp_path):
    chunks = spark.createDataFrame([("a", "1", "x", "t1"), ("b", None, "y", None)], "id string, slide_number string, corpus string, text string")
    meta = sinks.meta_table(chunks)
    assert len(meta.columns) == len(CHUNK.fields) and meta.schema["slide_number"].dataType == T.LongType()
    assert [r["text"] for r in meta.orderBy("id").collect()] == ["t1", ""]
    sinks.write_parquet(meta, f"{tmp_path}/meta", ["corpus"])
    assert spark.read.parquet(f"{tmp_path}/meta").where("corpus = 'x'").count() == 1
    sinks.write_jsonl(chunks, f"{tmp_path}/j", ["corpus"])
    assert spark.read.json(f"{tmp_path}/j").count() == 2
    m = json.loads(sinks.index_manifest(chunks, "m", "now").first()[0])
    assert m["counts"] == {"x": 1, "y": 1} and m["total"] == 2
    sinks.archive(f"{tmp_path}/meta", f"{tmp_path}/m.tar.zst")
    assert "meta" in sinks.archive_names(f"{tmp_path}/m.tar.zst")[0]
    sinks.write_inventory(spark.createDataFrame([("b",), ("a",), ("b",)], "path string"), f"{tmp_path}/inv")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/inv").collect()] == ["a", "b"]


def test_sidecars(spark, tmp_path):
    p = f"{tmp_path}/side"
    docs = spark.createDataFrame([("a",), ("b",)], "doc string")
    parts = lambda n: spark.createDataFrame([("a", n, "x"), ("b", 2, "y")], "doc string, part_count long, text string")
    sinks.write_sidecars(parts(2), p, "doc", docs)
    assert spark.read.json(p).select("doc").distinct().count() == 2
    sinks.write_sidecars(parts(1), p, "doc", docs)
    assert [r["doc"] for r in spark.read.json(p).select("doc").distinct().collect()] == ["b"]


def test_delete_is_opt_in(spark, tmp_path):
    (tmp_path / "f").write_text("x")
    files = spark.createDataFrame([(f"{tmp_path}/f",)], "path string")
    assert sinks.delete_files(spark, files) == 1 and (tmp_path / "f").exists()
    assert sinks.delete_files(spark, files, apply=True) == 1 and not (tmp_path / "f").exists()


def test_stream_equals_batch(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    key = lambda d: sorted(map(tuple, d.collect()))
    s = jobs.stream(spark, small, "events.parquet", events.schema)
    assert key(jobs.run_once(jobs.tumbling_counts(s))) == key(jobs.tumbling_counts(events))


def test_stream_windows(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    s = jobs.stream(spark, small, "events.parquet", events.schema).select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("s"))
    got = jobs.run_once(jobs.threshold_windows(s, "user_id", "s", 86400.0, 5), "append").collect()
    from chunkwright.plans import catalog

    batch = {(r["user_id"], r["window_index"]): (r["start"], r["end"], r["n"]) for r in catalog.threshold_windows(spark, small).collect()}
    closed = {k: v for k, v in batch.items() if v[1] - v[0] >= 86400.0 or v[2] >= 5}  # open ones stay in the state
    assert {(r["user_id"], r["window_index"]): (r["start"], r["end"], r["n"]) for r in got} == closed


def test_stream_index(spark, tmp_path, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs.repartition(2).write.parquet(f"{tmp_path}/in")
    jobs.keep_index(jobs.stream(spark, str(tmp_path), "in", docs.schema), "doc_id", f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    from chunkwright.operators import index, segments

    asked = spark.read.parquet(f"{small}/benchmark.parquet")
    got = segments.search(asked, segments.open_commit(spark, f"{tmp_path}/out"), "item_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, index.bm25_topk(asked, docs, "item_id", "doc_id").collect()))
    seen = jobs.deduplicated(jobs.stream(spark, str(tmp_path), "in", docs.schema).withColumn("ts", F.current_timestamp()))
    got = [r["content_sha"] for r in jobs.run_once(seen.select("content_sha"), "append").collect()]
    assert sorted(got) == sorted(r[0] for r in docs.select(F.sha2("text", 256)).distinct().collect())
