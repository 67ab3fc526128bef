import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chunkwright.functions import text
from chunkwright.operators import audit, fold, index, retrieve, segment
from chunkwright.plans import dispatch


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_rrf(spark):
    a = df(spark, [(0, 1, 0), (0, 2, 1)], "query_id long, row_id long, rank long")
    b = df(spark, [(0, 2, 0), (0, 3, 1)], "query_id long, row_id long, rank long")
    got = {r["row_id"]: r["score"] for r in retrieve.rrf(a, b).collect()}
    assert got == {1: 1 / 61, 2: 1 / 62 + 1 / 61, 3: 1 / 62}


def test_rrf_tie(spark):
    a = df(spark, [(0, 9, 0)], "query_id long, row_id long, rank long")
    b = df(spark, [(0, 1, 0)], "query_id long, row_id long, rank long")
    top = retrieve.final_topk(retrieve.rrf(a, b)).orderBy("rank").collect()
    assert [r["row_id"] for r in top] == [9, 1]


@pytest.mark.parametrize("n,parts", [(0, 1), (800, 1), (801, 2), (1500, 2), (1501, 3)])
def test_window_counts(spark, n, parts):
    t = df(spark, [(7, " ".join(f"w{i}" for i in range(n)))], "id long, text string")
    got = segment.sliding_windows(t, "id", text.words(F.col("text"))).collect()
    assert len(got) == parts
    ends = [r["text"].split() for r in sorted(got, key=lambda r: r["part_index"] or 0)]
    assert all(a[-100:] == b[:100] for a, b in zip(ends, ends[1:], strict=False))
    assert n == 0 or ends[-1][-1] == f"w{n - 1}"


@pytest.mark.parametrize("n,sizes", [(320, [320]), (321, [220, 101]), (450, [220, 220, 10])])
def test_word_groups(spark, n, sizes):
    t = df(spark, [(1, " ".join(["w"] * n))], "id long, text string")
    got = segment.word_groups(t, "id").orderBy("group_index").collect()
    assert [len(r["text"].split()) for r in got] == sizes


def test_percentile(spark):
    t = df(spark, [(i,) for i in range(1, 11)], "v long")
    assert tuple(audit.rank_percentiles(t, [], "v", {"p": 0.5, "q": 0.99}).first()) == (10, 6, 10)
    assert tuple(audit.rank_percentiles(t.union(t), ["v"], "v", {"p": 0.5}).orderBy("v").first()) == (1, 2, 1)


def test_strip_overlap():
    cues = ["hi everyone so I gave", "hi everyone so I gave a 30-minute talk", "I gave a 30-minute talk on large language models", "language models"]
    assert [" ".join(x) for x in fold.strip_overlap([c.split() for c in cues])] == [cues[0], "a 30-minute talk", "on large language models", ""]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), max_size=8))
def test_strip_overlap_keeps_ends(cues):
    for cue, fresh in zip(cues, fold.strip_overlap(cues), strict=True):
        assert cue[len(cue) - len(fresh) :] == fresh


def test_threshold_windows(spark):
    t = df(spark, [(1, float(i), float(i), 1) for i in range(10)], "k long, s double, e double, w int")
    got = fold.threshold_windows(t, "k", "s", "e", "w", 3.0, 100).orderBy("window_index").collect()
    assert [(r["start"], r["end"], r["n"]) for r in got] == [(0, 3, 4), (4, 7, 4), (8, 9, 2)]
    assert sum(r["n"] for r in fold.threshold_windows(t, "k", "s", "e", "w", math.inf, 3).collect()) == 10


def test_nth_occurrence_and_sections(spark):
    filing = "Item 1. A\nItem 2. B\n" + "Item 1. A\n" + "x " * 150 + "\nItem 2. B\n" + "y " * 150
    t = df(spark, [(1, filing)], "id long, text string")
    got = segment.filing_sections(t, "id").orderBy("start").collect()
    assert [(r["item"], r["start"]) for r in got] == [("1", 20), ("2", filing.rindex("Item 2"))]
    assert got[0]["end"] == got[1]["start"] and got[0]["is_priority_section"] and not got[1]["is_priority_section"]


def test_as_of(spark):
    marks = df(spark, [(1, 100, "1"), (1, 500, "2")], "id long, start long, part string")
    rows = df(spark, [(1, 50), (1, 100), (1, 600)], "id long, start long")
    assert [r["part"] for r in segment.as_of(rows, marks, "id", "part", "1").orderBy("start").collect()] == ["1", "1", "2"]


def test_turns(spark):
    t = df(spark, [(1, 0, "Welcome."), (1, 1, "Operator: Hi."), (1, 2, "More."), (1, 3, "Ann Lee, CFO: A."), (1, 4, "Ann Lee, CFO: B."), (1, 5, " ")], "c long, n long, text string")
    got = segment.speaker_turns(t, "c", "n").orderBy("turn_index").collect()
    assert [(r["speaker_name"], r["speaker_role"], r["text"]) for r in got] == [("Preamble", "prepared", "Welcome."), ("Operator", "operator", "Hi. More."), ("Ann Lee", "cfo", "A. B.")]


def test_collapse(spark):
    t = df(spark, [(1, 0, 0, 1, "a"), (1, 1, 1, 2, "a"), (1, 2, 2, 3, "b"), (1, 3, 3, 4, "a")], "k long, o long, s long, e long, v string")
    got = segment.collapse_repeats(t, "k", "o", "v", "s", "e").orderBy("s").collect()
    assert [(r["v"], r["s"], r["e"]) for r in got] == [("a", 0, 2), ("b", 2, 3), ("a", 3, 4)]


def test_markdown_and_headings(spark):
    t = df(spark, [(1, "intro\n## A\nx\n### in\ny\n## B \n")], "id long, text string")
    got = segment.markdown_sections(t, "id").orderBy("section").collect()
    assert [(r["heading"], r["text"]) for r in got] == [("Overview", "intro"), ("A", "## A\nx\n### in\ny"), ("B", "## B")]
    h = segment.heading_sections(df(spark, [(1, "short Outlook is good"), (2, "none")], "id long, text string"), "id", "Outlook").collect()
    assert sorted((r["id"], r["heading"], r["text"]) for r in h) == [(1, "Outlook", "Outlook is good"), (2, "Document", "none")]


def test_shadowing(spark):
    o = df(spark, [("a", "x"), ("b", "x")], "dir string, stem string")
    s = df(spark, [("a", "x")], "dir string, stem string")
    key = lambda d: sorted((r["dir"], r["kind"]) for r in d.collect())
    assert key(audit.unshadowed(o, s)) == [("a", "rechunked"), ("b", "chunks")]
    assert key(audit.unshadowed(o, s, by_stem=True).select("dir", "stem", "kind")) == [("a", "rechunked")]


def test_cache(spark, tmp_path):
    """Each missing text is encoded once, in this run and in the next."""
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<double>")
    def encode(s: pd.Series) -> pd.Series:
        calls.add(len(s))
        return s.map(lambda x: [len(x) + 1.0])

    texts = df(spark, [("k1", "a"), ("k2", "bb"), ("k2", "bb")], "key string, text string")
    for run, rows in enumerate((texts, texts.union(df(spark, [("k3", "ccc")], "key string, text string")))):
        got = audit.with_cache(rows, f"{tmp_path}/cache", encode)
        assert got.count() == rows.count() and {(r["key"], *r["embedding"]) for r in got.collect()} == {("k1", 2.0), ("k2", 3.0), ("k3", 4.0)} - ({("k3", 4.0)} if not run else set())
        assert calls.value == 2 + run


def test_names():
    retrieve.validate_names(["a"], ["a", "b"])
    with pytest.raises(ValueError, match="c"):
        retrieve.validate_names(["a", "c"], ["a", "b"])


def test_signoff(spark):
    t = df(spark, [("ab END cd END",), ("none",)], "x string")
    assert [r[0] for r in t.select(segment.cut_after(F.col("x"), "END")).collect()] == ["ab END", "none"]


def test_cut_pages(spark):
    rows = [("a", i, f"page {i}" + (" END tail" if i in (3, 4) else "")) for i in range(1, 8)] + [("b", i, "" if i <= 10 else "x") for i in range(1, 31)]
    rows += [("c", 1, "yours"), ("c", 2, None), ("c", 3, "E"), ("c", 4, "ND of it"), ("d", 1, "E"), ("d", 2, "ND"), ("d", 3, "END")]
    got = {r["k"]: tuple(r)[1:] for r in segment.cut_pages(df(spark, rows, "k string, n long, t string"), "k", "n", "t", r"E\n?ND").collect()}
    assert got["a"] == (3, True, "page 1\npage 2\npage 3 END")
    assert got["b"] == (15, False, "\n" * 10 + "x\nx\nx\nx\nx")  # blank pages count
    assert got["c"] == (4, True, "yours\n\nE\nND") and got["d"] == (2, True, "E\nND")  # over a page break


def test_turn_numbers(spark):
    t = df(spark, [("c", i, x) for i, x in enumerate(["hello", "Ann Lee:", "Bob Ray: yes", "and more", "Ann Lee: no"])], "k string, n long, text string")
    got = sorted(segment.speaker_turns(t, "k", "n").collect(), key=lambda r: r["turn_index"])
    assert [(r["turn_index"], r["speaker_name"], r["text"]) for r in got] == [(0, "Preamble", "hello"), (1, "Bob Ray", "yes and more"), (2, "Ann Lee", "no")]


def test_transcript():
    cues = [(0.0, 2.0, "so this is"), (1.0, 4.0, "so this is a 30-minute talk"), (3.0, 5.0, "30-minute talk"), (4.0, 90.0, "talk on large models"), (91.0, 92.0, "end")]
    assert fold.transcript(cues) == [(0.0, 90.0, "so this is a 30-minute talk on large models"), (91.0, 92.0, "end")]
    assert fold.transcript(cues, most_size=3)[0] == (0.0, 2.0, "so this is")
    assert fold.transcript([(0.0, 1.0, "")]) == [] and fold.transcript([]) == []


def test_dispatch(spark):
    vtt = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nhello there\n\n00:00:02.000 --> 00:00:03.000\nhello there you\n"
    rows = [("pdf", "a", "one\ftwo"), ("letter", "b", "hi\nSincerely, me\fannex"), ("html", "c", "<p>x</p>"), ("markdown", "d", "## H\ntext"), ("transcript", "e", "Ann Lee: hi\nthere"), ("vtt", "f", vtt), ("odd", "g", "x"), (None, "h", "y")]
    got = dispatch.dispatch(df(spark, rows, "format string, key string, text string"))
    assert sorted((r["format"], r["key"], r["part"], r["heading"], r["text"]) for r in got.collect() if r["format"] not in ("pdf", "letter", "html")) == [("markdown", "d", 1, "H", "## H\ntext"), ("transcript", "e", 0, "Ann Lee", "hi there"), ("vtt", "f", 0, "f::w000", "hello there you")]
    assert sorted((r["key"], r["part"], r["text"]) for r in got.collect() if r["format"] in ("pdf", "letter", "html")) == [("a", 1, "one"), ("a", 2, "two"), ("b", 0, "hi\nSincerely,"), ("c", 0, "x")]
    assert dispatch.dispatch(df(spark, rows, "format string, key string, text string"), {}).count() == 0


def test_dense_parts(spark, monkeypatch):
    r = np.random.default_rng(0)
    v = df(spark, [(i, [float(x) for x in r.normal(size=4)]) for i in range(300)], "row_id long, embedding array<float>")
    asked = v.where("row_id < 20").withColumnRenamed("row_id", "q")
    want = sorted(map(tuple, retrieve.dense_topk(asked, v, "q", "row_id", k=5).collect()))
    monkeypatch.setattr(retrieve, "VECTOR_PART", 40)
    monkeypatch.setattr(retrieve, "QUERY_BLOCK", 7)
    assert sorted(map(tuple, retrieve.dense_topk(asked, v, "q", "row_id", k=5).collect())) == want


def engine(spark):
    chunks = [(0, "c0", "regulation", "Act", "http://a/x.pdf", 2, None, "body", "High risk AI systems in the act"), (1, "c1", "letters", "Letter", "http://a/l", None, None, "body", "A shareholder letter about AI systems"), (2, "c1", "letters", "Later", "http://a/m", None, None, "body", "Another shareholder letter")]
    c = df(spark, chunks, "row_id long, id string, corpus string, doc_title string, source_url string, slide_number long, t_start_seconds long, section_path string, text string")
    v = df(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.6, 0.8])], "row_id long, embedding array<float>")
    return retrieve.Engine(c, v, lambda texts: [[1.0, 0.0] for _ in texts])


def test_engine(spark):
    e = engine(spark)
    hits = e.search("high risk systems", k=3).collect()
    assert len(hits) == 3 and "regulation" in {h["corpus"] for h in hits}
    fields = {"id", "corpus", "title", "source", "section_path", "citation_url", "citation_text", "citation_html", "snippet", "score"}
    assert fields <= set(hits[0].asDict())
    assert all(not h["citation_url"] or (h["citation_text"] and h["citation_html"]) for h in hits)
    scoped = e.search("shareholder letter", corpus="letters", k=2).collect()
    assert scoped and {h["corpus"] for h in scoped} == {"letters"}
    doc = e.fetch_doc("c1")
    assert doc["title"] == "Later" and doc["full_text"]
    with pytest.raises(KeyError):
        e.fetch_doc("nope")
    assert "_total" in e.warm_up()
    assert e.search("", k=2).count() == 2  # no tokens: the dense leg alone


def test_folds_run_over_batches_and_keys(spark):
    """Keys longer than an Arrow batch, null keys and short keys: the same as over lists, and no key is gathered as one frame."""
    rows = [(None if k == 3 else k, i, " ".join("abcab"[(i + j + k) % 5] for j in range(k % 4 + 1)) if i % 3 else "") for k in range(9) for i in range(40 if k == 2 else k)]
    t = df(spark, rows, "k long, i long, text string").repartition(3).withColumn("s", F.col("i").cast("double")).withColumn("w", F.lit(1))
    held = {k: sorted((i, x) for k2, i, x in rows if k2 == k) for k in {r[0] for r in rows}}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        cues, windows, spans = fold.rolling_overlap(t, "k", "i", "text"), fold.transcript_windows(t, "k", "s", "s", order="s"), fold.threshold_windows(t, "k", "s", "s", "w", 4.0, 100)
        assert not any("FlatMapGroups" in x._jdf.queryExecution().toString() for x in (cues, windows, spans))
        got = {(r["k"], r["i"]): r["text"] for r in cues.collect()}
        assert got == {(k, i): " ".join(f) for k, v in held.items() for (i, _), f in zip(v, fold.strip_overlap([x.split() for _, x in v]), strict=True) if f}
        got = {(r["k"], r["window_index"]): (r["id"], r["t_start_seconds"], r["t_end_seconds"], r["text"]) for r in windows.collect()}
        assert got == {(k, n): (f"{k}::w{n:03d}", *x) for k, v in held.items() for n, x in enumerate(fold.transcript([(float(i), float(i), x) for i, x in v]))}
        got = {(r["k"], r["window_index"]): (r["start"], r["end"], r["n"]) for r in spans.collect()}
        assert got == {(k, n // 5): (float(n), float(min(n + 4, len(v) - 1)), min(5, len(v) - n)) for k, v in held.items() for n in range(0, len(v), 5)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_bm25_without_an_index_scans(spark, monkeypatch):
    """The scan equals the join over postings, also with copies past the last place, texts without tokens, small slices and blocks; repeated ids go by the join."""
    import random

    from chunkwright.operators import index

    monkeypatch.setattr(index, "SLICE_ROWS", 7)
    monkeypatch.setattr(index, "BLOCK_CELLS", 20)
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(["the", "oak", "elm", "ash", "fir", "yew", "box", "x"]) for _ in range(n))
    same = text(9)
    rows = [(i, same if i % 4 == 0 else None if i % 9 == 1 else "" if i % 9 == 2 else text(i % 13)) for i in range(120)]
    chunks = df(spark, rows, "row_id long, text string").repartition(5)
    queries = df(spark, [(1, "the oak oak"), (2, "elm"), (3, "unheard"), (4, ""), (5, None), (6, "ash fir yew box the")], "q long, text string")

    def joined(c):
        rows = index.postings(c, "row_id").join(index.doc_lengths(c, "row_id").groupBy("row_id").agg(F.first("dl").alias("dl")), "row_id")
        stats = index.doc_lengths(c, "row_id").agg(F.count("*"), F.avg("dl")).first()
        return index.bm25_topk(queries, None, "q", k=10, index=index.Lexical(rows, index.document_frequency(index.postings(c, "row_id")), *stats))

    got = index.bm25_topk(queries, chunks, "q", k=10)
    assert "Join" not in got._jdf.queryExecution().toString()  # no pair of a query and a posting becomes a row
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined(chunks).collect())) and got.count() > 25
    twice = chunks.unionByName(chunks.where("row_id < 9"))
    assert {x["query_id"] for x in index.bm25_topk(queries, twice, "q", k=10).collect()} == {1, 2, 6}
    assert len(set(map(tuple, index.bm25_topk(queries, twice, "q", k=500).select("query_id", "row_id").collect()))) == index.bm25_topk(queries, twice, "q", k=500).count()
    assert index.bm25_topk(queries, chunks.where("false"), "q").count() == 0 and index.bm25_topk(queries.where("q > 2 AND q < 6"), chunks, "q").count() == 0
