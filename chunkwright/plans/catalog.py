"""Queries over the driver's tables, one or more for each operator, and the same in DuckDB SQL.

The tables stand in for corpora: documents for chunks (source is the corpus), embeddings for their vectors, benchmark for
queries, pages for web payloads, conversations for transcripts, events for cues, orders and the like for filings.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import citations, render, text
from ..functions import html as html_functions
from ..operators import audit, fold, index, longfold, lsa, retrieve, sections, segment, segments
from ..operators import vectors as stored_vectors
from ..sources import readers, sinks
from ..streaming import jobs
from . import dispatch

QUERIES = {}
SQL: dict[str, str] = {}

BOOSTS = {"src0": 1.40, "src1": 1.20, "src2": 1.05}
HEADINGS = r"Outlook|Summary|License"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOKENS = "list_filter(regexp_extract_all(lower({0}), '[a-z0-9]+'), lambda t: length(t) >= 2)"
WORDS = r"list_filter(string_split_regex({0}, '[ \t\n\r\f]+'), lambda w: w <> '')"

# ---------------------------------------------------------------- retrieval

BM25 = f"""
d AS (SELECT doc_id AS row_id, {TOKENS.format('text')} AS t FROM documents),
dl AS (SELECT row_id, len(t) AS dl FROM d), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
tf AS (SELECT tok, row_id, count(*) AS tf FROM (SELECT row_id, unnest(t) AS tok FROM d) GROUP BY ALL),
df AS (SELECT tok, count(*) AS df FROM tf GROUP BY tok),
q AS (SELECT query_id, tok, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({TOKENS.format('text')}) AS tok FROM benchmark) GROUP BY ALL),
bs AS (SELECT query_id, row_id, sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))) AS score
  FROM q JOIN tf USING (tok) JOIN df USING (tok) JOIN dl USING (row_id), st GROUP BY ALL),
bm AS (SELECT query_id, row_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, row_id) - 1 AS rank, round(score, 6) AS score FROM bs QUALIFY rank < 50)"""
DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))"
DENSE = f"""
ds AS (SELECT item_id AS query_id, e.vec_id AS row_id, {DOT.format('e.embedding', 'q.embedding')} AS score FROM benchmark b JOIN embeddings q ON q.vec_id = b.item_id, embeddings e),
de AS (SELECT query_id, row_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, row_id) - 1 AS rank, round(score, 6) AS score FROM ds QUALIFY rank < 50)"""
FUSED = """
fu AS (SELECT query_id, row_id, coalesce(1.0 / (60 + max(r0) + 1), 0) + coalesce(1.0 / (60 + max(r1) + 1), 0) AS score, max(r0) AS r0, max(r1) AS r1
  FROM (SELECT query_id, row_id, rank AS r0, NULL AS r1 FROM bm UNION ALL SELECT query_id, row_id, NULL, rank FROM de) GROUP BY ALL)"""
SNIPPET = "CASE WHEN length({0}) <= 240 THEN {0} ELSE rtrim(substr({0}, 1, 239)) || '…' END"


def _final(where: str) -> str:
    one = SNIPPET.format("line")
    return f"""WITH {BM25}, {DENSE}, {FUSED},
bo AS (SELECT query_id, row_id, source AS corpus, score * CASE source WHEN 'src0' THEN 1.40 WHEN 'src1' THEN 1.20 WHEN 'src2' THEN 1.05 ELSE 1.0 END AS score, r0, r1 FROM fu JOIN documents ON doc_id = row_id {where}),
fi AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, r0 ASC NULLS LAST, r1 ASC NULLS LAST, row_id) - 1 AS rank FROM bo QUALIFY rank < 6)
SELECT query_id, rank, row_id, corpus, {one} AS snippet, round(score, 6) AS score FROM (SELECT fi.*, array_to_string({WORDS.format('text')}, ' ') AS line FROM fi JOIN documents ON doc_id = row_id)"""


def _asked(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return table(spark, sf_dir, "benchmark").join(vectors, "item_id", "left")


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")


_BUILT: dict[tuple, object] = {}


def _state(spark, path: str) -> tuple:
    """Files of a table with their times and sizes: another state is another index."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((str(f.getPath()), f.getModificationTime(), f.getLen()) for f in fs.listStatus(p)))


def _built(spark, sf_dir, name: str, make):
    """What searches share: built by the first that needs it in an application and for a state of the table, read by the others."""
    key = (spark.sparkContext.applicationId, name, _state(spark, f"{sf_dir}/{name}.parquet"))
    if key not in _BUILT:
        _BUILT[key] = make(jobs.working_folder(spark, name))
    return _BUILT[key]


def _index(spark, sf_dir) -> segments.Commit:
    return _built(spark, sf_dir, "documents", lambda folder: segments.upsert(spark, folder, table(spark, sf_dir, "documents"), "doc_id", unique=True))


def _stored_vectors(spark, sf_dir) -> str:
    def make(folder: str) -> str:
        stored_vectors.store_vectors(_vectors(spark, sf_dir), folder)
        return folder

    return _built(spark, sf_dir, "embeddings", make)


@query(f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct FROM (SELECT doc_id, {TOKENS.format('text')} AS t FROM documents)")
def tokenize_counts(spark, sf_dir):
    t = text.tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


@query(f"WITH {BM25} SELECT tok, df FROM df")
def document_frequencies(spark, sf_dir):
    return index.frequencies(table(spark, sf_dir, "documents"))


@query(f"WITH {BM25} SELECT tok, row_id, tf FROM tf")
def postings(spark, sf_dir):
    return index.postings(table(spark, sf_dir, "documents"), "doc_id")


@query(f"WITH {BM25} SELECT * FROM bm")
def bm25_topk(spark, sf_dir):
    return segments.search(table(spark, sf_dir, "benchmark"), _index(spark, sf_dir), "item_id")


@query(f"WITH {BM25} SELECT tok, df FROM df")
def segment_index(spark, sf_dir):
    """A new index of the documents, and the frequencies that it holds: what building costs."""
    return segments.upsert(spark, jobs.working_folder(spark, "built"), table(spark, sf_dir, "documents"), "doc_id", unique=True).frequencies()


UPDATED = "SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN reverse(text) ELSE text END AS text FROM documents WHERE doc_id % 11 <> 5"


@query(f"WITH documents_now AS ({UPDATED}), {BM25.replace('FROM documents', 'FROM documents_now')} SELECT * FROM bm")
def segment_index_updated(spark, sf_dir):
    """[K3, J6] The index after a third of changes: rows changed and removed by delete vectors, then one segment of what is left."""
    folder = jobs.working_folder(spark, "updated")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    segments.upsert(spark, folder, docs, "doc_id", unique=True)
    now = docs.where("doc_id % 11 <> 5").withColumn("text", F.when(F.col("doc_id") % 7 == 3, F.reverse("text")).otherwise(F.col("text")))
    segments.upsert(spark, folder, now, "doc_id", whole=True, unique=True)
    return segments.search(table(spark, sf_dir, "benchmark"), segments.open_commit(spark, folder), "item_id")


@query(f"WITH {BM25} SELECT * FROM bm")
def bm25_topk_unindexed(spark, sf_dir):
    return index.bm25_topk(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id")


@query(f"WITH {DENSE} SELECT * FROM de")
def dense_topk(spark, sf_dir):
    return retrieve.dense_topk(_asked(spark, sf_dir).where("embedding IS NOT NULL"), _vectors(spark, sf_dir), "item_id", "row_id")


@query(f"WITH {DENSE} SELECT * FROM de")
def stored_vector_topk(spark, sf_dir):
    return stored_vectors.search_vectors(_asked(spark, sf_dir), _stored_vectors(spark, sf_dir), "item_id")


@query()
def fitted_encoder(spark, sf_dir):
    """[C11] The directions of an encoder fitted to the documents: each one's value, length, largest product with another, and how much of all rows the first ones hold."""
    docs = table(spark, sf_dir, "documents")
    model = lsa.fit(docs)
    products = model.basis.T @ model.basis
    other = abs(products - np.diag(np.diag(products))).max(0)
    rows = docs.where(F.exists(text.tokens(F.col("text")), lambda t: t.isNotNull())).count()  # rows have unit length
    shares = np.cumsum(model.values**2) / max(1, rows)
    found = [(i, float(v), float(products[i, i]), float(o), float(h)) for i, (v, o, h) in enumerate(zip(model.values, other, shares, strict=True))]
    return spark.createDataFrame(found, "direction long, singular_value double, squared_length double, largest_product double, held double")


@query(f"WITH {BM25}, {DENSE}, {FUSED} SELECT query_id, row_id, round(score, 9) AS score FROM fu")
def rrf_fuse(spark, sf_dir):
    return retrieve.rrf(bm25_topk(spark, sf_dir), dense_topk(spark, sf_dir)).select("query_id", "row_id", F.round("score", 9).alias("score"))


@query(_final(""))
def hybrid_search(spark, sf_dir):
    return retrieve.search_batch(_asked(spark, sf_dir), table(spark, sf_dir, "documents"), _vectors(spark, sf_dir), "item_id", "doc_id", "source", boosts=BOOSTS, index=_index(spark, sf_dir), stored=_stored_vectors(spark, sf_dir))


@query(_final("WHERE source IN ('src0', 'src1')"))
def hybrid_search_scoped(spark, sf_dir):
    return retrieve.search_batch(_asked(spark, sf_dir), table(spark, sf_dir, "documents"), _vectors(spark, sf_dir), "item_id", "doc_id", "source", boosts=BOOSTS, index=_index(spark, sf_dir), stored=_stored_vectors(spark, sf_dir), corpus=["src0", "src1"])


@query(f"SELECT doc_id, {SNIPPET.format('line')} AS snippet FROM (SELECT doc_id, array_to_string({WORDS.format('text')}, ' ') AS line FROM documents)")
def snippets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.snippet(F.col("text")).alias("snippet"))


META = "concat(source, '-', lang) AS id, doc_id AS row_id, CASE source WHEN 'src1' THEN 'youtube' WHEN 'src2' THEN 'lecturer/lectures' WHEN 'src3' THEN 'memes' ELSE source END AS corpus, concat('Doc <', doc_id, '>') AS doc_title, concat('http://x/', source, CASE WHEN source = 'src4' THEN '.PDF?v=1' ELSE '' END) AS source_url, n_chars AS slide_number, n_chars AS t_start_seconds, text"
ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
LABEL = "CASE WHEN {0} >= 3600 THEN printf('%d:%02d:%02d', {0} // 3600, {0} % 3600 // 60, {0} % 60) ELSE printf('%d:%02d', {0} // 60, {0} % 60) END"
CITED = f"""m AS (SELECT {META} FROM documents),
c0 AS (SELECT *, corpus NOT IN ('memes', 'youtube', 'lecturer/lectures') AND source_url LIKE '%.PDF?%' AS pdf FROM m),
c1 AS (SELECT *, CASE WHEN corpus = 'memes' THEN NULL WHEN pdf THEN source_url || '#page=' || slide_number ELSE source_url END AS citation_url,
  CASE WHEN corpus = 'memes' THEN NULL WHEN corpus = 'lecturer/lectures' THEN doc_title || ', slide ' || slide_number WHEN corpus = 'youtube' THEN doc_title || ', ' || {LABEL.format('t_start_seconds')} WHEN pdf THEN doc_title || ', p. ' || slide_number ELSE doc_title END AS citation_text FROM c0),
c AS (SELECT *, '<a href="' || {ESC.format('citation_url')} || '">' || {ESC.format('citation_text')} || '</a>' AS citation_html FROM c1)"""


def _meta(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(*[x.strip() for x in _split_columns(META)])


def _split_columns(columns: str) -> list[str]:
    out, depth, at, quoted = [], 0, 0, False
    for i, c in enumerate(columns):
        quoted ^= c == "'"
        depth += (c in "(" and not quoted) - (c in ")" and not quoted)
        if c == "," and not depth and not quoted:
            out.append(columns[at:i])
            at = i + 1
    return [*out, columns[at:]]


@query(f"WITH {CITED} SELECT row_id, citation_url, citation_text, citation_html FROM c")
def citations_built(spark, sf_dir):
    m = _meta(spark, sf_dir)
    c = citations.citation(F.col("corpus"), F.col("doc_title"), F.col("source_url"), F.col("slide_number"), F.col("t_start_seconds"))
    return m.select("row_id", c.alias("c")).select("row_id", F.col("c.url").alias("citation_url"), F.col("c.text").alias("citation_text"), F.col("c.html").alias("citation_html"))


@query(f"WITH {CITED} SELECT id, doc_title AS title, source_url AS source, citation_url, citation_text, citation_html, text AS full_text FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY row_id DESC) = 1")
def fetch_doc_last_wins(spark, sf_dir):
    return retrieve.last_of_id(_meta(spark, sf_dir))


@query(f"WITH {BM25}, {CITED} SELECT query_id, rank, id, corpus, doc_title AS title, source_url AS source, 'body' AS section_path, citation_url, citation_text, citation_html, {SNIPPET.format('line')} AS snippet, score FROM (SELECT bm.query_id, bm.rank, bm.score, c.*, array_to_string({WORDS.format('c.text')}, ' ') AS line FROM bm JOIN c USING (row_id))")
def hit_projection(spark, sf_dir):
    return retrieve.hits(bm25_topk(spark, sf_dir), _meta(spark, sf_dir).withColumn("section_path", F.lit("body")))


# ---------------------------------------------------------------- segmentation

@query(f"""WITH d AS (SELECT doc_id, {WORDS.format('text')} AS t FROM documents), n AS (SELECT *, len(t) AS n, CASE WHEN len(t) <= 800 THEN 1 ELSE 1 + CAST(ceil((len(t) - 800) / 700.0) AS BIGINT) END AS parts FROM d),
p AS (SELECT *, unnest(range(parts)) AS i FROM n)
SELECT doc_id, CASE WHEN parts > 1 THEN doc_id || '::p' || lpad(CAST(i AS VARCHAR), CAST(greatest(2, length(CAST(parts - 1 AS VARCHAR))) AS INTEGER), '0') ELSE CAST(doc_id AS VARCHAR) END AS id,
  CASE WHEN parts > 1 THEN CAST(doc_id AS VARCHAR) END AS part_of, CASE WHEN parts > 1 THEN i END AS part_index, CASE WHEN parts > 1 THEN parts END AS part_count,
  CAST(len(t[i * 700 + 1 : i * 700 + 800]) AS BIGINT) AS n_tokens, array_to_string(t[i * 700 + 1 : i * 700 + 800], ' ') AS text FROM p""")
def rechunk_windows(spark, sf_dir):
    return segment.sliding_windows(table(spark, sf_dir, "documents"), "doc_id", text.words(F.col("text")))


@query(f"""WITH d AS (SELECT doc_id, text, {WORDS.format('text')} AS t FROM documents), p AS (SELECT *, unnest(range(CASE WHEN len(t) <= 320 THEN 1 ELSE CAST(ceil(len(t) / 220.0) AS BIGINT) END)) AS i FROM d)
SELECT doc_id, i AS group_index, CASE WHEN len(t) <= 320 THEN text ELSE array_to_string(t[i * 220 + 1 : i * 220 + 220], ' ') END AS text FROM p""")
def word_groups(spark, sf_dir):
    return segment.word_groups(table(spark, sf_dir, "documents"), "doc_id")


@query("""WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) / 1000000.0 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, i, s AS first, s AS last, 1 AS n, 0 AS w, (1 >= 5) AS closed FROM e WHERE i = 1
  UNION ALL SELECT e.user_id, e.i, CASE WHEN r.closed THEN e.s ELSE r.first END, e.s, CASE WHEN r.closed THEN 1 ELSE r.n + 1 END, CASE WHEN r.closed THEN r.w + 1 ELSE r.w END,
    (e.s - CASE WHEN r.closed THEN e.s ELSE r.first END >= 86400 OR CASE WHEN r.closed THEN 1 ELSE r.n + 1 END >= 5) FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT user_id, CAST(w AS BIGINT) AS window_index, CAST(max(first) AS DOUBLE) AS "start", CAST(max(last) AS DOUBLE) AS "end", CAST(max(n) AS BIGINT) AS size, CAST(max(n) AS BIGINT) AS n FROM r GROUP BY user_id, w""")
def threshold_windows(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0).alias("s"), F.lit(1).alias("one"))
    return fold.threshold_windows(e.withColumn("e", F.col("s")), "user_id", "s", "e", "one", 86400.0, 5, ["s", "event_id"])


@query("""WITH RECURSIVE e AS (SELECT event_type, epoch_us(ts) / 1000000.0 AS s, 1 + event_id % 4 AS w, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT event_type, i, s AS first, s AS last, w AS total, 1 AS n, 0 AS k, w >= 40 AS closed FROM e WHERE i = 1
  UNION ALL SELECT event_type, i, first, s, total, n, k, s - first >= 21600 OR total >= 40 FROM (SELECT e.event_type, e.i, e.s, CASE WHEN closed THEN e.s ELSE first END AS first,
    CASE WHEN closed THEN e.w ELSE total + e.w END AS total, CASE WHEN closed THEN 1 ELSE n + 1 END AS n, k + CAST(closed AS INT) AS k FROM r JOIN e ON e.event_type = r.event_type AND e.i = r.i + 1))
SELECT event_type, CAST(k AS BIGINT) AS window_index, CAST(max(first) AS DOUBLE) AS "start", CAST(max(last) AS DOUBLE) AS "end", CAST(max(total) AS BIGINT) AS size, CAST(max(n) AS BIGINT) AS n FROM r GROUP BY event_type, k""")
def long_key_windows(spark, sf_dir):
    """[W7, W8] Five keys hold all events; blocks of 512 rows, so that each key is solved by many tasks."""
    s = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    e = table(spark, sf_dir, "events").select("event_type", "event_id", s.alias("s"), s.alias("e"), (1 + F.col("event_id") % 4).alias("w"))
    return longfold.threshold_windows(e, "event_type", "s", "e", "w", 21600.0, 40, ["s", "event_id"], jobs.working_folder(spark, "windows"), 512)


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_type(props) AS kind FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) >= 5""")
def variant_props(spark, sf_dir):
    """[D3, Y15] Extras kept as a variant, written and read again, then filtered by a field."""
    folder = jobs.working_folder(spark, "variant")
    table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("extra")).write.parquet(folder)
    held = spark.read.parquet(folder)
    k = F.try_variant_get("extra", "$.k", "bigint")
    return held.where(k >= 5).select("event_id", k.alias("k"), F.when(F.schema_of_variant("extra").startswith("OBJECT"), "OBJECT").alias("kind"))


@query("""WITH RECURSIVE m AS (SELECT epoch_ms(max(ts)) - 3600000 AS mark FROM events),
e AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events, m WHERE epoch_us(ts) // 1000 <= mark),
r AS (SELECT user_id, i, t AS first, t AS last, 1 AS n, 0 AS w, FALSE AS closed FROM e WHERE i = 1
  UNION ALL SELECT user_id, i, first, t, n, w, (t - first) / 1000000.0 >= 86400 OR n >= 5 FROM (SELECT e.user_id, e.i, e.t, CASE WHEN fresh THEN e.t ELSE first END AS first, CASE WHEN fresh THEN 1 ELSE n + 1 END AS n, w + CAST(fresh AS INT) AS w
    FROM (SELECT r.*, closed OR (x.t - last) / 1000000.0 > 21600 AS fresh FROM r JOIN e x ON x.user_id = r.user_id AND x.i = r.i + 1) r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1))
SELECT user_id, CAST(min(first) / 1000000.0 AS DOUBLE) AS "start", CAST(max(last) / 1000000.0 AS DOUBLE) AS "end", CAST(max(n) AS BIGINT) AS n FROM r, m GROUP BY user_id, w, mark
HAVING bool_or(closed) OR max(last) // 1000 + 21600001 <= mark OR w < (SELECT max(w) FROM r o WHERE o.user_id = r.user_id)""")
def idle_windows_stream(spark, sf_dir):
    """[W7] Through a stream: windows of a day or five events, given out on time-out after six idle hours."""
    events = jobs.stream(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema)
    return jobs.run_once(jobs.idle_windows(events, "user_id", "ts", 86400.0, 5, 21600.0), "append").select("user_id", "start", "end", "n")


@query(f"""WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
e AS (SELECT doc_id, i, len({WORDS.format('line')}) AS w FROM l),
r AS (SELECT doc_id, i, i AS first, w AS total, 1 AS n, 0 AS k, w >= 220 AS closed FROM e WHERE i = 0
  UNION ALL SELECT e.doc_id, e.i, CASE WHEN r.closed THEN e.i ELSE r.first END, CASE WHEN r.closed THEN 0 ELSE r.total END + e.w, CASE WHEN r.closed THEN 1 ELSE r.n + 1 END, r.k + CAST(r.closed AS INT), CASE WHEN r.closed THEN 0 ELSE r.total END + e.w >= 220
  FROM r JOIN e ON e.doc_id = r.doc_id AND e.i = r.i + 1)
SELECT doc_id, CAST(k AS BIGINT) AS window_index, CAST(max(first) AS DOUBLE) AS "start", CAST(max(i) AS DOUBLE) AS "end", CAST(max(total) AS BIGINT) AS size, CAST(max(n) AS BIGINT) AS n FROM r GROUP BY doc_id, k""")
def paragraph_packing(spark, sf_dir):
    held = segment.lines(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", F.col("line_no").cast("double").alias("a"), F.size(text.words(F.col("line"))).alias("w"))
    return fold.threshold_windows(held.withColumn("b", F.col("a")), "doc_id", "a", "b", "w", float("inf"), 220)


CUES = f"""d AS (SELECT doc_id, {WORDS.format('text')} AS w FROM documents),
c AS (SELECT doc_id, cue, w[cue * 5 + 1 : cue * 5 + 8] AS cue_words FROM (SELECT *, unnest(range(CAST(len(w) // 5 AS BIGINT) + 1)) AS cue FROM d))"""
OVERLAP = "list_max(list_filter(range(1, least(len(kept), len(cue_words), 30) + 1), lambda k: kept[len(kept) - k + 1 : len(kept)] = cue_words[1 : k]))"


@query(f"""WITH RECURSIVE {CUES},
r AS (SELECT doc_id, cue, cue_words AS fresh, cue_words AS kept FROM c WHERE cue = 0
  UNION ALL SELECT doc_id, cue, fresh, (kept || fresh)[greatest(1, len(kept) + len(fresh) - 29) : len(kept) + len(fresh)] FROM (
    SELECT doc_id, cue, kept, cue_words[coalesce({OVERLAP}, 0) + 1 : len(cue_words)] AS fresh FROM (SELECT c.doc_id, c.cue, c.cue_words, r.kept FROM r JOIN c ON c.doc_id = r.doc_id AND c.cue = r.cue + 1)))
SELECT doc_id, CAST(cue AS INTEGER) AS cue, array_to_string(fresh, ' ') AS text FROM r WHERE len(fresh) > 0""")
def overlap_strip(spark, sf_dir):
    return fold.rolling_overlap(_cues(spark, sf_dir), "doc_id", "cue", "text")


def _cues(spark, sf_dir) -> DataFrame:
    """Rolling cues of eight words, five further on each."""
    d = table(spark, sf_dir, "documents").select("doc_id", text.words(F.col("text")).alias("w"))
    return d.select("doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.size("w") / 5).cast("int"))).alias("cue"), "w").select("doc_id", "cue", F.array_join(F.slice("w", F.col("cue") * 5 + 1, 8), " ").alias("text"))


@query(f"""WITH RECURSIVE {CUES},
r AS (SELECT doc_id, cue, cue_words AS fresh, cue_words AS kept FROM c WHERE cue = 0
  UNION ALL SELECT doc_id, cue, fresh, (kept || fresh)[greatest(1, len(kept) + len(fresh) - 29) : len(kept) + len(fresh)] FROM (
    SELECT doc_id, cue, kept, cue_words[coalesce({OVERLAP}, 0) + 1 : len(cue_words)] AS fresh FROM (SELECT c.doc_id, c.cue, c.cue_words, r.kept FROM r JOIN c ON c.doc_id = r.doc_id AND c.cue = r.cue + 1))),
g AS (SELECT *, sum(CAST(len(fresh) > 0 AS INT)) OVER (PARTITION BY doc_id ORDER BY cue) AS g FROM r),
k AS (SELECT doc_id, g, CAST(min(cue) AS DOUBLE) AS s, CAST(max(cue) + 2 AS DOUBLE) AS e, arg_min(fresh, cue) AS words FROM g WHERE g > 0 GROUP BY doc_id, g),
t AS (SELECT doc_id, g, s AS first, e AS last, len(words) AS n, 0 AS w, e - s >= 75 OR len(words) >= 280 AS closed FROM k WHERE g = 1
  UNION ALL SELECT doc_id, g, first, last, n, w, last - first >= 75 OR n >= 280 FROM (SELECT k.doc_id, k.g, CASE WHEN closed THEN k.s ELSE first END AS first, k.e AS last,
    CASE WHEN closed THEN 0 ELSE n END + len(k.words) AS n, w + CAST(closed AS INT) AS w FROM t JOIN k ON k.doc_id = t.doc_id AND k.g = t.g + 1))
SELECT doc_id, doc_id || '::w' || lpad(CAST(w AS VARCHAR), CAST(greatest(3, length(CAST(w AS VARCHAR))) AS INTEGER), '0') AS id, CAST(w AS BIGINT) AS window_index, min(first) AS t_start_seconds, max(last) AS t_end_seconds,
  string_agg(array_to_string(words, ' '), ' ' ORDER BY g) AS text FROM t JOIN k USING (doc_id, g) GROUP BY doc_id, w""")
def transcript_windows(spark, sf_dir):
    cues = _cues(spark, sf_dir).select("doc_id", F.col("cue").cast("double").alias("start"), (F.col("cue") + 2).cast("double").alias("end"), "text")
    return fold.transcript_windows(cues, "doc_id")


@query(r"""WITH d AS (SELECT doc_id, text, CASE lang WHEN 'en' THEN 'pdf' WHEN 'de' THEN 'letter' WHEN 'fr' THEN 'html' ELSE 'unheard of' END AS format FROM documents),
p AS (SELECT *, unnest(string_split(text, chr(10))) AS page, unnest(range(len(string_split(text, chr(10))))) AS n FROM d WHERE format IN ('pdf', 'letter')),
l AS (SELECT doc_id, array_to_string(string_split(text, chr(10))[1:15], chr(10)) AS t FROM d WHERE format = 'letter')
SELECT format, doc_id AS key, n + 1 AS part, NULL::VARCHAR AS heading, page AS text FROM p WHERE format = 'pdf' AND trim(regexp_replace(page, '\s+', ' ', 'g')) <> ''
UNION ALL SELECT 'letter', doc_id, 0, NULL, CASE WHEN regexp_matches(t, '(?m)^Sincerely,') THEN regexp_extract(t, '(?ms)^(.*?^Sincerely,)', 1) ELSE t END FROM l
UNION ALL SELECT format, doc_id, 0, NULL, x FROM (SELECT format, doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'gs'), '[ 	

]+', ' ', 'g')) AS x FROM d WHERE format = 'html') WHERE x <> ''""")
def dispatch_formats(spark, sf_dir):
    kind = F.when(F.col("lang") == "en", "pdf").when(F.col("lang") == "de", "letter").when(F.col("lang") == "fr", "html").otherwise("unheard of")
    paged = F.when(F.col("lang").isin("en", "de"), F.replace("text", F.lit("\n"), F.lit("\f"))).otherwise(F.col("text"))
    return dispatch.dispatch(table(spark, sf_dir, "documents").select(kind.alias("format"), F.col("doc_id").alias("key"), paged.alias("text")))


@query("""WITH e AS (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events),
r AS (SELECT *, sum(CASE WHEN p IS NULL OR p <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY i) AS run FROM e)
SELECT user_id, CAST(run AS BIGINT) AS run, min(ts) AS first_ts, max(ts) AS last_ts, any_value(event_type) AS event_type, count(*) AS n FROM r GROUP BY user_id, run""")
def dedup_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("o", F.struct("ts", "event_id")).withColumn("first_ts", F.col("ts")).withColumn("last_ts", F.col("ts"))
    return segment.collapse_repeats(e, "user_id", "o", "event_type", "first_ts", "last_ts").select("user_id", "run", "first_ts", "last_ts", "event_type", "n")


@query("""WITH p AS (SELECT conv_id, turn, trim(replace(text, chr(10), ' ')) AS body, CASE role WHEN 'user' THEN 'Ann Lee' WHEN 'assistant' THEN 'Bob Ray' ELSE 'Operator' END AS name,
    CASE role WHEN 'user' THEN 'analyst' WHEN 'assistant' THEN 'ceo' ELSE 'operator' END AS role, turn % 3 = 2 AS cont FROM conversations WHERE trim(replace(text, chr(10), ' ')) <> ''),
f AS (SELECT *, coalesce(last_value(CASE WHEN NOT cont THEN name END IGNORE NULLS) OVER w, 'Preamble') AS who, coalesce(last_value(CASE WHEN NOT cont THEN role END IGNORE NULLS) OVER w, 'prepared') AS what FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(CASE WHEN lag_who IS NULL OR lag_who <> who OR lag_what <> what THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM (SELECT *, lag(who) OVER (PARTITION BY conv_id ORDER BY turn) AS lag_who, lag(what) OVER (PARTITION BY conv_id ORDER BY turn) AS lag_what FROM f))
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS turn_index, any_value(who) AS speaker_name, any_value(what) AS speaker_role, string_agg(body, ' ' ORDER BY turn) AS text FROM g GROUP BY conv_id, k""")
def speaker_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    head = F.when(F.col("role") == "user", "Ann Lee: ").when(F.col("role") == "assistant", "Bob Ray, Chief Executive Officer: ").otherwise("Operator: ")
    body = F.trim(F.replace("text", F.lit("\n"), F.lit(" ")))
    return segment.speaker_turns(c.where(body != "").select("conv_id", "turn", F.when(F.col("turn") % 3 == 2, body).otherwise(F.concat(head, body)).alias("text")), "conv_id", "turn")


FILING = "concat('Item 1. Business', chr(10), 'ITEM 1A - Risk', chr(10), 'Item 1. Business', chr(10), text, chr(10), 'Item 1A. Risk', chr(10), text, chr(10), 'PART II', chr(10), 'Item 1. Legal', chr(10), text)"
LINES = """f AS (SELECT doc_id, {0} AS x FROM documents), l AS (SELECT doc_id, x, unnest(string_split(x, chr(10))) AS line, unnest(range(len(string_split(x, chr(10))))) AS i FROM f),
s AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM l)"""
ITEM = r"'(?i)^\s*item\s+(\d+[A-Z]?)\.?\s*[—\-:]?\s*(.{0,200})$'"


def _sections(key: str, priority: str) -> str:
    return f"""WITH {LINES.format(FILING)}, it AS (SELECT doc_id, x, start, trim(line) AS heading, upper(regexp_extract(line, {ITEM}, 1)) AS item FROM s WHERE regexp_matches(line, {ITEM})),
pa AS (SELECT doc_id, start, '2' AS part FROM s WHERE regexp_matches(line, '(?i)^\\s*part\\s+(I|II|III|IV)\\b\\s*(.{{0,80}})$')),
ip AS (SELECT it.* EXCLUDE (item), {key} AS item FROM it ASOF LEFT JOIN pa ON it.doc_id = pa.doc_id AND it.start >= pa.start),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item ORDER BY start) AS r, count(*) OVER (PARTITION BY doc_id, item) AS c FROM ip QUALIFY r = least(c, 2)),
e AS (SELECT *, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), length(x)) AS e FROM r)
SELECT doc_id, item, CAST(start AS BIGINT) AS "start", CAST(e AS BIGINT) AS "end", heading, item IN ({priority}) AS is_priority_section, trim(substr(x, CAST(start AS BIGINT) + 1, CAST(e - start AS BIGINT))) AS text FROM e WHERE length(trim(substr(x, CAST(start AS BIGINT) + 1, CAST(e - start AS BIGINT)))) >= 200"""


@query(_sections("item", "'1', '1A', '7', '7A', '8'"))
def section_slices(spark, sf_dir):
    return segment.filing_sections(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{FILING} AS text"), "doc_id")


@query(_sections("'part' || coalesce(pa.part, '1') || '.' || item", "'part1.1', 'part1.2', 'part1.3', 'part1.4', 'part2.1', 'part2.1A'"))
def section_slices_quarterly(spark, sf_dir):
    return segment.filing_sections(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{FILING} AS text"), "doc_id", form="10-Q")


@query("""WITH m AS (SELECT user_id, epoch_us(ts) AS start, event_type AS mark FROM events WHERE event_type <> 'click' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_type DESC) = 1),
r AS (SELECT event_id, user_id, epoch_us(ts) AS start FROM events WHERE event_type = 'click')
SELECT r.event_id, r.user_id, coalesce(m.mark, '1') AS mark FROM r ASOF LEFT JOIN m ON r.user_id = m.user_id AND r.start >= m.start""")
def asof_part(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("start"))
    marks = e.where("event_type <> 'click'").groupBy("user_id", "start").agg(F.max("event_type").alias("mark"))
    return segment.as_of(e.where("event_type = 'click'").drop("event_type"), marks, "user_id", "mark", "1").select("event_id", "user_id", "mark")


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY o_custkey) AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) WHERE r = least(c, 2)")
def nth_occurrence(spark, sf_dir):
    return segment.second_or_only(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT o_custkey, o_orderkey AS \"start\", coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 99999999) AS \"end\" FROM orders")
def section_ends(spark, sf_dir):
    return segment.ends_of(table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("start")), "o_custkey", F.lit(99999999).cast("long"))


@query(r"""WITH d AS (SELECT doc_id, text AS x, string_split_regex(text, 'Outlook|Summary|License') AS b, regexp_extract_all(text, 'Outlook|Summary|License') AS h FROM documents),
p AS (SELECT *, unnest(range(len(b))) AS n FROM d), q AS (SELECT doc_id, n, h, b[n + 1] AS body FROM p)
SELECT doc_id, n AS section, CASE WHEN len(h) = 0 THEN 'Document' WHEN n = 0 THEN 'Preamble' ELSE h[n] END AS heading, trim(CASE WHEN n = 0 THEN body ELSE h[n] || body END) AS text FROM q WHERE n > 0 OR len(h) = 0 OR length(body) > 200""")
def heading_sections(spark, sf_dir):
    return segment.heading_sections(table(spark, sf_dir, "documents"), "doc_id", HEADINGS)


MARKDOWN = "concat(text, chr(10), '## First part', chr(10), text, chr(10), '### Inner', chr(10), text, chr(10), '## Second  part ', chr(10), 'end')"


@query(rf"""WITH f AS (SELECT doc_id, text, string_split({MARKDOWN}, chr(10)) AS ls FROM documents), l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS n FROM f),
o AS (SELECT *, regexp_matches(line, '^##\s+(.+?)\s*$') AND NOT starts_with(line, '###') AS opens FROM l), g AS (SELECT *, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY n) AS k FROM o)
SELECT doc_id, CAST(k AS BIGINT) AS section, coalesce(max(CASE WHEN opens THEN trim(regexp_extract(line, '^##\s+(.+?)\s*$', 1)) END), 'Overview') AS heading, regexp_replace(string_agg(line, chr(10) ORDER BY n), '^\s+|\s+$', '', 'g') AS text
FROM g GROUP BY doc_id, k HAVING regexp_replace(string_agg(line, chr(10) ORDER BY n), '\s+', '', 'g') <> ''""")
def markdown_sections(spark, sf_dir):
    return segment.markdown_sections(table(spark, sf_dir, "documents").selectExpr("doc_id", f"{MARKDOWN} AS text"), "doc_id")


@query(SQL["markdown_sections"])
def markdown_parts_sql(spark, sf_dir):
    """[X5] The same sections by a table function, called from SQL."""
    sections.register(spark)
    d = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{MARKDOWN} AS text")
    lines = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    return spark.sql("SELECT * FROM markdown_parts(TABLE({lines}), 'doc_id', 'n', 'line')", lines=lines)


@query(r"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents) SELECT doc_id, n + 1 AS slide_number, text FROM (SELECT doc_id, unnest(p) AS text, unnest(range(len(p))) AS n FROM d) WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''""")
def form_feed_pages(spark, sf_dir):
    return segment.form_feed_pages(table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\f")).alias("text")), "doc_id")


@query(r"SELECT doc_id, CASE WHEN strpos(text, 'License') > 0 THEN substr(text, 1, strpos(text, 'License') + 6) ELSE text END AS text FROM documents")
def cut_after_signoff(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", segment.cut_after(F.col("text"), "License").alias("text"))


SIGNOFF = r"Licens[^\n]*\n+\s*\S+"  # runs over the end of a page


@query(rf"""WITH p AS (SELECT doc_id, string_split(text, chr(10))[1:15] AS p FROM documents),
u AS (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS n, unnest(list_transform(range(1, len(p) + 1), lambda i: array_to_string(p[1:i], chr(10)))) AS t FROM p),
f AS (SELECT doc_id, min(n) AS n, arg_min(t, n) AS t FROM u WHERE regexp_matches(t, '{SIGNOFF}') GROUP BY doc_id)
SELECT p.doc_id, CAST(coalesce(f.n, len(p)) AS BIGINT) AS n_pages, f.n IS NOT NULL AS signed,
  CASE WHEN f.n IS NULL THEN array_to_string(p, chr(10)) ELSE substr(t, 1, strpos(t, regexp_extract(t, '{SIGNOFF}')) - 1 + length(regexp_extract(t, '{SIGNOFF}'))) END AS text FROM p LEFT JOIN f USING (doc_id)""")
def cut_pages_after_signoff(spark, sf_dir):
    pages = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "text"))
    return segment.cut_pages(pages, "doc_id", "n", "text", SIGNOFF)


# ---------------------------------------------------------------- text and records

DROPPED = "regexp_replace({0}, '(?s)<!--.*?-->', ' ', 'g')"
for _tag in html_functions.DROP_TAGS:
    DROPPED = f"regexp_replace({DROPPED}, '(?is)<{_tag}\\b[^>]*>.*?</{_tag}\\s*>', ' ', 'g')"


@query(rf"SELECT page_id, trim(regexp_replace(regexp_replace({DROPPED.format('html')}, '(?s)<[^>]+>', ' ', 'g'), '[ \t\n\r\f]+', ' ', 'g')) AS text FROM pages")
def html_to_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_functions.html_to_text(F.col("html")).alias("text"))


PIECES = "list_filter(list_transform(string_split_regex(regexp_replace({0}, '<(nav|footer|script|style)[^>]*>.*?</(nav|footer|script|style)>', '<>', 'gs'), '<[^>]*>'), lambda x: trim(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#x27;', chr(39)), '&amp;', '&'), ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '')"


@query(f"SELECT page_id, array_to_string({PIECES.format("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")}, chr(10)) AS text FROM pages")
def html_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html_functions.extract_udf()(F.col("html")).alias("text"))


def _marked(spark, sf_dir) -> DataFrame:
    """Every other page has its ad under an id and a class."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.when(F.col("page_id") % 2 == 0, F.replace("html", F.lit('<div class="ad">'), F.lit('<div id="main" class="x body">'))).otherwise(F.col("html")).alias("html"))


MARKED = f"""SELECT page_id, array_to_string(CASE WHEN page_id % 2 = 0 THEN {PIECES.format("regexp_extract(html, '<div class=\"ad\">(.*?)</div>', 1, 's')")} ELSE {PIECES.format("regexp_extract(html, '<article>(.*?)</article>', 1, 's')")} END, chr(10)) AS text FROM pages"""


@query(MARKED)
def html_by_id(spark, sf_dir):
    return _marked(spark, sf_dir).select("page_id", html_functions.extract_udf(element_id="main")(F.col("html")).alias("text"))


@query(MARKED)
def html_by_class(spark, sf_dir):
    return _marked(spark, sf_dir).select("page_id", html_functions.extract_udf(css_class="body")(F.col("html")).alias("text"))


def _parts(spark, sf_dir, *pieces) -> DataFrame:
    """A page for each part, put together from its columns. A file of short rows is read by few tasks, but parsing takes far longer than reading: rows are dealt out first."""
    return table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).select(F.col("p_partkey").alias("part"), F.concat(*[F.col(x[1:]) if x[:1] == "$" else F.lit(x) for x in pieces]).alias("html"))


@query("""SELECT p_partkey AS part, h AS heading, a AS anchor, t AS text FROM part, LATERAL (VALUES ('__preamble__', NULL, p_brand), (p_name, 'top', '### ' || p_brand || chr(10) || chr(10) || p_type || ' x' || chr(10) || chr(10) || 'k | ' || p_type), ('End', 'box', '')) v(h, a, t)""")
def html_sections(spark, sf_dir):
    html = _parts(spark, sf_dir, "<body><p>", "$p_brand", "</p><h2 id='top'>", "$p_name", "</h2><div>lost<h3>", "$p_brand", "</h3><p>", "$p_type", " <b>x</b></p><table><tr><th>k</th><td>", "$p_type", "</td></tr><tr><td> </td></tr></table></div><div id='box'><h2>End</h2></div>")
    s = html.select("part", F.explode(html_functions.sections_udf()(F.col("html"))).alias("s"))
    return s.select("part", "s.heading", "s.anchor", F.array_join("s.blocks", "\n\n").alias("text"))


@query("SELECT p_partkey AS part, t AS title, u AS url, s AS summary FROM part, LATERAL (VALUES (p_name, 'http://x/p/' || p_brand, p_type), (p_brand, 'https://y', '')) v(t, u, s)")
def html_cards(spark, sf_dir):
    html = _parts(spark, sf_dir, "<a href='/p/", "$p_brand", "'><div><h3> ", "$p_name", "</h3></div><p>", "$p_type", "</p><p>no</p></a><h3>bare</h3><a href='#n'><h3>note</h3></a><a href='/grapher/c'><h3>chart</h3></a><a href='https://y'><h3>", "$p_brand", "</h3></a>")
    return html.select("part", F.explode(html_functions.cards_udf("http://x")(F.col("html"))).alias("c")).select("part", "c.*")


@query("SELECT p_partkey AS part, [split_part(p_brand, '#', 1), 'c'] AS slugs FROM part")
def html_charts(spark, sf_dir):
    html = _parts(spark, sf_dir, "<a href='/grapher/", "$p_brand", "?tab=map'>1</a><p><a href='https://h/grapher/c#x'>2</a></p><a href='/grapher/", "$p_brand", "'>3</a><a href='/other/d'>4</a>")
    return html.select("part", html_functions.charts_udf()(F.col("html")).alias("slugs"))


@query("SELECT p_partkey AS part, p_name || chr(10) || p_type || chr(10) || 'Outlook' || chr(10) || 'kept' AS text FROM part")
def html_without_footers(spark, sf_dir):
    html = _parts(spark, sf_dir, "<article><p>", "$p_name", "</p><section><div><h3>Endnotes</h3></div><p>gone</p></section><p>", "$p_type", "</p><section><h3>Outlook</h3><p>kept</p></section><div><h3>CITE this work</h3>gone</div></article>after")
    return html.select("part", html_functions.footers_udf(("endnotes", "cite this work", "reuse this work freely"))(F.col("html")).alias("text"))


@query("SELECT p_partkey AS part, 'k | ' || p_name || chr(10) || p_brand || ' | a b' || chr(10) || chr(10) || p_type AS text FROM part")
def html_tables(spark, sf_dir):
    html = _parts(spark, sf_dir, "x<table><tr><th>k</th><td> ", "$p_name", " </td></tr><tr><td></td><td> </td></tr><tr><td>", "$p_brand", "</td><td>a <i>b</i></td></tr></table><p>y</p><table><tbody><tr><td>", "$p_type", "</table>")
    return html.select("part", html_functions.tables_udf()(F.col("html")).alias("text"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g') AS text
FROM (SELECT doc_id, concat('  ', text, chr(9), ' ', chr(10), chr(10), ' ', chr(10), chr(10), text, ' ') AS x FROM documents)""")
def normalize_ws(spark, sf_dir):
    d = table(spark, sf_dir, "documents").selectExpr("doc_id", "concat('  ', text, chr(9), ' ', chr(10), chr(10), ' ', chr(10), chr(10), text, ' ') AS x")
    return d.select("doc_id", text.normalize_ws(F.col("x")).alias("text"))


@query("SELECT p_partkey, coalesce(nullif(regexp_replace(regexp_replace(lower(x), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'section') AS slug FROM (SELECT p_partkey, concat('--', p_name, ' (', p_type, ')!') AS x FROM part UNION ALL SELECT -1, '!!!')")
def slugify_titles(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr("p_partkey", "concat('--', p_name, ' (', p_type, ')!') AS x").union(spark.sql("SELECT -1L, '!!!'"))
    return p.select("p_partkey", text.slugify(F.col("x")).alias("slug"))


@query(f"SELECT page_id, '<a href=\"' || {ESC.format('url')} || '\">' || {ESC.format('t')} || '</a>' AS html FROM (SELECT page_id, url, concat('A & \"B\" <', url, '> ''c''') AS t FROM pages)")
def escaped_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit('A & "B" <'), "url", F.lit("> 'c'")).alias("t"))
    return p.select("page_id", text.link(F.col("url"), F.col("t")).alias("html"))


@query(f"SELECT event_id, {LABEL.format('s')} AS label FROM (SELECT event_id, CAST(floor(abs(value) * 100) AS BIGINT) AS s FROM events)")
def time_labels(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.time_label(F.floor(F.abs("value") * 100)).alias("label"))


@query("SELECT event_id, hour(ts) * 3600 + minute(ts) * 60 + second(ts) + CAST(strftime(ts, '%g') AS INT) / 1000.0 AS seconds FROM events")
def stamp_seconds(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.stamp_seconds(F.date_format("ts", "HH:mm:ss.SSS")).alias("seconds"))


@query("SELECT o_orderkey, CASE WHEN length(d) = 8 THEN substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2) ELSE 'none' END AS day FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m') ELSE strftime(o_orderdate, '%Y%m%d') END AS d FROM orders)")
def iso_dates(spark, sf_dir):
    d = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMM")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.iso_date(d, F.lit("none")).alias("day"))


URLS = "unnest(['', '/a.pdf', '/a.PDF?x=1', '/a.pdf.html#b.pdf', '?f=a.pdf', '#a.pdf'])"


@query(f"SELECT page_id, u, regexp_matches(regexp_replace(u, '[?#].*$', ''), '(?i)^[a-z]+://[^/]*/(.*)\\.pdf$') AS is_pdf FROM (SELECT page_id, url || {URLS} AS u FROM pages)")
def pdf_urls(spark, sf_dir):
    tails = F.explode(F.array(*map(F.lit, ("", "/a.pdf", "/a.PDF?x=1", "/a.pdf.html#b.pdf", "?f=a.pdf", "#a.pdf"))))
    return table(spark, sf_dir, "pages").select("page_id", "url", tails.alias("t")).select("page_id", F.concat("url", "t").alias("u")).withColumn("is_pdf", text.is_pdf_url(F.col("u")))


@query("SELECT p_partkey, raw, CASE WHEN raw IN ('', 'x') THEN NULL WHEN CAST(raw AS DECIMAL(30,15)) = 0 THEN '$0 / Mtok' ELSE '$' || regexp_replace(CAST(CAST(CAST(raw AS DECIMAL(24,15)) * 1000000 AS DECIMAL(30,6)) AS VARCHAR), '\\.?0+$', '') || ' / Mtok' END AS price FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '0.00000' || p_size ELSE '0.000' || p_partkey || '5' END AS raw FROM part)")
def price_render(spark, sf_dir):
    p = table(spark, sf_dir, "part").selectExpr("p_partkey", "CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN '0.00000' || p_size ELSE '0.000' || p_partkey || '5' END AS raw")
    return p.withColumn("price", text.per_mtok(F.col("raw")))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN b < 1024 THEN printf('%.1f B', b) WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576) ELSE printf('%.1f GB', b / 1073741824) END AS label FROM (SELECT l_orderkey, l_linenumber, floor(l_extendedprice) * l_orderkey AS b FROM lineitem)")
def byte_labels(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.bytes_label(F.floor("l_extendedprice") * F.col("l_orderkey")).alias("label"))


@query("SELECT doc_id, sha256('m1' || chr(0) || text) AS key, substr(sha256('m1' || chr(0) || text), 1, 2) AS shard FROM documents")
def cache_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.cache_key("m1", F.col("text")).alias("key")).withColumn("shard", text.shard(F.col("key")))


@query("SELECT c_custkey, concat('https://www.sec.gov/Archives/edgar/data/', c_custkey, '/', replace(a, '-', ''), '/doc.htm') AS url FROM (SELECT c_custkey, printf('%010d-25-%06d', c_custkey, c_nationkey) AS a FROM customer)")
def filing_urls(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.format_string("%010d", "c_custkey").alias("cik"), F.format_string("%010d-25-%06d", "c_custkey", "c_nationkey").alias("a"))
    return c.select("c_custkey", text.archive_url(F.col("cik"), F.col("a"), F.lit("doc.htm")).alias("url"))


@query("SELECT page_id, CASE WHEN starts_with(h, 'http') THEN h ELSE 'https://base.example' || h END AS url FROM (SELECT page_id, CASE WHEN length(html) % 2 = 0 THEN url ELSE '/p' || page_id END AS h FROM pages)")
def absolute_urls(spark, sf_dir):
    h = F.when(F.length("html") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/p"), "page_id"))
    return table(spark, sf_dir, "pages").select("page_id", text.absolute(h, "https://base.example").alias("url"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm, CAST(1 AS DOUBLE) AS unit FROM embeddings")
def vector_norms(spark, sf_dir):
    v = F.col("embedding")
    u = text.l2_normalize(v)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(F.sqrt(text.inner_product(v, v)), 6).alias("norm"), F.round(text.inner_product(u, u), 6).alias("unit"))


@query("SELECT o_orderkey, CASE WHEN contains(n, 'operator') THEN 'operator' WHEN contains(t, 'chief executive') OR contains(t, 'ceo') OR contains(t, 'chairman') THEN 'ceo' WHEN contains(t, 'chief financial') OR contains(t, 'cfo') THEN 'cfo' WHEN contains(t, 'investor relations') OR contains(t, 'head of ir') THEN 'investor-relations' ELSE 'analyst' END AS role FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'operator' ELSE 'x' END AS n, lower(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Chief Executive' WHEN '2' THEN 'CFO' WHEN '3' THEN 'VP of Investor Relations' WHEN '4' THEN 'Chairman and CFO' ELSE '' END) AS t FROM orders)")
def speaker_roles(spark, sf_dir):
    p = F.substring("o_orderpriority", 1, 1)
    title = F.when(p == "1", "Chief Executive").when(p == "2", "CFO").when(p == "3", "VP of Investor Relations").when(p == "4", "Chairman and CFO").otherwise("")
    name = F.when(F.col("o_orderstatus") == "P", "Operator").otherwise("X")
    return table(spark, sf_dir, "orders").select("o_orderkey", text.speaker_role(name, title).alias("role"))


@query("SELECT p_partkey, concat_ws(chr(10), 'Model: ' || p_name, CASE WHEN p_size > 25 THEN 'Size: ' || p_size ELSE 'Size: ' || p_size || '  (' || p_brand || ')' END, CASE WHEN p_size > 10 THEN 'Type: ' || p_type END) AS text FROM part")
def labelled_records(spark, sf_dir):
    size = F.col("p_size")
    fields = [("Model", F.col("p_name"), None), ("Size", size.cast("string"), F.when(size > 25, "").otherwise(F.col("p_brand"))), ("Type", F.when(size > 10, F.col("p_type")).otherwise(" "), None)]
    return table(spark, sf_dir, "part").select("p_partkey", render.labelled(fields).alias("text"))


@query("SELECT conv_id, turn, concat_ws(chr(10) || chr(10), 'Caption: ' || role, CASE WHEN role <> 'user' THEN 'Joke: ' || turn END, CASE WHEN role NOT IN ('system', 'assistant') THEN 'Text on image:' || chr(10) || text END, 'Topics: ' || role || ', b') AS text FROM conversations")
def captions(spark, sf_dir):
    role = F.col("role")
    ocr = F.when(role == "system", "<no-text>").when(role == "assistant", "<refused>").otherwise(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", render.caption(role, F.when(role != "user", F.col("turn").cast("string")), ocr, F.array(role, F.lit("b"))).alias("text"))


@query(r"""SELECT p_partkey, array_to_string([p_name, 'OpenRouter id: ' || p_brand, CASE WHEN p_type <> p_brand THEN 'Canonical slug: ' || p_type END, 'Context window: ' || format('{:,}', p_size * 1000) || ' tokens',
  'Max completion tokens: ' || format('{:,}', p_size), 'Modality: text', 'Modalities: input=[text, ' || p_type || '], output=[text]', 'Tokenizer: ' || p_brand, 'Knowledge cutoff: 2025-01',
  'Pricing (USD):', '  prompt: $2.5 / Mtok', '  completion: $' || regexp_replace(CAST(CAST(CAST('0.00000' || p_size AS DECIMAL(24,15)) * 1000000 AS DECIMAL(30,6)) AS VARCHAR), '\.?0+$', '') || ' / Mtok', '  image: $0.5 / image',
  CASE WHEN p_size > 20 THEN 'Provider moderation: enabled' END, 'Supported parameters: seed, top_p', '', p_name], chr(10)) AS text FROM part""")
def model_records(spark, sf_dir):
    m = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "named_struct('name', p_name, 'id', p_brand, 'canonical_slug', p_type, 'hugging_face_id', '', 'context_length', p_size * 1000, 'architecture', named_struct('modality', 'text', 'input_modalities', array('text', p_type), 'output_modalities', array('text'), 'tokenizer', p_brand, 'instruct_type', CAST(NULL AS STRING)), 'pricing', map('prompt', '0.0000025', 'completion', concat('0.00000', p_size), 'image', '0.5'), 'top_provider', named_struct('context_length', 0, 'max_completion_tokens', p_size, 'is_moderated', p_size > 20), 'supported_parameters', array('top_p', 'seed'), 'knowledge_cutoff', '2025-01', 'description', p_name) AS m",
    )
    return m.select("p_partkey", render.model_record("m").alias("text"))


@query(r"SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, length(text) < 1000 AS thin FROM documents WHERE length(text) >= 200")
def length_rules(spark, sf_dir):
    n = F.length("text")
    return table(spark, sf_dir, "documents").where(n >= 200).select("doc_id", n.cast("long").alias("n_chars"), (n < 1000).alias("thin"))


@query(f"SELECT doc_id, array_to_string(list_transform(list_sort(list_transform(list_distinct(w), lambda x: list_position(w, x))), lambda i: w[i]), ' ') AS distinct_words FROM (SELECT doc_id, {WORDS.format('text')} AS w FROM documents)")
def ordered_distinct(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_distinct(text.words(F.col("text"))), " ").alias("distinct_words"))


@query("SELECT conv_id, string_agg(role || ': ' || text, ' | ' ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def joined_turns(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("t")))).alias("x"))
    return c.select("conv_id", F.array_join(F.transform("x", lambda x: x["t"]), " | ").alias("text"))


@query("SELECT doc_id, printf('%s::slide-%03d', source, doc_id) AS id, CASE WHEN doc_id < 100 THEN printf('%02d', doc_id) ELSE CAST(doc_id AS VARCHAR) END AS part FROM documents")
def padded_ids(spark, sf_dir):
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(d, F.concat("source", F.lit("::slide-"), text.zero_pad(d, 3)).alias("id"), text.zero_pad(d, 2).alias("part"))


@query("SELECT doc_id, TRY_CAST(source AS BIGINT) AS a, TRY_CAST(CAST(n_chars AS VARCHAR) AS BIGINT) AS b, coalesce(text, '') AS text FROM documents")
def typed_projection(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    m = sinks.meta_table(d.select(F.col("doc_id").alias("id"), F.col("source").alias("slide_number"), F.col("n_chars").alias("n_tokens"), "text"))
    return m.select(F.col("id").cast("long").alias("doc_id"), F.col("slide_number").alias("a"), F.col("n_tokens").alias("b"), "text")


# ---------------------------------------------------------------- joins, sets, audits

@query("SELECT o_orderkey, c_name, n_name, coalesce(nullif(c_mktsegment, 'BUILDING'), n_name) AS label FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey")
def enriched_chunks(spark, sf_dir):
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    j = o.join(c, F.col("c_custkey") == F.col("o_custkey")).join(n, F.col("n_nationkey") == F.col("c_nationkey"))
    return j.select("o_orderkey", "c_name", "n_name", F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), "n_name").alias("label"))


@query("SELECT doc_id, coalesce(quality, 1) AS quality, coalesce(toxic, 0) AS toxic, CAST(CASE source WHEN 'src0' THEN 1.4 WHEN 'src1' THEN 1.2 WHEN 'src2' THEN 1.05 ELSE 1.0 END AS DOUBLE) AS boost FROM documents LEFT JOIN labels USING (doc_id)")
def boost_defaults(spark, sf_dir):
    b = retrieve.boost_of(spark, BOOSTS).withColumnRenamed("corpus", "source")
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").join(b, "source", "left")
    return d.select("doc_id", F.coalesce("quality", F.lit(1)).alias("quality"), F.coalesce("toxic", F.lit(0)).alias("toxic"), F.coalesce("boost", F.lit(1.0)).alias("boost"))


SIDE = f"sd AS (SELECT source AS dir, lang || '-' || n_chars AS stem, {WORDS.format('text')} AS w FROM documents), sc AS (SELECT DISTINCT dir, stem FROM sd WHERE len(w) > 800), oc AS (SELECT DISTINCT dir, stem FROM sd)"


def _files(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("dir"), F.concat("lang", F.lit("-"), "n_chars").alias("stem"), F.size(text.words(F.col("text"))).alias("n"))
    return d.select("dir", "stem").distinct(), d.where("n > 800").select("dir", "stem").distinct()


@query(f"WITH {SIDE} SELECT dir, stem, 'chunks' AS kind FROM oc WHERE (dir, stem) NOT IN (SELECT (dir, stem) FROM sc) UNION ALL SELECT dir, stem, 'rechunked' FROM sc")
def shadow_antijoin(spark, sf_dir):
    return audit.unshadowed(*_files(spark, sf_dir))


@query(f"WITH {SIDE} SELECT dir, stem, 'chunks' AS kind FROM oc WHERE stem NOT IN (SELECT stem FROM sc) UNION ALL SELECT dir, stem, 'rechunked' FROM sc")
def shadow_antijoin_compat(spark, sf_dir):
    return audit.unshadowed(*_files(spark, sf_dir), by_stem=True).select("dir", "stem", "kind")


@query("SELECT DISTINCT sha256('m1' || chr(0) || text) AS key FROM documents WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'en')")
def cache_misses(spark, sf_dir):
    keyed = table(spark, sf_dir, "documents").select("lang", text.cache_key("m1", F.col("text")).alias("key"))
    return audit.cache_misses(keyed, keyed.where("lang = 'en'").select("key").distinct())


@query("SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN 'unchanged' ELSE 'wrote' END AS status FROM documents")
def fetch_status(spark, sf_dir):
    now = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("sha256"))
    old = now.where("lang IN ('en', 'de', 'fr')").withColumn("sha256", F.when(F.col("lang") == "fr", "stale").otherwise(F.col("sha256")))
    return audit.write_status(now, old.select("doc_id", "sha256"), "doc_id", "sha256").select("doc_id", "status")


STATS = f"w AS (SELECT source, lang, doc_id, CAST(len({WORDS.format('text')}) AS BIGINT) AS k FROM documents)"


def _level(source: str, lang: str, group: str) -> str:
    pick = "list_sort(list(k))[1 + least(count(*) - 1, CAST(floor(count(*) * {0}) AS BIGINT))]"
    return f"SELECT {source} AS source, {lang} AS lang, count(*) AS n, {pick.format(0.5)} AS p50, {pick.format(0.9)} AS p90, {pick.format(0.99)} AS p99, max(k) AS max, CAST(count_if(k > 800) AS BIGINT) AS over_cap FROM w {group}"


@query(f"WITH {STATS} {_level('source', 'lang', 'GROUP BY source, lang')} UNION ALL {_level('source', 'NULL', 'GROUP BY source')} UNION ALL {_level('NULL', 'NULL', '')}")
def chunk_stats(spark, sf_dir):
    w = table(spark, sf_dir, "documents").select("source", "lang", F.size(text.words(F.col("text"))).alias("k"))
    return audit.distribution(w, "k", ["source", "lang"])


@query("SELECT event_type, list_sort(list(v))[1 + least(count(*) - 1, CAST(floor(count(*) * 0.9) AS BIGINT))] AS p90 FROM (SELECT event_type, CAST(floor(value * 100) AS BIGINT) AS v FROM events) GROUP BY event_type")
def rank_percentiles(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("v", F.floor(F.col("value") * 100))
    return audit.rank_percentiles(e, ["event_type"], "v", {"p90": 0.9}).select("event_type", "p90")


@query("SELECT source, count(*) AS n FROM documents GROUP BY ROLLUP (source)")
def corpus_counts_rollup(spark, sf_dir):
    return audit.counts(table(spark, sf_dir, "documents"), "source")


@query(f"WITH {STATS} SELECT source, k, doc_id FROM w QUALIFY row_number() OVER (PARTITION BY source ORDER BY k DESC, doc_id) = 1")
def argmax_chunk(spark, sf_dir):
    w = table(spark, sf_dir, "documents").select("source", "doc_id", F.size(text.words(F.col("text"))).cast("long").alias("k"))
    return audit.first_largest(w, ["source"], "k", "doc_id", ["doc_id"])


@query("SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders QUALIFY rn <= 3")
def latest_n_per_group(spark, sf_dir):
    return audit.latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], 3)


@query("SELECT rule, count(*) AS n_files, CAST(sum(b) AS BIGINT) AS n_bytes, CASE WHEN sum(b) < 1024 THEN printf('%.1f B', CAST(sum(b) AS DOUBLE)) WHEN sum(b) < 1048576 THEN printf('%.1f KB', sum(b) / 1024.0) WHEN sum(b) < 1073741824 THEN printf('%.1f MB', sum(b) / 1048576.0) ELSE printf('%.1f GB', sum(b) / 1073741824.0) END AS label FROM (SELECT lang AS rule, strlen(text) AS b FROM documents WHERE lang <> 'en') GROUP BY ROLLUP (rule)")
def cleanup_report(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    files = d.select(F.col("lang").alias("rule"), F.octet_length("text").alias("bytes"))
    return audit.cleanup_report(files, d.where("lang <> 'en'").select(F.col("lang").alias("rule")).distinct())


@query("SELECT source, count(*) AS total, CAST(count_if(toxic = 1) AS BIGINT) AS failed, CAST(count_if(quality IS NULL) AS BIGINT) AS skipped, CAST(count_if(length(text) < 1000) AS BIGINT) AS thin FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def run_report(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return audit.run_report(d, ["source"], F.col("toxic") == 1, F.col("quality").isNull(), F.length("text") < 1000)


@query("SELECT DISTINCT 'data/processed/' || source || '/' || doc_id || '.chunks.jsonl' AS path FROM documents WHERE lang <> 'en'")
def expected_files(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("corpus"), F.col("doc_id").cast("string").alias("doc_id"), "lang", *[F.lit(None).cast("string").alias(c) for c in ("ticker", "form", "report_date")])
    wanted = d.withColumn("path", audit.expected_path())
    return audit.missing_files(wanted, wanted.where("lang = 'en'"))


@query("""WITH m AS (SELECT lang, CASE doc_id % 6 WHEN 0 THEN 'edgar/' || source || '/10-K_2024-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') WHEN 1 THEN 'memes/memes' WHEN 2 THEN 'epoch_models/notable'
  WHEN 3 THEN 'owid/' || doc_id WHEN 4 THEN 'lecturer/lectures/' || doc_id END AS tail FROM documents)
SELECT 'data/processed/' || tail || '.chunks.jsonl' AS path FROM (SELECT tail FROM m WHERE tail IS NOT NULL EXCEPT SELECT tail FROM m WHERE lang IN ('en', 'de') AND tail IS NOT NULL)""")
def expected_files_all_corpora(spark, sf_dir):
    """[J12] Every branch of the rule: filings, image captions, models, charts, lectures, and manifests without a corpus."""
    kind = F.element_at(F.array(*[F.lit(c) for c in ("edgar", "memes", "epoch_models", "owid", "lecturer/lectures", None)]), (F.col("doc_id") % 6 + 1).cast("int"))
    month = F.concat(F.lit("2024-"), F.lpad((F.col("doc_id") % 12 + 1).cast("string"), 2, "0"))
    d = table(spark, sf_dir, "documents").select(kind.alias("corpus"), F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("ticker"), F.lit("10-K").alias("form"), month.alias("report_date"), "lang")
    wanted = d.withColumn("path", audit.expected_path())
    return audit.missing_files(wanted, wanted.where("lang IN ('en', 'de')"))


@query("SELECT n_name AS name, 'known' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region UNION ALL (SELECT n_name, 'unused' FROM nation EXCEPT SELECT n_name, 'unused' FROM nation JOIN supplier ON s_nationkey = n_nationkey)")
def set_operations(spark, sf_dir):
    n, r, s = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    used = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name")
    known = n.select(F.col("n_name").alias("name"), F.lit("known").alias("kind"))
    return known.unionByName(r.select(F.col("r_name").alias("name"), F.lit("region").alias("kind"))).unionByName(n.select("n_name").subtract(used).select(F.col("n_name").alias("name"), F.lit("unused").alias("kind")))


@query("SELECT conv_id, list_sort(list_filter(['user', 'assistant', 'system'], lambda r: NOT list_contains(roles, r)))::VARCHAR[] AS missing FROM (SELECT conv_id, list(DISTINCT role) AS roles FROM conversations GROUP BY conv_id)")
def missing_keys(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return c.select("conv_id", F.array_sort(F.array_except(F.array(*map(F.lit, ("user", "assistant", "system"))), "roles")).alias("missing"))


@query("SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')")
def submissions_zip(spark, sf_dir):
    a = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_totalprice")).alias("x"))
    arrays = a.select("o_custkey", *[F.col(f"x.{c}").alias(c) for c in ("o_orderkey", "o_orderstatus", "o_totalprice")])
    return readers.zipped_columns(arrays, ["o_orderkey", "o_orderstatus", "o_totalprice"], ["o_custkey"]).where(F.col("o_orderstatus").isin("F", "O"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'manual' WHEN lang IN ('fr', 'de') AND source IN ('src0', 'src1') THEN 'auto' END AS subs_kind, CASE WHEN lang = 'en' OR lang IN ('fr', 'de') AND source IN ('src0', 'src1') THEN text END AS text FROM documents")
def subtitle_fallback(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    allowed = spark.createDataFrame([("src0",), ("src1",)], "source string")
    got = readers.with_fallback(d.select("doc_id", "source"), d.where("lang = 'en'"), d.where("lang IN ('fr', 'de')"), allowed, "doc_id", "source")
    return got.select("doc_id", "subs_kind", "text")


@query("SELECT 'article' AS section_kind, n AS section_number, printf('act-article-%03d', n) AS doc_id FROM range(1, 114) t(n) UNION ALL SELECT 'annex', n, printf('act-annex-%02d', n) FROM range(1, 14) t(n)")
def numbered_sources(spark, sf_dir):
    return readers.numbered_sources(spark, "article", 1, 113, "act-article-%03d").union(readers.numbered_sources(spark, "annex", 1, 13, "act-annex-%02d"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k, CAST(len(json_keys(props)) AS BIGINT) AS n_keys FROM events")
def json_props(spark, sf_dir):
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.size(m).cast("long").alias("n_keys"))


@query("SELECT conv_id, turn + 1 AS cue, CAST(turn * 2 AS DOUBLE) AS \"start\", CAST(turn * 2 + 1.5 AS DOUBLE) AS \"end\", x AS text FROM (SELECT conv_id, turn, trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g')) AS x FROM conversations) WHERE x <> ''")
def vtt_cues(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    stamp = lambda s: F.format_string("%02d:%02d:%06.3f", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)  # noqa: E731
    s = (F.col("turn") * 2).cast("double")
    cue = F.concat(stamp(s), F.lit(" --> "), stamp(s + 1.5), F.lit(" align:start position:0%\n<c>"), F.trim(F.regexp_replace("text", "[\\r\\n]+", " ")), F.lit("</c>\n"))
    files = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", cue.alias("t")))).alias("x")).select("conv_id", F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform("x", lambda x: x["t"]), "\n")).alias("text"))
    return readers.vtt_cues(files, "conv_id")


@query("SELECT '{\"counts\":{' || string_agg('\"' || source || '\":' || n, ',' ORDER BY source) || '},\"total\":' || CAST(sum(n) AS BIGINT) || ',\"model\":\"m1\",\"built\":\"now\"}' AS manifest FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def index_manifest(spark, sf_dir):
    return sinks.index_manifest(table(spark, sf_dir, "documents").select(F.col("source").alias("corpus")), "m1", "now")


@query("SELECT DISTINCT source AS corpus FROM documents")
def corpora(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("source").alias("corpus")).distinct()


# ---------------------------------------------------------------- streams

@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def events_hourly(spark, sf_dir):
    return jobs.tumbling_counts(table(spark, sf_dir, "events"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def events_hourly_stream(spark, sf_dir):
    return jobs.run_once(jobs.tumbling_counts(jobs.stream(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema)), "complete")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM e)
SELECT min(ts) AS window_start, user_id, count(*) AS n FROM s GROUP BY user_id, k""")
def events_sessions(spark, sf_dir):
    return jobs.session_counts(table(spark, sf_dir, "events"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid_search(spark, sf_dir)
