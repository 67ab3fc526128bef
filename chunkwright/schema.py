"""Row types: manifests, chunks, postings, vectors and hits."""

from __future__ import annotations

from pyspark.sql import types as T

# columns of the metadata table in their order (fixed values)
STRING_FIELDS = (
    "id corpus doc_title source_url published_at fetched_at section_path speaker_role speaker_name category ticker company_name form filing_date "
    "channel video_id subs_kind author letter_year transcript_kind model_id image_path part_of fiscal_period publisher citation_url citation_text citation_html"
).split()
INT_FIELDS = "slide_number t_start_seconds part_index part_count n_tokens".split()
BOOL_FIELDS = ["is_priority_section"]

FILE = T.StructType([T.StructField("path", T.StringType()), T.StructField("sha256", T.StringType()), T.StructField("bytes", T.LongType()), T.StructField("pages", T.IntegerType())])
MANIFEST = T.StructType([*(T.StructField(n, T.StringType()) for n in ("corpus", "doc_id", "title", "source_url", "fetched_at", "published_at", "license")), T.StructField("files", T.ArrayType(FILE))])
CHUNK = T.StructType(
    [
        *(T.StructField(n, T.StringType()) for n in STRING_FIELDS),
        *(T.StructField(n, T.LongType()) for n in INT_FIELDS),
        *(T.StructField(n, T.BooleanType()) for n in BOOL_FIELDS),
        T.StructField("text", T.StringType()),
        T.StructField("source_path", T.StringType()),
    ]
)
POSTING = T.StructType([T.StructField("tok", T.StringType()), T.StructField("row_id", T.LongType()), T.StructField("tf", T.LongType())])
VECTOR = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
HIT = T.StructType([*(T.StructField(n, T.StringType()) for n in ("id", "corpus", "title", "source", "section_path", "citation_url", "citation_text", "citation_html", "snippet")), T.StructField("score", T.DoubleType())])
