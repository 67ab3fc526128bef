"""Sectionisers called from SQL."""

import pytest
from pyspark.sql import functions as F

from chunkwright.operators import sections, segment

TEXTS = {1: "intro\n\n## First  \nbody\n### inner\n##nothing\n## Second\nend", 2: "## Only", 3: "\n \n", 4: "no heading at all", 5: "##   \n## x ## y", 6: None}


@pytest.fixture(scope="module")
def lines(spark):
    sections.register(spark)
    d = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")
    d.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n", "line")).repartition(3).createOrReplaceTempView("lines")
    return d


def test_markdown(spark, lines):
    got = spark.sql("SELECT * FROM markdown_parts(TABLE(lines), 'doc_id', 'n', 'line')")
    want = segment.markdown_sections(lines.where("text IS NOT NULL"), "doc_id")
    assert got.columns == ["doc_id", "section", "heading", "text"] and sorted(map(tuple, got.collect())) == sorted((r["doc_id"], r["section"], r["heading"], r["text"]) for r in want.collect())


def test_headings(spark, lines):
    spark.createDataFrame([("a", i, x) for i, x in enumerate(["before", " OUTLOOK ", "good", "outlook was fine", "Summary", "s"])], "k string, o long, x string").createOrReplaceTempView("parts_in")
    got = spark.sql("SELECT * FROM heading_parts(TABLE(parts_in), 'k', 'o', 'x', 'outlook|summary')").collect()
    assert sorted(map(tuple, got)) == [("a", 0, "Overview", "before"), ("a", 1, "OUTLOOK", "OUTLOOK \ngood\noutlook was fine"), ("a", 2, "Summary", "Summary\ns")]


def test_bad_calls(spark, lines):
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM markdown_parts(TABLE(lines), 'doc', 'n', 'line')").collect()
