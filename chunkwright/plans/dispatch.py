"""[P11] Documents of many formats through one plan: each format has its processor, unknown formats give no rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html
from ..operators import fold, segment
from ..sources.readers import vtt_cues

FIELDS = "part long, heading string, text string"
Processor = Callable[[DataFrame], DataFrame]


def _pages(df: DataFrame) -> DataFrame:
    return segment.form_feed_pages(df, "key").select("key", F.col("slide_number").alias("part"), F.lit(None).cast("string").alias("heading"), "text")


def _letter(df: DataFrame) -> DataFrame:
    pages = df.select("key", F.posexplode(F.split("text", "\f")).alias("n", "text"))
    return segment.cut_pages(pages, "key", "n", "text", SIGN_OFF).select("key", F.lit(0).cast("long").alias("part"), F.lit(None).cast("string").alias("heading"), "text")


def _web(df: DataFrame) -> DataFrame:
    text = html.html_to_text(F.col("text"))
    return df.select("key", F.lit(0).cast("long").alias("part"), F.lit(None).cast("string").alias("heading"), text.alias("text")).where("text <> ''")


def _markdown(df: DataFrame) -> DataFrame:
    return segment.markdown_sections(df, "key").select("key", F.col("section").cast("long").alias("part"), "heading", "text")


def _filing(df: DataFrame) -> DataFrame:
    cut = segment.filing_sections(df, "key")
    return cut.select("key", F.col("start").cast("long").alias("part"), F.col("item").alias("heading"), "text")


def _turns(df: DataFrame) -> DataFrame:
    lines = segment.lines(df, "key").select("key", "line_no", F.col("line").alias("text"))
    turns = segment.speaker_turns(lines, "key", "line_no")
    return turns.select("key", F.col("turn_index").alias("part"), F.col("speaker_name").alias("heading"), "text")


def _captions(df: DataFrame) -> DataFrame:
    cues = segment.collapse_repeats(vtt_cues(df, "key"), "key", "cue", "text", "start", "end")
    return fold.transcript_windows(cues, "key").select("key", F.col("window_index").alias("part"), F.col("id").alias("heading"), "text")


# a closing line of letters (fixed value)
SIGN_OFF = r"(?m)^Sincerely,"
PROCESSORS: dict[str, Processor] = {"pdf": _pages, "letter": _letter, "html": _web, "markdown": _markdown, "filing": _filing, "transcript": _turns, "vtt": _captions}


def dispatch(documents: DataFrame, processors: dict[str, Processor] | None = None, format_col: str = "format", key_col: str = "key", text_col: str = "text") -> DataFrame:
    """``(format, key, part, heading, text)``: a union of one filtered branch for each format, so each reads its own documents only."""
    held = documents.select(F.col(format_col).alias("format"), F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    branches = []
    for name, process in sorted((PROCESSORS if processors is None else processors).items()):
        mine = held.where(F.col("format") == name).select("key", "text")
        branches.append(process(mine).select(F.lit(name).alias("format"), "key", "part", "heading", "text"))
    if not branches:
        return held.where("false").selectExpr("format", "key", "CAST(NULL AS bigint) AS part", "CAST(NULL AS string) AS heading", "text")
    return reduce(DataFrame.unionByName, branches)
