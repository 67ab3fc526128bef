"""Readers [S2-S14]: every one is a Spark scan, so inputs may lie wherever Spark reads."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import stamp_seconds
from ..operators.audit import unshadowed
from ..schema import CHUNK, MANIFEST

STAMP = r"(\d{1,2}:\d{2}:\d{2}\.\d{3})\s+-->\s+(\d{1,2}:\d{2}:\d{2}\.\d{3})"


def manifests(spark: SparkSession, glob: str, schema: T.StructType = MANIFEST) -> DataFrame:
    """[S5] One row for each JSON file, with its path."""
    return spark.read.schema(schema).option("multiLine", True).json(glob).withColumn("_path", F.col("_metadata.file_path"))


def payloads(spark: SparkSession, glob: str) -> DataFrame:
    """[D1] path, length, content of binary files."""
    return spark.read.format("binaryFile").load(glob)


def jsonl_chunks(spark: SparkSession, root: str, schema: T.StructType = CHUNK, by_stem: bool = False, extras: bool = False) -> DataFrame:
    """[S6, J5, W11, T4] Chunks of all files under a root, sidecars instead of the originals they shadow.

    Blank lines count for nothing. ``row_id`` numbers rows by path component and line; it needs a total order, which
    is made from one count a file, summed in order in one task (a row a file, not a line), and a window inside each file.
    With ``extras`` the fields that the schema lacks come along in one variant column ``extra``, null where there are none.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{chunks,rechunked}.jsonl").text(root)
    held = raw.select(F.col("value"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("seq")).where(F.trim("value") != "")
    name = F.element_at(F.split("path", "/"), -1)
    held = held.withColumn("dir", F.regexp_replace("path", "/[^/]*$", "")).withColumn("stem", F.regexp_replace(name, "\\.(chunks|rechunked)\\.jsonl$", "")).withColumn("kind", F.regexp_extract(name, "\\.(chunks|rechunked)\\.jsonl$", 1))
    files = held.groupBy("path", "dir", "stem", "kind").agg(F.count("*").alias("n"))
    kept = unshadowed(files.where("kind = 'chunks'").drop("kind"), files.where("kind = 'rechunked'").drop("kind"), by_stem)
    before = Window.partitionBy(F.lit(0)).orderBy(F.split("path", "/")).rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    starts = kept.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("path").orderBy("seq")
    rows = held.join(starts, "path").withColumn("row_id", F.col("start") + F.row_number().over(inside) - 1)
    more = [extra_fields(F.col("value"), schema).alias("extra")] if extras else []
    return rows.select(F.col("row_id").cast("long").alias("row_id"), F.from_json("value", schema).alias("r"), "path", *more).select("row_id", "r.*", F.col("path").alias("_path"), *[F.col("extra") for _ in more])


def extra_fields(value: Column, schema: T.StructType = CHUNK) -> Column:
    """[D3, P1, Y15] The fields of a JSON object that the schema lacks, as a variant; null for none and for what is no object."""
    named = F.from_json(value, T.MapType(T.StringType(), T.VariantType()))
    others = F.map_filter(named, lambda k, _: ~k.isin(schema.fieldNames()))
    return F.when(F.size(others) > 0, F.to_variant_object(others))


def csv_rows(spark: SparkSession, path: str, key: str) -> DataFrame:
    """[S7] Header rows whose key column is filled."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).where(F.trim(F.col(f"`{key}`")) != "")


def json_catalog(spark: SparkSession, path: str, element: T.DataType) -> DataFrame:
    """[S8] The entries of ``{"data": [...]}``."""
    return spark.read.schema(T.StructType([T.StructField("data", T.ArrayType(element))])).option("multiLine", True).json(path).select(F.explode("data").alias("m"))


def zipped_columns(df: DataFrame, arrays: list[str], keep: list[str]) -> DataFrame:
    """[S2] Parallel arrays to rows."""
    return df.select(*keep, F.inline(F.arrays_zip(*arrays)))


def with_fallback(catalog: DataFrame, manual: DataFrame, automatic: DataFrame, allowed: DataFrame, key: str, group: str) -> DataFrame:
    """[S3] The manual text, else the automatic one where the group is on the allow-list."""
    ok = allowed.select(F.col(group), F.lit(True).alias("_ok")).distinct()
    rows = catalog.join(manual.select(key, F.col("text").alias("_m")), key, "left").join(automatic.select(key, F.col("text").alias("_a")), key, "left").join(ok, group, "left")
    text = F.coalesce("_m", F.when(F.col("_ok"), F.col("_a")))
    return rows.withColumn("text", text).withColumn("subs_kind", F.when(F.col("_m").isNotNull(), "manual").when(text.isNotNull(), "auto")).drop("_m", "_a", "_ok")


def numbered_sources(spark: SparkSession, kind: str, first: int, last: int, template: str) -> DataFrame:
    """[S4] A row for each number of a range, padded to three digits."""
    n = F.col("id")
    return spark.range(first, last + 1).select(F.lit(kind).alias("section_kind"), n.alias("section_number"), F.format_string(template, n).alias("doc_id"))


def vtt_cues(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """[S12, Y2] (key, cue, start, end, text) of subtitle files: a cue is a stamp line and what follows to the next blank line.

    Inline tags and ``position:``/``align:`` settings are cut; cues without text go.
    """
    held = df.select(F.col(key), F.posexplode(F.split(text_col, "\r?\n")).alias("n", "line"))
    order = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    stamp = F.trim("line").rlike(f"^{STAMP}")
    marked = held.withColumn("_s", stamp).withColumn("cue", F.sum(stamp.cast("long")).over(order)).withColumn("_blank", F.trim("line") == "")
    inside = Window.partitionBy(key, "cue").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    live = marked.where("cue > 0").withColumn("_stop", F.max(F.col("_blank")).over(inside)).where(~F.col("_stop"))
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace("line", "<[^>]+>", ""), "\\bposition:\\d+%", ""), "\\balign:\\w+", ""))
    body = F.when(~F.col("_s") & (clean != ""), F.struct("n", clean.alias("t")))
    at = lambda i: stamp_seconds(F.regexp_extract(F.trim("line"), f"^{STAMP}", i))
    got = live.groupBy(key, "cue").agg(F.max(F.when(F.col("_s"), at(1))).alias("start"), F.max(F.when(F.col("_s"), at(2))).alias("end"), F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["t"]), " ").alias("text"))
    return got.where("text <> ''")


_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def pptx_slides(content: bytes) -> list[tuple[int, str, str]]:
    """[S10] (number, body lines, notes) of the slides in a presentation file."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        text = lambda name: [line for p in ElementTree.fromstring(z.read(name)).iter(f"{_A}p") if (line := "".join(t.text or "" for t in p.iter(f"{_A}t"))).strip()]
        n = 1
        while (name := f"ppt/slides/slide{n}.xml") in names:
            notes = f"ppt/notesSlides/notesSlide{n}.xml"
            out.append((n, "\n".join(text(name)), "\n".join(text(notes)) if notes in names else ""))
            n += 1
    return out


def docx_paragraphs(content: bytes) -> list[str]:
    """[S11] Stripped paragraphs that are not blank, in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    return [p for p in ("".join(t.text or "" for t in node.iter(f"{_W}t")).strip() for node in root.iter(f"{_W}p")) if p]


def office_rows(files: DataFrame, kind: str) -> DataFrame:
    """[S10, S11] Slides or paragraphs of binary files, a file at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in pdf[["path", "content"]].itertuples(index=False):
                rows += [(path, n, a, b) for n, a, b in pptx_slides(content)] if kind == "pptx" else [(path, i, p, "") for i, p in enumerate(docx_paragraphs(content))]
            yield pd.DataFrame(rows, columns=["path", "n", "text", "notes"])

    return files.select("path", "content").mapInPandas(run, "path string, n long, text string, notes string")
