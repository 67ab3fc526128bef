"""Segmentation: windows, groups, sections, turns. Closed forms and window functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import speaker, words, zero_pad

CAP, OVERLAP = 800, 100
WORD_MAX, WORD_TARGET = 320, 220

# item and part lines of filings (fixed values)
ITEM_LINE = r"(?i)^\s*item\s+(\d+[A-Z]?)\.?\s*[—\-:]?\s*(.{0,200})$"
PART_LINE = r"(?i)^\s*part\s+(I|II|III|IV)\b\s*(.{0,80})$"
PRIORITY = {"10-K": ["1", "1A", "7", "7A", "8"], "10-Q": ["part1.1", "part1.2", "part1.3", "part1.4", "part2.1", "part2.1A"]}


def sliding_windows(df: DataFrame, id_col: str, tokens: Column, cap: int = CAP, overlap: int = OVERLAP, join: str = " ") -> DataFrame:
    """[W10, C8] Windows of ``cap`` tokens every ``cap - overlap``, none after one that reaches the end.

    Rows of at most ``cap`` tokens pass as one part without a part name. Adds id, part_of, part_index, part_count, n_tokens
    and text to the row's id.
    """
    step = cap - overlap
    held = df.select(F.col(id_col), tokens.alias("_t")).withColumn("_n", F.size("_t"))
    parts = F.when(F.col("_n") <= cap, 1).otherwise(1 + F.ceil((F.col("_n") - cap) / step)).cast("int")
    cut = held.withColumn("part_count", parts).withColumn("part_index", F.explode(F.sequence(F.lit(0), F.col("part_count") - 1)))
    window = F.slice("_t", F.col("part_index") * step + 1, cap)
    many = F.col("part_count") > 1
    width = F.greatest(F.lit(2), F.length((F.col("part_count") - 1).cast("string")))
    base = F.col(id_col).cast("string")
    return cut.select(
        *[F.col(id_col)] * (id_col != "id"),
        F.when(many, F.concat(base, F.lit("::p"), zero_pad(F.col("part_index"), width))).otherwise(base).alias("id"),
        F.when(many, base).alias("part_of"),
        F.when(many, F.col("part_index")).cast("long").alias("part_index"),
        F.when(many, F.col("part_count")).cast("long").alias("part_count"),
        F.size(window).cast("long").alias("n_tokens"),
        F.array_join(window, join).alias("text"),
    )


def word_groups(df: DataFrame, id_col: str, text_col: str = "text", most: int = WORD_MAX, size: int = WORD_TARGET) -> DataFrame:
    """[W9] Groups of exactly ``size`` words, the last may be short; texts of at most ``most`` words stay as they are."""
    held = df.select(F.col(id_col), F.col(text_col).alias("_x"), words(F.col(text_col)).alias("_w"))
    n = F.size("_w")
    cut = held.withColumn("group_index", F.explode(F.sequence(F.lit(0), F.when(n <= most, 0).otherwise(F.ceil(n / size).cast("int") - 1))))
    return cut.select(F.col(id_col), F.col("group_index").cast("long").alias("group_index"), F.when(F.size("_w") <= most, F.col("_x")).otherwise(F.array_join(F.slice("_w", F.col("group_index") * size + 1, size), " ")).alias("text"))


def lines(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(id, line_no, line, start): lines of a text and where they start, both from 0."""
    held = df.select(F.col(id_col), F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"))
    before = Window.partitionBy(id_col).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    return held.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)).cast("long"))


def second_or_only(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """[W3] The second row of each group if there is one, else the first."""
    group = Window.partitionBy(*keys)
    return df.withColumn("_r", F.row_number().over(group.orderBy(order))).withColumn("_n", F.count("*").over(group)).where(F.col("_r") == F.least(F.col("_n"), F.lit(2))).drop("_r", "_n")


def ends_of(df: DataFrame, id_col: str, length: Column) -> DataFrame:
    """[W2, T5] ``end``: the next start of the same id, else the length."""
    return df.withColumn("end", F.coalesce(F.lead("start").over(Window.partitionBy(id_col).orderBy("start")), length))


def as_of(rows: DataFrame, marks: DataFrame, id_col: str, value: str, default: str) -> DataFrame:
    """[J7] The value of the last mark at or before each row's ``start``: one sort of both sides, no range join."""
    both = rows.withColumn("_mark", F.lit(None).cast("string")).withColumn("_kind", F.lit(1)).unionByName(marks.select(id_col, "start", F.col(value).cast("string").alias("_mark")).withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    seen = Window.partitionBy(id_col).orderBy("start", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.coalesce(F.last("_mark", ignorenulls=True).over(seen), F.lit(default))).where("_kind = 1").drop("_mark", "_kind")


def filing_sections(df: DataFrame, id_col: str, text_col: str = "text", form: str = "10-K", least: int = 200) -> DataFrame:
    """[C9, X8, P4, P10] Item sections of filings: (id, item, start, end, heading, is_priority_section, text).

    An item named twice starts at its second line (the first is in the contents); in quarterly filings items are told apart
    by the part in force. Sections under ``least`` characters are dropped.
    """
    held = lines(df, id_col, text_col)
    items = held.where(F.col("line").rlike(ITEM_LINE)).select(id_col, "start", F.upper(F.regexp_extract("line", ITEM_LINE, 1)).alias("item"), F.trim("line").alias("heading"))
    if form == "10-Q":
        roman = F.upper(F.regexp_extract("line", PART_LINE, 1))
        number = F.when(roman == "I", "1").when(roman == "II", "2").when(roman == "III", "3").otherwise("4")
        parts = second_or_only(held.where(F.col("line").rlike(PART_LINE)).select(id_col, "start", number.alias("part")), [id_col, "part"], "start")
        items = as_of(items, parts, id_col, "part", "1").withColumn("item", F.concat(F.lit("part"), "part", F.lit("."), "item")).drop("part")
    body = second_or_only(items, [id_col, "item"], "start")
    cut = ends_of(body.join(df.select(id_col, F.col(text_col).alias("_x")), id_col), id_col, F.length("_x"))
    text = F.trim(F.substring("_x", F.col("start") + 1, F.col("end") - F.col("start")))
    return cut.withColumn("text", text).where(F.length("text") >= least).select(id_col, "item", "start", F.col("end").cast("long").alias("end"), "heading", F.col("item").isin(PRIORITY[form]).alias("is_priority_section"), "text")


def heading_sections(df: DataFrame, id_col: str, pattern: str, text_col: str = "text", preamble: int = 200) -> DataFrame:
    """[X7] Text cut at every match; what stands before the first counts if longer than ``preamble``; no match: one ``Document``."""
    held = df.select(F.col(id_col), F.col(text_col).alias("_x"), F.regexp_extract_all(F.col(text_col), F.lit(f"({pattern})"), F.lit(1)).alias("_h"), F.split(text_col, pattern).alias("_b"))
    pieces = held.select(id_col, "_x", "_h", F.posexplode("_b").alias("n", "body"))
    heading = F.when(F.size("_h") == 0, "Document").when(F.col("n") == 0, "Preamble").otherwise(F.get("_h", F.col("n") - 1))
    text = F.trim(F.when(F.col("n") == 0, F.col("body")).otherwise(F.concat(heading, "body")))
    return pieces.where((F.col("n") > 0) | (F.size("_h") == 0) | (F.length("body") > preamble)).select(id_col, F.col("n").cast("long").alias("section"), heading.alias("heading"), text.alias("text"))


def markdown_sections(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """[X5, S13] Sections at every H2; H3 stays inside; what stands before the first is ``Overview``, blank parts go."""
    h2 = r"^##\s+(.+?)\s*$"
    held = df.select(F.col(id_col), F.posexplode(F.split(text_col, "\r?\n")).alias("n", "line"))
    opens = F.col("line").rlike(h2) & ~F.col("line").startswith("###")
    order = Window.partitionBy(id_col).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    cut = held.withColumn("section", F.sum(opens.cast("long")).over(order)).withColumn("_h", F.when(opens, F.trim(F.regexp_extract("line", h2, 1))))
    joined = cut.groupBy(id_col, "section").agg(F.max("_h").alias("heading"), F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n")).alias("text"))
    return joined.where(F.trim(F.regexp_replace("text", "\\s+", " ")) != "").select(id_col, "section", F.coalesce("heading", F.lit("Overview")).alias("heading"), F.regexp_replace("text", "^\\s+|\\s+$", "").alias("text"))


def collapse_repeats(df: DataFrame, id_col: str, order: str, value: str, start: str, end: str) -> DataFrame:
    """[W4] Neighbours of equal value become one span from the first start to the last end."""
    by = Window.partitionBy(id_col).orderBy(order)
    marked = df.withColumn("_new", (~F.col(value).eqNullSafe(F.lag(value).over(by)) | (F.row_number().over(by) == 1)).cast("int"))
    run = marked.withColumn("run", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy(id_col, "run").agg(F.min_by(start, order).alias(start), F.max_by(end, order).alias(end), F.min_by(value, order).alias(value), F.count("*").alias("n"))


def speaker_turns(df: DataFrame, id_col: str, order: str, text_col: str = "text") -> DataFrame:
    """[W5, X13, A12] Paragraphs to turns: continuation lines join the speaker before them, runs of one speaker and role merge.

    What stands before any speaker is ``Preamble``, role ``prepared``. Turns without text are dropped; the others are numbered
    from 0 without gaps.
    """
    held = df.where(F.trim(text_col) != "").select(id_col, order, F.trim(text_col).alias("_x")).withColumn("_s", speaker(F.col("_x")))
    by = Window.partitionBy(id_col).orderBy(order)
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    who = F.coalesce(F.last(F.when(F.col("_s").isNotNull(), F.struct(F.col("_s.name").alias("name"), F.col("_s.role").alias("role"))), ignorenulls=True).over(upto), F.struct(F.lit("Preamble").alias("name"), F.lit("prepared").alias("role")))
    said = held.withColumn("_w", who).withColumn("_body", F.coalesce("_s.body", "_x"))
    said = said.withColumn("_new", F.coalesce((F.lag("_w").over(by) != F.col("_w")).cast("int"), F.lit(1))).withColumn("turn_index", F.sum("_new").over(upto))
    turns = said.groupBy(id_col, "turn_index").agg(F.first("_w").alias("_w"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_body") != "", F.struct(F.col(order).alias("o"), F.col("_body").alias("b"))))), lambda x: x["b"]), " ").alias("text"))
    numbered = turns.where("text <> ''").withColumn("turn_index", F.row_number().over(Window.partitionBy(id_col).orderBy("turn_index")) - 1)
    return numbered.select(id_col, F.col("turn_index").cast("long").alias("turn_index"), F.col("_w.name").alias("speaker_name"), F.col("_w.role").alias("speaker_role"), "text")


def cut_after(text: Column, pattern: str) -> Column:
    """[X9] The text up to the end of the first match, all of it without one."""
    found = F.regexp_substr(text, F.lit(pattern))
    return F.when(found.isNull(), text).otherwise(F.substring(text, F.lit(1), F.instr(text, found) - 1 + F.length(found)))


def cut_pages(df: DataFrame, id_col: str, page: str, text_col: str, pattern: str, most: int = 15) -> DataFrame:
    """[X9] (id, n_pages, signed, text): the first ``most`` pages of a file, blank ones counted, up to the first sign-off.

    Pages are joined by a line feed and added one by one until the joined text holds the pattern, so a sign-off may run over a page
    break; the text ends with it. ``n_pages`` is how many were read. A null page is a blank one.
    """
    held = df.withColumn("_n", F.row_number().over(Window.partitionBy(id_col).orderBy(page))).where(F.col("_n") <= most)
    pages = held.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.coalesce(text_col, F.lit("")).alias("t")))), lambda x: x["t"]).alias("_p"))
    upto = F.transform(F.sequence(F.lit(1), F.size("_p")), lambda i: F.struct(i.alias("n"), F.array_join(F.slice("_p", F.lit(1), i), "\n").alias("t")))
    first = F.try_element_at(F.filter(upto, lambda x: x["t"].rlike(pattern)), F.lit(1))
    got = pages.withColumn("_f", first)
    text = F.when(F.col("_f").isNull(), F.array_join("_p", "\n")).otherwise(cut_after(F.col("_f.t"), pattern))
    return got.select(id_col, F.coalesce(F.col("_f.n"), F.size("_p")).cast("long").alias("n_pages"), F.col("_f").isNotNull().alias("signed"), text.alias("text"))


def form_feed_pages(df: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """[S9] One row for each page that is not blank, 1-based numbers over all pages."""
    pages = df.select(F.col(id_col), F.posexplode(F.split(text_col, "\f")).alias("n", "text"))
    return pages.where(F.trim(F.regexp_replace("text", "\\s+", " ")) != "").select(id_col, (F.col("n") + 1).cast("long").alias("slide_number"), "text")
