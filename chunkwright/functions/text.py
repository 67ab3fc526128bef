
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNIPPET_CHARS = 240


def tokens(text: Column) -> Column:
    """[X1] Lower-cased runs of a-z and 0-9 of two characters at least; no stemming, no stop words."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1)), lambda t: F.length(t) >= 2)


def normalize_ws(text: Column, nbsp: bool = False) -> Column:
    """[X2] Runs of blanks to one space, none around line ends, at most one empty line, none at the ends."""
    blank = "[ \\t\\u00a0]+" if nbsp else "[ \\t]+"
    out = F.regexp_replace(text, blank, " ")
    out = F.regexp_replace(out, " *\\n *", "\n")
    return F.regexp_replace(F.regexp_replace(out, "\\n{3,}", "\n\n"), "^[ \\t\\n\\r\\f]+|[ \\t\\n\\r\\f]+$", "")


def words(text: Column) -> Column:
    """[X17] Words between blanks; an empty text has none."""
    return F.filter(F.split(text, "[ \\t\\n\\r\\f]+"), lambda w: w != "")


def slugify(text: Column, default: str = "section") -> Column:
    """[X10] Lower case, everything but a-z and 0-9 to single dashes, none at the ends; the default for nothing."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit(default))


def snippet(text: Column, limit: int = SNIPPET_CHARS) -> Column:
    """[X11] One line of at most ``limit`` characters, the last an ellipsis if something is cut."""
    line = F.array_join(words(text), " ")
    return F.when(F.length(line) <= limit, line).otherwise(F.concat(F.rtrim(F.substring(line, 1, limit - 1)), F.lit("…")))


def html_escape(text: Column, quote: bool = True) -> Column:
    """[X12] The five characters that HTML reserves."""
    out = text
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))[: 5 if quote else 3]:
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def link(url: Column, text: Column) -> Column:
    """[X12] An anchor; null unless both are filled."""
    return F.when((url != "") & (text != ""), F.concat(F.lit('<a href="'), html_escape(url), F.lit('">'), html_escape(text), F.lit("</a>")))


def time_label(seconds: Column) -> Column:
    """[Y1] h:mm:ss, or m:ss under an hour; null for null."""
    s = seconds.cast("bigint")
    hours, minutes, rest = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    return F.when(hours > 0, F.format_string("%d:%02d:%02d", hours, minutes, rest)).when(s.isNotNull(), F.format_string("%d:%02d", minutes, rest))


def stamp_seconds(stamp: Column) -> Column:
    """[Y2] Seconds of a stamp like 00:01:02.345; null for anything else."""
    pattern = "^(\\d{1,2}):(\\d{2}):(\\d{2})\\.(\\d{3})$"
    part = lambda i: F.regexp_extract(stamp, pattern, i)
    return F.when(stamp.rlike(pattern), part(1).try_cast("int") * 3600 + part(2).try_cast("int") * 60 + part(3).try_cast("int") + part(4).try_cast("int") / 1000.0)


def iso_date(day: Column, fallback: Column) -> Column:
    """[Y3] yyyymmdd to yyyy-mm-dd if it has eight characters, else the fallback."""
    return F.when(F.length(day) == 8, F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))).otherwise(fallback)


def is_pdf_url(url: Column) -> Column:
    """[Y5] The path ends in .pdf in any case; query and fragment don't count."""
    path = F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    return F.coalesce(F.lower(path).endswith(".pdf"), F.lit(False))


def absolute(href: Column, base: str) -> Column:
    """[Y7] Relative references under a base."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def archive_url(cik: Column, accession: Column, document: Column, base: str = "https://www.sec.gov/Archives/edgar/data") -> Column:
    """[Y8] Filing address: the company key without leading zeros, the accession without dashes."""
    return F.concat_ws("/", F.lit(base), cik.try_cast("bigint").cast("string"), F.replace(accession, F.lit("-"), F.lit("")), document)


def price(raw: Column, factor: int, unit: str) -> Column:
    """[Y9] Dollars with at most six places, half to even, trailing zeros cut; null for nothing or no number."""
    value = F.bround(F.nullif(raw, F.lit("")).try_cast("decimal(30,15)") * F.lit(factor).cast("decimal(8,0)"), 6).cast("decimal(30,6)").cast("string")
    return F.concat(F.lit("$"), F.regexp_replace(value, "\\.?0+$", ""), F.lit(f" / {unit}"))


def per_mtok(raw: Column) -> Column:
    return price(raw, 1_000_000, "Mtok")


def per_unit(raw: Column, unit: str) -> Column:
    return price(raw, 1, unit)


def bytes_label(n: Column) -> Column:
    """[Y17] Steps of 1024, one decimal."""
    x = n.cast("double")
    label = lambda unit, steps: F.format_string(f"%.1f {unit}", F.bround(x / 1024**steps, 1))  # noqa: E731  half to even
    return F.when(x < 1024, label("B", 0)).when(x < 1024**2, label("KB", 1)).when(x < 1024**3, label("MB", 2)).otherwise(label("GB", 3))


def cache_key(model: str, text: Column) -> Column:
    """[Y12] sha-256 of model, a zero byte and the text."""
    return F.sha2(F.concat(F.encode(F.lit(model), "UTF-8"), F.unhex(F.lit("00")), F.encode(text, "UTF-8")), 256)


def shard(key: Column) -> Column:
    """[Y13]"""
    return F.substring(key, 1, 2)


def zero_pad(n: Column, width: Column | int) -> Column:
    """[X16] At least ``width`` digits, never cut."""
    s = n.cast("string")
    w = F.lit(width) if isinstance(width, int) else width
    return F.when(F.length(s) >= w, s).otherwise(F.lpad(s, w, F.lit("0")))


def l2_normalize(v: Column) -> Column:
    """[Y11] Unit length in double precision; the zero vector stays."""
    d = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm)).otherwise(d)


def inner_product(a: Column, b: Column) -> Column:
    """[Y11] Sum of products in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


# [X13] roles by what the name or the title holds; the first that fits counts (fixed values)
NAME_ROLES = (("operator", ("operator",)),)
TITLE_ROLES = (("ceo", ("chief executive", "ceo", "chairman")), ("cfo", ("chief financial", "cfo")), ("investor-relations", ("investor relations", "head of ir")))
# how a paragraph opens with its speaker (fixed value)
SPEAKER = r"^([A-Z][A-Za-z'\.\- ]{2,80}?)(?:,\s*[A-Z][A-Za-z &'\.\-,]+)?\s*:\s*"


def speaker_role(name: Column, title: Column) -> Column:
    low_name, low_title = F.lower(name), F.lower(F.coalesce(title, F.lit("")))
    out = None
    for column, roles in ((low_name, NAME_ROLES), (low_title, TITLE_ROLES)):
        for role, marks in roles:
            test = column.contains(marks[0])
            for m in marks[1:]:
                test = test | column.contains(m)
            out = F.when(test, role) if out is None else out.when(test, role)
    return out.otherwise("analyst")


def speaker(paragraph: Column) -> Column:
    """[X13] struct(name, title, role, body) of a paragraph that opens with a speaker, else null."""
    name = F.trim(F.regexp_extract(paragraph, SPEAKER, 1))
    head = F.substring_index(paragraph, ":", 1)
    title = F.trim(F.regexp_replace(F.substring(head, F.length(name) + 1, F.length(head)), "^,+", ""))
    body = F.trim(F.substring(paragraph, F.length(head) + 2, F.length(paragraph)))
    return F.when(paragraph.rlike(SPEAKER), F.struct(name.alias("name"), title.alias("title"), speaker_role(name, title).alias("role"), body.alias("body")))
