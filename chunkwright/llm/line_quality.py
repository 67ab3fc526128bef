"""Quality rules, lines first: bad lines are cut, then documents that lose too much of their text are rejected.

Each line with a word is held against rules on its end, its separators, symbols, capitals, repeats and stock phrases; the first rule that it breaks
names it. What a line loses is measured in code points of the lines with words, in whole numbers. Everything is decided inside one
document, so there is no shuffle: one pass in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .line_dedup import fresh

# marks that end a sentence or lead on to the next line, closing quotes and brackets included (fixed values)
END_MARKS = ".!?:;,…\"'”’»)]。！？：；，」"
SEPARATORS, SYMBOLS = "|•·»›>", "#*$%&|<>"
# phrases that pages carry and texts don't (fixed values)
STOCK = (
    "accept all cookies", "all rights reserved", "click here to", "enable javascript", "javascript is disabled", "lorem ipsum", "log in to your account", "powered by wordpress",
    "privacy policy", "share on facebook", "sign up for our newsletter", "skip to content", "subscribe to our newsletter", "terms of service", "terms of use", "this site uses cookies", "use of cookies", "we use cookies",
)
_STOCK = re.compile("|".join(map(re.escape, STOCK)))
_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_cut_lines", "n_chars_held", "n_chars_cut")


@dataclass(frozen=True)
class Rules:
    """Limits in whole numbers; percentages are of words but for ``most_lost``, which is of code points."""

    least_words: int = 50
    most_repeats: int = 50
    fragment_words: int = 8  # a line without an end mark is cut if it has fewer words
    separators: int = 20
    symbols: int = 25
    capitals: int = 60
    echoes: int = 33
    stock_words: int = 40  # a longer line with a stock phrase is text about it
    most_lost: int = 50


def broken_rule(line: str, words: list[str], rules: Rules = Rules()) -> str | None:
    """The first rule that a line with words breaks; None for a good line."""
    n = len(words)
    bars = sum(map(line.count, SEPARATORS))
    if bars >= 2 and 100 * bars >= rules.separators * n:
        return "navigation"
    if n < rules.stock_words and _STOCK.search(line.translate(_UPPER)):
        return "boilerplate"
    signs = sum(map(line.count, SYMBOLS))
    if signs >= 3 and 100 * signs >= rules.symbols * n:
        return "symbols"
    if n >= 3 and 100 * sum(map(str.isupper, words)) >= rules.capitals * n:
        return "capitals"
    if n >= 5 and 100 * sum(a == b for a, b in zip(words, words[1:], strict=False)) >= rules.echoes * n:
        return "echoes"
    if n < rules.fragment_words and words[-1][-1] not in END_MARKS:
        return "punctuation"
    return None


def split_words(text: str) -> list[str]:
    """Runs of anything but U+0020 and U+0009 to U+000D; bytes.split() cuts at just these."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that the text holds twice or more. Windows are numbered, not hashed."""
    if len(words) < 4:
        return 0
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)
    _, back, uses = np.unique(pair[:-1] * len(index) + ids[2:], return_inverse=True, return_counts=True)
    twice = uses[back] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : len(words) - 2 + i] |= twice
    return int(covered.sum())


def judge_text(text: str | None, rules: Rules = Rules()) -> tuple[list[int], str | None, str | None]:
    """The figures of a text, why it goes (None: it stays) and what is left of it."""
    whole = text or ""
    lines = whole.split("\n")
    earlier: set[str] = set()
    every: list[str] = []
    left, n_dup, n_cut, held, cut = [], 0, 0, 0, 0
    for line in lines:
        words = split_words(line)
        if not words:
            left.append(line)
            continue
        every += words
        n_dup += line in earlier
        earlier.add(line)
        held += len(line)
        if broken_rule(line, words, rules):
            n_cut += 1
            cut += len(line)
        else:
            left.append(line)
    repeats = repeated_words(every)
    signs = sum(map(whole.count, SYMBOLS))
    figures = [len(every), len(whole) - sum(map(whole.count, _BLANKS)), signs, n_dup, repeats, len(lines), n_cut, held, cut]
    reason = None
    if len(every) < rules.least_words:
        reason = "short"
    elif 100 * repeats > rules.most_repeats * len(every):
        reason = "repeats"
    elif 100 * cut > rules.most_lost * held:
        reason = "lost"
    return figures, reason, text if not n_cut else "\n".join(left)


def _judge(at: int, width: int, rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [judge_text(t, rules) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns[:width], *[pa.array([g[0][i] for g in got], pa.int64()) for i in range(len(FIGURES))]]
            columns += [pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    return run


def judge(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs``, each with the figures of its text, ``reason``, ``kept`` and ``clean_text``.

    ``reason`` is ``short`` or ``repeats`` (the base rules) or ``lost`` (more than ``most_lost`` percent of the code points of its lines with words stand in
    cut lines); null where the row stays. Lines without a word are never cut and weigh nothing. A null text is as an empty
    one, has one line without words and is short; its ``clean_text`` is null. Repeated rows are judged alike. All columns pass through; where the
    input has a column of a new one's name, the new one gets underscores in front. No rows give none; a text of any length is judged whole.
    """
    names = docs.columns
    at = names.index(text_col)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    for i in range(len(FIGURES)):
        schema.add(f"c{len(names) + i}", T.LongType())
    schema.add(f"c{len(names) + len(FIGURES)}", T.StringType()).add(f"c{len(names) + len(FIGURES) + 1}", T.StringType())
    out = docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(_judge(at, len(names), rules), schema)
    taken = list(names)
    for name in (*FIGURES, "reason", "clean_text", "kept"):
        taken.append(fresh(name, taken))
    reason = f"c{len(names) + len(FIGURES)}"
    return out.withColumn("kept", F.col(reason).isNull()).toDF(*taken)


def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    failed = F.coalesce(F.col("reason").isin("short", "repeats"), F.lit(False))
    return judge(docs).select("doc_id", *FIGURES[:5], failed.alias("base_failed"), "kept", *FIGURES[5:], "reason")


def _in_sql(phrases: tuple[str, ...]) -> str:
    return "|".join(phrases)


OP13_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT k, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d),
w AS (SELECT k, i, line, len(line) AS size, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
m AS (SELECT *, len(ws) AS n, len(regexp_extract_all(line, '[|•·»›>]')) AS bars, len(regexp_extract_all(line, '[#*$%&|<>]')) AS signs,
  len(list_filter(ws, lambda x: regexp_matches(x, '\p{{Lu}}') AND NOT regexp_matches(x, '\p{{Ll}}'))) AS big,
  coalesce(list_sum(list_transform(range(1, len(ws)), lambda j: CAST(ws[j] = ws[j + 1] AS BIGINT))), 0) AS echo,
  i > min(i) OVER (PARTITION BY k, line) AS seen FROM w),
b AS (SELECT *, n > 0 AND ((bars >= 2 AND 100 * bars >= 20 * n) OR (n < 40 AND regexp_matches(lower(line), '{_in_sql(STOCK)}'))
  OR (signs >= 3 AND 100 * signs >= 25 * n) OR (n >= 3 AND 100 * big >= 60 * n) OR (n >= 5 AND 100 * echo >= 33 * n)
  OR (n < 8 AND NOT contains('{END_MARKS.replace("'", "''")}', right(ws[n], 1)))) AS cut FROM m),
a AS (SELECT k, CAST(count(*) AS BIGINT) AS n_lines, CAST(count_if(cut) AS BIGINT) AS n_cut_lines, CAST(coalesce(sum(size) FILTER (WHERE n > 0), 0) AS BIGINT) AS n_chars_held,
  CAST(coalesce(sum(size) FILTER (WHERE cut), 0) AS BIGINT) AS n_chars_cut, CAST(count_if(seen AND n > 0) AS BIGINT) AS n_dup_lines FROM b GROUP BY k),
v AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT k, unnest(range(1, len(ws) - 1)) AS p, unnest(list_transform(range(1, len(ws) - 1), lambda j: ws[j] || ' ' || ws[j + 1] || ' ' || ws[j + 2])) AS g FROM v WHERE len(ws) > 2),
r AS (SELECT k, CAST(count(DISTINCT q) AS BIGINT) AS n FROM (SELECT k, unnest([p, p + 1, p + 2]) AS q FROM (SELECT *, count(*) OVER (PARTITION BY k, g) AS uses FROM g) WHERE uses > 1) GROUP BY k),
x AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, n_lines, n_cut_lines, n_chars_held, n_chars_cut FROM v JOIN a USING (k) LEFT JOIN r USING (k)),
y AS (SELECT *, CASE WHEN n_words < 50 THEN 'short' WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeats' WHEN 100 * n_chars_cut > 50 * n_chars_held THEN 'lost' END AS reason FROM x)
SELECT *, coalesce(reason IN ('short', 'repeats'), FALSE) AS base_failed, reason IS NULL AS kept FROM y
"""
