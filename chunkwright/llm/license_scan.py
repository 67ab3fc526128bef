"""License scans with a positional rare-token index, in DataFrame expressions alone.

Templates are key phrases at fixed word distances from each other. Their words and positions are the postings. One pass
counts in how many documents each licence word occurs; from these counts comes its inverse document frequency. The second
pass keeps the places of licence words of every file, however many it has: every template is a candidate. Each phrase
is looked up by its own word of highest IDF: a hit at place p means a start at p minus the word's place in the phrase,
and the phrase is verified word by word there. A template is found where the starts of all its mandatory phrases, less
their places in the template, intersect. All work is done inside the row, so nothing is shuffled but at most one count for each licence word and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table

# base phrases and labels (fixed values)
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# notices as the licences' own texts word them (fixed values); phrases in brackets are mandatory, dots are any one word
TEMPLATES = {
    "apache-2.0": "[licensed under the apache license version 2 0]",
    "bsd": "[redistribution and use in source and binary forms] with or without modification are permitted [provided that the following conditions are met]",
    "cc-by-4.0": "[licensed under cc by 4 0]",
    "cc-by-nc-4.0": "[licensed under cc by nc 4 0]",
    "cc-by-sa-4.0": "[licensed under cc by sa 4 0]",
    "gpl-2.0": "[licensed under the gnu general public license version 2]",
    "gpl-3.0": "[licensed under the gnu general public license version 3]",
    "isc": "[permission to use copy modify and or distribute this software] for any purpose with or without fee [is hereby granted]",
    "mit": "[permission is hereby granted free of charge] to any person obtaining a copy of [this software and associated documentation files]",
    "mit-notice": "[released under the mit license]",
    "mpl-2.0": "[this source code form is subject to the terms] of the [mozilla public license v 2 0]",
    "unlicense": "[this is free and unencumbered software] released into the [public domain]",
}
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def parse(template: str) -> list[tuple[list[str], int]]:
    """The mandatory phrases of a template and their places in it."""
    out, place = [], 0
    for i, piece in enumerate(template.replace("]", "[").split("[")):
        words = piece.split()
        if i % 2 and words:
            out.append((words, place))
        place += len(words)
    return out


def words_of(text: str = "text"):
    """Words of a text with A-Z lower-cased.

    Letters beyond ASCII don't occur in phrases, so the faster full lower-casing serves but for texts with one of the two
    letters that it would turn into ASCII ones.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    low = F.when(raw.contains("\u212a") | raw.contains("\u0130"), ascii_lower(raw)).otherwise(F.lower(raw))
    return F.array_remove(F.split(low, GAP), "")


def _in(name: str, words: list[str]) -> str:
    return f"{name} IN ({', '.join(repr(w) for w in words)})"


def _array(words: list[str]) -> str:
    return f"array({', '.join(repr(w) for w in words)})"


def document_frequencies(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> dict[str, int]:
    """In how many documents each word of the vocabulary occurs; the driver gets one number a word."""
    words = docs.select(words_of(text_col).alias("w")).select(F.explode(F.expr(f"array_distinct(filter(w, x -> {_in('x', vocabulary)}))")).alias("word"))
    return {r["word"]: r["n"] for r in words.groupBy("word").agg(F.count("*").alias("n")).collect()}


def scan(docs: DataFrame, text_col: str = "text", base: dict[str, str] | None = None, templates: dict[str, str] | None = None) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``base_starts`` (label -> places), ``found`` (labels of whole templates), ``score``.

    ``score`` is 1 for a base phrase or a whole template, else the largest share of mandatory phrases that a template has. Null or empty text has no words and no places. Columns of the input stay under their own names; the
    four new names win over equal ones of the input. Repeated rows are scanned alike; no rows give none.
    """
    base, templates = base or BASE, templates or TEMPLATES
    parsed = {label: parse(t) for label, t in templates.items()}
    phrases = {tuple(p.split()) for p in base.values()} | {tuple(words) for t in parsed.values() for words, _ in t}
    vocabulary = sorted({w for p in phrases for w in p})
    df = document_frequencies(docs, vocabulary, text_col)
    rank = sorted(vocabulary, key=lambda w: (df.get(w, 0), w))  # by falling IDF, ties by the word

    order = {w: i for i, w in enumerate(rank)}
    anchor = {p: min(p, key=order.__getitem__) for p in phrases}
    anchors = sorted(set(anchor.values()))
    indexed = sorted({w for words, _ in (x for t in parsed.values() for x in t) for w in words} | set(anchors))

    others = [c for c in docs.columns if c != text_col and c.lower() not in {"n_words", "base_starts", "found", "score", "_w", "_hits", "_starts"}]
    out = docs.select(*[F.col(f"`{c}`") for c in others], words_of(text_col).alias("_w"))
    out = out.select("*", F.expr(f"array_compact(transform(_w, (x, i) -> CASE WHEN {_in('x', indexed)} THEN named_struct('p', i, 'x', x) END))").alias("_hits"))
    names = {p: f"s{i}" for i, p in enumerate(sorted(phrases))}
    starts = []
    for p, name in names.items():
        a = anchor[p]
        places = [i for i, w in enumerate(p) if w == a]
        # one place is enough: a phrase that stands in the text has its anchor at each of them
        starts.append(F.expr(f"filter(transform(filter(_hits, h -> h.x = '{a}'), h -> h.p - {places[0]}), s -> s >= 0 AND slice(_w, s + 1, {len(p)}) = {_array(list(p))})").alias(name))
    out = out.select("*", F.struct(*starts).alias("_starts"))
    found, shares = [], []
    for label, t in parsed.items():
        aligned = [f"transform(_starts.{names[tuple(words)]}, s -> s - {at})" for words, at in t]
        both = aligned[0]
        for more in aligned[1:]:
            both = f"array_intersect({both}, {more})"
        found.append(f"CASE WHEN size({both}) > 0 THEN '{label}' END")
        share = " + ".join(f"CAST(size({x}) > 0 AS INT)" for x in aligned)
        shares.append(f"({share}) / {len(t)}D")
    labelled = {label: names[tuple(p.split())] for label, p in base.items()}
    based = " OR ".join(f"size(_starts.{n}) > 0" for n in labelled.values())
    best = f"greatest({', '.join(shares)})" if len(shares) > 1 else (shares[0] if shares else "0D")
    return out.select(
        *[F.col(f"`{c}`") for c in others],
        F.size("_w").cast("long").alias("n_words"),
        F.struct(*[F.col(f"_starts.{n}").alias(label) for label, n in labelled.items()]).alias("base_starts"),
        F.expr(f"array_compact(array({', '.join(found)}))" if found else "CAST(array() AS array<string>)").alias("found"),
        F.expr(f"CASE WHEN {based} THEN 1D WHEN true THEN {best} END").alias("score"),
    )


def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = scan(docs)
    every = F.concat(*[F.col(f"base_starts.{label}") for label in BASE])
    labels = F.array_compact(F.array(*[F.when(F.size(f"base_starts.{label}") > 0, F.lit(label)) for label in BASE]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, "found")), ",").alias("labels"),
        "score",
    )


def _sql() -> str:
    """The same rules in DuckDB: every phrase by position in every text. Frequencies only choose where to look, so SQL needs none."""
    parsed = {label: parse(t) for label, t in TEMPLATES.items()}

    def starts(words: list[str], at: int = 0) -> str:
        test = " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(words))
        return f"list_transform(list_filter(range(1, len(w) - {len(words) - 2}), lambda i: {test}), lambda i: i - 1 - {at})"

    found, shares = [], []
    for label, t in parsed.items():
        aligned = [starts(words, at) for words, at in t]
        both = aligned[0]
        for more in aligned[1:]:
            both = f"list_intersect({both}, {more})"
        found.append(f"CASE WHEN len({both}) > 0 THEN '{label}' END")
        shares.append(f"({' + '.join(f'CAST(len({x}) > 0 AS INT)' for x in aligned)}) / {len(t)}.0")
    based = {label: starts(p.split()) for label, p in BASE.items()}
    base_labels = f"list_filter([{', '.join(f"CASE WHEN len({label}) > 0 THEN '{label}' END" for label in based)}], lambda x: x IS NOT NULL)"
    return f"""
WITH d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents
), b AS (SELECT doc_id, w, {', '.join(f'{x} AS {label}' for label, x in based.items())} FROM d),
c AS (SELECT *, list_concat(list_concat(mit, apache), gpl) AS places, {base_labels} AS bl,
  list_filter([{', '.join(found)}], lambda x: x IS NOT NULL) AS found, greatest({', '.join(shares)}) AS best FROM b)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  coalesce(array_to_string(list_sort(bl), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(bl, found))), ','), '') AS labels,
  CAST(CASE WHEN len(places) > 0 THEN 1.0 ELSE best END AS DOUBLE) AS score FROM c
"""


OP2_SQL = _sql()
