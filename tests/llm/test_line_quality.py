"""Line-first quality rules against plain counts, and what each rule cuts and keeps."""

import random
import re
from collections import Counter

import pytest

from chunkwright.llm import line_quality
from chunkwright.llm.line_quality import broken_rule, judge_text, split_words

WORDS = re.compile("[^\x20\x09-\x0d]+")
PROSE = "The river rose in the night and the people of the town went up the hill with what they could carry, and nobody looked back at the water."


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    text = text or ""
    w = WORDS.findall(text)
    lines = text.split("\n")
    dup = sum(bool(WORDS.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    uses = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return [len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), dup, len({i + j for i in range(len(w) - 2) if uses[tuple(w[i : i + 3])] > 1 for j in range(3)})]


def texts(seed=1, n=150):
    r = random.Random(seed)
    words = ["a", "b", "Ç", "x|y", "#", "日本", "A\x1cB", " ", "!", "🙂", "AB"]
    seps = [" ", " ", " ", "  ", "\t", "\n", "\r\n", "\x0b", "\n\n"]
    out = ["".join(r.choice(words[: r.randint(2, 11)]) + r.choice(seps) for _ in range(r.randint(0, 120))) for _ in range(n)]
    return [*out, None, "", " ", "\n", "\n\n", "x", "a b c a b c", "a a a a", "z " * 30000, out[5], out[5], PROSE]


def test_base_figures(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "mine", "mine") for i, t in rows], "doc_id long, text string, kept string, n_words string").repartition(3)
    got = {r["doc_id"]: r for r in line_quality.judge(df).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r, want = got[i], plain(t)
        assert (r["kept"], r["n_words"]) == ("mine", "mine")
        assert [r["_n_words"], *[r[c] for c in line_quality.FIGURES[1:5]]] == want, (i, t)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r["reason"] in ("short", "repeats")) == failed and not (failed and r["_kept"])


@pytest.mark.parametrize(
    "line, rule",
    [
        ("Home | About | Contact | Press", "navigation"), ("Home > Shop > Shoes", "navigation"), ("We use cookies to improve this site.", "boilerplate"), ("© 2020 Example. All Rights Reserved.", "boilerplate"),
        ("one*** two$$$ three&&& four### five.", "symbols"), ("BUY NOW!! LAST CHANCE!!", "capitals"), ("go go go go go go.", "echoes"), ("Related posts", "punctuation"),
        (PROSE, None), ("“Come in,” she said.", None), ("A", "punctuation"), ("NATO met in Paris.", None), ("It rose 5 % to $3 & more, by the latest count of the people who watch these things every single year.", None),
        ("a line of nine words that has no end", None), ("这是一个句子。", None), (f"{PROSE} {PROSE} They had read the terms of use and signed them.", None),
    ],
)
def test_rules(line, rule):
    assert broken_rule(line, split_words(line)) == rule


def test_cut_and_reject():
    body = "\n".join([PROSE, PROSE.replace("river", "lake").replace("town", "village").replace("hill", "ridge").replace("water", "fields")])
    assert judge_text(body)[1] in (None, "repeats")
    lines = ["He had come far, and the road behind him was long and dry, with few wells and no inn that would take a man so poor.", "Nobody asked his name; they gave him bread, a bench near the stove and a blanket that smelled of smoke and old apples.", "In spring the bees came back to the orchard."]
    text = "\n".join(["Home | About | Contact", *lines[:2], "", lines[2], "Related posts"])
    figures, reason, left = judge_text(text)
    assert reason is None and left == "\n".join([*lines[:2], "", lines[2]]) and figures[6] == 2
    menu = "\n".join([f"a{i} | b{i} | c{i}" for i in range(80)])
    assert judge_text(text + "\n" + menu)[1] == "lost"
    exact = "x" * 100  # lost exactly half: stays
    half = Rules(least_words=0)
    assert judge_text(exact + "\n" + "one two three four five six seven eight " + "y" * 59 + ".", half)[0][7:] == [200, 100]
    assert judge_text(exact + "\n" + "one two three four five six seven eight " + "y" * 59 + ".", half)[1] is None
    assert judge_text(exact + "\n" + "one two three four five six seven eight " + "y" * 58 + ".", half)[1] == "lost"
    assert judge_text(None) == ([0, 0, 0, 0, 0, 1, 0, 0, 0], "short", None)


def test_given_labels(spark, small):
    """Documents of good quality stay unless the base rules fail them; most of the bad ones with enough words go."""
    from pyspark.sql import functions as F

    judged = line_quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    by = {r["quality"]: r for r in judged.where("coalesce(reason, '') NOT IN ('short', 'repeats')").groupBy("quality").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert by[1]["kept"] == by[1]["n"] and by[0]["kept"] < 0.5 * by[0]["n"]


def test_empty(spark):
    assert line_quality.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0


Rules = line_quality.Rules
