"""Mixing sources to target weights by iterative proportional fitting, in DataFrame expressions alone.

One aggregation sums tokens by source, language and topic. Raking then scales the cells until their sums meet the target of
every source, of every language and of every topic; it works on the table of cells, never on documents. A round is one
sum by key and one join a dimension, so neither a value with most cells nor a table of many hosts lands in one task. Rounds go
on until no target is missed by more than ``tolerance``. Targets that contradict each other, or cells that aren't there, can
leave a miss that no round lowers by one per cent any more: rounds end there, too, and the miss is returned.

A cell's weight over its tokens is its rate. A token budget sets the scale: rates are as high as the budget allows and
at most one; what a cell can't give because all its documents are taken goes to the others. A document is sampled when a hash
of its id falls below its cell's rate, so expected tokens follow all targets at once as far as the capped cells can.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, table

DIMENSIONS = ("source", "lang", "topic")
ALPHA, SHARE, TOLERANCE, STALL, LEAST_ROUNDS, MOST_ROUNDS, CELLS_A_TASK, SEED = 0.9, 0.5, 1e-6, 0.99, 4, 100, 100_000, 42

# topics by what a text is made of (fixed values): name, marks of which a text needs one, and a pattern; the first that fits counts
TOPICS = (
    ("code", ("{", "}", ";"), None),
    ("code", ("def ",), r"\bdef \w+\("),
    ("code", ("class ",), r"\bclass \w+"),
    ("table", (" | ",), r" \| .* \| "),
    ("contact", ("@",), r"@[a-z0-9.-]+\.[a-z]{2,}"),
    ("contact", ("+",), r"\+[0-9]+ \([0-9]+\)"),
    ("legal", ("license", "copyright"), r"\b(license|licensed|copyright)\b"),
    ("shouting", ("!! ",), r"!! \S+!! \S+!!"),
)


def topic(text: str = "text") -> Column:
    """A coarse topic from marks and patterns; ``prose`` if none fits, ``none`` for null or empty text.

    Patterns run only on texts that hold a mark, which is a plain search for a few bytes.
    """
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    out = F.when(low == "", F.lit("none"))
    for name, marks, pattern in TOPICS:
        test = low.contains(marks[0])
        for m in marks[1:]:
            test = test | low.contains(m)
        out = out.when(test & low.rlike(pattern) if pattern else test, F.lit(name))
    return out.otherwise(F.lit("prose"))


def _key(column: Column) -> Column:
    """A value as a key that is never null, so that nulls are a value of their own in plain joins."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def targets(cells: DataFrame, dimension: str, alpha: float = ALPHA, given: DataFrame | None = None) -> DataFrame:
    """``(_v, target)`` of every value of a dimension, summing to one; ``_v`` is its key.

    By default token shares to the power ``alpha``, scaled: under 1 small ones gain. ``given`` holds (value, target) rows, the
    value under the dimension's name; values without cells are dropped. A value that ``given`` doesn't name, or names with a
    null or negative target, keeps its own token share, and the given targets are scaled to what is left.
    """
    own = cells.groupBy(_key(F.col(dimension)).alias("_v")).agg(F.sum("tokens").cast("double").alias("n"))
    if given is None:
        shares = own.select("_v", F.pow("n", F.lit(alpha)).alias("p"))
        total = shares.agg(F.sum("p")).first()[0]
        return shares.select("_v", (F.col("p") / F.lit(total or 1.0)).alias("target"))
    named = given.select(_key(F.col(dimension)).alias("_v"), F.col("target").cast("double").alias("g")).where("g >= 0").groupBy("_v").agg(F.sum("g").alias("g"))
    both = Stored(own.join(named, "_v", "left")).df
    whole = both.agg(F.sum("n"), F.sum(F.when(F.col("g").isNull(), F.col("n"))), F.sum("g")).first()
    rest = (whole[1] or 0.0) / (whole[0] or 1.0) if (whole[2] or 0.0) > 0 else 1.0
    scale = (1.0 - rest) / whole[2] if whole[2] else 0.0
    return both.select("_v", F.when(F.col("g").isNull(), F.col("n") / F.lit(whole[0] or 1.0)).otherwise(F.col("g") * scale).alias("target"))


def rake(cells: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, alpha: float = ALPHA, given: dict[str, DataFrame] | None = None, tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``weight``, raked so that every dimension's sums meet its target, and ``miss``.

    ``weight`` is a share of all tokens. ``miss``, the same in all rows, is the largest difference between a sum and its
    target that the last round found. Cells without tokens are left out. No cells give none.
    """
    live = cells.where("tokens > 0")
    n, whole = live.agg(F.count("*"), F.sum("tokens")).first()
    parts = max(1, -(-n // CELLS_A_TASK))
    work = live.withColumn("weight", F.col("tokens") / F.lit(float(whole or 1))).withColumn("miss", F.lit(0.0))
    for i, d in enumerate(dimensions):
        own = targets(live, d, alpha, (given or {}).get(d)).withColumnRenamed("target", f"_t{i}")
        work = work.withColumn("_v", _key(F.col(d))).join(own, "_v").withColumnRenamed("_v", f"_k{i}")
    columns = work.columns
    held = Stored(work.coalesce(1) if parts == 1 else work.repartition(parts))
    miss = 0.0
    for i in range(most_rounds if n else 0):
        step = held.df.coalesce(1) if parts == 1 else held.df
        step = step.withColumn("miss", F.lit(0.0))
        for d in range(len(dimensions)):
            sums = step.groupBy(f"_k{d}").agg(F.sum("weight").alias("_s"))
            step = step.join(sums, f"_k{d}")
            step = step.withColumn("miss", F.greatest("miss", F.abs(F.col("_s") - F.col(f"_t{d}"))))
            step = step.withColumn("weight", F.when(F.col("_s") > 0, F.col("weight") * F.col(f"_t{d}") / F.col("_s")).otherwise(F.lit(0.0))).select(*columns)
        fresh = Stored(step)
        held.drop()
        held = fresh
        before, miss = miss, held.df.agg(F.max("miss")).first()[0]
        if miss <= tolerance or i >= LEAST_ROUNDS and miss > STALL * before:
            break
    return held.df.select(*dimensions, "tokens", "weight", F.lit(miss).alias("miss"))


def rates(weighed: DataFrame, budget: float) -> DataFrame:
    """``weighed`` with ``rate``: least(1, k * weight / tokens), k such that the expected tokens are ``budget``.

    Cells that k would take more than once give all they have, and k grows for the others until nothing changes.
    """
    ratio = F.col("weight") / F.col("tokens")
    k, full = None, None
    while True:
        at = F.lit(False) if k is None else ratio * k >= 1
        got = weighed.agg(F.sum(F.when(at, F.col("tokens")).otherwise(0)).alias("taken"), F.sum(F.when(~at, F.col("weight")).otherwise(0.0)).alias("rest"), F.sum(at.cast("long")).alias("full")).first()
        if k is not None and got["full"] == full:
            break
        full = got["full"] or 0
        if not got["rest"] or budget <= 0:
            k = float("inf") if budget > 0 else 0.0
            break
        k = max(0.0, budget - (got["taken"] or 0)) / got["rest"]
    rate = F.when(F.col("weight") > 0, F.lit(1.0)).otherwise(F.lit(0.0)) if k == float("inf") else F.least(F.lit(1.0), ratio * k)
    return weighed.withColumn("rate", rate)


def draw(id_col: str, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone."""
    text = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dimensions: dict[str, Column] | None = None, tokens: Column | None = None, alpha: float = ALPHA, given: dict[str, DataFrame] | None = None, share: float = SHARE, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """All rows of ``docs`` with ``_source``, ``_lang``, ``_topic`` (or the given dimensions), ``_tokens``, ``_rate`` and ``_sampled``.

    ``budget`` tokens are sampled, by default ``share`` of all: at a half, targets that ask up to twice a cell's own share
    are met. Null sources or languages are a value of their own. Tokens are words unless ``tokens`` counts them; documents
    without tokens follow no target and are never sampled. Repeated ids share one draw; a null id draws as 0. No rows give
    none. Columns of the input pass through; equal names in the input lose to the new ones. ``attained`` compares the
    result with its targets.
    """
    from .packing import token_count

    dims = dimensions or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(text_col)}
    names = [f"_{d}" for d in dims]
    mine = {*names, "_tokens", "_rate", "_sampled"}
    others = [c for c in docs.columns if c.lower() not in mine]
    size = F.coalesce(tokens if tokens is not None else token_count(text_col), F.lit(0)).cast("long")
    marked = docs.select(*[F.col(f"`{c}`") for c in others], *[c.cast("string").alias(f"_{d}") for d, c in dims.items()], size.alias("_tokens"))
    cells = Stored(marked.groupBy(*names).agg(F.sum("_tokens").alias("tokens")).select(*[F.col(f"_{d}").alias(d) for d in dims], "tokens")).df
    weighed = rake(cells, tuple(dims), alpha, given)
    if budget is None:
        budget = share * (weighed.agg(F.sum("tokens")).first()[0] or 0)
    rated = rates(weighed, float(budget)).select(*[F.col(d).alias(f"_r_{d}") for d in dims], F.col("rate").alias("_rate"))
    same = None
    for d in dims:
        test = F.col(f"_{d}").eqNullSafe(F.col(f"_r_{d}"))
        same = test if same is None else same & test
    joined = marked.join(rated, same, "left")
    rate = F.coalesce("_rate", F.lit(0.0))
    return joined.select(*[F.col(f"`{c}`") for c in others], *names, "_tokens", rate.alias("_rate"), (draw(id_col, seed) < rate).alias("_sampled"))


def attained(mixed: DataFrame, dimension: str, alpha: float = ALPHA, given: DataFrame | None = None) -> DataFrame:
    """``(value, tokens, target, expected, sampled)`` of one dimension of ``mix``: shares of tokens, asked for, expected and drawn."""
    n = F.col("_tokens")
    by = mixed.groupBy(F.col(f"_{dimension}").alias(dimension)).agg(F.sum(n).alias("tokens"), F.sum(n * F.col("_rate")).alias("e"), F.sum(F.when(F.col("_sampled"), n).otherwise(0)).alias("s"))
    by = Stored(by.where("tokens > 0")).df
    whole = by.agg(F.sum("e").alias("e"), F.sum("s").alias("s")).first()
    wanted = targets(by.select(dimension, "tokens"), dimension, alpha, given)
    return by.withColumn("_v", _key(F.col(dimension))).join(wanted, "_v").select(F.col(dimension).alias("value"), "tokens", "target", (F.col("e") / F.lit(whole["e"] or 1.0)).alias("expected"), (F.col("s") / F.lit(float(whole["s"] or 1))).alias("sampled"))


def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.round("_rate", 6).alias("rate"), F.col("_sampled").alias("sampled"))


def _sql() -> str:
    """The same rules in DuckDB: a recursive query rakes the cells, sorted prefixes find the scale."""
    low = "lower(coalesce(text, ''))"
    cases = [f"WHEN {low} = '' THEN 'none'"]
    for name, marks, pattern in TOPICS:
        test = "(" + " OR ".join(f"contains({low}, '{m}')" for m in marks) + ")"
        cases.append(f"WHEN {test}" + (f" AND regexp_matches({low}, '{pattern}')" if pattern else "") + f" THEN '{name}'")
    shares = ", ".join(f"{d}_t AS (SELECT {d}, pow(sum(n), {ALPHA}) / sum(pow(sum(n), {ALPHA})) OVER () AS t{i} FROM c GROUP BY {d})" for i, d in enumerate(DIMENSIONS))
    joins = " ".join(f"JOIN {d}_t ON c.{d} IS NOT DISTINCT FROM {d}_t.{d}" for d in DIMENSIONS)
    step, held = "r", "source, lang, topic, n, t0, t1, t2, i, worst"
    for i, d in enumerate(DIMENSIONS):
        step = f"(SELECT {held}, w * t{i} / s AS w, greatest(miss, abs(s - t{i})) AS miss FROM (SELECT *, sum(w) OVER (PARTITION BY {d}) AS s FROM {step if i else '(SELECT * REPLACE (0.0::DOUBLE AS miss) FROM r WHERE worst > ' + str(TOLERANCE) + f' AND (i <= {LEAST_ROUNDS} OR worst <= {STALL} * was) AND i < {MOST_ROUNDS})'}))"
    return rf"""
WITH RECURSIVE d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, source, lang, CASE {' '.join(cases)} ELSE 'prose' END AS topic,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS n FROM documents),
c AS (SELECT source, lang, topic, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY ALL HAVING sum(n) > 0), {shares},
r AS (SELECT c.source, c.lang, c.topic, n, t0, t1, t2, 0 AS i, n / sum(n) OVER () AS w, 0.0::DOUBLE AS miss, 1.0::DOUBLE AS worst, 1.0::DOUBLE AS was FROM c {joins}
  UNION ALL SELECT source, lang, topic, n, t0, t1, t2, i + 1, w, miss, max(miss) OVER (), worst FROM {step}),
f AS (SELECT *, w / n AS ratio FROM r WHERE i = (SELECT max(i) FROM r)),
o AS (SELECT *, ({SHARE} * sum(n) OVER () - coalesce(sum(n) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS k, count(*) OVER before AS place
  FROM f WINDOW before AS (ORDER BY ratio DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
z AS (SELECT arg_min(k, place) FILTER (WHERE k * ratio < 1) AS k FROM o),
q AS (SELECT source, lang, topic, least(1.0, coalesce(z.k * ratio, 1.0)) AS rate FROM f, z)
SELECT doc_id, d.source, d.lang, d.topic, n AS n_tokens, round(coalesce(rate, 0.0), 6) AS rate,
  CAST('0x' || substr(md5(coalesce(doc_id, 0) || ':{SEED}'), 1, 13) AS BIGINT) / {float(1 << 52)!r} < coalesce(rate, 0.0) AS sampled
FROM d LEFT JOIN q ON d.source IS NOT DISTINCT FROM q.source AND d.lang IS NOT DISTINCT FROM q.lang AND d.topic IS NOT DISTINCT FROM q.topic
"""


OP6_SQL = _sql()
