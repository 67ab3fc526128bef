"""Quality classifier with hierarchical empirical Bayes.

Two logistic models, one for low quality and one for toxic text, are fitted on at most ``max_labelled`` labelled rows
(10,000, taken by a hash of the id) over hashed words, word beginnings and a few measures of form. Every document then gets its own evidence. Hosts and
paths get Beta posteriors from grouped sums of that evidence: a host's share of bad text shrinks toward the global share by
a prior whose weight comes from the spread between hosts (method of moments), a path's toward its host's in the same way.
A document's posterior odds are its own odds times the odds of its path against the global odds, so that sparse sites
count for little and no site decides alone. Site tables come from partial sums; documents meet them by a join on the path.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, table

MAX_LABELLED, SLOTS, THRESHOLD, SITE_POWER = 10_000, 1 << 18, 0.5, 0.5
FORM = 14
SYMBOLS = "#*-_=<>{}"


def _kinds(text: str) -> tuple[int, int, int]:
    """Upper-case letters, digits and symbols of the whole text."""
    if text.isascii():
        n = np.bincount(np.frombuffer(text.encode("ascii"), np.uint8), minlength=128)
        return int(n[65:91].sum()), int(n[48:58].sum()), int(n[list(SYMBOLS.encode("ascii"))].sum())
    seen = Counter(text)
    return sum(k for c, k in seen.items() if c.isupper()), sum(k for c, k in seen.items() if c.isdigit()), sum(seen[c] for c in SYMBOLS)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct slots of words and word beginnings, and measures of form between 0 and about 1."""
    import xxhash

    text = text or ""
    raw = text.split()
    n = len(raw)
    form = np.zeros(FORM)
    form[0] = 1.0
    if n == 0:
        form[1] = 1.0
        return np.zeros(0, np.int64), form
    chars = max(1, len(text))
    lines = [x for x in text.split("\n") if x.strip()]
    distinct = set(raw)
    upper, digits, symbols = _kinds(text)
    kinds = {w.strip("\"'.,;:!?()[]{}|<>").lower() for w in distinct}
    kinds.discard("")
    form[2:] = (
        np.log1p(n) / 10, len(distinct) / n, upper / chars, text.count("!") / n, text.count("|") / n, min(2.0, chars / n / 10), digits / chars,
        len(set(lines)) / max(1, len(lines)), text.count(",") / n, text.count(".") / n, sum(a == b for a, b in zip(raw, raw[1:], strict=False)) / n, symbols / n,
    )
    digest = xxhash.xxh3_64_intdigest
    slots = {digest(w) % SLOTS for w in kinds} | {digest(f"^{w[:5]}") % SLOTS for w in kinds if len(w) > 5}
    return np.array(sorted(slots), np.int64), form


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [features(t) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.astype(np.int32).tobytes() for s, _ in got], pa.binary()), pa.array([f.tobytes() for _, f in got], pa.binary()), b.column(3)], names=["low", "toxic", "slots", "form", "h"])


class Logistic:
    """Ridge logistic regression over sparse slots and dense measures, by Adam on all rows."""

    def __init__(self, weights: np.ndarray, form: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.form, self.mean, self.scale = weights, form, mean, scale

    @classmethod
    def fit(cls, slots: list[np.ndarray], form: np.ndarray, y: np.ndarray, steps: int = 400, ridge: float = 0.1, clear: float = 4.0) -> Logistic:
        n = len(y)
        mean, scale = form.mean(0), form.std(0) + 1e-6
        mean[0], scale[0] = 0.0, 1.0
        x = (form - mean) / scale
        used, at = np.unique(np.concatenate(slots) if n else np.zeros(0, np.int32), return_inverse=True)
        at = at.astype(np.int32)
        sizes = np.array([len(s) for s in slots])
        row = np.repeat(np.arange(n, dtype=np.int32), sizes)
        # only slots whose log odds stand clear of chance: invented and rare words must not be learned by heart
        with_slot = np.bincount(at, minlength=len(used)).astype(np.float64)
        hits = np.bincount(at, weights=y[row], minlength=len(used))
        cells = (hits + 0.5, with_slot - hits + 0.5, y.sum() - hits + 0.5, n - y.sum() - with_slot + hits + 0.5)
        gap = np.log(cells[0] * cells[3] / (cells[1] * cells[2])) / np.sqrt(sum(1 / c for c in cells))
        told = np.abs(gap) >= clear
        keep = told[at]
        place = np.cumsum(told) - 1
        at, row = place[at[keep]], row[keep]
        used = used[told]
        value = np.ones(len(used))
        theta = np.zeros(len(used) + x.shape[1])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        val = value[at]
        for t in range(1, steps + 1):
            z = np.bincount(row, weights=val * theta[at], minlength=n) + x @ theta[len(used):]
            g = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
            grad = np.concatenate([np.bincount(at, weights=val * g[row], minlength=len(used)) + ridge * theta[: len(used)], x.T @ g + 0.01 * theta[len(used):]]) / max(1, n)
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            theta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        weights = np.zeros(SLOTS, np.float32)
        weights[used] = value * theta[: len(used)]
        return cls(weights, theta[len(used):], mean, scale)

    def odds(self, slots: np.ndarray, form: np.ndarray) -> float:
        return float(np.clip(self.weights[slots].sum() + ((form - self.mean) / self.scale) @ self.form, -30, 30))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> tuple[Logistic, Logistic] | None:
    """Models of low quality and of toxic text, fitted to at most ``max_labelled`` labelled rows, those of the least hashes of their ids; null where no label meets a document."""
    clean = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).where("_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    known = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    told = clean.join(known.select("_id").distinct(), "_id", "left_semi")
    order = F.xxhash64("_id", F.lit(10))
    sample = told.orderBy(order, "_id", "quality", "toxic").limit(max_labelled)
    rows = known.join(F.broadcast(sample), "_id").select((1 - F.col("quality")).alias("low"), "toxic", "text", order.alias("h"))
    made = rows.mapInArrow(_collect, "low int, toxic int, slots binary, form binary, h long")
    got = made.orderBy("h", "low", "toxic", "slots", "form").limit(max_labelled).collect()
    if not got:
        return None
    slots = [np.frombuffer(r["slots"], np.int32) for r in got]
    form = np.stack([np.frombuffer(r["form"], np.float64) for r in got])
    low, toxic = (np.array([float(r[k] > 0) for r in got]) for k in ("low", "toxic"))
    return Logistic.fit(slots, form, low), Logistic.fit(slots, form, toxic)


def _score(sent, text_at: int, carried: bool):
    """Both models' probabilities of each row; the rows themselves come along only if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value and [Logistic(*m) for m in sent.value]
        for b in batches:
            odds = [[], []]
            for t in b.column(3).field(text_at).to_pylist():
                f = features(t)
                for o, m in zip(odds, models or (None, None), strict=True):
                    o.append(m.odds(*f) if m else -30.0)
            p = [1 / (1 + np.exp(-np.array(o, np.float64))) for o in odds]
            yield pa.RecordBatch.from_arrays([*b.columns[: 4 if carried else 3], pa.array(p[0], pa.float64()), pa.array(p[1], pa.float64())], names=["id", "host", "path", *["row"] * carried, "low", "toxic"])

    return run


def shrink(sites: DataFrame, key: str, prior: str) -> DataFrame:
    """Sites (n, bad, ``prior``) with ``post``: bad shares shrunk toward the prior by its estimated weight in documents.

    The variance between sites is what their spread around the prior leaves above the variance that their sizes explain.
    """
    share, p = F.col("bad") / F.col("n"), F.col(prior)
    s = sites.where("n > 1").agg(F.sum(F.col("n") * (share - p) * (share - p)).alias("spread"), F.count("*").alias("k"), F.sum(p * (1 - p)).alias("noise"), F.sum("n").alias("n")).first()
    between = max(0.0, (s["spread"] or 0.0) - (s["noise"] or 0.0)) / max(1, s["n"] or 1)
    mean_noise = (s["noise"] or 0.0) / max(1, s["k"] or 1)
    weight = min(1e6, max(1.0, mean_noise / between - 1)) if between > 0 else 1e6
    return sites.withColumn("post", (F.col("bad") + weight * p) / (F.col("n") + weight))


def _logit(c: Column) -> Column:
    c = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), c))
    return F.log(c / (1 - c))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host: Column | None = None, path: Column | None = None, threshold: float = THRESHOLD, site_power: float = SITE_POWER, max_labelled: int = MAX_LABELLED, carry: bool = False) -> DataFrame:
    """``(doc_id, host, path, p_low, p_toxic, host_bad, path_bad, p_bad, keep)`` for every row of ``docs``; with ``carry`` also
    ``row``, a struct of all its columns, so that a decision stays with its row whatever the ids.

    ``host`` is the source and ``path`` source and language by default; nulls are sites of their own. ``site_power`` is the
    weight of a path's odds beside the document's. Without labels nothing is rejected. Null or empty text is judged by its
    form like any other. Repeated rows get equal results. No rows give none. Other columns are ignored.
    """
    spark = docs.sparkSession
    models = fit(docs, labels, id_col, text_col, max_labelled)
    sent = spark.sparkContext.broadcast(models and [(m.weights, m.form, m.mean, m.scale) for m in models])
    host = F.coalesce((host if host is not None else F.col("source")).cast("string"), F.lit(""))
    path = F.coalesce((path if path is not None else F.col("lang")).cast("string"), F.lit(""))
    names = docs.columns if carry else [text_col]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    kinds = ", ".join(f"c{i}: {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), F.concat_ws("/", host, path).alias("path"), row.alias("row"))
    kind = f"id long, host string, path string{f', row struct<{kinds}>' if carry else ''}, low double, toxic double"
    scored = Stored(rows.mapInArrow(_score(sent, names.index(text_col), carry), kind)).df
    bad = F.col("low") + F.col("toxic") - F.col("low") * F.col("toxic")
    paths = Stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(bad).alias("bad"))).df
    whole = paths.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    overall = (whole["bad"] or 0.0) / max(1, whole["n"] or 1)
    hosts = shrink(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("all", F.lit(overall)), "host", "all").select("host", F.col("post").alias("host_bad"))
    sites = shrink(paths.join(hosts, "host"), "path", "host_bad")
    sites = Stored(sites.select("host", "path", "host_bad", F.col("post").alias("path_bad"), (_logit(F.col("post")) - _logit(F.lit(overall))).alias("shift"))).df
    joined = scored.join(sites, ["host", "path"]).withColumn("p_bad", 1 / (1 + F.exp(-(_logit(bad) + site_power * F.col("shift")))))
    return joined.select(F.col("id").alias("doc_id"), "host", "path", F.col("low").alias("p_low"), F.col("toxic").alias("p_toxic"), "host_bad", "path_bad", "p_bad", (F.col("p_bad") < threshold).alias("keep"), *(["row"] if carry else []))


def op10(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
