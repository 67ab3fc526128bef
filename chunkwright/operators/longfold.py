"""Threshold windows [W7, W8] inside a key of any length: its rows are cut into blocks, and all tasks work on them.

Where a window starts depends on where the one before it closed, so blocks are solved for every row that a window might start at: prefix sums and a table of
running maxima give the row at which it closes, and from the back of the block follows which window is open at its end. Few different windows are: all starts
soon fall in step. Only these are carried on to the row that closes them, in the next block or a later one. What is left is a short chain of
(first start in a block, window open at its end, first start after it), a few links a block, that one task a key follows. Then
each block knows its true first start and the window that owns the rows before it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 1 << 15


class Solved:
    """A block's rows: for each row the one that closes a window begun there (n: none does), and the window open at the end."""

    def __init__(self, s: np.ndarray, e: np.ndarray, w: np.ndarray, span: float, size: float):
        self.s, self.e, self.w, self.span, self.size, n = s, e, w, span, size, len(s)
        self.sums = np.concatenate([[0], np.cumsum(w)])
        self.tops = [e]
        while 2 ** len(self.tops) <= n:
            half = 2 ** (len(self.tops) - 1)
            last = self.tops[-1]
            self.tops.append(np.maximum(last[:-half], last[half:]))
        at = np.arange(n)
        self.close = np.minimum(self.reach(at, s + span), np.searchsorted(self.sums, self.sums[at] + size, side="left") - 1)
        self.close = np.maximum(self.close, at)
        close, open_ = self.close.tolist(), [0] * (n + 1)
        open_[n] = -1  # closed with the block's last row
        for i in range(n - 1, -1, -1):
            open_[i] = i if close[i] >= n else open_[close[i] + 1]
        self.open = open_

    def reach(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first row from ``at`` on whose end is ``least`` or more; the number of rows where there is none."""
        n, at = len(self.e), at.copy()
        for level in range(len(self.tops) - 1, -1, -1):
            top = self.tops[level]
            fits = at < len(top)
            fits[fits] = top[at[fits]] < least[fits]
            at[fits] += 2**level
        return np.minimum(at, n)

    def closes(self, s: float, held: int) -> int:
        """Where a window from an earlier block closes that began at ``s`` and holds ``held`` so far."""
        return int(min(self.reach(np.zeros(1, np.int64), np.array([s + self.span]))[0], max(0, np.searchsorted(self.sums, self.size - held, side="left") - 1)))


def _solve(packed: pa.Table, span: float, size: float) -> Solved:
    return Solved(np.frombuffer(packed.column("s")[0].as_py()), np.frombuffer(packed.column("e")[0].as_py()), np.frombuffer(packed.column("w")[0].as_py(), np.int64), span, size)


def threshold_windows(df: DataFrame, key: str, start: str, end: str, size: str, most_span: float, most_size: float, order: list[str], folder: str, block: int = BLOCK_ROWS) -> DataFrame:
    """(key, window_index, start, end, size, n) as ``fold.threshold_windows`` gives it, for keys of any length.

    Rows are taken in the order of ``order``, which must settle it; sizes are whole and not negative, starts and ends not null. What is left at the end of a key
    is a window too. ``folder`` is a shared one for the blocks. Null keys are a key of their own; no rows give none.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = T.StructType([T.StructField("k", kind), T.StructField("block", T.LongType())])

    def schema(text: str) -> T.StructType:
        return T.StructType([*cut.fields, *T._parse_datatype_string(text).fields])

    def stored(x: DataFrame, name: str) -> DataFrame:
        x.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(x.schema).parquet(f"{folder}/{name}")

    names = [F.col(key).alias("k"), F.col(start).cast("double").alias("s"), F.col(end).cast("double").alias("e"), F.col(size).cast("long").alias("w")]
    ranged = df.select(*names, *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    by = ["k", *[f"o{i}" for i in range(len(order))]]
    ranged = ranged.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("k", "s", "e", "w", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("m"))
    rows = stored(ranged, "rows")
    runs = rows.groupBy("k", "part").agg(F.min("m").alias("m0"), F.count("*").alias("c"))  # a key's rows of a part stand together
    before = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    runs = runs.withColumn("off", F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("m0")).select(F.col("k").alias("k2"), F.col("part").alias("p2"), "off")
    placed = rows.join(runs, F.col("k").eqNullSafe(F.col("k2")) & (F.col("part") == F.col("p2"))).withColumn("pos", F.col("m") + F.col("off"))

    def pack(t: pa.Table) -> pa.Table:
        at = np.argsort(t.column("pos").to_numpy(), kind="stable")
        blob = lambda c: pa.array([t.column(c).to_numpy()[at].tobytes()], pa.binary())
        return pa.table({"k": t.column("k").slice(0, 1), "block": t.column("block").slice(0, 1), "s": blob("s"), "e": blob("e"), "w": blob("w")})

    blocks = stored(placed.withColumn("block", F.expr(f"pos div {block}")).select("k", "block", "pos", "s", "e", "w").groupBy("k", "block").applyInArrow(pack, schema("s binary, e binary, w binary")), "blocks")

    def opened(t: pa.Table) -> pa.Table:
        x, b = _solve(t, most_span, most_size), t.column("block")[0].as_py()
        q = np.array(sorted(set(x.open) - {-1}), np.int64)
        return pa.table({"k": t.column("k").take(pa.array(np.zeros(len(q), np.int64))), "block": pa.array(np.full(len(q), b + 1)), "q": pa.array(q + b * block), "from_s": pa.array(x.s[q]), "held": pa.array(x.sums[-1] - x.sums[q]), "after": pa.nulls(len(q), pa.int64())})

    carried = schema("q long, from_s double, held long, after long")
    waiting = stored(blocks.groupBy("k", "block").applyInArrow(opened, carried), "open0")

    def closed(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        if not right.num_rows:  # the key ends: the window stays open, and nothing starts after it
            return left.set_column(5, "after", pa.array([-1] * left.num_rows, pa.int64()))
        x, b = _solve(right, most_span, most_size), right.column("block")[0].as_py()
        at = np.array([x.closes(s, h) for s, h in zip(left.column("from_s").to_pylist(), left.column("held").to_pylist(), strict=True)], np.int64)
        done = at < len(x.s)
        columns = {"k": left.column("k"), "block": pa.array(np.where(done, b, b + 1)), "q": left.column("q"), "from_s": left.column("from_s"), "held": pa.array(left.column("held").to_numpy() + x.sums[-1]), "after": pa.array(at + 1 + b * block, mask=~done)}
        return pa.table(columns)

    ended, step = None, 0
    theirs = blocks.toDF("bk", "bb", "s", "e", "w").withColumn("block", F.col("bb"))
    while True:  # a round for each block that the longest window runs over
        step += 1
        got = stored(waiting.groupBy("k", "block").cogroup(theirs.groupBy("bk", "bb")).applyInArrow(closed, carried), f"open{step}")
        over = got.where("after IS NOT NULL").select("k", "q", "after")
        ended = over if ended is None else ended.unionByName(over)
        waiting = got.where("after IS NULL")
        if not waiting.limit(1).count():
            break
    ended = stored(ended, "ended")

    firsts = blocks.select("k", "block", (F.col("block") * block).alias("r"))
    entries = firsts.unionByName(ended.where("after >= 0").select("k", F.expr(f"after div {block}").alias("block"), F.col("after").alias("r"))).distinct()

    def follow(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"k": [], "block": [], "r": [], "q": []}
        if left.num_rows and right.num_rows:  # an entry behind the last row of the key is none
            x, b = _solve(right, most_span, most_size), right.column("block")[0].as_py()
            n = len(x.s)
            for k, r in zip(left.column("k").to_pylist(), left.column("r").to_pylist(), strict=True):
                if r - b * block < n:
                    q = x.open[r - b * block]
                    for c, v in zip(out, (k, b, r, None if q < 0 else q + b * block), strict=True):
                        out[c].append(v)
        kinds = [left.schema.field("k").type, pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    links = entries.groupBy("k", "block").cogroup(theirs.groupBy("bk", "bb")).applyInArrow(follow, schema("r long, q long"))
    known = ended.toDF("ek", "eq", "after")
    links = links.join(known, F.col("k").eqNullSafe(F.col("ek")) & (F.col("q") == F.col("eq")), "left").select("k", "block", "r", "q", F.when(F.col("q").isNull(), (F.col("block") + 1) * block).otherwise(F.col("after")).alias("then"))

    def chain(t: pa.Table) -> pa.Table:
        """A key's true links, from its first row on."""
        at = {r: i for i, r in enumerate(t.column("r").to_pylist())}
        then, picked, r = t.column("then").to_pylist(), [], 0
        while r in at:
            picked.append(at[r])
            r = then[at[r]]
        return t.take(pa.array(picked, pa.int64()))

    true = stored(links.groupBy("k").applyInArrow(chain, schema("r long, q long, then long")), "true")
    ends = blocks.groupBy("k").agg(F.max("block").alias("end")).toDF("ek", "end")
    owned = true.where("q IS NOT NULL").join(ends, F.col("k").eqNullSafe(F.col("ek"))).withColumn("upto", F.when(F.col("then") < 0, F.col("end")).otherwise(F.expr(f"(then - 1) div {block}")))
    heads = owned.where("upto > block").select("k", F.explode(F.sequence(F.col("block") + 1, F.col("upto"))).alias("block"), F.lit(None).cast("long").alias("r"), F.col("q").alias("owner"))
    told = heads.unionByName(true.select("k", "block", "r", F.lit(None).cast("long").alias("owner")))
    told = told.groupBy("k", "block").agg(F.max("r").alias("r"), F.max("owner").alias("owner"))

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        x, b = _solve(right, most_span, most_size), right.column("block")[0].as_py()
        n, r, owner = len(x.s), left.column("r")[0].as_py(), left.column("owner")[0].as_py()
        out = {c: [] for c in ("window", "place", "first", "last", "size", "n")}

        def add(window: int, lo: int, hi: int, first: float | None) -> None:
            for c, v in zip(out, (window, hi + b * block, first, float(x.e[hi - 1]), int(x.sums[hi] - x.sums[lo]), hi - lo), strict=True):
                out[c].append(v)

        i = n if r is None else r - b * block
        if i and owner is not None:
            add(owner, 0, i, None)
        while i < n:
            stop = min(int(x.close[i]) + 1, n)
            add(i + b * block, i, stop, float(x.s[i]))
            i = stop
        m = len(out["window"])
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        lead = [left.column("k").take(pa.array(np.zeros(m, np.int64))), pa.array(np.full(m, b, np.int64))]
        return pa.table([*lead, *[pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)]], names=["k", "block", *out])

    pieces = told.groupBy("k", "block").cogroup(theirs.groupBy("bk", "bb")).applyInArrow(expand, schema("window long, place long, first double, last double, size long, n long"))
    whole = pieces.groupBy("k", "window").agg(F.max("first").alias("first"), F.max_by("last", "place").alias("last"), F.sum("size").alias("size"), F.sum("n").alias("n"))
    whole = stored(whole.withColumn("block", F.expr(f"window div {block}")), "windows")
    per = whole.groupBy("k", "block").agg(F.count("*").alias("c"))
    above = Window.partitionBy("k").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    per = per.withColumn("base", F.coalesce(F.sum("c").over(above), F.lit(0))).select(F.col("k").alias("k2"), F.col("block").alias("b2"), "base")
    inside = Window.partitionBy("k", "block").orderBy("window")
    numbered = whole.withColumn("i", F.row_number().over(inside) - 1).join(per, F.col("k").eqNullSafe(F.col("k2")) & (F.col("block") == F.col("b2")))
    return numbered.select(F.col("k").alias(key), (F.col("base") + F.col("i")).cast("long").alias("window_index"), F.col("first").alias("start"), F.col("last").alias("end"), "size", "n")
