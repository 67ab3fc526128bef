"""A lexical index of immutable segments [C1, J9, K5, J6]: block-max postings, delete vectors, compaction.

A segment is written once and holds three tables. ``rows`` (shard, place, row_id, sha, dl, toks, tfs): rows in shards of at most
``SHARD_ROWS`` and about ``SHARD_TOKENS``, as they come, with their distinct tokens. ``blocks`` (shard, tok, block, n, top_tf, least_dl, places, tfs, dls): up to ``BLOCK`` postings of a
token in a shard, in row order and packed, with the largest tf and the least length among them, from which a bound of their scores follows
whatever the mean length is by then. ``frequencies`` (tok, n).
A commit is a small JSON row: the live segments, rows and tokens in all. Changed and removed rows go to the delete vector of the commit
(segment, shard, place), and their tokens to its corrections of df. Readers open the last commit; a writer that dies before it
leaves files that nothing names. Compaction writes the live rows as one segment.

A search weighs its tokens by the corrected df, reads the blocks of these tokens alone, and sends them, still packed, to their shards.
A shard takes a query's tokens from the strongest bound down; once the bounds of the tokens left can't lift a new row to the k-th score so far, only rows
already met are completed, and blocks without such a row, or whose bound lifts none of theirs, stay packed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from .index import K1, TOP, B, ranked

BLOCK, SHARD_ROWS, SHARD_TOKENS, SLICE_ROWS, ASKED_TOKENS = 128, 1 << 13, 1 << 22, 512, 1_000_000
COMMIT = "number long, segments array<string>, deletes array<string>, corrections array<string>, n long, total long, shards long"
BLOCKS = "segment string, shard long, tok string, block long, n long, top_tf long, least_dl long, places binary, tfs binary, dls binary"


@dataclass(frozen=True)
class Commit:
    """What the last commit names: live segments, tables of deleted places and of df corrections, live rows and their tokens."""

    spark: SparkSession
    folder: str
    number: int
    segments: list[str]
    deletes: list[str]
    corrections: list[str]
    n: int
    total: int
    shards: int

    def table(self, kind: str) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.folder}/{s}/{kind}" for s in self.segments]) if self.segments else None

    def deleted(self) -> DataFrame | None:
        """(segment, shard, place)"""
        return self.spark.read.parquet(*[f"{self.folder}/{d}" for d in self.deletes]) if self.deletes else None

    def live(self) -> DataFrame | None:
        """Rows that no delete vector names."""
        rows, gone = self.table("rows"), self.deleted()
        return rows if rows is None or gone is None else rows.join(gone, ["segment", "shard", "place"], "left_anti")

    def frequencies(self) -> DataFrame:
        """(tok, df) of the live rows: counts of the segments' blocks, and what deleted rows take off."""
        parts = [self.table("frequencies")] if self.segments else []
        parts += [self.spark.read.parquet(*[f"{self.folder}/{c}" for c in self.corrections])] if self.corrections else []
        if not parts:
            return self.spark.createDataFrame([], "tok string, df long")
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return every.groupBy("tok").agg(F.sum("n").alias("df")).where("df > 0")

    @property
    def avgdl(self) -> float:
        return self.total / self.n if self.n else 1.0


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def open_commit(spark: SparkSession, folder: str, number: int | None = None) -> Commit:
    """The last commit in ``folder``, or that of a number; an empty one where there is none."""
    if not _exists(spark, f"{folder}/commits"):
        return Commit(spark, folder, -1, [], [], [], 0, 0, 0)
    known = spark.read.schema(COMMIT).option("recursiveFileLookup", True).json(f"{folder}/commits")
    last = (known if number is None else known.where(F.col("number") == number)).orderBy(F.desc("number")).first()
    return Commit(spark, folder, *last)


def _commit(before: Commit, **changed) -> Commit:
    """A commit is one file; two writers that start from the same one are told apart by the folder that only one can make."""
    new = Commit(**{**before.__dict__, "number": before.number + 1, **changed})
    row = (new.number, new.segments, new.deletes, new.corrections, new.n, new.total, new.shards)
    path = f"{new.folder}/commits/number_{new.number:09d}"
    new.spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("errorifexists").json(path)
    return new


ROWS = "segment string, shard long, place int, row_id long, sha string, dl long, toks array<string>, tfs array<long>"


def _number(name: str):
    """(row_id, sha, t) to rows with a shard and a place in it, and their distinct tokens with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, size = TaskContext.get().partitionId() << 20, 0, 0
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                n = batch.num_rows
                lists = batch.column(2)
                dl = pc.list_value_length(lists).cast(pa.int64())
                flat = pa.table({"row": pc.list_parent_indices(lists).cast(pa.int64()), "tok": lists.flatten()})
                held = flat.group_by(["row", "tok"], use_threads=False).aggregate([([], "count_all")])
                order = np.lexsort((np.arange(held.num_rows), held.column("row").to_numpy()))
                held = held.take(pa.array(order)).combine_chunks()
                ends = np.concatenate([[0], np.cumsum(np.bincount(held.column("row").to_numpy(), minlength=n))]).astype(np.int32)
                listed = lambda c, kind: pa.ListArray.from_arrays(pa.array(ends), held.column(c).combine_chunks().cast(kind))  # noqa: B023, E731
                shards, places = [], []
                for m in dl.to_pylist():
                    if place == SHARD_ROWS or (place and size + m > SHARD_TOKENS):
                        shard, place, size = shard + 1, 0, 0
                    shards.append(shard)
                    places.append(place)
                    place, size = place + 1, size + m
                columns = [pa.array([name] * n, pa.string()), pa.array(shards, pa.int64()), pa.array(places, pa.int32()), batch.column(0), batch.column(1), dl, listed("tok", pa.string()), listed("count_all", pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "shard", "place", "row_id", "sha", "dl", "toks", "tfs"])

    return run


def _pack(t: pa.Table) -> pa.Table:
    """A shard's postings by token, in blocks; ``toks`` are joined by blanks."""
    t = t.combine_chunks()
    lists = pc.split_pattern(t.column("toks").combine_chunks(), " ")
    tfs = t.column("tfs").combine_chunks()
    n_toks = pc.list_value_length(tfs).to_numpy()
    code = lists.flatten().filter(pc.not_equal(lists.flatten(), "")).dictionary_encode()
    tok, tf = code.indices.to_numpy(), tfs.flatten().to_numpy()
    place, dl = np.repeat(t.column("place").to_numpy(), n_toks), np.repeat(t.column("dl").to_numpy().astype(np.uint32), n_toks)
    order = np.lexsort((place, tok))
    tok, place, tf, dl = tok[order], place[order].astype(np.uint32), tf[order].astype(np.uint32), dl[order]
    first = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]])) if len(tok) else np.zeros(0, np.int64)
    inside = np.arange(len(tok)) - np.repeat(first, np.diff(np.append(first, len(tok))))
    starts = np.flatnonzero(inside % BLOCK == 0)
    ends = np.append(starts, len(tok))[1:]
    # four bytes a number: the arrays' own memory, cut at the blocks
    packed = lambda x: pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer((np.append(starts, len(tok)) * 4).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
    most = lambda f, x: pa.array((f.reduceat(x, starts) if len(starts) else x).astype(np.int64))
    return pa.table({
        "shard": pa.array(np.full(len(starts), t.column("shard")[0].as_py(), np.int64)),
        "tok": code.dictionary.take(pa.array(tok[starts])).cast(pa.string()), "block": pa.array(inside[starts] // BLOCK, pa.int64()), "n": pa.array(ends - starts, pa.int64()),
        "top_tf": most(np.maximum, tf), "least_dl": most(np.minimum, dl), "places": packed(place), "tfs": packed(tf), "dls": packed(dl),
    })


def _write_segment(spark: SparkSession, rows: DataFrame, folder: str, scan: bool = False) -> tuple[str, int, int, int] | None:
    """``rows`` (row_id, sha and text, or t: its tokens) as a new segment; its name, rows, tokens and shards. Nothing for no rows.

    Rows that are a mere ``scan`` of as many splits as there are cores stay where they are; others are dealt out.
    """
    name = f"segment-{uuid.uuid4().hex}"
    path = f"{folder}/{name}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows if scan and rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism else rows.repartition(parts)
    dealt = dealt.select("row_id", "sha", tokens(F.col("text")).alias("t") if "text" in rows.columns else F.col("t"))
    dealt.mapInArrow(_number(name), ROWS).write.option("compression", "zstd").parquet(f"{path}/rows")
    stored = spark.read.schema(ROWS).parquet(f"{path}/rows")
    n, total, shards = stored.agg(F.count("*"), F.sum("dl"), F.count_distinct("shard")).first()
    if not n:
        return None
    # a group is a shard of bounded size; joined tokens and short counts take a third of their lists in a shuffle
    short = stored.select("shard", "place", "dl", F.array_join("toks", " ").alias("toks"), F.col("tfs").cast("array<int>").alias("tfs"))
    blocks = short.groupBy("shard").applyInArrow(_pack, BLOCKS.removeprefix("segment string, "))
    # a frequent token's blocks spread over all files; inside each they are in order, so a search for a few tokens skips most row groups
    blocks.repartition(parts, "tok", "shard").sortWithinPartitions("tok", "shard", "block").select(F.lit(name).alias("segment"), "*").write.option("compression", "zstd").parquet(f"{path}/blocks")
    df = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("tok").agg(F.sum("n").alias("n"))
    df.sortWithinPartitions("tok").write.option("compression", "zstd").parquet(f"{path}/frequencies")
    return name, n, total or 0, shards


def upsert(spark: SparkSession, folder: str, chunks: DataFrame, id_col: str = "row_id", text_col: str = "text", removed: DataFrame | None = None, whole: bool = False, unique: bool = False) -> Commit:
    """[K3, J6] Brings the index in step with ``chunks``: new and changed rows are tokenised, the others aren't read again.

    A row is known by its long id; of an id that stands more than once in ``chunks`` the greatest content hash counts (``unique`` says that
    none does, and spares the texts a shuffle). A null text is empty, null ids are left out. ``removed`` (row_id) names
    rows to delete; with ``whole`` ids that ``chunks`` lacks are deleted, too. A call that changes nothing makes no commit, so a
    replayed batch has no effect.
    """
    before = open_commit(spark, folder)
    given = chunks.select(F.col(id_col).cast("long").alias("row_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("row_id IS NOT NULL")
    hashed = given.select("row_id", F.sha2("text", 256).alias("sha"), "text")
    live = before.live()
    if live is None:
        fresh, gone = hashed, None
    else:
        known = live.select("row_id", F.col("sha").alias("_sha"))
        fresh = hashed.join(known, "row_id", "left").where("_sha IS NULL OR _sha <> sha").drop("_sha")
        same = hashed.select("row_id", "sha").distinct().withColumn("_same", F.lit(True))
        marked = live.join(same, ["row_id", "sha"], "left")
        lost = marked.where("_same IS NULL")
        gone = lost if whole else lost.join(hashed.select("row_id").distinct(), "row_id", "left_semi")
        if removed is not None:
            named = live.join(removed.select(F.col(removed.columns[0]).cast("long").alias("row_id")).distinct(), "row_id", "left_semi")
            gone = gone.select(live.columns).unionByName(named.select(live.columns)).dropDuplicates(["segment", "shard", "place"])
    once = fresh if unique else fresh.groupBy("row_id").agg(F.max_by(F.struct("sha", "text"), "sha").alias("x")).select("row_id", "x.*")
    made = _write_segment(spark, once.select("row_id", "sha", "text"), folder, live is None and unique)
    deletes, corrections, n, total = list(before.deletes), list(before.corrections), before.n, before.total
    if gone is not None:
        part = f"delete-{uuid.uuid4().hex}"
        gone.select("segment", "shard", "place", "dl", "toks").write.option("compression", "zstd").parquet(f"{folder}/{part}/full")
        held = spark.read.parquet(f"{folder}/{part}/full")
        n_gone, dl_gone = held.agg(F.count("*"), F.sum("dl")).first()
        if n_gone:
            held.select("segment", "shard", "place").write.parquet(f"{folder}/{part}/places")
            held.select(F.explode("toks").alias("tok")).groupBy("tok").agg((-F.count("*")).alias("n")).write.parquet(f"{folder}/{part}/tokens")
            deletes.append(f"{part}/places")
            corrections.append(f"{part}/tokens")
            n, total = n - n_gone, total - (dl_gone or 0)
    if made is None and len(deletes) == len(before.deletes):
        return before
    segments = before.segments + ([made[0]] if made else [])
    return _commit(before, segments=segments, deletes=deletes, corrections=corrections, n=n + (made[1] if made else 0), total=total + (made[2] if made else 0), shards=before.shards + (made[3] if made else 0))


def compact(spark: SparkSession, folder: str) -> Commit:
    """The live rows as one segment without delete vectors; texts aren't needed. Searches give the same before and after."""
    before = open_commit(spark, folder)
    live = before.live()
    if live is None or (len(before.segments) == 1 and not before.deletes):
        return before
    back = F.flatten(F.zip_with("toks", "tfs", lambda t, n: F.array_repeat(t, n.cast("int"))))
    made = _write_segment(spark, live.select("row_id", "sha", back.alias("t")), folder)
    return _commit(before, segments=[made[0]] if made else [], deletes=[], corrections=[], n=made[1] if made else 0, total=made[2] if made else 0, shards=made[3] if made else 0)


def lowered(score: float) -> float:
    """A floor a little below a score: rounding never decides who is left out."""
    return score * (1 - 1e-9) - 1e-9


def score_shard(lists: dict[str, list[_Block]], asked: list[tuple[int, list[tuple[str, float]]]], dead: np.ndarray, avgdl: float, k: int, k1: float, b: float, floors: dict[int, float]) -> tuple[list, int, int]:
    """((query, places, scores) of a shard's best rows, the postings of the asked tokens, how many of them were unpacked)."""
    size = 1 + max((x.high for blocks in lists.values() for x in blocks), default=0)
    out, had, read = [], 0, 0
    score, met, alive = np.zeros(size), np.zeros(size, bool), ~dead[:size]
    tops = {t: max(x.bound for x in blocks) for t, blocks in lists.items()}
    for query, weighed in asked:
        mine = sorted(((w * tops[t], w, lists[t]) for t, w in weighed if t in lists), key=lambda x: -x[0])
        had += sum(x.n for m in mine for x in m[2])
        left = float(sum(m[0] for m in mine))
        floor, cand = floors.get(query, 0.0), None
        score.fill(0.0)
        met.fill(False)
        for bound, w, blocks in mine:
            if cand is None and left < floor:  # a row not met yet can't get more than what is left
                cand = np.flatnonzero(met & alive)
            if cand is None:
                for x in blocks:
                    read += x.n
                    places, part = x.open(avgdl, k1, b)
                    score[places] += w * part
                    met[places] = True
            else:
                cand = cand[score[cand] + left >= floor]
                for x in blocks:
                    lo, hi = np.searchsorted(cand, (x.low, x.high + 1))
                    if hi > lo and score[cand[lo:hi]].max() + (left - bound) + w * x.bound >= floor:
                        read += x.n
                        places, part = x.open(avgdl, k1, b)
                        score[places] += w * part
            left -= bound
            held = score[met & alive] if cand is None else score[cand]
            if len(held) >= k:
                floor = max(floor, lowered(float(np.partition(held, len(held) - k)[len(held) - k])))
        rows = np.flatnonzero(met & alive)
        if len(rows):
            kth = np.partition(score[rows], len(rows) - k)[len(rows) - k] if len(rows) > k else -np.inf
            rows = rows[score[rows] >= kth - 1e-8]  # ties at the last place stay
            out.append((query, rows, score[rows]))
    return out, had, read


class _Block:
    __slots__ = ("n", "low", "high", "bound", "raw", "held")

    def __init__(self, n, top_tf, least_dl, places, tfs, dls, avgdl, k1, b):
        self.n, self.raw, self.held = n, (places, tfs, dls), None
        self.low, self.high = (int.from_bytes(x, "little") for x in (places[:4], places[-4:]))
        self.bound = top_tf / (top_tf + k1 * (1 - b + b * least_dl / avgdl))

    def open(self, avgdl, k1, b):
        if self.held is None:
            places, tf, dl = (np.frombuffer(x, np.uint32) for x in self.raw)
            tf = tf.astype(np.float64)
            self.held = places.astype(np.int64), tf / (tf + k1 * (1 - b + b * dl.astype(np.float64) / avgdl))
        return self.held


def _scorer(sent, floors: dict[int, float], parts: int, avgdl: float, k: int, k1: float, b: float):
    """The best rows of a shard for its part of the queries, and a row with the postings that these had and unpacked."""

    def run(key: tuple, t: pa.Table, gone: pa.Table) -> pa.Table:
        shard = t if t.num_rows else None
        columns = {"segment": [], "shard": [], "place": [], "query_id": [], "score": [], "had": [], "read": []}
        if shard is not None:
            lists: dict[str, list] = {}
            for r in zip(*(t.column(c).to_pylist() for c in ("tok", "block", "n", "top_tf", "least_dl", "places", "tfs", "dls")), strict=True):
                lists.setdefault(r[0], []).append((r[1], _Block(*r[2:], avgdl, k1, b)))
            lists = {tok: [x[1] for x in sorted(v, key=lambda x: x[0])] for tok, v in lists.items()}
            dead = np.zeros(SHARD_ROWS, bool)
            dead[gone.column("place").to_numpy()] = True
            part = key[2].as_py()
            found, had, read = score_shard(lists, [q for i, q in enumerate(sent.value) if i % parts == part], dead, avgdl, k, k1, b, floors)
            name, number = key[0].as_py(), key[1].as_py()
            for query, places, scores in found:
                m = len(places)
                columns["segment"] += [name] * m
                columns["shard"] += [number] * m
                columns["place"] += places.tolist()
                columns["query_id"] += [query] * m
                columns["score"] += scores.tolist()
                columns["had"] += [0] * m
                columns["read"] += [0] * m
            columns["segment"].append(name)
            columns["shard"].append(number)
            columns["place"].append(None)
            columns["query_id"].append(None)
            columns["score"].append(None)
            columns["had"].append(had)
            columns["read"].append(read)
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(v, kind) for v, kind in zip(columns.values(), kinds, strict=True)], names=list(columns))

    return run


def _weighed(queries: DataFrame, commit: Commit, query_id: str, query_text: str) -> list[tuple[int, list[tuple[str, float, int]]]]:
    """The queries' tokens with their weights and df, the weightiest first, collected: a batch is bounded by ``ASKED_TOKENS``."""
    asked = queries.select(F.col(query_id).cast("long").alias("query_id"), F.explode(tokens(F.col(query_text))).alias("tok")).groupBy("query_id", "tok").agg(F.count("*").alias("qtf"))
    df = commit.frequencies().join(F.broadcast(asked.select("tok").distinct()), "tok", "left_semi")
    idf = F.log(1 + (F.lit(commit.n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    rows = asked.join(F.broadcast(df), "tok").select("query_id", "tok", (F.col("qtf") * idf).alias("w"), "df").limit(ASKED_TOKENS + 1).collect()
    if len(rows) > ASKED_TOKENS:
        raise ValueError(f"more than {ASKED_TOKENS} query tokens in one batch: search in several")
    held: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (-r["w"], r["tok"])):
        held.setdefault(r["query_id"], []).append((r["tok"], r["w"], r["df"]))
    return sorted(held.items())


def _scored(commit: Commit, asked: list[tuple[int, list[tuple[str, float]]]], floors: dict[int, float], k: int, k1: float, b: float) -> DataFrame:
    """Shards' best rows for the queries, and a row with the postings that each had and unpacked."""
    spark = commit.spark
    names = sorted({t for _, weighed in asked for t, _ in weighed})
    blocks = commit.table("blocks")
    if len(names) <= 64:
        blocks = blocks.where(F.col("tok").isin(names))
    else:
        wanted = spark.createDataFrame(pa.table({"tok": pa.array(names)}))
        blocks = blocks.where(F.col("tok").between(names[0], names[-1])).join(F.broadcast(wanted), "tok", "left_semi")
    # few shards: the queries are dealt, too, so that all tasks have work
    parts = min(len(asked), max(1, spark.sparkContext.defaultParallelism // commit.shards))
    each = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    held = blocks.withColumn("part", each)
    gone = commit.deleted()
    gone = gone if gone is not None else spark.createDataFrame([], "segment string, shard long, place int")
    gone = gone.select(F.col("segment").alias("s_"), F.col("shard").alias("h_"), "place", each.alias("p_"))
    sent = spark.sparkContext.broadcast(asked)
    return held.groupBy("segment", "shard", "part").cogroup(gone.groupBy("s_", "h_", "p_")).applyInArrow(_scorer(sent, floors, parts, commit.avgdl, k, k1, b), "segment string, shard long, place int, query_id long, score double, had long, read long")


def floors_of(commit: Commit, weighed: list[tuple[int, list[tuple[str, float, int]]]], k: int, k1: float, b: float) -> dict[int, float]:
    """A score that k rows of each query reach by its weightiest tokens alone, as many as have k postings together."""
    seeds = []
    for query, toks in weighed:
        some, n = [], 0
        for tok, w, df in toks:
            some.append((tok, w))
            n += df
            if n >= k:
                break
        seeds.append((query, some))
    found = _scored(commit, seeds, {}, k, k1, b).where("place IS NOT NULL").select("query_id", "score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("s")).where(F.col("n") == k)
    return {r["query_id"]: lowered(r["s"]) for r in kth.collect()}


def search(queries: DataFrame, commit: Commit, query_id: str = "query_id", query_text: str = "text", k: int = TOP, k1: float = K1, b: float = B, report: bool = False) -> DataFrame:
    """[C1, J9, T2] (query_id, row_id, rank, score) as ``bm25_topk`` gives it; with ``report`` one row (postings, unpacked) instead.

    The weighed query tokens are sent to the shards; a batch holds at most ``ASKED_TOKENS``. Shards get the blocks of these tokens alone. A first round
    over each query's weightiest tokens sets the floors from which all shards start.
    """
    spark = commit.spark
    weighed = _weighed(queries, commit, query_id, query_text) if commit.segments else []
    if not weighed:
        return spark.createDataFrame([(0, 0)], "postings long, unpacked long") if report else spark.createDataFrame([], "query_id long, row_id long, rank long, score double")
    floors = floors_of(commit, weighed, k, k1, b)
    scored = _scored(commit, [(q, [(t, w) for t, w, _ in toks]) for q, toks in weighed], floors, k, k1, b)
    if report:
        return scored.agg(F.coalesce(F.sum("had"), F.lit(0)).alias("postings"), F.coalesce(F.sum("read"), F.lit(0)).alias("unpacked"))
    rows = commit.table("rows").select("segment", "shard", "place", "row_id")
    found = scored.where("place IS NOT NULL").select("segment", "shard", "place", "query_id", "score")
    return ranked(rows.join(F.broadcast(found), ["segment", "shard", "place"]).select("query_id", "row_id", "score"), k)
