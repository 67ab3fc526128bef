"""Line dedup: lines found in many documents go, found by probing sharded minimal perfect hashes.

Pass 1 hashes every line's key and counts its documents: one row for each distinct key of a document, summed by hash with
map-side partial sums, so a line that a third of all documents hold is a handful of partial counts. The distinct hashes
that reach the limit are dealt to shards of bounded size; each shard becomes a minimal perfect hash (levels of bit
arrays with rank counts) that indexes two compact arrays, the rest of each hash as its fingerprint and its count.
Pass 2 walks the documents again: every task looks its lines up in the arrays, no line is joined. Up to ``broadcast_bytes`` all
shards reach the tasks as one broadcast. Beyond that the documents' line hashes go to the shards, packed, and each shard
answers with those that are hot; a text then meets its answers once and is cut. A shard whose questions exceed a task's
measure is laid out several times and they are dealt among its copies. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, mix64, table

MIN_DOCS, SHARD_KEYS, BROADCAST_BYTES, ASKED_BYTES = 10, 1 << 18, 64 << 20, 64 << 20
GAMMA = 2.0


def line_key(line: bytes) -> bytes:
    """bytes.strip() and lower() act on ASCII alone: blanks are 09-0D and 20, letters A-Z."""
    return line.strip().lower()


def line_hashes(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """The lines of a text and the 64-bit hashes of their keys; an empty key hashes to 0."""
    import xxhash

    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    digest = xxhash.xxh3_64_intdigest
    out = np.fromiter(((digest(k) or 1) if (k := line_key(x)) else 0 for x in lines), np.uint64, len(lines))
    return lines, out


class PerfectHash:
    """A minimal perfect hash: key -> 0..n-1 in about three bits a key; ``fingerprints`` tell strangers apart.

    Level by level each key claims a slot of a bit array; keys whose slot nobody else claims are placed, the others go to
    the next level. The index of a key is the number of set bits before its own.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        keys = np.asarray(keys, np.uint64)
        left, sizes, words = np.arange(len(keys)), [], []
        level = 0
        while len(left):
            size = max(64, int(GAMMA * len(left)) + 63 & ~63)
            slot = self._slot(keys[left], level, size)
            uses = np.bincount(slot, minlength=size)
            alone = uses[slot] == 1
            bits = np.zeros(size, np.uint8)
            bits[slot[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone]
            level += 1
        self.sizes = np.array(sizes, np.int64)
        self.bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)]).astype(np.int64)
        self.fingerprints = np.zeros(len(keys), np.uint64)
        self.counts = np.zeros(len(keys), np.uint32)
        if len(keys):
            at = self.index(keys)
            self.fingerprints[at] = keys
            self.counts[at] = np.minimum(counts, 0xFFFFFFFF)

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys; -1 for a key that no level holds. A stranger may get a place: compare fingerprints."""
        out = np.full(len(keys), -1, np.int64)
        left, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            slot = self._slot(keys[left], level, int(size)) + base
            word, bit = slot >> 6, (slot & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.rank[word] + below)[hit]
            left = left[~hit]
            base += int(size)
        return out

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for keys that are not in the set."""
        keys = np.asarray(keys, np.uint64)
        at = self.index(keys)
        known = at >= 0
        known[known] = self.fingerprints[at[known]] == keys[known]
        out = np.zeros(len(keys), np.uint32)
        out[known] = self.counts[at[known]]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.bits), len(self.counts)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.sizes, self.bits, self.rank, self.fingerprints, self.counts))

    @classmethod
    def from_bytes(cls, blob: bytes) -> PerfectHash:
        self = cls.__new__(cls)
        levels, words, n = np.frombuffer(blob, np.int64, 3)
        at = 24
        for name, kind, size in (("sizes", np.int64, levels), ("bits", np.uint64, words), ("rank", np.int64, words + 1), ("fingerprints", np.uint64, n), ("counts", np.uint32, n)):
            setattr(self, name, np.frombuffer(blob, kind, int(size), at))
            at += int(size) * np.dtype(kind).itemsize
        return self


def _distinct_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the batch's documents: a row for each hash in it."""
    for batch in batches:
        found = [np.unique(h[h != 0]) for h in (line_hashes(t)[1] for t in batch.column(0).to_pylist())]
        if found:
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["h", "n"])


def _lines_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each hash and each text of the batch that has it; a text is known by the set of its lines."""
    import xxhash

    for batch in batches:
        found = [np.unique(h[h != 0]) for h in (line_hashes(t)[1] for t in batch.column(0).to_pylist())]
        texts = {xxhash.xxh3_64_intdigest(h.tobytes()): h for h in found if len(h)}
        if texts:
            t = np.repeat(np.array(list(texts), np.uint64), [len(h) for h in texts.values()])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(list(texts.values())).view(np.int64)), pa.array(t.view(np.int64))], names=["h", "t"])


def _build_group(table: pa.Table) -> pa.Table:
    blob = PerfectHash(table.column("h").to_numpy().view(np.uint64), table.column("n").to_numpy()).to_bytes()
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "blob": pa.array([blob], pa.binary()), "size": pa.array([len(blob)], pa.int64())})


def line_counts(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, copies: bool = True) -> DataFrame:
    """(h, n): hashes of the line keys that at least ``min_docs`` documents hold, and how many hold them.

    Without ``copies`` documents of the same lines count once.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"))
    if not copies:
        return rows.mapInArrow(_lines_of_texts, "h long, t long").distinct().groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    return rows.mapInArrow(_distinct_hashes, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


class LineIndex:
    """Shards of perfect hashes over the hot line hashes, kept in the shared folder."""

    def __init__(self, docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS, copies: bool = True):
        hot = Stored(line_counts(docs, text_col, min_docs, copies))
        self.keys = hot.df.count()
        self.shards = max(1, -(-self.keys // shard_keys))
        dealt = hot.df.select(F.pmod(F.shiftrightunsigned("h", 20), F.lit(self.shards)).cast("int").alias("shard"), "h", "n")
        self.table = Stored(dealt.groupBy("shard").applyInArrow(_build_group, "shard int, blob binary, size long"))
        hot.drop()

        self.bytes = self.table.df.agg(F.sum("size")).first()[0] or 0

    def load(self) -> list[tuple[int, bytes]]:
        """All shards, for an index of bounded size."""
        return [(r["shard"], bytes(r["blob"])) for r in self.table.df.collect()]


def _prober(sent, shards: int, min_docs: int):
    opened: dict[int, PerfectHash] = {}

    def doomed(h: np.ndarray) -> np.ndarray:
        if not opened:
            opened.update((k, PerfectHash.from_bytes(b)) for k, b in sent.value)
        shard = ((h >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
        out = np.zeros(len(h), bool)
        for k in np.unique(shard):
            if int(k) in opened:
                at = shard == k
                out[at] = opened[int(k)].counts_of(h[at]) >= min_docs
        return out & (h != 0)

    return doomed


def _ask(shards: int, copies: int):
    """Each batch's distinct lines, by the text that has them, packed for their shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            texts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            found = [(key, np.unique(h[h != 0])) for key, h in ((key, line_hashes(t)[1]) for key, t in texts.items())]
            if not found:
                continue
            key = np.repeat(np.array([k for k, _ in found], np.int64), [len(h) for _, h in found])
            h = np.concatenate([h for _, h in found])
            shard = ((h >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(shard[order]) != 0])) if len(h) else []
            rows = [(int(shard[order[a]]), turn % copies, key[order[a:b]].tobytes(), h[order[a:b]].tobytes()) for a, b in zip(edges, [*edges[1:], len(h)] if len(h) else [], strict=True)]
            turn += 1
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], names=["shard", "copy", "texts", "lines"])

    return run


def _answer(min_docs: int):
    """A shard and what it is asked: the hot lines of each text."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, hot = [], []
        if left.num_rows and right.num_rows:
            index = PerfectHash.from_bytes(right.column("blob")[0].as_py())
            for texts, lines in zip(left.column("texts"), left.column("lines"), strict=True):
                key, h = np.frombuffer(texts.as_py(), np.int64), np.frombuffer(lines.as_py(), np.uint64)
                known = index.counts_of(h) >= min_docs
                keys.append(key[known])
                hot.append(h[known].view(np.int64))
        key, h = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, hot))
        order = np.lexsort((h, key))
        key, h = key[order], h[order]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        keep = new | np.concatenate([[True], h[1:] != h[:-1]]) if len(key) else new  # copies of a text asked more than once
        key, h = key[keep], h[keep]
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        ends = np.append(edges, len(key)).astype(np.int32) if len(key) else np.zeros(1, np.int32)
        return pa.table({"key": pa.array(key[edges]), "hot": pa.ListArray.from_arrays(pa.array(ends), pa.array(h))})

    return run


def asked(work: DataFrame, text: str, key: str, index: LineIndex, min_docs: int, asked_bytes: int = ASKED_BYTES) -> DataFrame:
    """(key, gone): the hot line hashes of each text, known by a hash of the text; texts without any are left out."""
    size = work.agg(F.sum(F.octet_length(text))).first()[0] or 0
    copies = max(1, -(-size // (index.shards * asked_bytes)))
    questions = work.select(key, text).mapInArrow(_ask(index.shards, copies), "shard int, copy int, texts binary, lines binary")
    laid = index.table.df.select("shard", "blob", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    answers = questions.groupBy("shard", "copy").cogroup(laid.groupBy("shard", "copy")).applyInArrow(_answer(min_docs), "key long, hot array<long>")
    # one answer for each text and shard, whoever asked; a text's answers are no more than its lines
    apart = answers.withColumn("shard", F.pmod(F.shiftrightunsigned(F.col("hot")[0], 20), F.lit(index.shards)))
    once = apart.groupBy("key", "shard").agg(F.first("hot").alias("hot"))
    return once.groupBy("key").agg(F.flatten(F.collect_list("hot")).alias("gone"))


def drop_hot_lines(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, broadcast_bytes: int = BROADCAST_BYTES, shard_keys: int = SHARD_KEYS, copies: bool = True, asked_bytes: int = ASKED_BYTES) -> DataFrame:
    """The rows of ``docs`` with hot lines taken out of the text, and ``_lines``, ``_dropped``: lines before and lines gone.

    Null or empty text is one line that is empty and stays (null stays null). Keys are compared by a 64-bit hash.
    All other columns pass through untouched; where the input already has a column ``_lines`` or ``_dropped``, the new
    ones get further underscores in front. Repeated rows count as documents of their own, but for ``copies=False``:
    then documents of the same lines count once.
    """
    spark = docs.sparkSession
    names = docs.columns
    at = names.index(text_col)
    work = docs.toDF(*[f"c{i}" for i in range(len(names))])
    kinds = [f.dataType.simpleString() for f in docs.schema.fields]
    index = LineIndex(work.select(F.col(f"c{at}").alias("text")), "text", min_docs, shard_keys, copies)
    fields = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds))
    if index.bytes <= broadcast_bytes:
        probe = _prober(spark.sparkContext.broadcast(index.load()), index.shards, min_docs)
    else:
        probe = None
        work = work.withColumn("key", F.xxhash64(F.coalesce(f"c{at}", F.lit(""))))
        work = work.join(asked(work, f"c{at}", "key", index, min_docs, asked_bytes), "key", "left").select(*[f"c{i}" for i in range(len(names))], "gone")
    out = work.mapInArrow(_pass(probe, at, len(names)), fields + ", lines bigint, dropped bigint")
    return out.toDF(*names, fresh("_lines", names), fresh("_dropped", names))


def fresh(name: str, taken: list[str]) -> str:
    while name.lower() in {x.lower() for x in taken}:
        name = f"_{name}"
    return name


def _pass(probe, at: int, width: int):
    """Cuts hot lines: those that the broadcast index knows, or without one those that come along in the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            cut = [line_hashes(t) for t in texts]
            ends = np.cumsum(np.array([len(x[0]) for x in cut], np.int64))
            every = probe(np.concatenate([x[1] for x in cut])) if probe is not None and cut else None
            gone = batch.column(width) if probe is None else None
            kept, n_lines, n_gone = [], [], []
            for i, (lines, h) in enumerate(cut):
                if every is not None:
                    bad = every[ends[i] - len(lines) : ends[i]]
                else:
                    bad = np.isin(h, np.array(gone[i].as_py() or [], np.int64).view(np.uint64))
                kept.append(texts[i] if not bad.any() else b"\n".join(x for x, b in zip(lines, bad, strict=True) if not b).decode("utf-8", "surrogatepass"))
                n_lines.append(len(lines))
                n_gone.append(int(bad.sum()))
            columns = [batch.column(i) for i in range(width)]
            columns[at] = pa.array(kept, batch.column(at).type)
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_gone, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(f"c{i}" for i in range(width)), "lines", "dropped"])

    return run


def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = drop_hot_lines(docs)
    return kept.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH l AS (SELECT row_number() OVER () AS k, CAST(doc_id AS BIGINT) AS doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT k, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM l),
y AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM x),
hot AS (SELECT key FROM y WHERE key <> '' GROUP BY key HAVING count(DISTINCT k) >= 10),
z AS (SELECT y.*, hot.key IS NOT NULL AS gone FROM y LEFT JOIN hot USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM z GROUP BY k
"""
