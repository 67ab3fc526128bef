"""Cross-tokenizer alignment: how the tokens of two vocabularies cover the same bytes.

Documents come in Arrow batches and are taken in blocks of a few MB. Words recur, and neither vocabulary merges across the
blank before a word, so a block aligns each of its distinct words once: DuckDB holds the two tables of token intervals, an
ASOF join finds the B token in which an A token begins, a range join adds those up to its end, and a window sum over the
shared ends numbers the groups. The block leaves its documents' figures, their linked pairs (numbers into the block's own list)
and, for each pair, how many of its documents hold it. Spark merges these partial counts. Each block then asks once for every pair that
it holds, whatever the number of its documents, and the answers meet the block's documents again.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import Stored, table

BLOCK_BYTES, SLICE_WORDS = 8 << 20, 400_000
FOLDER = "/opt/tokenizers"
# how byte-level vocabularies of this kind cut text before merging (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# a blank after a character that is none: the text may be cut before it (Python's blanks include all that the patterns know)
_CUT = re.compile(r"(?<=\S) ")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
_OPEN: dict[int, Pair] = {}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself where it prints, else the next free one from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE vocabulary file (JSON); strings of special tokens inside texts are plain text."""

    def __init__(self, data: bytes):
        import tiktoken

        file = json.loads(data)
        model, pre = file["model"], file.get("pre_tokenizer") or {}
        if model.get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or file.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        order = [model["vocab"][m] for m in made]
        if order != sorted(order):
            raise ValueError("ids don't follow the order of the merges")
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of blank + word."""
        one = self.encoding.encode_ordinary
        return [one(" " + w) for w in words]


class Pieces:
    """A sentence-piece model; a blank in front is added by the model itself."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=data)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.apart = not any(re.search("[^▁]▁", n) for n in names)  # no piece goes over the blank before a word
        self.bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(n)) else n.replace("▁", " ").encode() for n in names]
        self.blank = names.index("▁") if "▁" in names else None
        self.apart &= self.blank is not None

    def encode(self, words: list[str]) -> list[list[int]]:
        out = self.model.encode(words, num_threads=1) if words else []
        return [[self.blank] if not w and self.blank is not None else x for w, x in zip(words, out, strict=True)]


class Pair:
    """Two vocabularies, opened once a Python worker."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.len_a = np.array([len(x) for x in self.a.bytes], np.int32)
        self.len_b = np.array([len(x) for x in self.b.bytes], np.int32)

    def words(self, text: str) -> list[str]:
        """The parts that both vocabularies encode on their own, without the blank in front of each."""
        return _CUT.split(text) if self.b.apart else [text]

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids by A and by B, and whether both give back blank + word."""
        ids_a, ids_b = self.a.encode(words), self.b.encode(words)
        of_a, of_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        good = [b"".join(map(of_a, x)) == (whole := b" " + w.encode()) and b"".join(map(of_b, y)) == whole for w, x, y in zip(words, ids_a, ids_b, strict=True)]
        return ids_a, ids_b, np.array(good, bool)


def open_pair(sent) -> Pair:
    key = id(sent)
    if key not in _OPEN:
        _OPEN[key] = Pair(*sent.value)
    return _OPEN[key]


def intervals(ids: list[list[int]], lengths: np.ndarray) -> tuple[np.ndarray, pa.Table]:
    """Token counts by word, and the table (r, u, id, s, e) of tokens in order: word, id, first byte and end inside the word."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(n.sum()))
    unit = np.repeat(np.arange(len(ids), dtype=np.int32), n)
    end = np.cumsum(lengths[flat], dtype=np.int64)
    first = np.cumsum(n) - n
    before = np.concatenate([[0], end])[first]
    end = (end - np.repeat(before, n)).astype(np.int32)
    return n, pa.table({"r": np.arange(len(flat), dtype=np.int32), "u": unit, "id": flat, "s": end - lengths[flat], "e": end})


# the B token in which an A token begins, then all from there on that begin before the A token ends
LINKS = """
WITH begun AS (SELECT a.u, a.id, a.e, b.r AS r FROM ta a ASOF JOIN tb b ON a.u = b.u AND a.s >= b.s)
SELECT x.u, x.id AS a, b.id AS b FROM begun x JOIN tb b ON b.u = x.u AND b.r >= x.r AND b.s < x.e
"""
# the number of a token's group inside its word: how many shared ends lie before it
GROUPS = """
WITH shared AS (SELECT a.u, a.e, a.r AS ra, b.r AS rb FROM ta a JOIN tb b ON a.u = b.u AND a.e = b.e),
every AS (SELECT 0 AS side, ta.r, ta.u, shared.ra IS NOT NULL AS cut FROM ta LEFT JOIN shared ON shared.ra = ta.r
UNION ALL SELECT 1, tb.r, tb.u, shared.rb IS NOT NULL FROM tb LEFT JOIN shared ON shared.rb = tb.r)
SELECT side, r, cut, coalesce(sum(cut::INT) OVER (PARTITION BY side, u ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS g FROM every
"""


class Aligned:
    """Words aligned: token, group and link counts, group strings, and links by word as rows of (A id, B id)."""

    def __init__(self, ids_a: list[list[int]], ids_b: list[list[int]], pair: Pair):
        import duckdb

        n_words = len(ids_a)
        self.n_a, ta = intervals(ids_a, pair.len_a)
        self.n_b, tb = intervals(ids_b, pair.len_b)
        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB"})
        try:
            for name, held in (("ta", ta), ("tb", tb)):
                con.register("given", held)
                con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
                con.unregister("given")
            links = con.execute(LINKS).fetchnumpy()
            groups = con.execute(GROUPS).fetchnumpy()
        finally:
            con.close()
        unit = np.asarray(links["u"], np.int64)
        order = np.argsort(unit, kind="stable")
        self.pairs = (np.asarray(links["a"], np.int64) << 32 | np.asarray(links["b"], np.int64))[order]
        self.n_links = np.bincount(unit, minlength=n_words)
        self.first = np.cumsum(self.n_links) - self.n_links
        side, row, group = (np.asarray(groups[c]) for c in ("side", "r", "g"))
        cut = np.asarray(groups["cut"], bool)
        g_a, g_b = np.empty(len(ta), np.int64), np.empty(len(tb), np.int64)
        g_a[row[side == 0]], g_b[row[side == 1]] = group[side == 0], group[side == 1]
        word_a, word_b = (t.column("u").to_numpy() for t in (ta, tb))
        self.n_groups = np.bincount(word_a[row[(side == 0) & cut]], minlength=n_words)
        self.texts = self._texts(word_a, g_a, ta.column("id").to_numpy(), word_b, g_b, tb.column("id").to_numpy(), n_words)

    def _texts(self, word_a, g_a, id_a, word_b, g_b, id_b, n_words: int) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each word: tokens in the order of word, group, side and place."""
        start = np.cumsum(self.n_groups) - self.n_groups
        place = np.concatenate([2 * (start[word_a] + g_a), 2 * (start[word_b] + g_b) + 1])
        order = np.argsort(place, kind="stable")
        place, ids, word = place[order], np.concatenate([id_a, id_b])[order].tolist(), np.concatenate([word_a, word_b])[order]
        new_word = np.diff(word, prepend=-1) != 0
        sign = np.where(new_word, "", np.where(np.diff(place, prepend=-1) == 0, ",", np.where(place % 2 == 1, "|", ";"))).tolist()
        parts = [f"{a}{b}" for a, b in zip(sign, ids, strict=True)]
        ends = np.cumsum(np.bincount(word, minlength=n_words)).tolist()
        return ["".join(parts[a:b]) for a, b in zip([0, *ends], ends)]  # noqa: B905


def block_row(texts: list[str | None], pair: Pair, keep_groups: bool = False) -> dict:
    """The figures of a block's documents, and its distinct linked pairs with the number of documents that hold each."""
    index: dict[str, int] = {}
    put = index.setdefault
    held = [np.array([put(w, len(index)) for w in pair.words(t)], np.int64) if t else np.zeros(0, np.int64) for t in texts]
    ids_a, ids_b, good = pair.encode(list(index))
    # a document with a word that doesn't come back is tried as a whole
    for i, h in enumerate(held):
        if len(h) and not good[h].all():
            whole_a, whole_b, ok = pair.encode([texts[i]])
            held[i] = np.array([len(ids_a)], np.int64) if ok[0] else np.zeros(0, np.int64)
            if ok[0]:
                ids_a += whole_a
                ids_b += whole_b
                good = np.append(good, True)
    used = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
    at = np.zeros(len(ids_a), np.int64)
    at[used] = np.arange(len(used))
    held = [at[h] for h in held]
    words = Aligned([ids_a[i] for i in used], [ids_b[i] for i in used], pair)
    keys, number = np.unique(words.pairs, return_inverse=True)
    total = lambda x: [int(x[h].sum()) for h in held]
    groups = [";".join(map(words.texts.__getitem__, h.tolist())) for h in held]
    out = {"n_a": total(words.n_a), "n_b": total(words.n_b), "n_groups": total(words.n_groups), "n_links": total(words.n_links)}
    out["sha"] = [hashlib.sha256(g.encode()).hexdigest() if len(h) else "" for g, h in zip(groups, held, strict=True)]
    out["groups"] = groups if keep_groups else [None] * len(groups)
    sizes, lists, times, docs_of = [], [], [], np.zeros(len(keys), np.int64)
    lo, lengths = 0, [len(h) for h in held]
    while lo < len(held):  # some documents at a time, so that the rows of links stay few
        hi, n = lo, 0
        while hi < len(held) and (hi == lo or n + lengths[hi] <= SLICE_WORDS):
            n += lengths[hi]
            hi += 1
        doc = np.repeat(np.arange(hi - lo), lengths[lo:hi])
        both, uses = np.unique(doc * max(1, len(used)) + np.concatenate(held[lo:hi]), return_counts=True)
        doc, unit = np.divmod(both, max(1, len(used)))
        m = words.n_links[unit]
        inside = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        link = number[np.repeat(words.first[unit], m) + inside]
        both, back = np.unique(np.repeat(doc, m) * max(1, len(keys)) + link, return_inverse=True)
        doc, link = np.divmod(both, max(1, len(keys)))
        times.append(np.bincount(back, np.repeat(uses, m), len(both)).astype(np.uint32))
        lists.append(link.astype(np.uint32))
        sizes.append(np.bincount(doc, minlength=hi - lo))
        docs_of += np.bincount(link, minlength=len(keys))
        lo = hi
    join = lambda x, kind: np.concatenate(x).astype(kind).tobytes() if x else b""
    return out | {"pairs": keys, "docs": docs_of, "sizes": join(sizes, np.uint32), "links": join(lists, np.uint32), "times": join(times, np.uint32)}


def _blocks(sent, block_bytes: int, keep_groups: bool, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part, turn = open_pair(sent), TaskContext.get().partitionId(), 0
        keys: list[pa.Array] = []
        texts: list[str | None] = []

        def row() -> pa.RecordBatch:
            got = block_row(texts, pair, keep_groups)
            one = lambda x, kind: pa.array([x], pa.list_(kind))
            whole = pa.concat_arrays(keys)
            columns = {
                "block": pa.array([part << 32 | turn], pa.int64()), "keys": pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole),
                **{c: one(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}, "sha": one(got["sha"], pa.string()), "groups": one(got["groups"], pa.string()),
                "pairs": one(got["pairs"], pa.int64()), "docs": one(got["docs"], pa.int64()), **{c: pa.array([got[c]], pa.binary()) for c in ("sizes", "links", "times")},
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        size = 0
        for batch in batches:
            got, start = batch.column(1).to_pylist(), 0
            for i, t in enumerate(got):
                texts.append(t)
                size += len(t or "") + 8
                if size >= block_bytes:
                    keys.append(batch.column(0).slice(start, i + 1 - start).cast(key_type))
                    yield row()
                    keys, texts, size, start, turn = [], [], 0, i + 1, turn + 1
            if start < len(got):
                keys.append(batch.column(0).slice(start).cast(key_type))
        if texts:
            yield row()

    return run


def read_vocabulary(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file from wherever Spark or the driver can read it."""
    if "://" not in path:
        return Path(path).read_bytes()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, keep_groups: bool = False) -> Stored:
    """A row for each block of documents, written once: encoding is the dear part and isn't done again."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((read_vocabulary(spark, a_path), read_vocabulary(spark, b_path)))  # two vocabulary files of a few MB
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("keys", T.ArrayType(kind))])
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema.add(name, T.ArrayType(T.LongType()))
    for name in ("sha", "groups"):
        schema.add(name, T.ArrayType(T.StringType()))
    for name in ("pairs", "docs"):
        schema.add(name, T.ArrayType(T.LongType()))
    for name in ("sizes", "links", "times"):
        schema.add(name, T.BinaryType())
    rows = docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").cast("string").alias("t"))
    return Stored(rows.mapInArrow(_blocks(sent, block_bytes, keep_groups, to_arrow_type(kind)), schema))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n): how many documents hold each linked pair; ``pair`` is the A id times 2^32 plus the B id. Blocks bring partial counts."""
    rows = blocks.select(F.inline(F.arrays_zip("pairs", "docs")))
    return rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n"))


def mapping(counts: DataFrame) -> DataFrame:
    """(a, b, n, best): pairs of ids, the documents that hold them linked, and whether that is the A id's highest count (ties included)."""
    split = counts.select(F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n")
    most = split.groupBy("a").agg(F.max("n").alias("m"))  # a row for each id of the vocabulary at most
    return split.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("m")).alias("best"))


def _meet(key_type: pa.DataType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = left.to_pylist()[0]
        pairs = np.array(got["pairs"], np.int64)
        asked = right.column("pair").to_numpy()
        order = np.argsort(asked)
        assert np.array_equal(asked[order], pairs)
        n, best = right.column("n").to_numpy()[order], right.column("best").to_numpy()[order]
        sizes, links, times = (np.frombuffer(got[c], np.uint32).astype(np.int64) for c in ("sizes", "links", "times"))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        held = left.column("keys").combine_chunks()
        columns = {"k": held.flatten().cast(key_type), **{c: pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}}
        columns |= {"n_best": pa.array(_sums(doc, times * best[links], len(sizes))), "count_sum": pa.array(_sums(doc, times * n[links], len(sizes))), "groups_sha256": pa.array(got["sha"], pa.string()), "groups": pa.array(got["groups"], pa.string())}
        return pa.table(columns)

    return run


def _sums(key: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Whole sums by key, which rises; no floating point."""
    total = np.concatenate([[0], np.cumsum(x)])
    ends = np.searchsorted(key, np.arange(n), side="right")
    return total[ends] - total[np.concatenate([[0], ends[:-1]])] if n else total[:0]


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, keep_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs). Documents: the id column, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and groups (null unless kept).

    Pairs: (a, b, n, best), see ``mapping``. Null and empty texts, and texts that a vocabulary doesn't give back byte for byte,
    have no tokens: zeros and an empty hash. Ids are carried only: null and repeated ones are rows like others, and repeated
    rows are documents of their own. Other columns are not read, whatever their names. A table without rows gives none. A text of any
    length is one row of a block; a block holds at most about ``block_bytes`` characters or one text.
    """
    blocks = aligned_blocks(docs, a_path, b_path, id_col, text_col, block_bytes, keep_groups).df
    pairs = Stored(mapping(pair_counts(blocks))).df
    keyed = pairs.select((F.shiftleft("a", 32) + F.col("b")).alias("pair"), "n", "best")
    asked = blocks.select(F.col("block").alias("asker"), F.explode("pairs").alias("pair"))  # once a block
    answers = asked.join(keyed, "pair").select("asker", "pair", "n", "best")
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("k", kind)])
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema.add(name, T.LongType())
    schema.add("groups_sha256", T.StringType()).add("groups", T.StringType())
    met = blocks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_meet(to_arrow_type(kind)), schema)
    return met.withColumnRenamed("k", id_col), pairs


def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, _ = align(docs, f"{FOLDER}/byte_bpe_50k.json", f"{FOLDER}/piece_bpe_32k.model")
    return found.drop("groups")
