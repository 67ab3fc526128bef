"""Phrase collocations: runs of words that stand together far more often than their parts would.

1. Texts are cut into pieces, and identical pieces of a language become one row with a multiplicity: copies cost nothing further.
2. Counting goes up by length, since a phrase is never more frequent than its parts. Words are counted by their text. Two-word runs of frequent words,
   then longer runs whose two-word parts are all frequent, are counted by 64-bit hashes: hashes that collide add up, so none that is frequent is missed.
   What reaches the limit so is counted once more by its text, and that count decides.
   Tasks add up what repeats inside them first; each hash bucket is then summed by DuckDB, which goes to disk where a bucket exceeds its memory.
3. Which phrases stay of interest travels to the tasks as an array of bits of bounded size. It only leaves work out: where it is too
   full to do so, counts are the same.
4. Candidates are dealt to blocks of bounded size. A block asks for each part of its candidates once, and the answers come back to it,
   so a part that a third of all candidates share is asked for once a block. Scores are whole numbers of any size.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _M2, _PATHS, Stored, mix64, shared_dir, shuffle_partitions, table

MIN_COUNT, MOST_WORDS, FIRST = 100, 5, 2000
CUT_ROWS, FLUSH_WORDS, MERGE_ROWS, BLOCK_CANDIDATES, MEMORY = 1 << 10, 1 << 19, 1 << 19, 1 << 14, "192MB"
PAGE_BITS, LEAST_BITS, MOST_BITS = 1 << 17, 1 << 20, 1 << 29

# one byte each: letters A-Z to lower case, the ends of pieces to a line feed, a tab to a blank (fixed values)
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, piece, m): words of a piece joined by one blank, pieces of a slice once each."""
    for batch in (b.take(pa.array(range(at, min(at + CUT_ROWS, b.num_rows)))) for b in batches for at in range(0, b.num_rows, CUT_ROWS)):  # a dozen copies of its text are alive at once
        text = pc.fill_null(batch.column(1), "").cast(pa.large_string())
        _, ends, data = text.buffers()
        low = pa.LargeStringArray.from_buffers(len(text), ends, pa.py_buffer((data or pa.py_buffer(b"")).to_pybytes().translate(_BYTES)), None, 0, text.offset)
        lists = pc.split_pattern(low, "\n")
        piece = pc.utf8_trim(pc.replace_substring_regex(lists.flatten(), " {2,}", " "), " ")
        lang = batch.column(0).take(pc.list_parent_indices(lists))
        held = pa.table({"lang": lang, "piece": piece}).filter(pc.not_equal(piece, ""))
        once = held.group_by(["lang", "piece"], use_threads=False).aggregate([([], "count_all")])
        for b in once.select(["lang", "piece", "count_all"]).to_batches():
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.string()), b.column(2).cast(pa.int64())], names=["lang", "piece", "m"])


def pieces(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, piece, m): distinct pieces of each language and how often each occurs; a null language is ``und``."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_cut, "lang string, piece string, m long").groupBy("lang", "piece").agg(F.sum("m").alias("m"))


class Words:
    """The words of a batch of pieces: texts, hashes (of language and word), multiplicities, and how many words follow inside the piece."""

    def __init__(self, lang: pa.Array, piece: pa.Array, m: np.ndarray):
        import xxhash

        lists = pc.split_pattern(piece, " ")
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.text = lists.flatten()
        ends = np.cumsum(n)
        self.after = np.repeat(ends, n) - np.arange(len(self.text)) - 1
        self.m = np.repeat(m, n)
        code = lang.dictionary_encode()
        self.langs, self.lang = code.dictionary, np.repeat(code.indices.to_numpy(), n)
        words = self.text.dictionary_encode()
        self.words, self.word = words.dictionary, words.indices.to_numpy()
        both, self.at = np.unique(self.lang.astype(np.int64) * max(1, len(self.words)) + self.word, return_inverse=True)
        self.lang_of, self.word_of = np.divmod(both, max(1, len(self.words)))
        names = [x.encode() + b"\0" for x in self.langs.to_pylist()]
        texts = self.words.to_pylist()
        digest = xxhash.xxh3_64_intdigest
        self.distinct = np.fromiter((digest(names[a] + texts[b].encode()) for a, b in zip(self.lang_of.tolist(), self.word_of.tolist(), strict=True)), np.uint64, len(both))
        self.hash = self.distinct[self.at]

    def runs(self, n: int, before: np.ndarray) -> np.ndarray:
        """Hashes of the runs of n words from each place, from those of n - 1; places too near to their piece's end hold anything."""
        out = np.zeros(len(before), np.uint64)
        out[: len(before) - n + 1] = mix64(before[: len(before) - n + 1] * _M2 + self.hash[n - 1 :])
        return out

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        return pc.binary_join_element_wise(*[self.text.take(pa.array(at + i)) for i in range(n)], pa.scalar(" ", self.text.type))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Batches put together to about half a million words."""
    held: list[pa.RecordBatch] = []
    size = 0

    def made() -> Words:
        t = pa.Table.from_batches(held).combine_chunks()
        return Words(t.column("lang").combine_chunks(), t.column("piece").combine_chunks(), t.column("m").to_numpy())

    for batch in batches:
        for at in range(0, batch.num_rows, 20_000):
            part = batch.slice(at, 20_000)
            held.append(part)
            size += int(pc.sum(pc.binary_length(part.column("piece"))).as_py() or 0) // 5
            if size >= FLUSH_WORDS:
                yield made()
                held, size = [], 0
    if held:
        yield made()


class Bits:
    """A set of 64-bit hashes as one array of bits, each hash a bit: it may hold more than it was given, never less.

    At least 32 bits a hash up to 2^29 bits (64 MB), which no data exceed; beyond that it fills up and leaves less out.
    """

    def __init__(self, hashes: DataFrame):
        """``hashes``: a stored table with one long column."""
        n = hashes.count()
        self.size = min(MOST_BITS, max(LEAST_BITS, 1 << int(32 * max(1, n) - 1).bit_length()))
        shift, page = 64 - (self.size.bit_length() - 1), PAGE_BITS

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.unique(b.column(0).to_numpy().view(np.uint64) >> np.uint64(shift)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at // page).astype(np.int32)), pa.array((at % page).astype(np.int32))], names=["page", "bit"])

        def build(t: pa.Table) -> pa.Table:
            bits = np.zeros(page, np.uint8)
            bits[t.column("bit").to_numpy()] = 1
            return pa.table({"page": t.column("page").slice(0, 1), "blob": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        spark = hashes.sparkSession
        made = hashes.mapInArrow(rows, "page int, bit int").distinct().groupBy("page").applyInArrow(build, "page int, blob binary")
        whole = np.zeros(self.size // 8, np.uint8)
        for r in made.toLocalIterator():  # at most 4,096 pages of 16 KB
            whole[r["page"] * page // 8 : (r["page"] + 1) * page // 8] = np.frombuffer(r["blob"], np.uint8)
        self.sent, self.shift = spark.sparkContext.broadcast(whole.tobytes()), shift

    def test(self):
        sent, shift = self.sent, np.uint64(self.shift)

        def hits(h: np.ndarray) -> np.ndarray:
            at = (h >> shift).astype(np.int64)
            return (np.frombuffer(sent.value, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

        return hits


def _summed(keys: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the whole sums of their multiplicities."""
    order = np.argsort(keys, kind="stable")
    keys, total = keys[order], np.concatenate([[0], np.cumsum(m[order])])
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(total[np.append(first, len(keys))])


def _merged(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
    """Counts (keys, n) of one task added up, as far as ``MERGE_ROWS`` distinct keys allow, before any is sent on."""
    held: list[pa.Table] = []
    rows = 0

    def summed() -> pa.Table:
        keys = [c for c in held[0].column_names if c != "n"]
        return pa.concat_tables(held).group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])

    for t in tables:
        held.append(t)
        rows += t.num_rows
        if rows >= 2 * MERGE_ROWS:
            held = [summed()]
            rows = held[0].num_rows
            if rows >= MERGE_ROWS:
                yield from held[0].to_batches(100_000)
                held, rows = [], 0
    if held:
        yield from summed().to_batches(100_000)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def tables() -> Iterator[pa.Table]:
        for w in _gathered(batches):
            at, n = _summed(w.at, w.m)
            yield pa.table({"lang": w.langs.take(pa.array(w.lang_of[at])), "phrase": w.words.take(pa.array(w.word_of[at])), "n": pa.array(n)})

    return _merged(tables())


def _pair_rows(frequent):
    """Hashes of two-word runs whose words are both frequent."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for w in _gathered(batches):
            good = frequent(w.distinct)[w.at]
            at = np.flatnonzero(good[:-1] & good[1:] & (w.after[:-1] > 0)) if len(good) else np.zeros(0, np.int64)
            keys, n = _summed(w.runs(2, w.hash)[at], w.m[at])
            yield pa.table({"h": pa.array(keys.view(np.int64)), "n": pa.array(n)})

    return lambda batches: _merged(tables(batches))


def _longer(w: Words, pairs, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, places, hashes) of runs of two words and more whose two-word parts are all frequent."""
    h = w.runs(2, w.hash)
    linked = (w.after > 0) & pairs(h)
    at = np.flatnonzero(linked)
    yield 2, at, h
    for n in range(3, most + 1):
        if not len(at):
            return
        at = at[(w.after[at] >= n - 1)]
        at = at[linked[at + n - 2]]
        h = w.runs(n, h)
        yield n, at, h


def _long_rows(pairs, most: int):
    """Hashes of runs of three words and more."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for w in _gathered(batches):
            for n, at, h in _longer(w, pairs, most):
                if n > 2 and len(at):
                    keys, total = _summed(h[at], w.m[at])
                    yield pa.table({"h": pa.array(keys.view(np.int64)), "n": pa.array(total)})

    return lambda batches: _merged(tables(batches))


def _phrase_rows(pairs, longer, most: int):
    """(lang, phrase, n) of runs whose hash reached the limit."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        for w in _gathered(batches):
            for n, at, h in _longer(w, pairs, most):
                at = at if n == 2 else at[longer(h[at])]
                for part in (at[i : i + 200_000] for i in range(0, len(at), 200_000)):
                    held = pa.table({"lang": pa.array(w.lang[part]), "phrase": w.phrases(part, n), "n": pa.array(w.m[part])})
                    once = held.group_by(["lang", "phrase"], use_threads=False).aggregate([("n", "sum")]).combine_chunks()
                    yield pa.table({"lang": w.langs.take(once.column("lang").combine_chunks()), "phrase": once.column("phrase"), "n": once.column("n_sum")})

    return lambda batches: _merged(tables(batches))


def _bucket(select: str, fields: list[str], scratch: str):
    """One task's bucket, summed by DuckDB; what exceeds its memory goes to a folder of its own under ``scratch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        own = f"{scratch}/{uuid.uuid4().hex}"
        os.makedirs(own, exist_ok=True)
        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY, "temp_directory": own})
        try:
            con.execute(f"CREATE TABLE parts ({', '.join(fields)})")
            held, rows = [], 0
            for batch in batches:
                held.append(batch)
                rows += batch.num_rows
                if rows >= 250_000:
                    con.register("given", pa.Table.from_batches(held))
                    con.execute("INSERT INTO parts SELECT * FROM given")
                    con.unregister("given")
                    held, rows = [], 0
            if held:
                con.register("given", pa.Table.from_batches(held))
                con.execute("INSERT INTO parts SELECT * FROM given")
                con.unregister("given")
            for got in con.sql(select).to_arrow_reader(100_000):
                yield got
        finally:
            con.close()
            shutil.rmtree(own, ignore_errors=True)

    return run


def scratch_folder(spark) -> str:
    """Where DuckDB puts what exceeds its memory: in the shared folder where that is a mounted path, else beside Spark's own spills.

    Files there belong to one task, which deletes them; nothing else reads them.
    """
    base = shared_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[5:].lstrip("/")
    if not base.startswith("/"):
        base = spark.conf.get("spark.local.dir", "/tmp").split(",")[0]
        return f"{base}/chunkwright-{uuid.uuid4().hex}"
    path = f"{base}/chunkwright-{uuid.uuid4().hex}"
    _PATHS[f"file://{path}"] = spark
    return path


def bucket_counts(parts: DataFrame, least: int, buckets: int, totals: bool = False) -> DataFrame:
    """Partial counts (keys, n) summed by hash bucket; keys that reach ``least``. ``totals`` adds a row (lang, '', all) a language and bucket."""
    keys = [c for c in parts.columns if c != "n"]
    names = ", ".join(keys)
    select = f"SELECT {names}, sum(n)::BIGINT AS n FROM parts GROUP BY {names} HAVING sum(n) >= {int(least)}"
    if totals:
        select += " UNION ALL SELECT lang, '', sum(n)::BIGINT FROM parts GROUP BY lang"
    fields = [f"{f.name} {'VARCHAR' if f.dataType.simpleString() == 'string' else 'BIGINT'}" for f in parts.schema.fields]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)
    return parts.repartition(buckets, *keys).mapInArrow(_bucket(select, fields, scratch_folder(parts.sparkSession)), kinds)


def _hash_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    for b in batches:
        h = np.fromiter((digest(x.encode() + b"\0" + y.encode()) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


def frequencies(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, most: int = MOST_WORDS, buckets: int | None = None) -> DataFrame:
    """(lang, phrase, n): all phrases of 1 to ``most`` words that occur ``least`` times or more, and, with an empty phrase, a language's words."""
    spark = docs.sparkSession
    buckets = buckets or shuffle_partitions(spark)
    held = Stored(pieces(docs, text_col, lang_col))
    words = Stored(bucket_counts(held.df.mapInArrow(_word_rows, "lang string, phrase string, n long"), least, buckets, totals=True)).df
    single = words.where("phrase <> ''")
    every = single.unionByName(words.where("phrase = ''").groupBy("lang", "phrase").agg(F.sum("n").alias("n")))
    if most < 2:
        return every
    hashes = lambda df: Stored(df.select("h"))
    kept = hashes(single.select("lang", "phrase").mapInArrow(_hash_phrases, "h long"))
    ones = Bits(kept.df).test()
    kept = hashes(bucket_counts(held.df.mapInArrow(_pair_rows(ones), "h long, n long"), least, buckets))
    pairs = Bits(kept.df).test()
    if most > 2:
        kept = hashes(bucket_counts(held.df.mapInArrow(_long_rows(pairs, most), "h long, n long"), least, buckets))
    longer = Bits(kept.df).test()
    # every task sends nearly all frequent phrases, so fewer and larger tasks send less: four splits each while all cores have work
    splits = held.df.rdd.getNumPartitions()
    wide = held.df.coalesce(max(1, min(splits, max(spark.sparkContext.defaultParallelism, splits // 4))))
    exact = bucket_counts(wide.mapInArrow(_phrase_rows(pairs, longer, most), "lang string, phrase string, n long"), least, buckets)
    return every.unionByName(exact)


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's candidates and the counts of all parts that it asked for.

    Also rows with ``inside`` set: phrases that a longer candidate holds and that occur no more often than it.
    """
    known = {(x, y): n for x, y, n in zip(*(right.column(c).to_pylist() for c in ("of", "part", "m")), strict=True)}
    out = []
    for lang, phrase, a in zip(*(left.column(c).to_pylist() for c in ("lang", "phrase", "n")), strict=True):
        words, n = phrase.split(" "), known[lang, ""]
        best = None
        for k in range(1, len(words)):
            l, r = known[lang, " ".join(words[:k])], known[lang, " ".join(words[k:])]  # noqa: E741
            score = 1000 * a * n // (l * r)
            best = (score, l, r) if best is None or score < best[0] else best
        out.append((lang, phrase, a, best[1], best[2], n, best[0], False))
        if len(words) > 2:
            for part in (" ".join(words[:-1]), " ".join(words[1:])):
                if known[lang, part] <= a:
                    out.append((lang, part, 0, 0, 0, 0, 0, True))
    columns = list(zip(*out, strict=True)) if out else [[]] * 8
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 5, pa.bool_()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "phrase", "a", "l", "r", "n", "score", "inside"])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, most: int = MOST_WORDS, first: int | None = None, buckets: int | None = None, block: int = BLOCK_CANDIDATES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): phrases of two words and more with their lowest-scoring cut, best first.

    a, l and r are the occurrences of the phrase and of the two parts, n the words of the language; score is floor(1000 * a * n / (l * r)) in
    whole numbers. Phrases inside a longer one that is as frequent are left out. ``first`` keeps so many of each language.

    Null texts are empty, a null language is ``und``; repeated rows count as often as they stand. Empty texts have no
    words, a text without ends is one piece. Only the two columns are read, whatever others are called. No rows give none.
    Ties go by score, count and phrase in byte order, so ranks are fixed.
    """
    counted = Stored(frequencies(docs, text_col, lang_col, least, most, buckets)).df
    split = counted.where(F.instr("phrase", " ") > 0)
    blocks = max(1, -(-split.count() // block))
    dealt = split.withColumn("block", F.pmod(F.xxhash64("lang", "phrase"), F.lit(blocks)).cast("int"))
    words = F.split("phrase", " ")
    cut = lambda k: F.array(F.array_join(F.slice(words, F.lit(1), k), " "), F.array_join(F.slice(words, k + 1, F.size(words) - k), " "))
    parts = F.flatten(F.transform(F.sequence(F.lit(1), F.size(words) - 1), cut))
    asked = dealt.select(F.col("block").alias("asker"), F.col("lang").alias("of"), F.explode(F.array_distinct(F.concat(parts, F.array(F.lit(""))))).alias("part")).distinct()
    answers = asked.join(counted.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias("m")), ["of", "part"]).select("asker", "of", "part", "m")
    scored = Stored(dealt.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_score, "lang string, phrase string, a long, l long, r long, n long, score long, inside boolean")).df
    left = scored.where("NOT inside").drop("inside").join(scored.where("inside").select("lang", "phrase"), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"), first=FIRST)


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase FROM w, (SELECT unnest(range(1, 6)) AS size) WHERE len(ws) >= size),
f AS (SELECT lang, phrase, any_value(size) AS size, CAST(count(*) AS BIGINT) AS a FROM g GROUP BY lang, phrase HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2),
x AS (SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, n.n,
  CAST(1000::HUGEINT * c.a::HUGEINT * n.n::HUGEINT // (l.a::HUGEINT * r.a::HUGEINT) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c) c JOIN n ON n.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:c.size], ' ')),
lowest AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_part AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, size - m + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS m FROM c WHERE size > 2))),
lost AS (SELECT DISTINCT s.lang, s.phrase FROM inner_part s JOIN f ON f.lang = s.lang AND f.phrase = s.phrase AND 100 * s.a >= 100 * f.a)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM lowest ANTI JOIN lost USING (lang, phrase) QUALIFY rank <= 2000
"""
