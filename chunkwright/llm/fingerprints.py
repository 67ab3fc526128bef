"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Every paragraph (a line of the text that is not blank) is hashed to one wide vector: 1,024 lanes of 16 bits drawn from
SHAKE-128 of its bytes, and 128 lanes of 64 bits that add the random signs of its five-word shingles. A document's fingerprint
is the sum of its paragraphs' vectors modulo 2^16 (2^64 in the signed lanes, which no text fills). The sum does not depend on the paragraphs' order, and a paragraph is
inserted or deleted by adding or subtracting its vector. The first lanes decide equality; the signed lanes are a
tug-of-war sketch whose inner products estimate how many shingles two documents share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, shingle_hashes, shuffle_partitions, table, word_hashes

LANES, SIGNS, SHINGLE, MOST_RANGES = 1024, 128, 5, 8192
_TWIST = np.uint64(0xA0761D6478BD642F)


class MultisetHash:
    """The running sum. ``add`` and ``remove`` take a text of one or more paragraphs; both are exact inverses."""

    __slots__ = ("lanes", "signs")

    def __init__(self, lanes: np.ndarray | None = None, signs: np.ndarray | None = None):
        self.lanes = np.zeros(LANES, np.uint16) if lanes is None else lanes
        self.signs = np.zeros(SIGNS, np.int64) if signs is None else signs

    def copy(self) -> MultisetHash:
        return MultisetHash(self.lanes.copy(), self.signs.copy())

    def _fold(self, text: str, sign: int) -> MultisetHash:
        shingles = []
        for paragraph in text.split("\n"):
            if words := paragraph.encode("utf-8", "surrogatepass").split():
                wide = np.frombuffer(hashlib.shake_128(paragraph.encode("utf-8", "surrogatepass")).digest(2 * LANES), np.uint16)
                self.lanes = self.lanes + wide if sign > 0 else self.lanes - wide
                shingles.append(shingle_hashes(word_hashes(words), SHINGLE))
        if shingles:
            self.signs = self.signs + sign * sign_sums(np.concatenate(shingles))
        return self

    def add(self, text: str) -> MultisetHash:
        return self._fold(text, 1)

    def remove(self, text: str) -> MultisetHash:
        return self._fold(text, -1)

    def hexdigest(self) -> str:
        """Digest of all lanes (64 digits), then a common shift (2) and the signed lanes shifted by it (512), so strings can be compared."""
        shift = max(0, int(np.abs(self.signs).max()).bit_length() - 15)
        signs = (self.signs >> shift).astype(">i2").tobytes()
        return hashlib.blake2b(self.lanes.astype("<u2").tobytes() + self.signs.astype("<i8").tobytes(), digest_size=32).hexdigest() + f"{shift:02x}" + signs.hex()

    def likeness(self, other: MultisetHash) -> float:
        return likeness(self.hexdigest(), other.hexdigest())


def sign_sums(shingles: np.ndarray) -> np.ndarray:
    total = np.zeros(SIGNS, np.int64)
    for i in range(0, len(shingles), 8192):  # long texts in blocks
        part = shingles[i : i + 8192]
        bits = np.unpackbits(np.stack([mix64(part), mix64(part ^ _TWIST)], axis=1).view(np.uint8), axis=1)
        total += 2 * bits.sum(axis=0, dtype=np.int64) - len(part)
    return total


def likeness(a: str, b: str) -> float:
    """Estimated Tanimoto likeness of two fingerprints: 1 if they are equal, about 0 for unrelated texts.

    Two fingerprints of texts without any word are equal; one such against any other gives 0.
    """
    if a == b:
        return 1.0
    x, y = (np.ldexp(np.frombuffer(bytes.fromhex(s[66:]), ">i2").astype(np.float64), int(s[64:66], 16)) for s in (a, b))
    xy, xx, yy = float(x @ y), float(x @ x), float(y @ y)
    rest = xx + yy - xy
    return min(1.0, max(0.0, xy / rest)) if rest > 0 else 0.0


def fingerprint(text: str | None) -> str:
    return MultisetHash().add(text or "").hexdigest()


def edit(text: str, after: str) -> tuple[str, int]:
    """The text with its last quarter replaced by as much of ``after``, and where its first changed paragraph starts."""
    n = len(text)
    cut = n - n // 4
    return text[:cut] + after[: n // 4], text.rfind("\n", 0, cut) + 1


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and in the order of their ids, each range closed by the next one's first row."""
    held: tuple | None = None
    for batch in batches:
        rows = []
        for span, guest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            text = text or ""
            whole = MultisetHash()
            shared = None
            if held is not None and held[0] == span:
                edited, start = edit(held[2], text)
                shared = held[3].copy().remove(held[2][start:]).add(edited[start:]).hexdigest()
                whole.add(text)
                own, own_next = held[3].hexdigest(), whole.hexdigest()
                rows.append((held[1], len(held[2]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, shared, likeness(own, shared), likeness(own, own_next)))
                held = (span, doc_id, text, whole) if not guest else None
            elif not guest:
                held = (span, doc_id, text, whole.add(text))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), OUT, strict=True)], schema=OUT)


def successor_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, in one shuffle of the texts.

    The ids are cut into ranges at sampled quantiles; a range also gets the first row of the range after it (the last
    range the first row of all), so each task walks its sorted ranges as a stream and holds two rows at a time.
    Null text: empty. Null id: sorts first. Equal ids: ordered by text. An empty table gives an empty result; columns
    besides id and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ranges = ranges or min(MOST_RANGES, 4 * shuffle_partitions(spark))
    cuts = sorted({int(x) for x in rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)}) if ranges > 1 else []
    # two steps of about sqrt(ranges) comparisons place an id
    width = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    fine = F.array(*[F.array(*[F.lit(x).cast("long") for x in g]) for g in groups]) if groups else None
    if groups:
        coarse = F.size(F.filter(F.array(*[F.lit(g[0]).cast("long") for g in groups]), lambda x: x <= F.col("doc_id")))
        span = F.when(coarse == 0, 0).otherwise((coarse - 1) * width + F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda x: x <= F.col("doc_id"))))
        span = F.coalesce(span, F.lit(0))
    else:
        span = F.lit(0)
    heads = sorted((r["span"], r["head"]["doc_id"]) for r in rows.select(span.alias("span"), "doc_id").groupBy("span").agg(F.min(F.struct("doc_id")).alias("head")).collect())
    if not heads:
        heads = [(0, None)]
    # the first row of each range also closes the range before it
    back = {heads[i][0]: heads[i - 1][0] for i in range(len(heads))}
    head_of = dict(heads)
    last = max(head_of)
    head_ids = F.array(*[F.lit(head_of.get(i)).cast("long") for i in range(last + 1)])
    before = F.array(*[F.lit(back.get(i, -1)).cast("int") for i in range(last + 1)])
    placed = rows.withColumn("span", span)
    placed = placed.withColumn("closes", F.when(F.element_at(head_ids, F.col("span") + 1).eqNullSafe(F.col("doc_id")), F.element_at(before, F.col("span") + 1)))
    twice = placed.select("doc_id", "text", F.explode(F.when(F.col("closes").isNull(), F.array(F.struct(F.col("span").alias("span"), F.lit(False).alias("guest")))).otherwise(F.array(F.struct(F.col("span").alias("span"), F.lit(False).alias("guest")), F.struct(F.col("closes").alias("span"), F.lit(True).alias("guest"))))).alias("at"))
    dealt = twice.select(F.col("at.span").alias("span"), F.col("at.guest").alias("guest"), "doc_id", "text").repartition(shuffle_partitions(spark), "span")
    return dealt.sortWithinPartitions("span", "guest", "doc_id", "text").mapInArrow(_walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op1(spark, sf_dir):
    return successor_fingerprints(table(spark, sf_dir, "documents"))
