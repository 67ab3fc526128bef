"""N-gram Jaccard join over count vectors.

A document is the set of its word shingles. Shingles are hashed into groups; the group counts are the document's point,
and two sets share at most the sum of the coordinate minima of their points. The join runs in three steps.

1. *Routing.* All pairs of points can't be dealt to machines, so documents that can link are brought together first.
   Shingles are ordered by document frequency, ties by hash. Two sets that link share one of their first
   n - ceil(t n) + 1 shingles in any common order (t the threshold), and rare first means that few others share it.
   One exchange counts all shingles; shingles that no other document has never travel again. Each set then sends what is
   left of its own first shingles; documents that share one form candidate clusters through star edges to the least member,
   first inside a task and then across tasks, so no group is ever gathered.
2. *Blocks.* A cluster of bounded volume is one block. A larger one is cut by set size into classes a factor 1/t apart,
   so that links lie inside a class or between neighbours, and classes into blocks of bounded volume; all pairs of blocks
   that can hold a link meet, each in a task of two blocks. Work is quadratic only in documents that share rare
   shingles and differ in text.
3. *R-tree.* A block packs its points into an R-tree by size and least shingle; pairs of nodes go when the summed
   minima of their upper corners fall short of the overlap that the threshold asks for, then pairs of points in the same way.
   All pairs that are left are verified on the sets themselves. Each set gets the number of documents that it links with,
   and links leave the task as a forest, so no list of pairs is ever written.

Equal sets are one class from the start. Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Stored, beside, components, forest, mix64, shingle_hashes, shuffle_partitions, table, word_hashes
from .suffix_dedup import _blobs, unpack

WORDS, PERCENT, BLOCK_SHINGLES, FLUSH, MANY = 5, 80, 120_000, 1 << 19, 64
POINT, LEAF, FAN, PART_BYTES = 128, 16, 16, 16 << 20
NULL_ID = -(1 << 63)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles; blanks are 09-0D and 20, A-Z are lower-cased."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(word_hashes(found), words))


def set_key(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return (d & (1 << 64) - 1) - (1 << 64) * (d >> 63 & 1), (d >> 64) - (1 << 64) * (d >> 127)


def _stars(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each signature with its least class, and edges from the other classes to it."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    first = np.concatenate([[True], sig[1:] != sig[:-1]])
    lead = cls[first][np.cumsum(first) - 1]
    other = cls != lead
    a, b = forest(cls[other], lead[other])
    return sig[first], cls[first], a, b


T = "kind int, x long, y long, n long, row long"
PACKED = "part int, kind int, blob binary"
SKETCH, COUNT, HEAVY, SHARED, OWN, SIGN, EDGE = range(7)


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


def _range(h: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """The part of a shortened hash: equal ranges, so that a part's sorted hashes lie close together."""
    width = np.uint64(-(-(1 << bits) // parts))
    return (h // width).astype(np.int64)


def _pack_counts(base: int, h: np.ndarray, place: np.ndarray) -> bytes:
    """Sorted hashes as steps, byte by byte so that empty high bytes compress, and who has them, counted from ``base``."""
    step = np.diff(h, prepend=np.uint64(0))
    return np.array([base, len(h)], np.int64).tobytes() + step.view(np.uint8).reshape(-1, 8).T.tobytes() + place.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _open_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    base, n = np.frombuffer(blob, np.int64, 2)
    step = np.ascontiguousarray(np.frombuffer(blob, np.uint8, 8 * n, 16).reshape(8, n).T).view(np.uint64).ravel()
    place = np.ascontiguousarray(np.frombuffer(blob, np.uint8, 4 * n, 16 + 8 * n).reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(step, dtype=np.uint64), base + place.astype(np.int64)


def _owner(ref: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(ref.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _scan(words: int, bits: int, parts: int):
    """Sets of each task's documents: equal ones once, shingles dealt by hash. A set is known by task and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        base = (context.partitionId() if context is not None else 0) << 32
        seen, sets, keys, sketch, size = set(), [], [], [], 0

        def flush():
            nonlocal base
            doc, key, n, row = (np.array(x, np.int64) for x in zip(*sketch, strict=True))
            rows = [(p, SKETCH, blob) for p, blob in _blobs(np.arange(len(doc)) % parts, doc, key, n, row)]
            if sets:
                ref = base + np.arange(len(sets))
                sizes = np.array([len(x) for x in sets], np.int64)
                rows += [(p, OWN, blob) for p, blob in _blobs(_owner(ref, parts), ref, np.array(keys, np.int64), sizes)]
                h = np.concatenate(sets) >> np.uint64(64 - bits)
                sets.clear()
                place = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
                order = np.argsort(h, kind="stable")
                h, place = h[order], place[order]
                del order
                first = np.concatenate([[True], h[1:] != h[:-1]])
                count = np.diff(np.append(np.flatnonzero(first), len(h)))
                heavy = np.repeat(count > MANY, count)
                if heavy.any():
                    rows += [(p, HEAVY, blob) for p, blob in _blobs(_range(h[heavy & first], bits, parts), h[heavy & first])]
                    rows += [(p, SHARED, blob) for p, blob in _blobs(_owner(base + place[heavy].astype(np.int64), parts), base + place[heavy].astype(np.int64), h[heavy], np.full(heavy.sum(), MANY, np.uint8))]
                h, place = h[~heavy], place[~heavy]
                part = _range(h, bits, parts)
                cut = np.searchsorted(part, np.arange(parts + 1))
                rows += [(p, COUNT, _pack_counts(base, h[a:b], place[a:b])) for p, (a, b) in enumerate(zip(cut, cut[1:], strict=False)) if b > a]
                base += len(sizes)
            return _rows(rows)

        for batch in batches:
            for doc, row, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1), strict=True):
                s = shingle_set(text.as_py(), words)
                key = set_key(s)[0]
                sketch.append((doc, key, len(s), row))
                if len(s) and key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(s)
                    size += len(s)
                if size > FLUSH:
                    yield flush()
                    seen, sets, keys, sketch, size = set(), [], [], [], 0
        if sketch:
            yield flush()

    return run


def _read(batches: Iterator[pa.RecordBatch], through: tuple[int, ...], out: list) -> dict[int, list[bytes]]:
    """Blobs by kind; rows of the kinds in ``through`` go to ``out``."""
    blobs: dict[int, list[bytes]] = {k: [] for k in range(7)}
    for batch in batches:
        for part, kind, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if kind in through:
                out.append((part, kind, blob.as_py()))
            else:
                blobs[kind].append(blob.as_py())
    return blobs


def _count(bits: int, parts: int):
    """Document frequency of whole hashes; those of two documents or more go back to the sets that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        blobs = _read(batches, (SKETCH, OWN, SHARED), out)
        yield _rows(out)
        if not blobs[COUNT]:
            return
        h, ref = (np.concatenate(x) for x in zip(*map(_open_counts, blobs[COUNT]), strict=True))
        blobs[COUNT].clear()
        order = np.argsort(h, kind="stable")
        h, ref = h[order], ref[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        count = np.diff(np.append(np.flatnonzero(first), len(h)))
        count[np.isin(h[first], unpack(blobs[HEAVY], np.uint64)[0])] += MANY
        many = np.repeat(np.minimum(count, MANY).astype(np.uint8), np.diff(np.append(np.flatnonzero(first), len(h))))
        shared = many > 1
        ref, h, many = ref[shared], h[shared], many[shared]
        order = np.argsort(ref, kind="stable")
        ref, h, many = ref[order], h[order], many[order]
        yield _rows([(p, SHARED, blob) for p, blob in _blobs(_owner(ref, parts), ref, h, many)])

    return run


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """n - ceil(percent * n / 100) + 1"""
    return n - -(-percent * n // 100) + 1


def _choose(percent: int, bits: int, parts: int):
    """The first shingles of each set that others have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list = []
        blobs = _read(batches, (SKETCH,), out)
        yield _rows(out)
        own, key, n = unpack(blobs[OWN], np.int64, np.int64, np.int64)
        ref, h, many = unpack(blobs[SHARED], np.int64, np.uint64, np.uint8)
        if not len(ref):
            return
        order = np.argsort(own)
        own, key, n = own[order], key[order], n[order]
        at = np.searchsorted(own, ref)
        # what only this set has comes first in its order
        quota = prefix_length(n, percent) - (n - np.bincount(at, minlength=len(own)))
        live = quota[at] > 0
        at, h, many = at[live], h[live], many[live]
        order = np.lexsort((h, many, at))
        at, h = at[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        chosen = rank < quota[at]
        if chosen.any():
            sig, lead, a, b = _stars(h[chosen], key[at[chosen]])
            rows = [(p, SIGN, blob) for p, blob in _blobs(_range(sig, bits, parts), sig, lead)]
            yield _rows(rows + [(p, EDGE, blob) for p, blob in _blobs(_owner(a, parts), a, b)])

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole signatures: star edges between their classes. Sketches and edges pass through."""

    def rows(kind: int, x: np.ndarray, y: np.ndarray, n: np.ndarray, row: np.ndarray) -> pa.RecordBatch:
        null = (x == NULL_ID) if kind == 0 else None
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x, mask=null), pa.array(y), pa.array(n), pa.array(row)], names=["kind", "x", "y", "n", "row"])

    blobs = _read(batches, (), [])
    doc, key, n, row = unpack(blobs[SKETCH], np.int64, np.int64, np.int64, np.int64)
    if len(doc):
        yield rows(0, doc, key, n, row)
    a, b = unpack(blobs[EDGE], np.int64, np.int64)
    sig, cls = unpack(blobs[SIGN], np.uint64, np.int64)
    if len(sig):
        _, _, c, d = _stars(sig, cls)
        a, b = np.concatenate([a, c]), np.concatenate([b, d])
    if len(a):
        a, b = forest(a, b)
        yield rows(1, a, b, np.zeros(len(a), np.int64), np.zeros(len(a), np.int64))


def points(sets: list[np.ndarray]) -> np.ndarray:
    """Count vectors: shingles hashed into POINT groups."""
    out = np.zeros((len(sets), POINT), np.int32)
    for i, s in enumerate(sets):
        out[i] = np.bincount((s >> np.uint64(11)).astype(np.int64) % POINT, minlength=POINT)
    return out


class CountTree:
    """An R-tree packed bottom-up over points in a given order; each level keeps upper corners and least sizes."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        n = len(sizes)
        starts = np.arange(0, n, LEAF)
        self.levels = [(np.maximum.reduceat(vectors, starts), np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts))]
        while len(self.levels[-1][1]) > FAN:
            top, least, most = self.levels[-1]
            starts = np.arange(0, len(least), FAN)
            self.levels.append((np.maximum.reduceat(top, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)))


def may_overlap(va, na, vb, nb, most_a, most_b, percent: int) -> np.ndarray:
    """Rows that the bound can't rule out: the minima reach the overlap asked of the smallest sets, and sizes can match."""
    bound = np.minimum(va, vb).sum(1)
    fits = (100 * most_b >= percent * na) & (100 * most_a >= percent * nb)
    return fits & ((100 + percent) * bound >= percent * (na + nb))


def leaf_pairs(a: CountTree, b: CountTree, percent: int, same: bool) -> Iterator[tuple[int, int]]:
    """Leaves that may hold a link, found from the roots down."""

    def at(tree: CountTree, level: int):
        return tree.levels[min(level, len(tree.levels) - 1)]

    height = max(len(a.levels), len(b.levels)) - 1
    ta, tb = at(a, height), at(b, height)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(ta[1])), np.arange(len(tb[1])), indexing="ij"))
    for level in range(height, -1, -1):
        ta, tb = at(a, level), at(b, level)
        keep = []
        for c in range(0, len(i), 65536):
            x, y = i[c : c + 65536], j[c : c + 65536]
            keep.append(may_overlap(ta[0][x], ta[1][x], tb[0][y], tb[1][y], ta[2][x], tb[2][y], percent) & ((x <= y) | (not same)))
        ok = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j = i[ok], j[ok]
        if level:
            na = len(at(a, level - 1)[1]) if level < len(a.levels) else None
            nb = len(at(b, level - 1)[1]) if level < len(b.levels) else None
            ci = i[:, None] * FAN + np.arange(FAN) if na is not None else i[:, None]
            cj = j[:, None] * FAN + np.arange(FAN) if nb is not None else j[:, None]
            i, j = np.broadcast_arrays(ci[:, :, None], cj[:, None, :])
            i, j = i.reshape(-1), j.reshape(-1)
            inside = np.ones(len(i), bool)
            if na is not None:
                inside &= i < na
            if nb is not None:
                inside &= j < nb
            i, j = i[inside], j[inside]
    return zip(i.tolist(), j.tolist(), strict=True)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Block:
    """Sets in the order of their leaves, their shingles numbered inside the block, and the R-tree over their points."""

    def __init__(self, sets: list[np.ndarray], rows: np.ndarray):
        size = np.array([len(sets[i]) for i in rows], np.int64)
        least = np.array([int(sets[i][0]) >> 1 for i in rows], np.int64)
        # slices by size, inside them by least shingle: near copies come to lie in one leaf
        slices = max(1, int((len(rows) / LEAF) ** 0.5))
        rank = np.empty(len(rows), np.int64)
        rank[np.argsort(size, kind="stable")] = np.arange(len(rows)) * slices // max(1, len(rows))
        order = np.lexsort((size, least, rank))
        self.rows, self.size = rows[order], size[order]
        self.sets = [sets[i] for i in self.rows]
        self.vectors = points(self.sets)
        self.tree = CountTree(self.vectors, self.size)
        self.ends = np.cumsum(self.size)


def join_block(sets: list[np.ndarray], weight: np.ndarray, percent: int, left: np.ndarray | None = None, seen: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(n, a, b)``: the weight of the sets that each set links with, and a forest of links that connects what all links do.

    ``left`` marks the sets of the first block; links then count between the two blocks alone, else between all sets.
    ``seen`` collects how many pairs there were and how many the tree left to verify.
    """
    found = np.zeros(len(sets), np.int64)
    none = np.zeros(0, np.int64)
    every = np.arange(len(sets))
    if left is not None and (left.all() or not left.any()) or len(sets) < 2:
        return found, none, none
    one = Block(sets, every if left is None else every[left])
    two = one if left is None else Block(sets, every[~left])
    _, ids = np.unique(np.concatenate(two.sets), return_inverse=True)
    words = np.unique(np.concatenate(two.sets))
    mark = np.zeros(len(words) + 1, np.int32)
    pairs: dict[int, list[int]] = {}
    for i, j in leaf_pairs(one.tree, two.tree, percent, left is None):
        pairs.setdefault(i, []).append(j)
    edges_a, edges_b, waiting, verified = [], [], 0, 0
    for i, leaves in pairs.items():
        x = np.arange(i * LEAF, min((i + 1) * LEAF, len(one.size)))
        y = np.concatenate([np.arange(j * LEAF, min((j + 1) * LEAF, len(two.size))) for j in sorted(leaves)])
        for p in x:
            ok = may_overlap(one.vectors[p], one.size[p], two.vectors[y], two.size[y], one.size[p], two.size[y], percent)
            q = y[ok & (y > p)] if left is None else y[ok]
            if not len(q):
                continue
            verified += len(q)
            mine = np.searchsorted(words, one.sets[p])
            mine = mine[words[np.minimum(mine, len(words) - 1)] == one.sets[p]] if left is not None else mine
            mark[mine] = 1
            n = two.size[q]
            start = np.cumsum(n) - n
            at = np.repeat(two.ends[q] - n - start, n) + np.arange(n.sum())
            both = np.add.reduceat(mark[ids[at]], start)
            mark[mine] = 0
            q = q[100 * both >= percent * (one.size[p] + n - both)]
            if len(q):
                a, b = one.rows[p], two.rows[q]
                found[a] += weight[b].sum()
                found[b] += weight[a]
                edges_a.append(np.full(len(q), a))
                edges_b.append(b)
                waiting += len(q)
                if waiting > 1 << 20:
                    short = forest(np.concatenate(edges_a), np.concatenate(edges_b))
                    edges_a, edges_b, waiting = [short[0]], [short[1]], len(short[0])
    if seen is not None:
        seen.append((len(sets) * (len(sets) - 1) // 2 if left is None else len(one.size) * len(two.size), verified))
    if not edges_a:
        return found, none, none
    return found, *forest(np.concatenate(edges_a), np.concatenate(edges_b))


LINK = "dst long, n long, src long"


def _joiner(percent: int):
    def run(t: pa.Table) -> pa.Table:
        cls = t.column("cls").to_numpy()
        blobs = t.column("set")
        sets = [np.frombuffer(b.as_py(), np.uint64) for b in blobs]
        left = t.column("left").to_numpy(zero_copy_only=False)
        n, a, b = join_block(sets, t.column("docs").to_numpy(), percent, None if t.num_rows and t.column("alone")[0].as_py() else left)
        some = np.flatnonzero(n)
        zero = np.zeros(len(a), np.int64)
        return pa.table({"dst": pa.array(np.concatenate([cls[b], cls[some]])), "n": pa.array(np.concatenate([zero, n[some]])), "src": pa.array(np.concatenate([cls[a], cls[some]]))})

    return run


MEMBER = ["cls", "cluster", "size", "block", "own", "below", "above", "docs"]


def _to_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, sets = [], []
            for i, (cls, text) in enumerate(zip(b.column(0).to_pylist(), b.column(len(MEMBER)).to_pylist(), strict=True)):
                s = shingle_set(text, words)
                if set_key(s)[0] == cls:
                    keep.append(i)
                    sets.append(s.tobytes())
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(at) for i in range(len(MEMBER))), pa.array(sets, pa.binary())], names=[*MEMBER, "set"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES, broadcast_members: int = BROADCAST_ROWS, row_col: str | None = None) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)`` for every row: the least id reachable over links of Jaccard >= percent / 100,
    and the number of rows that this row links with.

    A text with fewer words than ``words`` is one shingle; one without words, or null, has none and links with nothing.
    Equal sets always link. Null ids are never a component's name, unless all its rows lack one. Repeated ids are rows of
    their own; ``row_col``, a column of longs, comes along as ``row`` with ``root``, the same in all rows of a component
    (null without words). No rows give none. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    row = F.xxhash64(F.col(text_col).cast("string")) if row_col is None else F.col(row_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc"), F.col(text_col).cast("string").alias("text"), row.cast("long").alias("row"))
    if "Exchange" in rows._jdf.queryExecution().executedPlan().toString():
        rows = Stored(rows).df  # sets are numbered by their place: a task that runs again must see the same rows in the same order
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    bits = min(64, max(40, int(size).bit_length() + 10))
    wide = max(2 * shuffle_partitions(spark), -(-size // PART_BYTES))
    step = rows.mapInArrow(_scan(words, bits, wide), PACKED)
    for next_step in (_count(bits, wide), _choose(percent, bits, wide)):
        step = step.repartition(wide, "part").mapInArrow(next_step, PACKED)
    found = Stored(step.repartition(wide, "part").mapInArrow(_gather, T)).df
    sketch = found.where("kind = 0").select(F.col("x").alias("doc_id"), F.col("y").alias("cls"), "n", "row")
    edges = found.where("kind = 1").select(F.col("x").alias("src"), F.col("y").alias("dst"))
    classes = Stored(sketch.where("n > 0").groupBy("cls").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "row")).alias("at"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.count("*").alias("docs"))).df
    links = Stored(verified_links(rows, classes, edges, words, percent, block_shingles, broadcast_members)).df
    roots = components(links.where("src <> dst"))
    others = links.where("src = dst").groupBy(F.col("src").alias("cls")).agg(F.sum("n").alias("others"))
    # every class to the least id of its component; then every row to its class
    labelled = classes.join(roots.select(F.col("node").alias("cls"), "component"), "cls", "left").select("cls", "least", "docs", F.coalesce("component", "cls").alias("root"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    counted = labelled.join(others, "cls", "left").select("cls", "root", (F.col("docs") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    of_class = Stored(counted.join(named, "root").select("cls", "root", "component_id", "links")).df
    out = sketch.join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "row", "root"
    )
    return out if row_col is not None else out.drop("row", "root")


def verified_links(rows: DataFrame, classes: DataFrame, edges: DataFrame, words: int, percent: int, block_shingles: int, broadcast_members: int) -> DataFrame:
    """``(dst, n, src)``: a forest of links between classes; rows with equal ends give the documents of other classes that a class links with."""
    clusters = components(edges)
    members = clusters.select(F.col("node").alias("cls"), F.col("component").alias("cluster")).join(classes, "cls")
    whole = members.groupBy("cluster").agg(F.sum("n").alias("volume"))
    # sets that link differ by at most one size class; the classes are a hair wider than the threshold asks for, against rounding
    step = float(np.log(100 / percent) * (1 + 1e-9)) or 1.0
    size = F.when(F.col("volume") > block_shingles, F.floor(F.log(F.col("n").cast("double")) / step)).otherwise(F.lit(0)).cast("long")
    sized = Stored(members.join(whole, "cluster").select("cls", "cluster", "at.doc", "at.row", "n", "docs", size.alias("size"))).df
    volume = sized.groupBy("cluster", "size").agg(F.ceil(F.sum("n") / F.lit(block_shingles)).cast("long").alias("own"))
    near = [volume.select("cluster", (F.col("size") + by).alias("size"), F.col("own").alias(name)) for by, name in ((1, "below"), (-1, "above"))]
    blocks = Stored(volume.join(near[0], ["cluster", "size"], "left").join(near[1], ["cluster", "size"], "left").na.fill(0)).df
    placed = Stored(sized.join(blocks, ["cluster", "size"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("own"))).select("doc", "row", *MEMBER)).df
    # ten numbers a member: up to two million members (about 200 MB) they go to the texts, beyond that both sides meet by the document; its id alone
    # may stand in any number of rows, so a hash of the row or its text goes with it
    with_text = rows.join(beside(placed, broadcast_members), ["doc", "row"]).select(*MEMBER, "text")
    # repeated rows hold a class more than once
    sets = with_text.mapInArrow(_to_sets(words), ", ".join(f"{c} long" for c in MEMBER) + ", set binary")

    def meet(more: str, test: str, a: str, i: str, b: str, j: str, left: str) -> str:
        return f"CASE WHEN {more} > 0 THEN transform(sequence(0L, {more} - 1), x -> struct({a} AS a, {i} AS i, {b} AS b, {j} AS j, {left} AS left, {test} AS alone)) ELSE array() END"

    kind = "array<struct<a:bigint,i:bigint,b:bigint,j:bigint,left:boolean,alone:boolean>>"
    pairs = [meet("own", "block = x", "size", "least(block, x)", "size", "greatest(block, x)", "block <= x"), meet("above", "false", "size", "block", "size + 1", "x", "true"), meet("below", "false", "size - 1", "x", "size", "block", "false")]
    spread = sets.withColumn("at", F.explode(F.expr(f"concat({', '.join(f'CAST({p} AS {kind})' for p in pairs)})"))).select("cls", "cluster", "docs", "set", "at.*")
    return spread.groupBy("cluster", "a", "i", "b", "j").applyInArrow(_once_each(_joiner(percent)), LINK)


def _once_each(run):
    def once(t: pa.Table) -> pa.Table:
        _, first = np.unique(t.column("cls").to_numpy(), return_index=True)
        return run(t.take(pa.array(first)) if len(first) < t.num_rows else t)

    return once


def op4(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 100 * na.n >= 85 * nb.n AND 100 * nb.n >= 85 * na.n GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(na.n) + any_value(nb.n) - count(*))),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
k AS (SELECT a, count(*) AS k FROM e GROUP BY a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.b), w.doc_id)) AS component_id, coalesce(any_value(k.k), 0) AS n_links
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.a = w.doc_id LEFT JOIN k ON k.a = w.doc_id GROUP BY w.doc_id
"""
