"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

A suffix counts by its first ``width`` bytes (100); it is doomed if an earlier suffix of the input has the same ones.
Sorting every suffix of 100 TB would shuffle many times the input, so the array is sparse, without losing a match:

1. *Sync points.* Every 100-byte string takes the leftmost least hash among the 40-byte strings inside it as its anchor.
   Equal strings have their anchors at the same place, and neighbours mostly share one, so only the suffixes at anchors,
   about one in 30, enter the array. An anchor whose 40 bytes stand nowhere else in the corpus is safe and goes no
   further: one exchange counts their hashes, and a hash that occurs once belongs to bytes that occur once.
2. *Ranges.* The other anchors' suffixes travel with their bytes, 100 to the right and up to 60 to the left, to ranges
   between sampled splitters of their leading five tokens (8 bytes each). Suffixes that agree in those meet in one range, so
   none that can match lie on two sides of a border.
3. *Buckets.* A range sorts its suffixes by multikey quicksort, token by token over ties, and the bytes before the anchors
   in the same way, and takes the common prefixes of neighbours. The string that starts d bytes before an anchor equals
   another one if their suffixes share 100 - d bytes and the bytes before them share d: both are intervals of the sorted
   arrays. All but the earliest of equal strings are doomed. All of this compares bytes.
4. *Cutting.* Each document gets its doomed strings back; their union is cut.

Hot anchors, of which one task has seen over ``LOCAL`` different surroundings or the corpus more than ``hot``, would fill a range.
Their strings are dealt out one by one to ranges of (leading token, hash of all 100 bytes) and compared by 128 bits of hash.
Every task first drops what repeats inside it, byte for byte, keeping the earliest, so a passage that a third of all
documents share reaches a range once a task. Exchanges carry packed arrays, a row for each task and range, and tasks are as
many as keep each to a bounded number of bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, mix64, shuffle_partitions, table

WIDTH, GRAM, LOCAL, HOT, FLUSH, PART_BYTES, STRINGS, SAMPLE_DOCS, SAMPLE_EACH = 100, 40, 64, 20_000, 24 << 20, 16 << 20, 1 << 18, 2000, 32
CHUNK = (1 << 16) - 128  # small enough for a core's cache; places inside a piece fit 20 bits
_BASE, _BASE_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
RUN, DOOMED, COLD, HOT_RUN, MARKER = range(5)


class Rolling:
    """Polynomial hashes of all substrings of one length, built by doubling."""

    def __init__(self, data: np.ndarray, base: np.uint64 = _BASE):
        self.levels = {1: data.astype(np.uint64) + np.uint64(1)}
        self.base = base

    def _power(self, n: int) -> np.uint64:
        return np.uint64(pow(int(self.base), n, 1 << 64))

    def _level(self, n: int) -> np.ndarray:
        if n not in self.levels:
            half = self._level(n // 2)
            self.levels[n] = half[: max(0, len(half) - n // 2)] * self._power(n // 2) + half[n // 2 :]
        return self.levels[n]

    def of(self, length: int, mixed: bool = True) -> np.ndarray:
        out, done = None, 0
        for bit in reversed(range(length.bit_length())):
            if length >> bit & 1:
                level = self._level(1 << bit)
                if out is None:
                    out = level
                else:
                    m = max(0, len(level) - done)
                    out = out[:m] * self._power(1 << bit) + level[done : done + m]
                done += 1 << bit
        return mix64(out) if mixed else out


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, m = 1, x
    while span * 2 <= width:
        m = np.minimum(m[: len(m) - span], m[span:])
        span *= 2
    n = len(x) - width + 1
    return np.minimum(m[:n], m[width - span : width - span + n])


def runs_of(data: np.ndarray, width: int, gram: int, ends: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor's hash, hash of the covered bytes, first start, anchor less start, strings) of the strings that share an anchor.

    ``ends`` are the ends of the texts that ``data`` is made of; no string crosses one.
    """
    rolling = Rolling(data)
    grams = rolling.of(gram)
    place = np.uint64((1 << 20) - 1)
    best = sliding_min(grams & ~place | np.arange(len(grams), dtype=np.uint64), width - gram + 1)
    anchor = (best & place).astype(np.int64)
    for e in (ends or [])[:-1]:
        anchor[max(0, e - width + 1) : e] = -1
    edges = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    lengths = np.diff(np.append(edges, len(anchor)))
    inside = anchor[edges] >= 0
    fresh, lengths = edges[inside], lengths[inside]
    whole = rolling.of(width, mixed=False)
    covered = mix64(whole[fresh] * np.uint64(3) + mix64(whole[fresh + lengths - 1] + np.uint64(0xA0761D6478BD642F) * lengths.astype(np.uint64)))
    return grams[anchor[fresh]], covered, fresh, anchor[fresh] - fresh, lengths


def pieces(texts: list[tuple[int, int, bytes]], width: int) -> Iterator[tuple[bytes, list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """Texts put together to pieces of at most CHUNK strings, longer ones cut: the bytes, where each text's part ends, and of
    each part the document, the sequence and what to add to a place in the piece."""
    held, ends, who, size = [], [], [], 0

    def close():
        doc, seq, shift = (np.array(x, np.int64) for x in zip(*who, strict=True))
        return b"".join(held), list(ends), doc, seq, shift

    for doc, seq, data in texts:
        for i in range(0, len(data) - width + 1, CHUNK):
            part = data[i : i + CHUNK + width - 1]
            if held and size + len(part) > CHUNK:
                yield close()
                held, ends, who, size = [], [], [], 0
            who.append((doc, seq, i - size))
            held.append(part)
            size += len(part)
            ends.append(size)
    if held:
        yield close()


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.int64(len(arrays[0])).tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def unpack(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.int64, 1)[0]), 8
        for into, kind in zip(parts, kinds, strict=True):
            into.append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(parts, kinds, strict=True)]


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte by byte (all first bytes, all second ones and so on), compressed."""
    n = len(arrays[0])
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(n, -1).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.int64(n).tobytes(), *planes]))


def unsqueeze(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    parts: list[list[np.ndarray]] = [[np.zeros(0, k)] for k in kinds]
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
        for into, kind in zip(parts, kinds, strict=True):
            wide = np.dtype(kind).itemsize
            into.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * wide, at).reshape(wide, n).T).view(kind).ravel())
            at += n * wide
    return [np.concatenate(p) for p in parts]


def multikey_quicksort(*tokens: np.ndarray) -> np.ndarray:
    """The order of rows by their first token, ties by the second and so on: a quicksort by one token, after which only
    the runs that are still tied go on to the next."""
    order = np.argsort(tokens[0])
    same = tokens[0][order][1:] == tokens[0][order][:-1]
    tied = np.zeros(len(order), bool)
    for token in tokens[1:]:
        if not same.any():
            break
        tied[:] = False
        tied[1:] |= same
        tied[:-1] |= same
        at = np.flatnonzero(tied)
        run = np.cumsum(np.concatenate([[True], ~same]))[at]
        rows = order[at]
        by = np.argsort(token[rows])
        order[at] = rows[by[np.argsort(run[by], kind="stable")]]
        moved = token[order]
        same = same & (moved[1:] == moved[:-1])
    return order


def shared_prefix(tokens: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Common leading bytes of each row with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return out
    at = np.arange(1, len(order))
    for token in tokens:
        x = token[order[at]] ^ token[order[at - 1]]
        bytes_ = np.zeros(len(at), np.int64)
        for k in range(8):
            bytes_ += x < np.uint64(1 << 8 * k) if k else x == 0
        out[at] += bytes_
        at = at[bytes_ == 8]
        if not len(at):
            break
    return out


def _bytes(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _home(doc: np.ndarray, seq: np.ndarray, parts: int) -> np.ndarray:
    """The group of documents that a document belongs to."""
    return (mix64(doc.astype(np.int64).view(np.uint64) ^ mix64(seq.astype(np.int64).view(np.uint64))) % np.uint64(parts)).astype(np.int64)


def _groups(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(key) else []
    for a, b in zip(edges, [*edges[1:], len(key)] if len(key) else [], strict=True):
        yield int(ordered[a]), order[a:b]


def _blobs(key: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for k, rows in _groups(key):
        yield k, pack(*(x[rows] for x in arrays))


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())], names=["part", "kind", "blob"])


PACKED = "part int, kind int, blob binary"
RUNS = (np.uint64, np.int64, np.int64, np.int64)  # short hash of the anchor, doc, seq, place
SPAN = (np.int64, np.int64, np.int64)  # doc, seq, place: start << 14 | anchor less start << 7 | strings


def _spans(kind: int, homes: int, parts: int, doc: np.ndarray, seq: np.ndarray, at: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Places sent to the home of their document; the home travels in the kind."""
    order = np.lexsort((at, seq, doc))
    doc, seq, at = doc[order], seq[order], at[order]
    return [(home % parts, kind | home << 3, squeeze(doc[rows], seq[rows], at[rows])) for home, rows in _groups(_home(doc, seq, homes))]


def _scan(width: int, gram: int, bits: int, parts: int, homes: int):
    """Runs of each task, equal ones but the earliest doomed byte for byte, the others' short hashes dealt to be counted."""

    def settle(texts: list[tuple[int, int, bytes]]) -> list[tuple[int, int, bytes]]:
        texts.sort(key=lambda x: x[:2])
        texts = [x for i, x in enumerate(texts) if not i or x[:2] != texts[i - 1][:2]]  # a repeated row is the same document
        found, bodies = [], []
        for body, ends, docs, seqs, shift in pieces(texts, width):
            anchor, covered, start, off, n = runs_of(np.frombuffer(body, np.uint8), width, gram, ends)
            part = np.searchsorted(ends, start, "right")
            found.append((anchor, covered, docs[part], seqs[part], (start + shift[part]) << 14 | off << 7 | n, np.full(len(start), len(bodies), np.int32), start.astype(np.int32)))
            bodies.append(body)
        if not found:
            return []
        anchor, covered, doc, seq, at, body, start = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        # runs are in the order of documents and starts: of equal ones the first is the earliest
        same = mix64(anchor + covered * _BASE + (at & 0x3FFF).astype(np.uint64))
        order = np.argsort(same, kind="stable")
        again = np.zeros(len(order), bool)
        again[order[1:]] = same[order][1:] == same[order][:-1]
        lead = np.empty(len(order), np.int64)
        lead[order] = order[np.maximum.accumulate(np.where(again[order], 0, np.arange(len(order))))]
        size = (at & 127) + (width - 1)
        for i in np.flatnonzero(again).tolist():
            j, a, b, k = lead[i], start[i], start[lead[i]], size[i]
            if bodies[body[i]][a : a + k] != bodies[body[j]][b : b + k]:
                again[i] = False
        first = ~again
        _, group, count = np.unique(anchor[first], return_inverse=True, return_counts=True)
        wide = np.zeros(len(order), bool)
        wide[first] = count[group] > LOCAL
        rows = _spans(DOOMED, homes, parts, doc[again], seq[again], at[again])
        rows += _spans(HOT_RUN, homes, parts, *(x[wide] for x in (doc, seq, at)))
        short = mix64(anchor) >> np.uint64(64 - bits)  # anchors are least hashes and crowd at the low end
        span = np.uint64(-(-(1 << bits) // parts))
        some = np.unique(short[wide])
        rows += [(p, MARKER, squeeze(some[x])) for p, x in _groups((some // span).astype(np.int64))]
        some = np.flatnonzero(first & ~wide)
        short, doc, seq, at = short[some], doc[some], seq[some], at[some]
        return rows + [(p, RUN, squeeze(short[x], doc[x], seq[x], at[x])) for p, x in _groups((short // span).astype(np.int64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc, seq, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                data = _bytes(text.as_py())
                if len(data) >= width:
                    held.append((doc, seq, data))
                    size += len(data)
                if size > FLUSH:
                    yield _rows(settle(held))
                    held, size = [], 0
        if held:
            yield _rows(settle(held))

    return run


def _count(hot: int, parts: int, homes: int):
    """Whole ranges of short hashes: runs whose hash occurs once are safe and end here, the others go home as cold or hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, markers = [], []
        for batch in batches:
            through = []
            for part, kind, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if kind & 7 in (RUN, MARKER):
                    (markers if kind == MARKER else runs).append(blob)
                else:
                    through.append((part, kind, blob))
            yield _rows(through)
        short, doc, seq, at = unsqueeze(runs, *RUNS)
        runs.clear()
        if len(short):
            order = np.argsort(short, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], short[order][1:] != short[order][:-1]]))
            count = np.empty(len(short), np.int64)
            size = np.diff(np.append(edges, len(short)))
            count[order] = np.repeat(size, size)
            marked = np.isin(short, unsqueeze(markers, np.uint64)[0])
            for kind, rows in ((HOT_RUN, marked | (count > hot)), (COLD, ~marked & (count > 1) & (count <= hot))):
                yield _rows(_spans(kind, homes, parts, doc[rows], seq[rows], at[rows]))

    return run


def _ship(homes: int):
    """Texts packed for their homes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            rows = []
            for home, at in _groups(_home(t.column("doc").to_numpy(), t.column("seq").to_numpy(), homes)):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, t.schema) as out:
                    out.write_table(t.take(pa.array(at)))
                rows.append((home, RUN, zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())))
            return _rows(rows)

        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                held.append(batch.slice(i, 4096))
                size += held[-1].nbytes
                if size > 32 << 20:
                    yield send()
                    held, size = [], 0
        if size:
            yield send()

    return run


def _texts(t: pa.Table) -> Iterator[tuple[int | None, int, int, bytes]]:
    for blob in t.column("blob"):
        got = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob.as_py())).read_all()
        for row in zip(*(got.column(c).to_pylist() for c in ("doc_id", "doc", "seq")), got.column("text"), strict=True):
            yield *row[:3], _bytes(row[3].as_py())


def _by_document(t: pa.Table, kind: int) -> tuple[dict[tuple[int, int], np.ndarray], np.ndarray]:
    """The rows of each document among the places of one kind, and the places."""
    kinds = t.column("kind").to_numpy() & 7
    blobs = t.column("blob")
    doc, seq, at = unsqueeze([blobs[int(i)].as_py() for i in np.flatnonzero(kinds == kind)], *SPAN)
    order = np.lexsort((at, seq, doc))
    doc, seq, at = doc[order], seq[order], at[order]
    edges = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (seq[1:] != seq[:-1])])) if len(doc) else []
    return {(int(doc[a]), int(seq[a])): np.arange(a, b) for a, b in zip(edges, [*edges[1:], len(doc)] if len(doc) else [], strict=True)}, at


def _lead(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on as one big-endian word; the data must reach 7 bytes further."""
    x = data.astype(np.uint64)
    x = x[:-1] << np.uint64(8) | x[1:]
    x = x[:-2] << np.uint64(16) | x[2:]
    return x[:-4] << np.uint64(32) | x[4:]


def _sampler(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, lead, key = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for text in batch.column(0).to_pylist():
                raw = _bytes(text)
                if len(raw) >= width:
                    random = np.random.default_rng(len(raw))
                    first = int(random.integers(0, max(1, len(raw) - CHUNK)))
                    raw = raw[first : first + CHUNK]
                    data = np.frombuffer(raw, np.uint8)
                    at = random.integers(0, len(data) - width + 1, SAMPLE_EACH)
                    lead.append(_lead(data)[at])
                    key.append(Rolling(data).of(width)[at])
                    start, off = runs_of(data, width, gram)[2:4]
                    anchors = (start + off)[random.integers(0, len(start), SAMPLE_EACH)]
                    grams += [raw[i : i + gram] for i in anchors.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), *(pa.array(np.concatenate(x).view(np.int64)) for x in (lead, key))], names=["gram", "lead", "key"])

    return run


def range_of(lead: np.ndarray, key: np.ndarray, cut_lead: np.ndarray, cut_key: np.ndarray) -> np.ndarray:
    """The range of each (lead, key) among sorted splitters."""
    low, high = np.searchsorted(cut_lead, lead, "left"), np.searchsorted(cut_lead, lead, "right")
    for i in np.unique(low[high > low]):
        rows = (low == i) & (high > low)
        low[rows] += np.searchsorted(cut_key[i : high[rows][0]], key[rows], "right")
    return low


def _expand(at: np.ndarray) -> np.ndarray:
    start, n = at >> 14, at & 127
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


RECORD = (np.int64, np.int64, np.int64, np.int64)  # home, doc, seq, place


def _suffixes(width: int, gram: int, grams: list[bytes], cut_lead: np.ndarray, cut_key: np.ndarray, ranges: int, homes: int):
    """Of the runs that go on: cold ones with their bytes to the range of their anchor, the strings of hot ones to theirs."""
    splitters = np.array(grams, f"S{gram}")

    def cold(home: int, got: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, bytes]]:
        got.sort(key=lambda x: x[:3])
        seen: dict[tuple[int, bytes], int] = {}
        again = np.array([seen.setdefault((x[2] & 0x3FFF, x[3]), i) != i for i, x in enumerate(got)], bool)
        doc, seq, at = (np.array([x[i] for x in got], np.int64) for i in range(3))
        rows = _spans(DOOMED, homes, ranges, doc[again], seq[again], at[again])
        left = np.flatnonzero(~again)
        off = (at >> 7) & 127
        key = np.array([got[i][3][off[i] : off[i] + gram] for i in left], f"S{gram}")
        for part, x in _groups(np.searchsorted(splitters, key, "right")):
            mine = left[x]
            body = b"".join(got[i][3] for i in mine)
            where = squeeze(np.full(len(mine), home, np.int64), doc[mine], seq[mine], at[mine])
            rows.append((part, COLD, np.int64(len(where)).tobytes() + where + zstandard.ZstdCompressor(level=1).compress(body)))
        return rows

    def warm(home: int, got: list[tuple[np.ndarray, ...]]) -> list[tuple[int, int, bytes]]:
        one, two, lead, doc, seq, start = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((start, seq, doc, two, one))
        first = np.ones(len(order), bool)
        first[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        again, once = order[~first], np.sort(order[first])
        rows = _spans(DOOMED, homes, ranges, doc[again], seq[again], start[again] << 14 | 1)
        for part, x in _groups(range_of(lead[once], one[once], cut_lead, cut_key)):
            x = once[x]
            rows.append((part, HOT_RUN, squeeze(one[x], two[x], np.full(len(x), home, np.int64), doc[x], seq[x], start[x])))
        return rows

    def run(key, docs: pa.Table, flags: pa.Table) -> pa.Table:
        if not docs.num_rows or not flags.num_rows:
            return pa.Table.from_batches([_rows([])])
        home = key[0].as_py()
        (cold_of, cold_at), (hot_of, hot_at) = _by_document(flags, COLD), _by_document(flags, HOT_RUN)
        runs, strings, seen, out, n = [], [], set(), [], 0
        for _, doc, seq, data in _texts(docs):
            if (doc, seq) in seen:
                continue  # a repeated row is the same document
            seen.add((doc, seq))
            for at in np.unique(cold_at[cold_of.get((doc, seq), [])]).tolist():
                start = at >> 14
                runs.append((doc, seq, at, data[start : start + (at & 127) + width - 1]))
            if (doc, seq) in hot_of:
                wanted = np.unique(_expand(hot_at[hot_of[doc, seq]]))
                for a in range(0, len(data), CHUNK):
                    here = wanted[(wanted >= a) & (wanted < a + CHUNK)]
                    if len(here):
                        piece = np.frombuffer(data, np.uint8)[a : a + CHUNK + width - 1]
                        strings.append((Rolling(piece).of(width)[here - a], Rolling(piece, _BASE_2).of(width)[here - a], _lead(piece)[here - a], np.full(len(here), doc, np.int64), np.full(len(here), seq, np.int64), here))
                        n += len(here)
                    if n > STRINGS:
                        out += warm(home, strings)
                        strings, n = [], 0
            if len(runs) > STRINGS >> 3:
                out += cold(home, runs)
                runs = []
        return pa.Table.from_batches([_rows(out + (cold(home, runs) if runs else []) + (warm(home, strings) if strings else []))])

    return run


def repeats(doc: np.ndarray, seq: np.ndarray, at: np.ndarray, body: bytes, width: int, gram: int) -> np.ndarray:
    """For each run a row of marks, one for each distance d of a string's start from the anchor: an equal string starts earlier.

    ``body`` holds the bytes of all runs, one after the other.
    """
    off, n = (at >> 7) & 127, at & 127
    size = n + (width - 1)
    anchor = np.cumsum(size) - size + off
    data = np.frombuffer(body, np.uint8)
    reach = width - gram

    def tokens(first: np.ndarray, step: int, have: np.ndarray, most: int) -> list[np.ndarray]:
        """The strings from ``first`` on, forwards or backwards, cut to ``have`` and ``most`` bytes and filled with zeros, as big-endian words."""
        out = np.zeros((len(first), most + 7 & ~7), np.uint8)
        for i in range(0, len(first), 8192):
            place = first[i : i + 8192, None] + step * np.arange(most)
            out[i : i + 8192, :most] = np.where(np.arange(most) < have[i : i + 8192, None], data[np.clip(place, 0, len(data) - 1)], 0)
        return [np.ascontiguousarray(x) for x in out.view(">u8").astype(np.uint64).T]

    right = tokens(anchor, 1, size - off, width)
    left = tokens(anchor - 1, -1, off, reach)
    by_right, by_left = multikey_quicksort(*right), multikey_quicksort(*left)
    prefix, suffix = shared_prefix(right, by_right), shared_prefix(left, by_left)
    age = np.lexsort((at, seq, doc))
    low, high = off - n + 1, off
    gone = np.zeros((len(at), reach + 1), bool)
    right_class, left_class = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    for d in range(reach + 1):
        right_class[by_right] = np.cumsum(prefix < width - d)
        left_class[by_left] = np.cumsum(suffix < d)
        here = age[(low[age] <= d) & (high[age] >= d)]
        key = right_class[here] * (len(at) + 1) + left_class[here]
        order = np.argsort(key, kind="stable")
        again = np.concatenate([[False], key[order][1:] == key[order][:-1]]) if len(key) else np.zeros(0, bool)
        gone[here[order[again]], d] = True
    return gone


def _sort(width: int, gram: int, homes: int, parts: int):
    """Whole ranges: cold suffixes by their bytes, hot strings by both hashes; what repeats goes home as doomed."""

    def cold(blobs: list[bytes]) -> list[tuple[int, int, bytes]]:
        heads, bodies = [], []
        for blob in blobs:
            size = int(np.frombuffer(blob, np.int64, 1)[0])
            heads.append(blob[8 : 8 + size])
            bodies.append(zstandard.ZstdDecompressor().decompress(blob[8 + size :]))
        blobs.clear()
        home, doc, seq, at = unsqueeze(heads, *RECORD)
        gone = repeats(doc, seq, at, b"".join(bodies), width, gram)
        # runs of doomed strings: distances fall as starts rise
        marks = np.zeros((len(at), gone.shape[1] + 2), np.int8)
        marks[:, 1:-1] = gone[:, ::-1]
        step = np.diff(marks, axis=1)
        (row, first), last = np.nonzero(step == 1), np.nonzero(step == -1)[1]
        start = (at >> 14)[row] + ((at >> 7) & 127)[row] - (gone.shape[1] - 1) + first
        return _spans(DOOMED, homes, parts, doc[row], seq[row], start << 14 | (last - first))

    def warm(blobs: list[bytes]) -> list[tuple[int, int, bytes]]:
        one, two, home, doc, seq, start = unsqueeze(blobs, np.uint64, np.uint64, *RECORD)
        blobs.clear()
        order = np.lexsort((start, seq, doc, two, one))
        again = order[1:][(one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
        return _spans(DOOMED, homes, parts, doc[again], seq[again], start[again] << 14 | 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {COLD: [], HOT_RUN: []}
        for batch in batches:
            through = []
            for part, kind, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if kind & 7 == DOOMED:
                    through.append((part, kind, blob))
                else:
                    blobs[kind].append(blob)
            yield _rows(through)
        for kind, work in ((COLD, cold), (HOT_RUN, warm)):
            if blobs[kind]:
                yield _rows(work(blobs[kind]))

    return run


def _cut(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])

    def run(key, docs: pa.Table, flags: pa.Table) -> pa.Table:
        of, at = _by_document(flags, DOOMED) if flags.num_rows else ({}, np.zeros(0, np.int64))
        rows = []
        for doc_id, doc, seq, data in _texts(docs) if docs.num_rows else ():
            removed, spans, kept = 0, np.zeros(0, np.int64), data
            if (doc, seq) in of:
                mine = at[of[doc, seq]]
                start, end = mine >> 14, np.maximum.accumulate((mine >> 14) + (mine & 127) - 1 + width)
                fresh = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
                left, right = start[fresh], end[np.append(fresh[1:] - 1, len(end) - 1)]
                spans = np.stack([left, right], 1).ravel()
                removed = int((right - left).sum())
                kept = b"".join(data[a:b] for a, b in zip([0, *right.tolist()], [*left.tolist(), len(data)], strict=True))
            rows.append((doc_id, len(data), removed, len(spans) // 2, hashlib.sha256(kept).hexdigest(), spans.tolist()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * 6, schema, strict=True)], schema=schema)

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM, part_bytes: int = PART_BYTES, hot: int = HOT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``; ``spans`` lists start and end of each removed run.

    Earlier means a smaller id, or the same document and an earlier start. Null text: empty. Null id: before all others.
    Rows that share an id but not the text are ordered by a hash of the text; repeated rows are one document that is
    listed more than once, and each gets the same result. Texts under ``width`` bytes keep all. No rows give none.
    Other columns are ignored, whatever their names. ``width`` is at most 127, and ``gram`` at most ``width``.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = raw.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    unique = raw.groupBy("doc_id").count().where("count > 1").limit(1).count() == 0
    seq = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce("text", F.lit("")))
    rows = raw.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), seq.alias("seq"), "text")
    parts = max(shuffle_partitions(spark), -(-(size["bytes"] or 0) // part_bytes))
    bits = min(63, max(32, int(size["bytes"] or 1).bit_length() + 4))
    found = rows.select("doc", "seq", "text").mapInArrow(_scan(width, gram, bits, parts, parts), PACKED)
    flags = Stored(found.repartition(parts, "part").mapInArrow(_count(hot, parts, parts), PACKED)).df

    wanted = max(SAMPLE_DOCS, parts // 8)
    share = min(1.0, wanted / max(1, size["n"]))
    sample = rows.where(F.pmod(F.xxhash64("doc", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text").mapInArrow(_sampler(width, gram), "gram binary, lead long, key long").collect()
    lead, key = (np.array([r[i] for r in sample], np.int64).view(np.uint64) for i in (1, 2))
    order = np.lexsort((key, lead))
    cuts = np.unique(np.linspace(0, len(order) - 1, parts + 1).astype(np.int64)[1:-1]) if len(order) else np.zeros(0, np.int64)
    grams = sorted({bytes(r["gram"]) for r in sample})
    grams = [grams[i] for i in np.unique(np.linspace(0, len(grams) - 1, parts + 1).astype(np.int64)[1:-1])] if grams else []

    packed = rows.mapInArrow(_ship(parts), PACKED).groupBy("part")
    by_home = F.shiftright("kind", 3).alias("part")
    going = flags.where(F.col("kind").bitwiseAND(7) != DOOMED).select(by_home, "kind", "blob")
    tests = packed.cogroup(going.groupBy("part")).applyInArrow(_suffixes(width, gram, grams, lead[order][cuts], key[order][cuts], parts, parts), PACKED)
    doomed = Stored(tests.repartition(parts, "part").mapInArrow(_sort(width, gram, parts, parts), PACKED)).df
    gone = flags.where(F.col("kind").bitwiseAND(7) == DOOMED).union(doomed).select(by_home, "kind", "blob")
    return packed.cogroup(gone.groupBy("part")).applyInArrow(_cut(width), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")


def op3(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
