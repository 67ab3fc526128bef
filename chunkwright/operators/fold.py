"""Folds whose state depends on their own output: one pass over each ordered group, in Python.

Tasks take their keys sorted and fold them batch by batch: a key is never held as a whole, and short keys cost no frame each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WINDOW_SECONDS, MAX_WORDS, MEMORY = 75.0, 280, 30


def folded(df: DataFrame, key: str, order: list[str], columns: list, start: Callable[[object], object], out: str) -> DataFrame:
    """Each key's rows in the order of ``order`` through a fold of its own.

    ``start`` makes a fold for a key; its ``step`` takes a row's ``columns``, its ``rest`` comes after the last, and both give rows without the key. ``out`` are the fields of those rows.
    """
    kind = T.StructType([T.StructField(key, df.schema[key].dataType), *T._parse_datatype_string(out).fields])
    schema = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fold, made = None, None, []

        def batch() -> pa.RecordBatch:
            got = list(zip(*made, strict=True)) or [()] * len(schema)
            made.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(got, schema, strict=True)], schema=schema)

        for b in batches:
            for k, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if fold is None or (k != now and (k == k or now == now)):  # NaN is one key
                    if fold is not None:
                        made += [(now, *x) for x in fold.rest()]
                    now, fold = k, start(k)
                for x in fold.step(*row):
                    made.append((now, *x))
            if made:
                yield batch()
        if fold is not None:
            made += [(now, *x) for x in fold.rest()]
            yield batch()

    sorted_keys = df.repartition(F.col(key)).sortWithinPartitions(key, *[F.col(c).asc_nulls_last() for c in order])
    return sorted_keys.select(key, *columns).mapInArrow(run, kind)


def _number(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))


class _Threshold:
    def __init__(self, most_span: float, most_size: int, idle: float):
        self.most_span, self.most_size, self.idle = most_span, most_size, idle
        self.index, self.first, self.last, self.total, self.n = 0, None, 0.0, 0, 0

    def rest(self) -> list[tuple]:
        if not self.n:
            return []
        made = [(self.index, self.first, self.last, self.total, self.n)]
        self.index, self.first, self.total, self.n = self.index + 1, None, 0, 0
        return made

    def step(self, start: float, end: float, size: int) -> list[tuple]:
        made = self.rest() if self.n and start - self.last > self.idle else []
        self.first = start if self.first is None else self.first
        self.last, self.total, self.n = end, self.total + size, self.n + 1
        if self.last - self.first >= self.most_span or self.total >= self.most_size:
            made = made + self.rest()
        return made


def threshold_windows(df: DataFrame, key: str, start: str, end: str, size: str, most_span: float = WINDOW_SECONDS, most_size: int = MAX_WORDS, order: list[str] | None = None, idle: float = float("inf")) -> DataFrame:
    """[W7, W8] (key, window_index, start, end, size, n): a window closes once its span or its size reaches the limit, or after ``idle`` without a row.

    Rows are taken in the order of ``order`` (by default start, end). What is left at the end is a window too.
    """
    columns = [_number(start).alias("start"), _number(end).alias("end"), F.col(size).cast("long").alias("size")]
    return folded(df, key, order or [start, end], columns, lambda _: _Threshold(most_span, most_size, idle), "window_index long, start double, end double, size long, n long")


class _Overlap:
    """The new words of each cue: without the longest start that equals the end of the words kept so far."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.kept = memory, []

    def fresh(self, cue: list[str]) -> list[str]:
        kept = self.kept
        last = kept[-1] if kept else None
        for k in range(min(len(kept), len(cue), self.memory), 0, -1):
            if cue[k - 1] == last and kept[-k:] == cue[:k]:
                cue = cue[k:]
                break
        self.kept = (kept + cue)[-self.memory :]
        return cue

    def step(self, order: object, text: str | None) -> list[tuple]:
        words = self.fresh((text or "").split())
        return [(order, " ".join(words))] if words else []

    def rest(self) -> list[tuple]:
        return []


def strip_overlap(cues: list[list[str]], memory: int = MEMORY) -> list[list[str]]:
    """The new words of each cue of a list."""
    held = _Overlap(memory)
    return [held.fresh(cue) for cue in cues]


def rolling_overlap(df: DataFrame, key: str, order: str, text: str, memory: int = MEMORY) -> DataFrame:
    """[W6] (key, order, text) of the cues that add words; text holds the new words only."""
    return folded(df, key, [order], [order, text], lambda _: _Overlap(memory), f"{order} {df.schema[order].dataType.simpleString()}, {text} string")


class _Transcript:
    """(start, end, text) of windows over cues in order: overlaps stripped, then closed by span or words.

    A cue that adds no word lengthens the one before it, so a cue waits for the next one with words.
    """

    def __init__(self, memory: int = MEMORY, most_span: float = WINDOW_SECONDS, most_size: int = MAX_WORDS):
        self.overlap, self.most_span, self.most_size = _Overlap(memory), most_span, most_size
        self.waiting, self.words, self.first, self.last = None, [], 0.0, 0.0

    def step(self, start: float, end: float, text: str | None) -> list[tuple]:
        fresh = self.overlap.fresh((text or "").split())
        if fresh:
            made = self._place()
            self.waiting = [start, end, fresh]
            return made
        if self.waiting:
            self.waiting[1] = max(self.waiting[1], end)
        return []

    def _place(self) -> list[tuple]:
        if self.waiting is None:
            return []
        start, self.last, fresh = self.waiting
        self.first = self.first if self.words else start
        self.words += fresh
        if self.last - self.first >= self.most_span or len(self.words) >= self.most_size:
            return self._close()
        return []

    def _close(self) -> list[tuple]:
        made, self.words = [(self.first, self.last, " ".join(self.words))], []
        return made

    def rest(self) -> list[tuple]:
        made = self._place()
        return made + self._close() if self.words else made


def transcript(cues: list[tuple[float, float, str]], memory: int = MEMORY, most_span: float = WINDOW_SECONDS, most_size: int = MAX_WORDS) -> list[tuple[float, float, str]]:
    """The windows of a list of cues."""
    held = _Transcript(memory, most_span, most_size)
    return [x for cue in cues for x in held.step(*cue)] + held.rest()


class _Named(_Transcript):
    """Windows with ids and numbers."""

    def __init__(self, key: object):
        super().__init__()
        self.key, self.index = key, 0

    def _close(self) -> list[tuple]:
        made = [(f"{self.key}::w{self.index:03d}", self.index, *x) for x in super()._close()]
        self.index += 1
        return made


def transcript_windows(cues: DataFrame, key: str, start: str = "start", end: str = "end", text: str = "text", order: str = "start") -> DataFrame:
    """[C10] (key, id, window_index, t_start_seconds, t_end_seconds, text): cues of a video to overlap-free windows with ids."""
    columns = [_number(start).alias("start"), _number(end).alias("end"), F.col(text).alias("text")]
    return folded(cues, key, [order, end], columns, _Named, "id string, window_index long, t_start_seconds double, t_end_seconds double, text string")
