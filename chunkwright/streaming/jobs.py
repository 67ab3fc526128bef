"""Structured Streaming counterparts of the batch operators; each is checked against its batch twin."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import segments


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream(spark: SparkSession, folder: str, name: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files as they land: those of the folder ``name``, or the one file of that name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(f"{folder}/{name}")
    return reader.option("pathGlobFilter", name).parquet(folder)


def tumbling_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """[A1] Rows by window and value; late rows beyond ``delay`` are dropped by the watermark."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = timed.withWatermark(ts, delay) if timed.isStreaming else timed
    return timed.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), by, "n")


def session_counts(events: DataFrame, ts: str = "ts", by: str = "user_id", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = timed.withWatermark(ts, delay) if timed.isStreaming else timed
    return timed.groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), by, "n")


def deduplicated(df: DataFrame, ts: str = "ts", delay: str = "1 hour", text: str = "text") -> DataFrame:
    """[K3, J6] The first row of each content hash within the watermark."""
    return df.withColumn("content_sha", F.sha2(F.col(text), 256)).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["content_sha"])


def threshold_windows(events: DataFrame, key: str, at: str, most_span: float, most_size: int) -> DataFrame:
    """[W7] Closed windows by key as they fill; what is open at the end stays in the state.

    ``at`` is in seconds and rises within each key across batches. State is (first, last, n, index) a key.
    """

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, n, index = state.get if state.exists else (None, 0.0, 0, 0)
        out = []
        rows = sorted(x for pdf in batches for x in pdf[at])
        for t in rows:
            first = t if first is None or n == 0 else first
            last, n = t, n + 1
            if last - first >= most_span or n >= most_size:
                out.append((k[0], index, float(first), float(last), n))
                first, n, index = None, 0, index + 1
        state.update((first if first is not None else 0.0, last, n, index))
        yield pd.DataFrame(out, columns=[key, "window_index", "start", "end", "n"])

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(fold, f"{key} {kind}, window_index long, start double, end double, n long", "first double, last double, n long, index long", "append", GroupStateTimeout.NoTimeout)


class WindowProcessor(StatefulProcessor):
    """One key's open window, and the rows that the watermark hasn't reached.

    Rows wait until the watermark has passed them, so they are taken in order of time however they came in; one timer a key stands at the first
    row that waits, or at the end of the open window's idle time. What it closes leaves no state behind.
    """

    def __init__(self, key: str, at: str, most_span: float, most_size: int, idle: float):
        self.key, self.at, self.span, self.size, self.idle = key, at, most_span, most_size, idle

    def init(self, handle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "first long, last long, n long")
        self.waiting = handle.getListState("waiting", "t long")

    def _step(self, key: tuple, fresh: list[int], mark: int) -> Iterator[pd.DataFrame]:
        """Times are in microseconds, ``mark`` is the watermark in milliseconds."""
        held = sorted([r[0] for r in self.waiting.get()] + fresh)
        ready = [t for t in held if t // 1000 <= mark]
        wait = held[len(ready) :]
        first, last, n = self.window.get() if self.window.exists() else (0, 0, 0)
        out = []
        for t in ready:
            if n and (t - last) / 1e6 > self.idle:
                out.append((key[0], first / 1e6, last / 1e6, n))
                n = 0
            first = t if not n else first
            last, n = t, n + 1
            if (last - first) / 1e6 >= self.span or n >= self.size:
                out.append((key[0], first / 1e6, last / 1e6, n))
                n = 0
        ends = last // 1000 + int(self.idle * 1000) + 1
        if n and ends <= mark:
            out.append((key[0], first / 1e6, last / 1e6, n))
            n = 0
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if wait:
            self.waiting.put([(t,) for t in wait])
        else:
            self.waiting.clear()
        if n:
            self.window.update((first, last, n))
        else:
            self.window.clear()
        due = min([t // 1000 for t in wait[:1]] + ([ends] if n else []), default=None)
        if due is not None:
            self.handle.registerTimer(max(due, mark + 1))
        if out:
            yield pd.DataFrame(out, columns=[self.key, "start", "end", "n"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        times = [int(t.value // 1000) for pdf in rows for t in pdf[self.at]]
        yield from self._step(key, times, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield from self._step(key, [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def idle_windows(events: DataFrame, key: str, at: str, most_span: float, most_size: int, idle: float, delay: str = "1 hour") -> DataFrame:
    """[W7] (key, start, end, n) in seconds: windows close by span or rows as in the batch fold, or after ``idle`` seconds without a row.

    Rows up to ``delay`` late are sorted in; later ones are dropped by the watermark, and so are null times and keys. An open window is given out when the watermark passes its
    idle time, the last one of a key as well. Needs the RocksDB state store.
    """
    timed = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, F.col(at).cast("timestamp").alias(at)).withWatermark(at, delay)
    kind = events.schema[key].dataType.simpleString()
    processor = WindowProcessor(key, at, most_span, most_size, idle)
    return timed.groupBy(key).transformWithStateInPandas(processor, f"{key} {kind}, start double, end double, n long", "Append", "EventTime")


def keep_index(chunks: DataFrame, id_col: str, folder: str, checkpoint: str, text_col: str = "text"):
    """[K3, J6] New files to the segmented index in ``folder``, which a search reads at any time.

    A batch's new and changed rows become a segment, what they replace is deleted. A replayed batch finds its rows there
    unchanged and has no effect, so no row is indexed twice.
    """

    def put(batch: DataFrame, epoch: int) -> None:
        segments.upsert(batch.sparkSession, folder, batch, id_col, text_col)

    return chunks.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def working_folder(spark: SparkSession, name: str) -> str:
    """A new folder in ``spark.checkpoint.dir``, deleted when the process ends. Where that isn't set a local one, on local masters only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="chunkwright-")
    home = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, home)
    return home


def run_once(stream_df: DataFrame, mode: str = "complete") -> DataFrame:
    """All that is there now, through a stream, as a table in the shared checkpoint folder; append and complete modes.

    The folder goes with the process. State is kept by RocksDB, which timers need.
    """
    spark = stream_df.sparkSession
    store = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(store)
    spark.conf.set(store, ROCKS)
    try:
        return _run_once(spark, stream_df, mode)
    finally:
        spark.conf.set(store, old)


def _run_once(spark: SparkSession, stream_df: DataFrame, mode: str) -> DataFrame:
    home = working_folder(spark, "stream")

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/out" if mode == "complete" else f"{home}/out/epoch={epoch}")

    stream_df.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream_df.schema).parquet(f"{home}/out")


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the session may be gone when the interpreter ends
        pass
