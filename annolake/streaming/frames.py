"""Per-frame metrics as Structured Streaming queries, and prediction over rows."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from annolake.operators.runs import MOVING_WINDOW

RATE_OUTPUT = (
    "source_id bigint, event_id bigint, frame_index bigint, detection_count int, inference_ms double, "
    "instantaneous_fps double, moving_average_fps double"
)
#: Frames of one source and batch that are sorted in memory; more go to the state store in sorted runs of blocks.
HELD_ROWS = 50_000
BLOCK_ROWS = 2_000
_FRAME = {"source": "bigint", "event_id": "bigint", "detection_count": "int", "inference_ms": "double", "us": "bigint"}
_ORDER = ["source", "us", "event_id"]
#: Sources are kept in this many groups unless the caller, who may know how many there are, names another number.
GROUPS = 1024
#: Sources that a group had better hold: enough to share the cost of a call, few enough to read and write at once.
GROUP_SOURCES = 256
_SOURCE = {"source": "bigint", "last_us": "bigint", "nth": "bigint", "held": "bigint"}
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Sources:
    """What is known of the sources of a group, in order of their ids: the last frame's time, the number of frames and
    the last ``MOVING_WINDOW`` rates (``held`` of them, at the end of a row of ``rates``)."""

    def __init__(self, columns: tuple | None) -> None:
        columns = columns or ([],) * (len(_SOURCE) + 1)
        self.columns = {c: np.array(v, np.int64) for c, v in zip(_SOURCE, columns, strict=False)}
        self.rates = np.array(columns[-1], np.float64).reshape(-1, MOVING_WINDOW)

    def stored(self) -> tuple:
        return *(v.tolist() for v in self.columns.values()), self.rates.ravel().tolist()

    def keep(self, kept: np.ndarray) -> None:
        self.columns, self.rates = {c: v[kept] for c, v in self.columns.items()}, self.rates[kept]

    def _rows_of(self, ids: np.ndarray) -> np.ndarray:
        """The rows of the sources ``ids`` (ascending); new ones get a row first."""
        new = np.setdiff1d(ids, self.columns["source"], assume_unique=True)
        if len(new):
            added = {c: np.concatenate([v, new if c == "source" else np.zeros(len(new), np.int64)]) for c, v in self.columns.items()}
            order = np.argsort(added["source"])
            self.columns = {c: v[order] for c, v in added.items()}
            self.rates = np.concatenate([self.rates, np.zeros((len(new), MOVING_WINDOW))])[order]
        return np.searchsorted(self.columns["source"], ids)

    def paced(self, frames: pd.DataFrame) -> pd.DataFrame:
        """Rates of frames, ordered by source and time, that follow those seen before."""
        # A frame without a time is an error here.
        source, us = frames["source"].to_numpy(), frames["us"].astype("int64").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1]]))
        counts = np.diff(np.append(starts, len(source)))
        at = self._rows_of(source[starts])
        nth, held = self.columns["nth"][at], self.columns["held"][at]
        gaps = np.diff(us, prepend=us[0])
        gaps[starts] = us[starts] - self.columns["last_us"][at]
        rate = np.divide(1e6, gaps, out=np.zeros(len(gaps)), where=gaps > 0)
        counted = np.ones(len(rate))
        rate[starts[nth == 0]] = counted[starts[nth == 0]] = 0  # a source's first frame has no rate
        # The rates of each source in one line, those from before in front; `slots` are the places of the new ones.
        ends = np.cumsum(counts + MOVING_WINDOW)
        slots = np.arange(len(source)) + np.repeat(np.arange(1, len(starts) + 1) * MOVING_WINDOW, counts)
        line, valid = np.zeros((2, ends[-1]))
        before = (ends - counts)[:, None] + np.arange(-MOVING_WINDOW, 0)
        line[before], valid[before] = self.rates[at], np.arange(MOVING_WINDOW) >= MOVING_WINDOW - held[:, None]
        line[slots], valid[slots] = rate, counted
        windows = [np.lib.stride_tricks.sliding_window_view(x, MOVING_WINDOW)[slots - MOVING_WINDOW + 1].sum(axis=1) for x in (line, valid)]
        after = ends[:, None] + np.arange(-MOVING_WINDOW, 0)
        self.rates[at] = line[after]
        self.columns["held"][at] = valid[after].sum(axis=1)
        self.columns["nth"][at] = nth + counts
        self.columns["last_us"][at] = us[starts + counts - 1]
        return frames.drop(columns="us").assign(
            frame_index=np.arange(len(source)) + np.repeat(nth - starts, counts),
            instantaneous_fps=rate,
            moving_average_fps=windows[0] / np.maximum(windows[1], 1),
        )


class MovingRate(StatefulProcessor):
    """Status rows of the sources of one group; state is each source's last frame time, its count and at most 20 rates.

    A call costs far more than a row, so a group's sources share one. A batch of more than ``HELD_ROWS`` frames of one
    group is sorted outside memory: sorted runs go to the state store in blocks, and a merge keeps one block of each run.
    """

    def __init__(self, idle_ms: int | None) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sources = handle.getValueState("sources", ", ".join(f"{n} array<{t}>" for n, t in (_SOURCE | {"rates": "double"}).items()))
        self.waiting = handle.getMapState("waiting", "run bigint, block bigint", ", ".join(f"{n} array<{t}>" for n, t in _FRAME.items()))

    def _wait(self, run: int, frames: pd.DataFrame) -> int:
        """Put a sorted run aside; returns its number of blocks."""
        starts = range(0, len(frames), BLOCK_ROWS)
        for block, start in enumerate(starts):
            some = frames.iloc[start : start + BLOCK_ROWS]
            self.waiting.updateValue((run, block), tuple(some[c].tolist() for c in _FRAME))
        return len(starts)

    def _merged(self, blocks: list[int]) -> Iterator[pd.DataFrame]:
        at, current = [0] * len(blocks), {}
        while True:
            for run, count in enumerate(blocks):
                if run not in current and at[run] < count:
                    value = self.waiting.getValue((run, at[run]))
                    self.waiting.removeKey((run, at[run]))
                    current[run] = pd.DataFrame(dict(zip(_FRAME, value, strict=True)))
                    at[run] += 1
            if not current:
                return
            # All rows up to the smallest last row are complete; at least one block is used up.
            limit = min(tuple(x[_ORDER].iloc[-1]) for x in current.values())
            ready = []
            for run, rows in list(current.items()):
                same, upto = pd.Series(True, rows.index), pd.Series(False, rows.index)
                for column, value in zip(_ORDER, limit, strict=True):
                    upto |= same & (rows[column] < value)
                    same &= rows[column] == value
                upto = int((upto | same).sum())
                ready.append(rows.iloc[:upto])
                if upto == len(rows):
                    del current[run]
                else:
                    current[run] = rows.iloc[upto:]
            yield pd.concat(ready).sort_values(_ORDER, ignore_index=True)

    def _in_order(self, chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, blocks, size = [], [], 0
        for chunk in chunks:
            held.append(chunk[list(_FRAME)])
            size += len(chunk)
            if size > HELD_ROWS:
                blocks.append(self._wait(len(blocks), pd.concat(held).sort_values(_ORDER, ignore_index=True)))
                held, size = [], 0
        if held and blocks:
            blocks.append(self._wait(len(blocks), pd.concat(held).sort_values(_ORDER, ignore_index=True)))
        if blocks:
            yield from self._merged(blocks)
        elif size:
            yield pd.concat(held).sort_values(_ORDER, ignore_index=True)

    def _store(self, sources: Sources) -> None:
        """Keep what is known; a timer stands for each time at which a source expires."""
        self.sources.update(sources.stored())
        if self.idle_ms is not None:
            wanted, there = set((sources.columns["last_us"] // 1000 + self.idle_ms).tolist()), set(self.handle.listTimers())
            for timer in there - wanted:
                self.handle.deleteTimer(timer)
            for timer in wanted - there:
                self.handle.registerTimer(timer)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sources = Sources(self.sources.get())
        for frames in self._in_order(rows):
            out = sources.paced(frames)
            # Null sources have a group, and thus a place in the state, of their own.
            out["source_id"] = out["source"] if key[0] >= 0 else pd.array([None] * len(out), "Int64")
            yield out[["source_id", "event_id", "frame_index", "detection_count", "inference_ms", "instantaneous_fps", "moving_average_fps"]]
        if len(sources.rates):
            self._store(sources)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sources = Sources(self.sources.get())
        sources.keep(sources.columns["last_us"] // 1000 + self.idle_ms > expiredTimerInfo.getExpiryTimeInMs())
        if len(sources.rates):
            self.sources.update(sources.stored())
        else:
            self.sources.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_moving_fps(frames: DataFrame, idle_ms: int | None = None, watermark: str = "10 minutes", groups: int = GROUPS) -> DataFrame:
    """Status row per frame with instantaneous and moving rate, state kept per source.

    Frames of a batch are taken in time order, whatever order they come in; batches have to follow one another in
    time (``land_in_order``).  ``idle_ms`` forgets a source once the event time has passed its last frame by that much
    (a timer at the watermark, so it works the same in every run; frames behind the watermark are then left out).
    Sources are dealt into ``groups`` by their hash, whose state is read and written at once: a stream of very many
    sources wants about one group for each ``GROUP_SOURCES`` of them; the rows are the same with any number.
    Null sources are a source of their own; the state store is RocksDB, which this sets for the session.
    """
    frames.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    timed = frames.withColumn("event_time", F.col("frame_ts").cast("timestamp"))
    if idle_ms is not None:
        timed = timed.withWatermark("event_time", watermark)
    timed = timed.withColumn("us", F.unix_micros(F.col("event_time")))
    # Nulls would turn a batch's ids to doubles.
    timed = timed.withColumns(
        {
            "source": F.coalesce(F.col("source_id").cast("bigint"), F.lit(0).cast("bigint")),
            "source_group": F.when(F.col("source_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("source_id"), F.lit(groups))),
        }
    )
    kept = ["source_group", *_FRAME, *(["event_time"] if idle_ms is not None else [])]
    return timed.select(*kept).groupBy("source_group").transformWithStateInPandas(
        MovingRate(idle_ms), RATE_OUTPUT, "append", "none" if idle_ms is None else "eventTime"
    )


def land_in_order(rows: DataFrame, order: list[str], path: str, files: int, after: int = 0) -> int:
    """Write ``rows`` as ``files`` Parquet files that a file stream takes in ``order``; returns their number.

    A file stream goes by modification time, so the files, one range of ``order`` each, get times one
    second apart, behind the ``after`` files that landed before.
    """
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)
    spark = rows.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    system = jpath(path).getFileSystem(spark._jsc.hadoopConfiguration())
    landed = sorted((s.getPath() for s in system.listStatus(jpath(path)) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for nth, one in enumerate(landed):
        system.setTimes(one, (1_000_000_000 + after + nth) * 1000, -1)
    return len(landed)


def stream_class_counts(frames: DataFrame) -> DataFrame:
    """Running detections per source and class."""
    return frames.groupBy("source_id", "class_name").agg(F.sum("detection_count").alias("detections"))


def window_rate(frames: DataFrame, width: str = "1 hour", watermark: str | None = "10 minutes") -> DataFrame:
    """Detections and mean inference time per tumbling window; batch or stream."""
    timed = frames.withColumn("event_time", F.col("frame_ts").cast("timestamp"))
    if watermark and timed.isStreaming:
        timed = timed.withWatermark("event_time", watermark)
    return _windows(timed, width)


def _windows(timed: DataFrame, width: str) -> DataFrame:
    return (
        timed.groupBy(F.window("event_time", width).alias("w"))
        .agg(
            F.count("*").alias("frames"),
            F.sum("detection_count").alias("detections"),
            F.avg("inference_ms").alias("mean_inference_ms"),
        )
        .select(F.col("w.start").alias("window_start"), "frames", "detections", "mean_inference_ms")
    )


def run_window_rate(
    frames: DataFrame, path: str, checkpoint: str, width: str = "1 hour", watermark: str = "10 minutes"
) -> int:
    """Append every window to ``path`` once event time has passed it; returns how many rows came too late.

    Rows are taken once per ``event_id`` first: that step lets through no row behind the watermark and counts
    each it drops, so rows in windows, rows still open and rows returned as late add up to all rows.
    """
    timed = frames.withColumn("event_time", F.col("frame_ts").cast("timestamp")).withWatermark("event_time", watermark)
    once = timed.dropDuplicatesWithinWatermark(["event_id"])
    return run_to_table(_windows(once, width), path, checkpoint)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> int:
    """Process everything available now into a Parquet folder (exactly once by checkpoint).

    Returns the rows that stateful steps dropped as late.
    """
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.numRecentProgressUpdates"
    before = conf.get(name)
    conf.set(name, "1000000")  # no batch's count may be lost
    try:
        if mode == "append":
            writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
        else:

            def upsert(batch: DataFrame, batch_id: int) -> None:
                # A folder per batch: repeating a batch after a failure replaces its own output.
                batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

            writer = stream.writeStream.outputMode(mode).foreachBatch(upsert)
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    finally:
        conf.set(name, before)


def stream_result_ingest(spark: SparkSession, source: str, schema, path: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Append result documents as they land."""
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    run_to_table(arrived, path, checkpoint)


KEPT_PREDICTORS = 4


def batch_predict(
    rows: DataFrame,
    make_predictor: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
    model_key: str | None = None,
) -> DataFrame:
    """Run a caller's predictor over Arrow batches.

    ``schema`` may be nested: a column of ``array<struct<...>>`` takes a list of dicts per row, so one row can
    have any number of detections (``detections_explode`` makes rows of them).  The predictor is made once per
    Python worker and reused by later tasks of the same call; calls that name the same ``model_key`` share it.
    A worker keeps the ``KEPT_PREDICTORS`` used last.
    """
    model_key = model_key or uuid.uuid4().hex

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = vars(sys).setdefault("_annolake_predictors", {})
        made[model_key] = predictor = made.pop(model_key, None) or make_predictor()
        while len(made) > KEPT_PREDICTORS:
            del made[next(iter(made))]
        for batch in batches:
            yield predictor(batch)

    return rows.mapInPandas(predict, schema)


# Workers get these functions by value, so they run where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
