"""Streams over several micro-batches against their batch twins."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from annolake.operators import runs
from annolake.streaming import frames as streams


def frames(spark, n=120):
    base = spark.range(n).select(
        (F.col("id") % 2).alias("source_id"), F.col("id").alias("event_id"),
        F.timestamp_micros(F.col("id") * F.col("id") * 1000 + 5_000_000).alias("frame_ts"),
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("class_name"),
        (F.col("id") % 4).cast("int").alias("detection_count"), (F.col("id") * 1.5).alias("inference_ms"),
    )
    return base


def landed(spark, path):
    """Five files in time order, read one file per batch."""
    all_frames = frames(spark)
    for part in range(5):
        all_frames.filter(F.floor(F.col("event_id") / 24) == part).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(all_frames.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_moving_rate_carries_state_across_batches(spark, tmp_path):
    stream = streams.stream_moving_fps(landed(spark, str(tmp_path / "in")))
    streams.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    columns = ["source_id", "event_id", "frame_index", F.round("instantaneous_fps", 8), F.round("moving_average_fps", 8)]
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).select(*columns).collect()))
    want = sorted(map(tuple, runs.frame_fps(frames(spark)).select(*columns).collect()))
    assert got == want


def test_running_counts(spark, tmp_path):
    stream = streams.stream_class_counts(landed(spark, str(tmp_path / "in")))
    streams.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "update")
    newest = spark.read.parquet(str(tmp_path / "out")).groupBy("source_id", "class_name").agg(F.max_by("detections", "batch_id"))
    want = frames(spark).groupBy("source_id", "class_name").agg(F.sum("detection_count"))
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, want.collect()))


def test_result_ingest_is_incremental(spark, tmp_path):
    schema = "result_id string, n long"
    run = lambda: streams.stream_result_ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"))
    spark.createDataFrame([("a", 1)], schema).write.json(str(tmp_path / "in"))
    run()
    spark.createDataFrame([("b", 2)], schema).write.mode("append").json(str(tmp_path / "in"))
    run()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", 1), ("b", 2)}


def test_predictor_is_made_by_the_worker(spark):
    def make():
        def predict(batch):
            return batch.assign(score=batch["id"] * 2.0)

        return predict

    got = streams.batch_predict(spark.range(10), make, "id bigint, score double", "double")
    assert got.agg(F.sum("score")).first()[0] == 90.0


def test_two_predictors_in_one_session_do_not_mix(spark):
    rows = spark.createDataFrame([(1.0,), (2.0,)], "x double")

    def times(factor):
        return lambda: lambda batch: batch.assign(score=batch["x"] * factor)[["score"]]

    for factor in (2, 5):
        out = streams.batch_predict(rows, times(factor), "score double")
        assert sorted(r.score for r in out.collect()) == [factor, 2 * factor]


def _moving(spark, stream, tmp_path, name="out"):
    streams.run_to_table(stream, str(tmp_path / name), str(tmp_path / f"{name}-cp"))
    columns = ["source_id", "event_id", "frame_index", F.round("instantaneous_fps", 8), F.round("moving_average_fps", 8)]
    return sorted(map(tuple, spark.read.parquet(str(tmp_path / name)).select(*columns).collect()))


def test_a_source_with_most_frames_is_sorted_outside_memory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "HELD_ROWS", 300)
    monkeypatch.setattr(streams, "BLOCK_ROWS", 70)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        # Nearly all frames belong to source 0, in no order of time, with ties.
        rows = spark.range(3000).select(
            F.when(F.col("id") % 20 == 0, 1).otherwise(0).cast("long").alias("source_id"), F.col("id").alias("event_id"),
            F.timestamp_micros((F.col("id") * 7919 % 1500) * 40_000).alias("frame_ts"),
            F.lit("c").alias("class_name"), F.lit(1).alias("detection_count"), F.lit(1.0).alias("inference_ms"),
        )
        rows.repartition(3).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        columns = ["source_id", "event_id", "frame_index", F.round("instantaneous_fps", 8), F.round("moving_average_fps", 8)]
        want = sorted(map(tuple, runs.frame_fps(rows).select(*columns).collect()))
        assert _moving(spark, streams.stream_moving_fps(stream), tmp_path) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_an_idle_source_expires_by_timer(spark, tmp_path):
    second = 1_000_000
    times = {0: [0, 1, 2, 4000, 4001], 1: list(range(0, 4002, 100))}
    rows = [(s, 10_000 * s + i, (t + 9000) * second) for s, all_times in times.items() for i, t in enumerate(all_times)]
    frame = spark.createDataFrame(rows, "source_id long, event_id long, us long").select(
        "source_id", "event_id", F.timestamp_micros("us").alias("frame_ts"), F.lit(1).alias("detection_count"), F.lit(1.0).alias("inference_ms")
    )
    assert streams.land_in_order(frame, ["frame_ts", "event_id"], str(tmp_path / "in"), 8) == 8
    for idle, want in ((None, [0, 1, 2, 3, 4]), (600_000, [0, 1, 2, 0, 1])):
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        found = _moving(spark, streams.stream_moving_fps(stream, idle, "1 second"), tmp_path, f"out{idle}")
        assert [r[2] for r in found if r[0] == 0] == want
        assert [r[2] for r in found if r[0] == 1] == list(range(41))


def test_windows_close_and_late_rows_are_counted(spark, tmp_path):
    rows = spark.range(2000).select(
        F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 60_000_000 + 86_400_000_000).alias("frame_ts"),
        F.lit(2).alias("detection_count"), F.col("id").cast("double").alias("inference_ms"),
    )
    late = (F.col("event_id") % 10 == 3) & (F.col("event_id") < 1000)
    again = rows.filter("event_id = 1990")  # the same event twice counts once
    ahead = rows.limit(1).select(F.lit(-1).cast("long").alias("event_id"), F.timestamp_micros(F.lit(10**13)).alias("frame_ts"), "detection_count", "inference_ms")
    landed = 0
    for nth, (part, files) in enumerate([(rows.filter(~late), 6), (rows.filter(late).union(again), 1), (ahead, 1)]):
        landed += streams.land_in_order(part, ["frame_ts", "event_id"], str(tmp_path / "in" / str(nth)), files, landed)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    dropped = streams.run_window_rate(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert dropped == 100 and got.agg(F.sum("frames")).first()[0] == 1900
    want = streams.window_rate(rows.filter(~late))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sources_share_a_call(spark, tmp_path, monkeypatch):
    """Many sources in few groups: the rows are those of the batch twin, and a batch calls once a group, not once a source."""
    calls = spark.sparkContext.accumulator(0)
    handled = streams.MovingRate.handleInputRows

    def counted(self, key, rows, timers):
        calls.add(1)
        yield from handled(self, key, rows, timers)

    monkeypatch.setattr(streams.MovingRate, "handleInputRows", counted)
    rows = spark.range(1200).select(
        F.when(F.col("id") % 300 != 7, F.col("id") * 7 % 300 + 2**60).alias("source_id"), F.col("id").alias("event_id"),
        F.timestamp_micros(F.col("id") * F.col("id") * 1000).alias("frame_ts"),
        F.lit(1).alias("detection_count"), F.lit(1.0).alias("inference_ms"),
    )
    assert streams.land_in_order(rows, ["frame_ts", "event_id"], str(tmp_path / "in"), 3) == 3
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    columns = ["source_id", "event_id", "frame_index", F.round("instantaneous_fps", 8), F.round("moving_average_fps", 8)]
    want = [tuple(r) for r in runs.frame_fps(rows).select(*columns).collect()]
    streams.run_to_table(streams.stream_moving_fps(stream, groups=5), str(tmp_path / "out"), str(tmp_path / "cp"))
    found = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select(*columns).collect()]
    by_id = lambda all_rows: sorted(all_rows, key=lambda r: r[1])
    assert by_id(found) == by_id(want) and len({r[0] for r in found}) == 300
    assert 0 < calls.value <= 3 * (5 + 1)


def test_a_frame_without_a_time_is_an_error():
    one = pd.DataFrame({"source": [1, 1], "event_id": [1, 2], "detection_count": [0, 0], "inference_ms": [1.0, 1.0], "us": [5.0, float("nan")]})
    with pytest.raises(ValueError, match="NA|NaN|inf"):
        streams.Sources(None).paced(one)
