"""Streams whose rows come late, out of order, twice or over many batches."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.streaming import operators as ST


def _land(spark, path, batches, schema):
    """One file a batch, one after the other."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


_EVENTS = "event_id long, key string, t double, value double"


@pytest.fixture
def shuffled(spark):
    """Rows up to an hour out of order over 12 batches; one key holds most of them."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot"] * 8 + ["a", "b"]), 1_000_000.0 + i * 60 + rng.choice([0.0, 0.25]), float(rng.randint(0, 5000))) for i in range(600)]
    arrival = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 3600))
    batches = [arrival[k * 50:(k + 1) * 50] for k in range(12)] + [[(-1, "end", 9e6, 0.0)]]
    path = _land(spark, scratch_path(spark, "shuffled"), batches, _EVENTS)
    s = ST.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    return rows, s.withColumn("event_time", F.timestamp_micros((F.col("t") * 1e6).cast("long")))


def test_rate_keeps_event_time_order_over_batches(spark, shuffled):
    rows, s = shuffled
    out = scratch_path(spark, "rate")
    q = ST.to_files(ST.CounterRate("event_id", "t", "value", width=600.0).over(s, ["key"], "event_time", "2 hours"), out, scratch_path(spark, "ckpt"))
    assert len(q.recentProgress) > 10
    last, want = {}, {}
    for i, key, t, v in sorted(rows, key=lambda r: (r[2], r[0])):
        before = last.get(key)
        want[i] = None if before is None else max(v - before[1], 0.0) / max(t - before[0], 1e-6) / 1024
        last[key] = (t, v)
    got = {r["event_id"]: r["rate"] for r in spark.read.parquet(out).collect()}
    assert got.keys() == want.keys()
    assert all(got[i] == want[i] or abs(got[i] - want[i]) < 1e-9 for i in want)


def test_burst_limit_equals_a_loop(spark, shuffled):
    rows, s = shuffled
    out = scratch_path(spark, "burst")
    ST.to_files(ST.BurstLimit("event_id", "t", 3, 500.0, width=600.0).over(s, ["key"], "event_time", "2 hours"), out, scratch_path(spark, "ckpt"))
    let, want = {}, {}
    for i, key, t, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        times = [w for w in let.get(key, []) if t - w <= 500.0]
        want[i] = len(times) < 3
        let[key] = times + [t] if want[i] else times
    assert {r["event_id"]: r["accepted"] for r in spark.read.parquet(out).collect()} == want


def test_late_rows_are_dropped_and_counted_and_state_is_evicted(spark):
    hours = [[(h * 4 + k, "x", h * 3600.0 + k, 1.0) for k in range(4)] for h in range(12)]
    late = [(900, "x", 10.0, 1.0)]   # eleven hours behind
    path = _land(spark, scratch_path(spark, "late"), [*hours, late, [(-1, "end", 9e6, 0.0)]], _EVENTS)
    s = ST.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1) \
        .withColumn("event_time", F.timestamp_micros((F.col("t") * 1e6).cast("long"))).withWatermark("event_time", "1 hour")
    out = scratch_path(spark, "late-out")
    q = ST.to_files(s.groupBy(F.window("event_time", "1 hour")).agg(F.count(F.lit(1)).alias("n")), out, scratch_path(spark, "ckpt"))
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [4] * 12
    assert ST.late_rows(q) == 1
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 4   # windows that the watermark has not passed


def test_first_seen_over_thirty_days_keeps_no_state(spark):
    rng = random.Random(5)
    days = [[(rng.choice([f"t{rng.randint(0, 200)}", f"d{d}-{k}", None]),) for k in range(40)] for d in range(30)]
    path = _land(spark, scratch_path(spark, "days"), days, "task_id string")
    checkpoint, out = scratch_path(spark, "ckpt"), scratch_path(spark, "seen")
    stream = lambda: ST.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    q = ST.first_seen(stream(), "task_id", out, checkpoint)
    assert len(q.recentProgress) >= 30 and not any(p["stateOperators"] for p in q.recentProgress)
    got = [r["task_id"] for r in spark.read.schema("task_id string, batch int").parquet(out).collect()]
    assert sorted(got, key=str) == sorted({r[0] for d in days for r in d}, key=str)
    _land(spark, path, [[(next(filter(None, got)),), ("new",), (None,)]], "task_id string")   # a restart knows what was seen before
    ST.first_seen(stream(), "task_id", out, checkpoint)
    again = [r["task_id"] for r in spark.read.schema("task_id string, batch int").parquet(out).collect()]
    assert sorted(again, key=str) == sorted([*got, "new"], key=str)


def test_consumed_files_are_archived_and_a_restart_goes_on(spark):
    path = _land(spark, scratch_path(spark, "in"), [[(k,)] for k in range(4)], "x long")
    checkpoint, out, archive = scratch_path(spark, "ckpt"), scratch_path(spark, "out"), scratch_path(spark, "archive")
    schema = spark.read.parquet(path).schema
    stream = lambda: ST.file_stream(spark, path, schema, max_files=1, clean="archive", archive=archive)
    ST.to_files(stream(), out, checkpoint)
    _land(spark, path, [[(9,)]], "x long")
    ST.to_files(stream(), out, checkpoint)
    assert sorted(r["x"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 9]
    gone = glob.glob(f"{archive}/**/*.parquet", recursive=True)
    left = glob.glob(f"{path}/*.parquet")
    assert gone and len(gone) + len(left) == 5 and not {os.path.basename(p) for p in gone} & {os.path.basename(p) for p in left}


def test_snapshot_of_the_last_batch(spark):
    path = _land(spark, scratch_path(spark, "in"), [[(k,)] for k in range(3)], "x long")
    s = ST.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    out = scratch_path(spark, "snap")
    q = ST.to_table_snapshot(s.agg(F.sum("x").alias("x")), out, scratch_path(spark, "ckpt"))
    assert ST.read_snapshot(q, spark, out).first()["x"] == 3
