"""Queries for the streaming operators.  Each lands a driver
table as files, runs the stream to completion with ``availableNow`` into a
file sink / snapshot under the shared checkpoint folder, and returns the
sink read back.  Keys whose result equals the batch result carry the batch
oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.classify import _BASE_SQL as _CLS_SQL
from tessera.plans.common import LI_FEATURES, li_key, lineitem, r6, with_role
from tessera.plans.registry import register
from tessera.session import scratch_path, table
from tessera.streaming import operators as ST

def _scored_stream(spark, sf_dir):
    """Fit once on the context (batch), score query files as they land."""
    from tessera.plans.classify import FEATURES, apply_classifier, fit_classifier
    li = with_role(lineitem(spark, sf_dir), li_key()).select("row_id", *FEATURES, "l_returnflag", "role")
    model = fit_classifier(li.where("role = 'context'"))
    src = ST.land(li.where("role = 'query'").drop("role"), "stream-in", 8, "csv")
    stream = ST.file_stream(spark, src, li.drop("role").schema, "csv", max_files=4)
    x = apply_classifier(stream.withColumn("input", F.regexp_extract("_metadata.file_path", "([^/]+)$", 1)), model)
    out = scratch_path(spark, "stream-scored")
    # one result folder for each input file
    ST.to_files(x.select("row_id", "prediction", "l_returnflag", "input"), out, scratch_path(spark, "ckpt-scored"), by="input")
    return out


@register("stream_score_files", _CLS_SQL + "SELECT row_id, prediction FROM pred")
def _stream_score(spark, sf_dir):
    return spark.read.parquet(_scored_stream(spark, sf_dir)).select("row_id", "prediction")


@register("stream_accuracy", _CLS_SQL + """
SELECT count(*) AS n, CAST(sum(CASE WHEN prediction = l_returnflag THEN 1 ELSE 0 END) AS BIGINT) AS correct FROM pred""")
def _stream_accuracy(spark, sf_dir):
    scored = _scored_stream(spark, sf_dir)
    schema = spark.read.parquet(scored).schema
    s = spark.readStream.schema(schema).parquet(scored)
    agg = s.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("prediction") == F.col("l_returnflag")).cast("bigint")).alias("correct"))
    out = scratch_path(spark, "stream-acc")
    return ST.read_snapshot(ST.to_table_snapshot(agg, out, scratch_path(spark, "ckpt-acc")), spark, out)


def _events_stream(spark, sf_dir, max_files=2):
    e = table(spark, sf_dir, "events")
    src = ST.land(e, "events-in", 8, order="event_id")
    return ST.file_stream(spark, src, e.schema, max_files=max_files), src


@register("stream_progress", """
SELECT count(*) FILTER (WHERE event_type = 'view') AS discovered, count(*) FILTER (WHERE event_type = 'purchase') AS processed,
       count(*) FILTER (WHERE event_type = 'view') = 0 AND count(*) FILTER (WHERE event_type = 'purchase') = 0 AS idle FROM events""")
def _stream_progress(spark, sf_dir):
    s, _ = _events_stream(spark, sf_dir)
    agg = s.agg(F.sum((F.col("event_type") == "view").cast("bigint")).alias("discovered"),
                F.sum((F.col("event_type") == "purchase").cast("bigint")).alias("processed"))
    agg = agg.withColumn("idle", (F.col("discovered") == 0) & (F.col("processed") == 0))
    out = scratch_path(spark, "stream-progress")
    return ST.read_snapshot(ST.to_table_snapshot(agg, out, scratch_path(spark, "ckpt-progress")), spark, out)


def _ordered_events(spark, sf_dir, name):
    """events as files that follow each other in event time, and a last one far behind them."""
    e = table(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))
    last = e.agg(F.max("event_time")).first()[0]
    src = ST.land_in_order(e, name, "event_time", 8, {"event_time": F.lit(last) + F.expr("INTERVAL 60 DAYS")})
    return ST.file_stream(spark, src, e.schema, max_files=1)


_TICK_VALUES = "round(sum(value), 6) AS value_sum, round(avg(value), 6) AS value_mean, count(*) AS n"


def _ticks(spark, sf_dir, window, name):
    """Closed windows, in append mode: the watermark evicts what it has passed."""
    s = _ordered_events(spark, sf_dir, name).withWatermark("event_time", "2 hours")
    w = s.groupBy(window, F.pmod("user_id", F.lit(4)).alias("gpu")).agg(
        F.sum("value").alias("value_sum"), F.avg("value").alias("value_mean"), F.count(F.lit(1)).alias("n"))
    out = scratch_path(spark, f"{name}-out")
    ST.to_files(w, out, scratch_path(spark, f"{name}-ckpt"))
    r = spark.read.schema(w.schema).parquet(out)
    at = lambda c: F.date_format(F.col(c).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    first = r.columns[0]
    return r.select(at(f"{first}.start").alias("window_start"), at(f"{first}.end").alias("window_end"), "gpu",
                    r6("value_sum").alias("value_sum"), r6("value_mean").alias("value_mean"), "n")


@register("stream_ticks", f"""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
       user_id % 4 AS gpu, {_TICK_VALUES} FROM events GROUP BY 1, 2, 3""")
def _stream_ticks(spark, sf_dir):
    return _ticks(spark, sf_dir, F.window("event_time", "1 hour").alias("window"), "ticks")


@register("stream_ticks_sliding", f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, user_id % 4 AS gpu, {_TICK_VALUES}
FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k AS w FROM events, range(2) r(k)) t GROUP BY ALL""")
def _stream_ticks_sliding(spark, sf_dir):
    return _ticks(spark, sf_dir, F.window("event_time", "1 hour", "30 minutes").alias("window"), "sliding")


@register("stream_ticks_session", f"""
WITH l AS (SELECT *, user_id % 4 AS gpu, lag(ts) OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) AS before FROM events),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 10 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY gpu ORDER BY ts, event_id) AS k FROM l)
SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(max(ts) + INTERVAL 10 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, gpu, {_TICK_VALUES}
FROM s GROUP BY gpu, k""")
def _stream_ticks_session(spark, sf_dir):
    return _ticks(spark, sf_dir, F.session_window("event_time", "10 minutes").alias("session"), "session")


@register("stream_counter_rate", """
WITH e AS (SELECT event_id, user_id % 4 AS gpu, CASE WHEN event_type IN ('click', 'view') THEN 'rx' ELSE 'tx' END AS dir,
                  epoch_us(ts) / 1e6 AS t, value FROM events),
l AS (SELECT *, lag(value) OVER w AS pv, lag(t) OVER w AS pt FROM e WINDOW w AS (PARTITION BY gpu, dir ORDER BY t, event_id))
SELECT gpu, dir, event_id, round(CASE WHEN pv IS NULL THEN NULL ELSE greatest(value - pv, 0) / greatest(t - pt, 1e-6) / 1024 END, 6) AS rate
FROM l""")
def _stream_rate(spark, sf_dir):
    s = _ordered_events(spark, sf_dir, "rate")
    x = s.select("event_time", "event_id", F.pmod("user_id", F.lit(4)).alias("gpu"),
                 F.when(F.col("event_type").isin("click", "view"), "rx").otherwise("tx").alias("dir"),
                 (F.unix_micros("event_time") / 1e6).alias("t"), "value")
    r = ST.CounterRate("event_id", "t", "value").over(x, ["gpu", "dir"], "event_time", "2 hours")
    out = scratch_path(spark, "rate-out")
    ST.to_files(r, out, scratch_path(spark, "rate-ckpt"))
    return spark.read.parquet(out).withColumn("rate", r6("rate"))


@register("stream_burst_limit")
def _stream_burst(spark, sf_dir):
    """Sequential by nature (a row counts only if it was let through): tested against a loop."""
    s = _ordered_events(spark, sf_dir, "burst")
    lvl = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "signup", "WARNING").otherwise("INFO")
    x = s.select("event_time", "event_id", lvl.alias("level"), F.col("event_type").alias("event"), (F.unix_micros("event_time") / 1e6).alias("t"))
    r = ST.BurstLimit("event_id", "t", 5, 3600.0).over(x, ["level", "event"], "event_time", "2 hours")
    out = scratch_path(spark, "burst-out")
    ST.to_files(r, out, scratch_path(spark, "burst-ckpt"))
    return spark.read.parquet(out)


@register("stream_dedupe_tasks", "SELECT DISTINCT 't' || CAST(user_id AS VARCHAR) AS task_id FROM events")
def _stream_dedupe(spark, sf_dir):
    s, _ = _events_stream(spark, sf_dir)
    out = scratch_path(spark, "stream-dedupe")
    ST.first_seen(s.select(F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("task_id")), "task_id", out, scratch_path(spark, "ckpt-dedupe"))
    return spark.read.schema("task_id string, batch int").parquet(out).select("task_id")


@register("stream_consume_and_clean", "SELECT event_id, event_type FROM events")
def _stream_clean(spark, sf_dir):
    """Every file is read once, then moved to the archive; a restart goes on behind the last one read."""
    e = table(spark, sf_dir, "events")
    src = ST.land(e, "consume-in", 8, order="event_id")
    archive = scratch_path(spark, "consume-archive")
    s = ST.file_stream(spark, src, e.schema, max_files=1, clean="archive", archive=archive)
    out = scratch_path(spark, "consume-out")
    ST.to_files(s.select("event_id", "event_type"), out, scratch_path(spark, "ckpt-consume"))
    return spark.read.parquet(out)
