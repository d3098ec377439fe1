"""Queries for telemetry and log analytics.

Log text is rendered from ``events`` inside each query (one file per event
type, line numbers from event ids, headers and junk lines included), parsed
back with the operators, and checked against values computed straight from
``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.operators import telemetry as TL
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.plans.sqlbits import u_sql
from tessera.session import scratch_path, table
from tessera.sources.text import read_lines

_EPOCH = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def _ev(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _chunk():
    return F.floor(F.col("line_no") / (1 << 20))


def _lines():
    """Chunks of lines that were read from files (numbered by input split)."""
    return F.shiftright("line_no", 16)


def _logged(lines, name):
    """The lines as log files, one each, read back."""
    path = scratch_path(lines.sparkSession, name)
    lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", "value").write.partitionBy("file").text(path)
    return read_lines(lines.sparkSession, path).withColumn("file", F.regexp_extract("file", "file=([^/]+)", 1))


def _headers(e, header, every=1000, stride=2):
    files = e.select(F.col("event_type").alias("file")).distinct()
    h0 = files.select("file", F.lit(-1).cast("bigint").alias("line_no"), F.lit(header).alias("value"))
    mid = e.where(F.pmod("event_id", F.lit(every)) == 0).select(
        F.col("event_type").alias("file"), (F.col("event_id") * stride).alias("line_no"), F.lit(header).alias("value"))
    return h0.unionByName(mid)


# ------------------------------------------------------------ start time
@register("parse_start_time", """
WITH f AS (SELECT event_type, min(ts) AS t FROM events GROUP BY 1)
SELECT event_type AS file, CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN floor(epoch(t)) - 8 * 3600
  WHEN 'view' THEN floor(epoch(t)) + 0.25 ELSE floor(epoch(t)) END::DOUBLE AS start_epoch FROM f""")
def _start(spark, sf_dir):
    """No time, an offset, a fraction without a zone, and 'Z'."""
    e = _ev(spark, sf_dir)
    f = e.groupBy(F.col("event_type").alias("file")).agg(F.min("ts").alias("t"))
    iso = F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss")
    at = (F.when(F.col("file") == "click", F.lit("not-a-time")).when(F.col("file") == "error", F.concat(iso, F.lit("+08:00")))
          .when(F.col("file") == "view", F.concat(iso, F.lit(".250"))).otherwise(F.concat(iso, F.lit("Z"))))
    lines = f.select("file", F.lit(0).alias("line_no"), F.concat(F.lit("Monitor started at "), at).alias("value"))
    return TL.parse_start_time(_logged(lines, "start"))


# ------------------------------------------------------------- gpu dmon
_DMON_HEADER = "  # GPU pwr temp sm mem mclk pclk"


def _dmon_lines(e):
    gpu = F.when(F.col("value") > 95, F.lit("N/A")).otherwise(F.pmod("user_id", F.lit(4)).cast("string"))
    pwr = F.format_string("%.2f", F.col("value"))
    mem = F.when(F.col("event_type") == "click", F.lit("-")).otherwise(F.pmod("event_id", F.lit(100)).cast("string"))
    full = F.concat_ws(" ", gpu, pwr, F.pmod("user_id", F.lit(90)).cast("string"), F.pmod("user_id", F.lit(100)).cast("string"),
                       mem, F.lit("5001"), (F.col("user_id") + 1500).cast("string"))
    short = F.concat_ws(" ", gpu, pwr)
    data = e.select(F.col("event_type").alias("file"), (F.col("event_id") * 2 + 1).alias("line_no"),
                    F.concat(F.lit("  "), F.when(F.col("value") < 1, short).otherwise(full)).alias("value"))
    return _headers(e, _DMON_HEADER).unionByName(data)


_GPU_TICK_SQL = """f AS (SELECT file, arg_min(gpu, line_no) AS first_gpu FROM p GROUP BY 1),
t AS (SELECT p.*, sum(CASE WHEN gpu = first_gpu THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS tick FROM p JOIN f USING (file))"""


@register("parse_header_driven", f"""
WITH p AS (SELECT event_type AS file, event_id AS line_no, user_id % 4 AS gpu, value AS pwr_W,
       CAST(user_id % 90 AS DOUBLE) AS temp_C, CAST(user_id % 100 AS DOUBLE) AS sm_pct,
       CASE WHEN event_type = 'click' THEN NULL ELSE CAST(event_id % 100 AS DOUBLE) END AS mem_pct,
       5001.0 AS mclk_MHz, CAST(user_id + 1500 AS DOUBLE) AS pclk_MHz FROM events WHERE value >= 1 AND value <= 95),
{_GPU_TICK_SQL}
SELECT file, CAST(tick AS DOUBLE) AS time_s, gpu, pwr_W, temp_C, sm_pct, mem_pct, mclk_MHz, pclk_MHz FROM t""")
def _dmon(spark, sf_dir):
    lines = _logged(_dmon_lines(_ev(spark, sf_dir)), "dmon")
    d = TL.first_key_ticks(TL.parse_header_driven(lines, TL.DMON_RENAME, "gpu", _lines()), "gpu", _lines())
    return d.withColumn("time_s", F.col("tick") * 1.0).drop("line_no", "tick")


_PMON_HEADER = "# gpu pid type sm mem enc dec fb command"


@register("parse_pmon", """
WITH p AS (SELECT event_type AS file, event_id * 2 + 1 AS line_no, user_id % 4 AS gpu,
                  CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id % 100 AS DOUBLE) END AS sm,
                  CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS DOUBLE) END AS fb FROM events WHERE value <= 95),
f AS (SELECT file, arg_min(gpu, line_no) AS first_gpu FROM p GROUP BY 1),
t AS (SELECT p.*, sum(CASE WHEN gpu = first_gpu THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line_no
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS tick FROM p JOIN f USING (file))
SELECT file, CAST(tick AS BIGINT) AS tick, gpu, round(coalesce(sum(fb), 0), 6) AS fb_mem_MB,
       round(coalesce(sum(sm), 0), 6) AS sm_pct, count(fb) AS proc_count FROM t GROUP BY 1, 2, 3""")
def _pmon(spark, sf_dir):
    e = _ev(spark, sf_dir)
    gpu = F.when(F.col("value") > 95, F.lit("x")).otherwise(F.pmod("user_id", F.lit(4)).cast("string"))
    sm = F.when(F.col("event_type") == "view", F.lit("-")).otherwise(F.pmod("user_id", F.lit(100)).cast("string"))
    row = F.concat_ws(" ", gpu, F.col("event_id").cast("string"), F.lit("C"), sm, F.lit("-"), F.lit("-"), F.lit("-"),
                      F.when(F.col("event_type") == "error", F.lit("-")).otherwise(F.floor("value").cast("string")), F.lit("python"))
    data = e.select(F.col("event_type").alias("file"), (F.col("event_id") * 2 + 1).alias("line_no"), row.alias("value"))
    lines = _headers(e, _PMON_HEADER).unionByName(data)
    p = TL.parse_header_driven(_logged(lines, "pmon"), {"sm": "sm", "fb": "fb"}, "gpu", _lines(), need=("pid",))
    t = TL.first_key_ticks(p, "gpu", _lines())
    g = t.groupBy("file", "tick", "gpu").agg(F.coalesce(F.sum("fb"), F.lit(0.0)).alias("fb_mem_MB"),
                                             F.coalesce(F.sum("sm"), F.lit(0.0)).alias("sm_pct"),
                                             F.count("fb").alias("proc_count"))
    return g.select("file", "tick", "gpu", r6("fb_mem_MB").alias("fb_mem_MB"), r6("sm_pct").alias("sm_pct"), "proc_count")


# --------------------------------------------------------------- vmstat
_VM_HEADER = " r  b   swpd   free   buff  cache   si   so    bi    bo   in   cs us sy ID wa st"


def _vm_lines(e):
    files = e.select(F.col("event_type").alias("file")).distinct()
    top = files.select("file", F.lit(-2).cast("bigint").alias("line_no"),
                       F.lit("procs -----------memory---------- ---swap-- -----io---- -system-- ------cpu-----").alias("value"))
    hdr = files.select("file", F.lit(-1).cast("bigint").alias("line_no"), F.lit(_VM_HEADER).alias("value"))
    us = F.pmod("user_id", F.lit(40))
    nums = [F.pmod("user_id", F.lit(5)), F.lit(0), F.lit(0), F.col("user_id") * 100, F.lit(1), F.lit(2), F.lit(0), F.lit(0),
            F.pmod("event_id", F.lit(50)), F.lit(3), F.lit(100), F.lit(200), us, F.lit(5), F.lit(95) - us, F.lit(0), F.lit("1e1")]
    row = F.concat_ws(" ", *[n.cast("string") for n in nums])
    row = F.when((F.col("event_type") == "error") & (F.col("value") > 90), F.concat(row, F.lit(" x"))).otherwise(row)
    data = e.select(F.col("event_type").alias("file"), F.col("event_id").alias("line_no"), row.alias("value"))
    return top.unionByName(hdr).unionByName(data)


_VM_SQL = """(SELECT event_type AS file, event_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS BIGINT) AS sample,
  CAST(user_id % 40 AS DOUBLE) AS us, 5.0 AS sy, CAST(95 - user_id % 40 AS DOUBLE) AS id
  FROM events WHERE NOT (event_type = 'error' AND value > 90))"""


@register("parse_vmstat", f"SELECT file, sample, us, sy, id FROM {_VM_SQL} v")
def _vmstat(spark, sf_dir):
    v = TL.parse_numeric_table(_logged(_vm_lines(_ev(spark, sf_dir)), "vmstat"), TL.vmstat_header(), _lines())
    return v.select("file", "sample", F.col("row")["us"].alias("us"), F.col("row")["sy"].alias("sy"),
                    F.col("row")["id"].alias("id"))


@register("cpu_usage", f"SELECT file, sample, 100.0 - id AS cpu_pct FROM {_VM_SQL} v")
def _cpu(spark, sf_dir):
    v = TL.parse_numeric_table(_logged(_vm_lines(_ev(spark, sf_dir)), "vmstat"), TL.vmstat_header(), _lines())
    return v.select("file", "sample", TL.cpu_usage(F.col("row")["id"]).alias("cpu_pct"))


# --------------------------------------------------------------- iostat
@register("parse_iostat", """
WITH d AS (SELECT event_type AS file, event_id, value, user_id FROM events),
t AS (SELECT *, count(*) FILTER (WHERE event_id % 10 = 0) OVER (PARTITION BY file ORDER BY event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tick FROM d)
SELECT file, CAST(tick AS BIGINT) AS time_s, round(avg(value) + 1e-9, 4) AS util_pct,
  round(avg(CASE WHEN user_id % 7 > 0 THEN user_id / 10.0 END) + 1e-9, 4) AS await_ms FROM t GROUP BY 1, 2""")
def _iostat(spark, sf_dir):
    """Dates and clock times before ticks, repeated headers, cells without a number."""
    e = _ev(spark, sf_dir)
    files = e.select(F.col("event_type").alias("file")).distinct()
    header = F.lit("Device r/s w/s await aqu-sz %util")
    line = lambda df, at, value: df.select("file", F.lit(at).cast("bigint").alias("line_no") if isinstance(at, int) else at.alias("line_no"), value.alias("value"))
    named = e.withColumn("file", F.col("event_type"))
    tick = named.where(F.pmod("event_id", F.lit(10)) == 0)
    stamp = F.when(F.pmod("event_id", F.lit(20)) == 0, F.lit("Mon 1 2024")).otherwise(F.date_format("ts", "HH:mm:ss"))
    wait = F.when(F.pmod("user_id", F.lit(7)) > 0, (F.col("user_id") / 10.0).cast("string")).otherwise("-")
    row = F.concat_ws(" ", F.lit("sda"), F.lit("1.0"), F.lit("2.0"), wait, F.lit("0.1"), F.format_string("%.2f", "value"))
    lines = line(files, -3, F.lit("12:00:00")).unionByName(line(files, -2, header)).unionByName(line(files, -1, F.lit(""))) \
        .unionByName(line(tick, F.col("event_id") * 3, stamp)).unionByName(line(tick, F.col("event_id") * 3 + 1, header)) \
        .unionByName(line(named, F.col("event_id") * 3 + 2, row))
    r = TL.parse_iostat(_logged(lines, "iostat"), _lines())
    # means of 1- and 2-decimal values can sit exactly on a rounding tie: nudge, then round
    return r.select("file", F.col("time_s").cast("bigint").alias("time_s"), F.round(F.col("util_pct") + 1e-9, 4).alias("util_pct"),
                    F.round(F.col("await_ms") + 1e-9, 4).alias("await_ms"))


# ---------------------------------------------------------------- network
@register("parse_net_sum", """
WITH x AS (SELECT event_type AS file, event_id, round(value + user_id, 6) AS sum_kBs FROM events WHERE NOT (event_type <> 'view' AND value < 5))
SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY event_id) - 1 AS BIGINT) AS time_s, sum_kBs FROM x""")
def _net(spark, sf_dir):
    """Counter logs, and of views an interface table, where only two of the numbers count."""
    e = _ev(spark, sf_dir)
    plain = F.when(F.col("value") < 5, F.concat_ws(" ", F.lit("lo"), F.col("user_id").cast("string"), F.lit("kb"))) \
        .otherwise(F.concat_ws(" ", F.lit("eth0"), F.format_string("%.2f", "value"), F.col("user_id").cast("string"), F.lit("kb")))
    table_row = F.concat_ws(" ", F.lit("12:00:01"), F.lit("eth0"), F.format_string("%.2f", "value"), F.col("user_id").cast("string"), F.lit("3.5 4.5 0 0"))
    kinds = e.select(F.col("event_type").alias("file"), F.col("event_id").alias("line_no"),
                     F.when(F.col("event_type") == "view", table_row).otherwise(plain).alias("value"))
    head = spark.createDataFrame([("view", -2, "12:00:00 lo 9 9 9 9"), ("view", -1, "12:00:00 IFACE rxpck/s rxkB/s txkB/s x x x")], kinds.schema)
    lines = _logged(head.unionByName(kinds), "net")
    view = F.col("file") == "view"
    x = TL.parse_net(lines.where(view), _lines(), interfaces=True).unionByName(TL.parse_net(lines.where(~view), _lines()))
    return x.select("file", "time_s", r6("sum_kBs").alias("sum_kBs"))


@register("link_throughput", """
SELECT event_id, user_id % 4 AS gpu, round((coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value END, 0)
       + coalesce(CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(user_id AS DOUBLE) END, 0)) / 1024.0, 3) AS kBs FROM events""")
def _link(spark, sf_dir):
    e = _ev(spark, sf_dir)
    rx = F.when(F.col("event_type") == "error", None).otherwise(F.col("value"))
    tx = F.when(F.col("event_type") == "signup", None).otherwise(F.col("user_id").cast("double"))
    return e.select("event_id", F.pmod("user_id", F.lit(4)).alias("gpu"), F.round(TL.link_throughput(rx, tx), 3).alias("kBs"))


_UNIT_OF = {"click": ("MB", "KB"), "view": ("KB/s", "b"), "purchase": ("GB", "bytes"), "error": ("XB", "MB/s"),
            "signup": ("B", "Gb")}


def _scale_sql(u: str) -> float:
    b = u.lower()
    b = b[:-2] if b.endswith("/s") else b
    return float(TL.UNIT_SCALE.get(b, 1))


@register("extract_unit_values", "SELECT event_id, tx, rx FROM (SELECT event_id, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN round(value * {_scale_sql(a)}, 2) " for k, (a, b) in _UNIT_OF.items()) + "END AS tx, CASE event_type " + " ".join(
    f"WHEN '{k}' THEN round(user_id * {_scale_sql(b)}, 2) " for k, (a, b) in _UNIT_OF.items()) +
    "END AS rx0, CASE WHEN tx = 0 AND rx0 = 0 THEN NULL ELSE tx END AS tx2, CASE WHEN tx = 0 AND rx0 = 0 THEN NULL ELSE rx0 END AS rx FROM events) t"
    .replace("SELECT event_id, tx, rx FROM", "SELECT event_id, tx2 AS tx, rx FROM"))
def _units(spark, sf_dir):
    e = _ev(spark, sf_dir)
    ua = F.lit(None).cast("string")
    ub = F.lit(None).cast("string")
    for k, (a, b) in _UNIT_OF.items():
        ua = F.when(F.col("event_type") == k, F.lit(a)).otherwise(ua)
        ub = F.when(F.col("event_type") == k, F.lit(b)).otherwise(ub)
    line = F.concat(F.lit("GPU link 0: Tx: "), F.format_string("%.2f", "value"), F.lit(" "), ua,
                    F.lit("   Rx: "), F.col("user_id").cast("string"), F.lit(" "), ub)
    tx, rx = TL.extract_unit_values(line)
    return e.select("event_id", F.round(tx, 2).alias("tx"), F.round(rx, 2).alias("rx"))


@register("rebuild_timestamp", """
WITH s AS (SELECT event_type, min(ts) AS t0 FROM events GROUP BY 1)
SELECT event_id, strftime(t0 + to_seconds(CAST(event_id % 3600 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS ts
FROM events JOIN s USING (event_type)""")
def _rebuild(spark, sf_dir):
    e = _ev(spark, sf_dir)
    s = e.groupBy("event_type").agg(F.min("ts").alias("t0"))
    x = e.join(s, "event_type")
    t = F.timestamp_add("SECOND", F.pmod("event_id", F.lit(3600)), F.col("t0"))
    return x.select("event_id", F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("ts"))


# ---------------------------------------------------------- service logs
_LEVEL_OF = {"view": "DEBUG", "click": "INFO", "purchase": "INFO", "signup": "WARNING", "error": "ERROR"}


def _level_col():
    c = F.lit("INFO")
    for k, v in _LEVEL_OF.items():
        c = F.when(F.col("event_type") == k, F.lit(v)).otherwise(c)
    return c


_LEVEL_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _LEVEL_OF.items()) + " ELSE 'INFO' END"


def _log_lines(e):
    ts = F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(8), F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))
    fields = {"job_id": F.col("user_id").cast("string"), "attempt": F.pmod("event_id", F.lit(3)).cast("string"),
              "latency_ms": F.format_string("%.2f", "value"),
              "msg": F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit(""))}
    extras = [("k", F.get_json_object("props", "$.k"))]
    return e.select("event_id", TL.render_log_line(ts, F.concat(F.lit("worker.py:"), F.col("user_id").cast("string")),
                                                   _level_col(), F.col("event_type"), fields, extras).alias("line"))


_LOG_SQL = f"""(SELECT event_id, concat_ws('|', strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00',
  'worker.py:' || CAST(user_id AS VARCHAR), {_LEVEL_SQL}, 'event=' || event_type, 'job_id=' || CAST(user_id AS VARCHAR),
  'attempt=' || CAST(event_id % 3 AS VARCHAR), 'latency_ms=' || printf('%.2f', value),
  CASE WHEN event_type = 'error' THEN 'msg=failed' END, 'k=' || json_extract_string(props, '$.k')) AS line FROM events)"""


@register("render_log_line", f"SELECT event_id, line FROM {_LOG_SQL} l")
def _render(spark, sf_dir):
    return _log_lines(_ev(spark, sf_dir))


@register("parse_log_line", f"""
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS ts, 'worker.py:' || CAST(user_id AS VARCHAR) AS file,
       {_LEVEL_SQL} AS level, event_type AS event, CAST(user_id AS VARCHAR) AS job_id, printf('%.2f', value) AS latency_ms,
       CASE WHEN event_type = 'error' THEN 'failed' END AS msg, json_extract_string(props, '$.k') AS k FROM events""")
def _parse_log(spark, sf_dir):
    p = _log_lines(_ev(spark, sf_dir)).select("event_id", TL.parse_log_line(F.col("line")).alias("r"))
    kv = F.col("r.kv")
    return p.select("event_id", F.col("r.ts").alias("ts"), F.col("r.file").alias("file"), F.col("r.level").alias("level"),
                    kv["event"].alias("event"), kv["job_id"].alias("job_id"), kv["latency_ms"].alias("latency_ms"),
                    F.try_element_at(kv, F.lit("msg")).alias("msg"), kv["k"].alias("k"))


_REDACT_KEYS = ["user", "api_key", "Password", "session_token", "monkey", "public_key", "k"]


@register("redact_keys", """
SELECT event_id, key, CASE WHEN key <> 'public_key' AND regexp_matches(lower(key), 'password|secret|token|key|credential|pwd')
  THEN '***' ELSE value END AS value FROM (
  SELECT event_id, unnest(['user', 'api_key', 'Password', 'session_token', 'monkey', 'public_key', 'k']) AS key,
         unnest([CAST(user_id AS VARCHAR), 'ak' || CAST(event_id AS VARCHAR), 'pw', 'tok', 'banana', 'pk',
                 json_extract_string(props, '$.k')]) AS value FROM events) t""")
def _redact(spark, sf_dir):
    e = _ev(spark, sf_dir)
    vals = [F.col("user_id").cast("string"), F.concat(F.lit("ak"), F.col("event_id").cast("string")), F.lit("pw"),
            F.lit("tok"), F.lit("banana"), F.lit("pk"), F.get_json_object("props", "$.k")]
    m = F.map_from_arrays(F.array(*[F.lit(k) for k in _REDACT_KEYS]), F.array(*vals))
    r = e.select("event_id", TL.redact(m, allow=("public_key",)).alias("m"))
    return r.select("event_id", F.explode("m").alias("key", "value"))


_CUT = "CASE WHEN length({0}) > 16384 THEN {0}[1:16384] || '...<truncated ' || CAST(length({0}) - 16384 AS VARCHAR) || ' chars>' ELSE {0} END"
_LIST = "CASE WHEN len({0}) > 16 THEN json_object('_type', 'list', 'size', len({0}), 'sample', {0}[1:5]) ELSE to_json({0}) END"


@register("summarise_values", f"""
WITH d AS (SELECT doc_id, text, lang, source, list_transform(string_split(text, ' '), lambda w: {_CUT.format('w')}) AS words,
                  list_sort(list_distinct(string_split(text, ' '))) AS tags FROM documents),
n AS (SELECT *, list_transform(range(0, 3), lambda k: words[k * 20 + 1 : k * 20 + 20]) AS rows FROM d)
SELECT doc_id, CAST(json_object(
  'text', {_CUT.format('text')},
  'words', {_LIST.format('words')},
  'rows', list_transform(rows, lambda r: {_LIST.format('r')}),
  'meta', json_object('lang', lang, 'source', source, 'none', NULL),
  'wide', json_object('_type', 'dict', 'size', 20, 'keys', ['k0', 'k1', 'k2', 'k3', 'k4', 'k5', 'k6', 'k7']),
  'tags', json_object('_type', 'set', 'size', len(tags), 'values', list_transform(tags[1:8], lambda w: {_CUT.format('w')})),
  'raw', json_object('_type', 'bytes', 'size', octet_length(encode(text)), 'head', lower(left(hex(encode(text)), 64))),
  'n', length(text)) AS VARCHAR) AS summary FROM n""")
def _summarise(spark, sf_dir):
    """Nested values of every kind, as a log line would hold them."""
    words = F.split("text", " ")
    value = F.struct(
        F.col("text"), words.alias("words"), F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.slice(words, k * 20 + 1, 20)).alias("rows"),
        F.create_map(F.lit("lang"), "lang", F.lit("source"), "source", F.lit("none"), F.lit(None).cast("string")).alias("meta"),
        F.map_from_arrays(F.array(*[F.lit(f"k{i}") for i in range(20)]), F.sequence(F.lit(0), F.lit(19))).alias("wide"),
        words.alias("tags"), F.col("text").cast("binary").alias("raw"), F.length("text").alias("n"))
    d = table(spark, sf_dir, "documents").select("doc_id", value.alias("v"))
    return d.select("doc_id", TL.summarise(F.col("v"), d.schema["v"].dataType, sets=("tags",)).alias("summary"))


@register("level_filter", f"""
SELECT event_id, {_LEVEL_SQL} AS level FROM events WHERE event_type IN ('signup', 'error')""")
def _level_filter(spark, sf_dir):
    e = _ev(spark, sf_dir).select("event_id", _level_col().alias("level"))
    return TL.level_filter(e, "level", "WARNING")


_RULES = [("ERROR", None, 1.0), (None, "click", 0.25), ("INFO", None, 0.5)]


@register("sample_by_rule", f"""
SELECT event_id, event_type FROM events WHERE {u_sql('sample', 'event_id')} <
  CASE WHEN {_LEVEL_SQL} = 'ERROR' THEN 1.0 WHEN event_type = 'click' THEN 0.25 WHEN {_LEVEL_SQL} = 'INFO' THEN 0.5 ELSE 0.1 END""")
def _sample_rule(spark, sf_dir):
    e = _ev(spark, sf_dir)
    rate = TL.rule_rate(_level_col(), F.col("event_type"), _RULES, 0.1)
    return e.where(uniform("sample", "event_id") < rate).select("event_id", "event_type")
