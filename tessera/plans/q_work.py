"""Queries for work partitioning and the task ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import work as WK
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.plans.sqlbits import u_sql
from tessera.session import table

_ITEMS_SQL = """(SELECT CAST(p_partkey AS VARCHAR) AS part_id, p_partkey, p_brand, p_type, CAST(p_size AS DOUBLE) AS weight FROM part)"""


def _items(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("part_id"), "p_partkey", "p_brand", "p_type",
                    F.col("p_size").cast("double").alias("weight"))


@register("items_normalise", f"""
SELECT part_id AS ref, weight, sha256(concat_ws('|', part_id, CAST(weight AS VARCHAR))) AS checksum,
       p_brand AS brand, p_type AS type FROM {_ITEMS_SQL} i""")
def _normalise(spark, sf_dir):
    i = _items(spark, sf_dir)
    meta = [F.create_map(F.lit("brand"), F.col("p_brand")), F.create_map(F.lit("type"), F.col("p_type"))]
    n = WK.items_normalise(i, ["payload_ref", "ref", "part_id"], "weight", meta)
    return n.select("ref", "weight", "checksum", F.col("metadata")["brand"].alias("brand"),
                    F.col("metadata")["type"].alias("type"))


_TARGET = 5000


@register("items_replicate", f"""
WITH i AS (SELECT part_id, row_number() OVER (ORDER BY p_partkey) AS ord, count(*) OVER () AS n FROM {_ITEMS_SQL} x),
c AS (SELECT part_id, ord, n, copy FROM i, range(0, 100) r(copy) WHERE copy * n + ord - 1 < {_TARGET})
SELECT CASE WHEN copy > 0 THEN part_id || '_dup' || CAST(copy AS VARCHAR) ELSE part_id END AS part_id,
       CASE WHEN copy > 0 THEN part_id END AS duplicate_of FROM c""")
def _replicate(spark, sf_dir):
    i = _items(spark, sf_dir).select("part_id", "p_partkey")
    return WK.items_replicate(i, "part_id", ["p_partkey"], _TARGET, F.floor(F.col("p_partkey") / 1024)).select(
        "part_id", "duplicate_of")


@register("chunk_fixed", """
SELECT p_partkey, p_brand || '#' || CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 AS VARCHAR) AS task_id
FROM part""")
def _chunk_fixed(spark, sf_dir):
    c = WK.chunk_fixed(_items(spark, sf_dir), ["p_brand"], ["p_partkey"], 10, F.floor(F.col("p_partkey") / 1024))
    return c.select("p_partkey", "task_id")


@register("chunk_by_weight", """
WITH RECURSIVE x AS (SELECT p_partkey, p_brand, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part),
w AS (SELECT p_partkey, p_brand, r, p_size AS held, 0 AS chunk FROM x WHERE r = 1
      UNION ALL
      SELECT x.p_partkey, x.p_brand, x.r, CASE WHEN w.held >= 100 THEN x.p_size ELSE w.held + x.p_size END,
             w.chunk + CASE WHEN w.held >= 100 THEN 1 ELSE 0 END
      FROM w JOIN x ON x.p_brand = w.p_brand AND x.r = w.r + 1)
SELECT p_partkey, CAST(chunk AS BIGINT) AS chunk FROM w""")
def _chunk_weight(spark, sf_dir):
    c = WK.chunk_by_weight(_items(spark, sf_dir), ["p_brand"], ["p_partkey"], "weight", 100.0, F.floor(F.col("p_partkey") / 1024))
    return c.select("p_partkey", "chunk")


@register("chunk_hash", """
SELECT p_partkey, ('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 15))::BIGINT % 8 AS chunk FROM part""")
def _chunk_hash(spark, sf_dir):
    i = _items(spark, sf_dir)
    return i.select("p_partkey", WK.chunk_hash(F.col("p_partkey"), 8).alias("chunk"))


@register("chunk_balanced", f"""
WITH r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_size DESC, {u_sql(0, 'p_partkey')}, p_partkey) - 1 AS r FROM part)
SELECT p_partkey, CAST(CASE WHEN (r // 8) % 2 = 0 THEN r % 8 ELSE 7 - r % 8 END AS BIGINT) AS chunk FROM r""")
def _chunk_balanced(spark, sf_dir):
    c = WK.chunk_balanced(_items(spark, sf_dir), "weight", "part_id", 8)
    return c.select("p_partkey", "chunk")


@register("chunk_shuffle", """
SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY
  ('0x' || substr(md5(concat_ws('|', '3', CAST(p_partkey AS VARCHAR))), 1, 13))::BIGINT / 4503599627370496.0, p_partkey) - 1 AS INTEGER) AS position
FROM part""")
def _chunk_shuffle(spark, sf_dir):
    return WK.chunk_shuffle(_items(spark, sf_dir), ["p_brand"], "p_partkey", 3).select("p_partkey", "position")


@register("task_build", """
WITH t AS (SELECT *, p_brand || '#' || CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 AS VARCHAR) AS task_id
           FROM part)
SELECT task_id, CAST(count(*) AS INTEGER) AS n_items, round(sum(CAST(p_size AS DOUBLE)), 6) AS weight,
       sha256(string_agg(CAST(p_partkey AS VARCHAR), '|' ORDER BY p_partkey)) AS checksum FROM t GROUP BY task_id""")
def _task_build(spark, sf_dir):
    c = WK.chunk_fixed(_items(spark, sf_dir), ["p_brand"], ["p_partkey"], 10)
    t = WK.task_build(c, "task_id", "p_partkey", "part_id", "weight")
    return t.select("task_id", "n_items", r6("weight").alias("weight"), "checksum")


_OP_SQL = ("CASE event_type WHEN 'view' THEN 'put' WHEN 'click' THEN 'lease' WHEN 'purchase' THEN 'ack' "
           "WHEN 'error' THEN 'nack' ELSE 'extend' END")
_LEDGER_SQL = f"""
WITH e AS (SELECT 't' || CAST(user_id % 50 AS VARCHAR) AS task_id, {_OP_SQL} AS op, epoch_us(ts) / 1e6 AS t FROM events),
p AS (SELECT DISTINCT task_id FROM e WHERE op = 'put'),
g AS (SELECT task_id, list(struct_pack(t := t, op := op, due := NULL::DOUBLE, again := NULL::DOUBLE) ORDER BY t, op) FILTER (op IN ('lease', 'nack', 'extend')) AS log,
             count(*) FILTER (WHERE op = 'lease') AS attempts, bool_or(op = 'ack') AS acked FROM e WHERE task_id IN (SELECT task_id FROM p) GROUP BY 1),
now AS (SELECT max(t) + 1800 AS now FROM e),
f AS (SELECT *, list_reduce(list_prepend(struct_pack(t := NULL::DOUBLE, op := '', due := NULL::DOUBLE, again := NULL::DOUBLE), coalesce(log, [])),
  lambda s, e: struct_pack(t := e.t, op := e.op,
    due := CASE WHEN e.op = 'lease' OR (e.op = 'extend' AND e.t < s.due) THEN e.t + 3600 WHEN e.op = 'nack' THEN NULL ELSE s.due END,
    again := CASE WHEN e.op = 'lease' OR (e.op = 'extend' AND e.t < s.due) THEN NULL WHEN e.op = 'nack' THEN e.t + 600 ELSE s.again END)) AS r FROM g),
s AS (SELECT task_id, CAST(attempts AS BIGINT) AS attempts, CASE WHEN acked THEN 'acked' WHEN now < r.due THEN 'leased'
  WHEN attempts >= 400 THEN 'acked' WHEN now < coalesce(r.due + 600, r.again) THEN 'delayed' ELSE 'visible' END AS state FROM f, now)"""


def _ledger(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    op = (F.when(F.col("event_type") == "view", "put").when(F.col("event_type") == "click", "lease")
          .when(F.col("event_type") == "purchase", "ack").when(F.col("event_type") == "error", "nack")
          .otherwise("extend"))
    t = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)") / 1e6
    ev = e.select(F.concat(F.lit("t"), F.pmod("user_id", F.lit(50)).cast("string")).alias("task_id"),
                  op.alias("op"), t.alias("t"))
    now = ev.agg(F.max("t") + 1800).scalar()
    return WK.ledger_state(ev, now, 3600.0, 600.0, 400)


@register("ledger_state", _LEDGER_SQL + " SELECT task_id, state, attempts FROM s")
def _ledger_state(spark, sf_dir):
    return _ledger(spark, sf_dir)


@register("ledger_stats", _LEDGER_SQL + """
SELECT count(*) FILTER (WHERE state = 'visible') AS visible, count(*) FILTER (WHERE state = 'leased') AS leased,
       count(*) FILTER (WHERE state = 'delayed') AS delayed, count(*) FILTER (WHERE state = 'acked') AS acked,
       count(*) AS total, count(*) FILTER (WHERE state = 'acked') = count(*) AS drained FROM s""")
def _ledger_stats(spark, sf_dir):
    return WK.ledger_stats(_ledger(spark, sf_dir))
