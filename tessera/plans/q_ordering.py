"""Queries for sampling, splits, ranks and ordered-window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ordering as O
from tessera.plans.common import li_key, lineitem, r6
from tessera.plans.registry import register
from tessera.plans.sqlbits import LI_KEY_SQL, digest_sql, u_sql
from tessera.session import table

_EPOCH_US = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


@register("sample_exact_k", f"""
SELECT row_id, l_quantity FROM (SELECT {digest_sql(*LI_KEY_SQL)} AS row_id, l_quantity, {u_sql(7, *LI_KEY_SQL)} AS u,
  {', '.join(f'{e} AS k{i}' for i, e in enumerate(LI_KEY_SQL))} FROM lineitem) t
ORDER BY u, k0, k1, k2, k3, k4, k5 LIMIT 100""")
def _sample_k(spark, sf_dir):
    li = lineitem(spark, sf_dir).select("row_id", "l_quantity", *[c.alias(f"k{i}") for i, c in enumerate(li_key())])
    keys = [f"k{i}" for i in range(6)]
    return O.sample_k(li, 100, 7, keys).select("row_id", "l_quantity")


@register("support_sample", f"""
SELECT o_orderkey FROM orders ORDER BY {u_sql(42, 'o_orderkey')}, o_orderkey LIMIT 4000""")
def _support(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return O.select_support(o, 4000, ["o_orderkey"], True, 42).select("o_orderkey")


@register("stratified_kfold", f"""
SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {u_sql('kf', 'o_orderkey')}, o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM orders""")
def _kfold(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return O.stratified_kfold(o, "o_orderstatus", 5, "kf", ["o_orderkey"]).select("o_orderkey", "fold")


@register("stratified_split", f"""
SELECT o_orderkey, r <= round(n * 0.2) AS is_test FROM (
  SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {u_sql('ss', 'o_orderkey')}, o_orderkey) AS r,
         count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) t""")
def _strat_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return O.stratified_split(o, "o_orderpriority", 0.2, "ss", ["o_orderkey"]).select("o_orderkey", "is_test")


@register("ratio_split", f"""
SELECT c_custkey, r <= round(n * 0.8) AS is_train FROM (
  SELECT c_custkey, row_number() OVER (ORDER BY {u_sql('rs', 'c_custkey')}, c_custkey) AS r, count(*) OVER () AS n
  FROM customer) t""")
def _ratio(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return O.ratio_split(c, 0.8, "rs", ["c_custkey"]).select("c_custkey", "is_train")


@register("position_split", """
SELECT conv_id, turn, CAST(floor(n * 0.5) AS INTEGER) AS train_size, turn < floor(n * 0.5) AS is_train
FROM (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) t""")
def _position(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    n = c.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    x = c.join(n, "conv_id").select("conv_id", "turn", "n")
    O.validate_train_size_range(0.1, 0.9)
    return O.position_split(x, "turn", "n", 0.5).select("conv_id", "turn", "train_size", "is_train")


_VALID_SQL = """
SELECT l_orderkey, count(*) AS n, CAST(sum(CASE WHEN tr THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
  (sum(CASE WHEN tr THEN 1 ELSE 0 END) > 0 AND sum(CASE WHEN tr THEN 1 ELSE 0 END) < count(*)
   AND coalesce(list_sort(list_distinct(list(l_returnflag) FILTER (WHERE tr))), []) =
       coalesce(list_sort(list_distinct(list(l_returnflag) FILTER (WHERE NOT tr))), [])
   AND len(coalesce(list_distinct(list(l_returnflag) FILTER (WHERE tr)), [])) >= 2) AS valid
FROM (SELECT l_orderkey, l_returnflag, l_linenumber - 1 < 2 AS tr FROM lineitem) t GROUP BY l_orderkey"""


@register("split_validity", _VALID_SQL)
def _validity(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("tr", F.col("l_linenumber") - 1 < 2)
    return O.split_validity(li, ["l_orderkey"], "l_returnflag", "tr", 2)


_REPAIR_KEY = ["l_linenumber", "l_partkey", "l_suppkey", "CAST(round(l_extendedprice * 100) AS BIGINT)"]


REPAIR_SQL = f"""
WITH a AS (
  SELECT l_orderkey, l_returnflag, 0 AS attempt, l_linenumber - 1 AS p FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_returnflag, attempt,
         row_number() OVER (PARTITION BY l_orderkey, attempt ORDER BY u, {', '.join(f'k{i}' for i in range(4))}) - 1 AS p
  FROM (SELECT l_orderkey, l_returnflag, attempt, {u_sql(0, 'attempt', *_REPAIR_KEY)} AS u,
               {', '.join(f'{e} AS k{i}' for i, e in enumerate(_REPAIR_KEY))}
        FROM lineitem, range(1, 11) r(attempt)) s),
v AS (SELECT l_orderkey, attempt,
   (sum(CASE WHEN p < 2 THEN 1 ELSE 0 END) > 0 AND sum(CASE WHEN p < 2 THEN 1 ELSE 0 END) < count(*)
    AND coalesce(list_sort(list_distinct(list(l_returnflag) FILTER (WHERE p < 2))), []) =
        coalesce(list_sort(list_distinct(list(l_returnflag) FILTER (WHERE p >= 2))), [])
    AND len(coalesce(list_distinct(list(l_returnflag) FILTER (WHERE p < 2)), [])) >= 2) AS valid
   FROM a GROUP BY 1, 2),
best AS (SELECT l_orderkey, CAST(min(attempt) AS INTEGER) AS attempt FROM v WHERE valid GROUP BY 1)
SELECT d.l_orderkey, coalesce(best.attempt, -1) AS attempt, best.attempt IS NOT NULL AS accepted
FROM (SELECT DISTINCT l_orderkey FROM lineitem) d LEFT JOIN best USING (l_orderkey)"""


def repaired_orders(spark, sf_dir):
    """Orders as datasets: the first split of two training lines that is valid."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", (F.col("l_linenumber") - 1).alias("pos"),
        F.col("l_linenumber").alias("k0"), F.col("l_partkey").alias("k1"), F.col("l_suppkey").alias("k2"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("k3"))
    return O.split_repair(li, ["l_orderkey"], "l_returnflag", "pos", 2, ["k0", "k1", "k2", "k3"], 10, 0)


@register("split_repair", REPAIR_SQL)
def _repair(spark, sf_dir):
    r = repaired_orders(spark, sf_dir)
    return r.select("l_orderkey", F.coalesce(F.col("attempt").cast("int"), F.lit(-1)).alias("attempt"), "accepted")


def _ev_chunk():
    return F.floor(F.col("event_id") / (1 << 20))


@register("tick_counter", """
WITH e AS (SELECT event_id, event_type, user_id % 4 AS gpu FROM events),
f AS (SELECT event_type, arg_min(gpu, event_id) AS first_gpu FROM e GROUP BY 1)
SELECT event_id, event_type, CAST(sum(CASE WHEN gpu = first_gpu THEN 1 ELSE 0 END)
       OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS tick
FROM e JOIN f USING (event_type)""")
def _tick_counter(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.pmod("user_id", F.lit(4)).alias("gpu"))
    first = e.groupBy("event_type").agg(F.min_by("gpu", "event_id").alias("first_gpu"))
    x = e.join(first, "event_type")
    x = O.running_sum(x, ["event_type"], ["event_id"], (F.col("gpu") == F.col("first_gpu")).cast("bigint"),
                      _ev_chunk(), "seen")
    return x.select("event_id", "event_type", (F.col("seen") - 1).cast("bigint").alias("tick"))


@register("counter_rate", """
WITH e AS (SELECT event_id, user_id % 4 AS gpu, CASE WHEN event_type IN ('click', 'view') THEN 'rx' ELSE 'tx' END AS dir,
                  epoch_us(ts) / 1e6 AS t, value FROM events),
l AS (SELECT *, lag(value) OVER w AS pv, lag(t) OVER w AS pt FROM e WINDOW w AS (PARTITION BY gpu, dir ORDER BY event_id))
SELECT event_id, round(CASE WHEN pv IS NULL THEN NULL ELSE greatest(value - pv, 0) / greatest(t - pt, 1e-6) / 1024 END, 6) AS rate
FROM l""")
def _counter_rate(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.pmod("user_id", F.lit(4)).alias("gpu"),
        F.when(F.col("event_type").isin("click", "view"), "rx").otherwise("tx").alias("dir"),
        (F.expr(_EPOCH_US) / 1e6).alias("t"), "value")
    e = e.withColumn("sample", F.struct("t", "value"))
    x = O.chunked_lag(e, ["gpu", "dir"], "event_id", "sample", _ev_chunk(), "prev")
    rate = F.when(F.col("prev").isNull(), None).otherwise(
        F.greatest(F.col("value") - F.col("prev.value"), F.lit(0.0))
        / F.greatest(F.col("t") - F.col("prev.t"), F.lit(1e-6)) / 1024)
    return x.select("event_id", r6(rate).alias("rate"))


@register("progress_eta", """
WITH e AS (SELECT event_id, epoch_us(ts) / 1e6 AS t FROM events),
r AS (SELECT event_id, count(*) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS done_total,
             t - min(t) OVER () + 1.0 AS elapsed, count(*) OVER () AS total FROM e)
SELECT event_id, CAST(done_total AS BIGINT) AS done_total, round(done_total / greatest(elapsed, 1e-9), 6) AS rows_per_sec,
       round((total - done_total) / greatest(done_total / greatest(elapsed, 1e-9), 1e-9), 6) AS eta_sec FROM r""")
def _progress(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    total = e.count()
    t = F.expr(_EPOCH_US) / 1e6
    start = e.agg(F.min(t)).scalar()
    x = e.select("event_id", (t - start + 1.0).alias("elapsed"), F.lit(1).cast("bigint").alias("one"))
    from tessera.operators.metrics import progress
    p = progress(x, "event_id", "one", "elapsed", total, _ev_chunk())
    return p.select("event_id", F.col("done_total").cast("bigint").alias("done_total"),
                    r6("rows_per_sec").alias("rows_per_sec"), r6("eta_sec").alias("eta_sec"))


@register("relative_time", """
SELECT event_id, round((epoch_us(ts) - min(epoch_us(ts)) OVER ()) / 1e6, 6) AS time_s FROM events""")
def _relative(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    us = F.expr(_EPOCH_US)
    start = e.agg(F.min(us)).scalar()           # scalar subquery: one value, no join
    return e.select("event_id", r6((us - start) / 1e6).alias("time_s"))


@register("unique_names", """
SELECT doc_id, CASE WHEN r = 1 THEN source || '.csv' ELSE source || '.' || CAST(r - 1 AS VARCHAR) || '.csv' END AS name
FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) t""")
def _unique_names(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.concat("source", F.lit(".csv")).alias("base"))
    x = O.exact_rank(d, ["base"], "doc_id", [], out="r", bucket=F.floor(F.col("doc_id") / 4096))
    stem = F.regexp_replace("base", r"\.[^.]*$", "")
    ext = F.regexp_extract("base", r"(\.[^.]*)$", 1)
    name = F.when(F.col("r") == 1, F.col("base")).otherwise(F.concat(stem, F.lit("."), (F.col("r") - 1).cast("string"), ext))
    return x.select("doc_id", name.alias("name"))


@register("order_restore", f"""
SELECT {digest_sql(*LI_KEY_SQL)} AS row_id, l_quantity FROM lineitem""")
def _order_restore(spark, sf_dir):
    return lineitem(spark, sf_dir).select("row_id", "l_quantity").orderBy("row_id")

