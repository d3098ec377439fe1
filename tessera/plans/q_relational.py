"""Queries for joins and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.operators import ordering as O
from tessera.operators import targets as TG
from tessera.operators import work as WK
from tessera.operators.transforms import OrdinalEncode
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.plans.sqlbits import u_sql
from tessera.session import table


def _items(spark, sf_dir):
    """part rows as work items: id, group, weight."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("string").alias("part_id"), F.col("p_brand").alias("group"),
                    F.col("p_size").cast("double").alias("weight"), F.col("p_type").alias("category"),
                    F.col("p_partkey"))


_CHUNK_SQL = """(SELECT CAST(p_partkey AS VARCHAR) AS part_id, p_brand AS grp, CAST(p_size AS DOUBLE) AS weight,
  p_brand || '#' || CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 AS VARCHAR) AS task_id
  FROM part)"""


@register("join_item_lookup", f"""
WITH t AS {_CHUNK_SQL}
SELECT t.task_id, p.part_id, p.weight FROM t JOIN (SELECT CAST(p_partkey AS VARCHAR) AS part_id, CAST(p_size AS DOUBLE) AS weight FROM part) p
USING (part_id)""")
def _item_lookup(spark, sf_dir):
    items = _items(spark, sf_dir)
    tasks = WK.chunk_fixed(items, ["group"], ["p_partkey"], 10)
    built = tasks.groupBy("task_id").agg(F.collect_list("part_id").alias("payload_ref"))
    refs = built.select("task_id", F.explode("payload_ref").alias("part_id"))
    return refs.join(items.select("part_id", "weight"), "part_id").select("task_id", "part_id", "weight")


@register("join_category_encode", f"""
WITH p AS (SELECT *, p_size <= 25 AS is_ctx FROM part),
d AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT p_type AS v FROM p WHERE is_ctx AND p_type IS NOT NULL) t),
n AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
      FROM (SELECT DISTINCT p_name AS v FROM p WHERE is_ctx AND p_name IS NOT NULL) t)
SELECT p.p_partkey, coalesce(d.code, -1) AS p_type, coalesce(n.code, -1) AS p_name
FROM p LEFT JOIN d ON p.p_type = d.v LEFT JOIN n ON p.p_name = n.v""")
def _cat_encode(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    enc = OrdinalEncode(["p_type", "p_name"]).fit(p.where(F.col("p_size") <= 25))
    return enc.transform(p).select("p_partkey", "p_type", "p_name")


@register("join_class_group", """
WITH c AS (SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS r, count(*) OVER () AS n
           FROM (SELECT DISTINCT p_brand FROM part) t),
h AS (SELECT *, n // CAST(least(ceil(n / 10.0), 10) AS BIGINT) AS q, n % CAST(least(ceil(n / 10.0), 10) AS BIGINT) AS m FROM c),
g AS (SELECT p_brand, CAST(CASE WHEN n <= 10 THEN 0 WHEN r < m * (q + 1) THEN r // (q + 1) ELSE m + (r - m * (q + 1)) // q END AS INTEGER) AS grp FROM h)
SELECT p_partkey, grp FROM part JOIN g USING (p_brand)""")
def _class_group(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    d = TG.label_dictionary(p, "p_brand")
    root = TG.class_tree(d).where("depth = 0").select("class_idx", F.col("group").cast("int").alias("grp"))
    m = d.join(root, "class_idx").select(F.col("label").alias("p_brand"), "grp")
    return p.join(m, "p_brand").select("p_partkey", "grp")


from tessera.plans.classify import _BASE_SQL as _CLS_SQL  # noqa: E402
from tessera.plans.sqlbits import LI_KEY_SQL, digest_sql  # noqa: E402


@register("join_predictions_to_rows", _CLS_SQL + f"""
SELECT r.row_id, r.l_orderkey, r.l_linenumber, pred.prediction
FROM (SELECT {digest_sql(*LI_KEY_SQL)} AS row_id, l_orderkey, l_linenumber FROM lineitem) r JOIN pred USING (row_id)""")
def _pred_rows(spark, sf_dir):
    from tessera.plans.classify import classify
    from tessera.plans.common import lineitem
    q, _, _ = classify(spark, sf_dir)
    rows = lineitem(spark, sf_dir).select("row_id", "l_orderkey", "l_linenumber")
    return rows.join(q.select("row_id", "prediction"), "row_id", "inner")


@register("join_cv_complement", f"""
SELECT o_orderkey FROM (SELECT o_orderkey,
  (row_number() OVER (PARTITION BY o_orderstatus ORDER BY {u_sql('kf', 'o_orderkey')}, o_orderkey) - 1) % 5 AS fold FROM orders) t
WHERE fold <> 0""")
def _cv_complement(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    f = O.stratified_kfold(o, "o_orderstatus", 5, "kf", ["o_orderkey"])
    fold0 = f.where("fold = 0").select("o_orderkey")
    return f.join(fold0, "o_orderkey", "left_anti").select("o_orderkey")


@register("range_join_bins", """
WITH e AS (SELECT quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(len(list_filter(edges, lambda b: l_extendedprice > b)) AS INTEGER) AS bin FROM lineitem, e""")
def _range_bins(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    from tessera.operators.ordering import exact_quantiles
    edges = exact_quantiles(li, "l_extendedprice", [i / 10 for i in range(1, 10)]).first()["q"]   # 9 numbers
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     TG.count_below(F.col("l_extendedprice"), edges).cast("int").alias("bin"))


@register("union_rows", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, round(c_acctbal, 6) AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6), NULL FROM supplier""")
def _union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        r6("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        r6("s_acctbal").alias("acctbal"))
    return c.unionByName(s, allowMissingColumns=True)


@register("class_set_equal", """
SELECT l_orderkey,
  coalesce(list_sort(list_distinct(list(l_returnflag) FILTER (WHERE l_linenumber <= 2))), []) =
  coalesce(list_sort(list_distinct(list(l_returnflag) FILTER (WHERE l_linenumber > 2))), []) AS equal
FROM lineitem GROUP BY l_orderkey""")
def _class_set_equal(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    tr = F.col("l_linenumber") <= 2
    g = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set(F.when(tr, F.col("l_returnflag")))).alias("a"),
        F.sort_array(F.collect_set(F.when(~tr, F.col("l_returnflag")))).alias("b"))
    return g.select("l_orderkey", (F.col("a") == F.col("b")).alias("equal"))


@register("dedupe_first_seen", """
SELECT l_orderkey, l_linenumber, arg_min(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def _dedupe(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    # partial aggregate keeps a hot key from landing whole in one task
    g = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.struct("l_shipdate", "l_partkey", "l_suppkey")).alias("first"))
    return g.select("l_orderkey", "l_linenumber", F.col("first.l_partkey").alias("l_partkey"))


@register("task_dedupe", f"""
WITH t AS (SELECT DISTINCT task_id FROM {_CHUNK_SQL} c),
existing AS (SELECT task_id FROM t WHERE {u_sql('ledger', 'task_id')} < 0.5)
SELECT task_id FROM t WHERE task_id NOT IN (SELECT task_id FROM existing)""")
def _task_dedupe(spark, sf_dir):
    tasks = WK.chunk_fixed(_items(spark, sf_dir), ["group"], ["p_partkey"], 10).select("task_id").distinct()
    existing = tasks.where(uniform("ledger", "task_id") < 0.5)
    return tasks.join(existing, "task_id", "left_anti")


del Window
