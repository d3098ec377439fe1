"""Queries for projection, column contracts and row cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import columns as C
from tessera.operators import metrics as M
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.session import table


def _positional(spark, sf_dir, name):
    df = table(spark, sf_dir, name)
    return df.toDF(*C.positional_names(len(df.columns)))


@register("select_features_include",
          "SELECT l_extendedprice AS col_5, l_quantity AS col_4, l_tax AS col_7 FROM lineitem")
def _include(spark, sf_dir):
    df = _positional(spark, sf_dir, "lineitem")
    return df.select(*C.select_features(df, label=8, include=[5, 4, 7]))


@register("select_features_exclude",
          "SELECT l_quantity AS col_4, l_extendedprice AS col_5, l_discount AS col_6, l_tax AS col_7, "
          "l_linestatus AS col_9 FROM lineitem")
def _exclude(spark, sf_dir):
    df = _positional(spark, sf_dir, "lineitem")
    return df.select(*C.select_features(df, label=8, exclude=[0, 1, 2, 3, 10]))


@register("passthrough_columns",
          "SELECT l_orderkey AS col_0, l_returnflag AS col_8, l_linenumber AS col_3 FROM lineitem")
def _passthrough(spark, sf_dir):
    df = _positional(spark, sf_dir, "lineitem")
    return df.select(*C.passthrough(df, [0, 8, 0, 99, 3]))


@register("drop_target_and_ids", """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS id, o_orderkey, o_custkey, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def _drop_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date").cast("string"))
    out, _ = C.drop_target_and_ids(o, "o_orderstatus", ["o_orderkey"])
    return out


_CF_COLS = ["p_brand", "p_type", "p_size", "p_retailprice", "p_one"]


@register("constant_feature_filter", """
WITH ctx AS (SELECT *, 1 AS p_one FROM part),
d AS (
  SELECT 'p_brand' AS feature, count(DISTINCT p_brand) + max(CASE WHEN p_brand IS NULL THEN 1 ELSE 0 END) AS n FROM ctx
  UNION ALL SELECT 'p_type', count(DISTINCT p_type) + max(CASE WHEN p_type IS NULL THEN 1 ELSE 0 END) FROM ctx
  UNION ALL SELECT 'p_size', count(DISTINCT p_size) + max(CASE WHEN p_size IS NULL THEN 1 ELSE 0 END) FROM ctx
  UNION ALL SELECT 'p_one', count(DISTINCT p_one) FROM ctx
  UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice) + max(CASE WHEN p_retailprice IS NULL THEN 1 ELSE 0 END) FROM ctx)
SELECT feature, CAST(n AS BIGINT) AS n_distinct, (n > 1 OR (SELECT count(*) FROM ctx) <= 1) AS keep FROM d""")
def _constant_filter(spark, sf_dir):
    ctx = table(spark, sf_dir, "part").withColumn("p_one", F.lit(1))
    return C.constant_filter_report(ctx, _CF_COLS)


@register("dataset_constant_filter", """
WITH li AS (SELECT l_orderkey, l_linenumber,
                   [l_quantity, l_discount, l_tax, CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END] AS x FROM lineitem),
lng AS (SELECT l_orderkey, f, x[f + 1] AS v FROM li, range(4) r(f)),
keep AS (SELECT l_orderkey, f FROM lng GROUP BY l_orderkey, f HAVING min(v) < max(v)),
kept AS (SELECT l_orderkey, list(f ORDER BY f) AS k FROM keep GROUP BY l_orderkey)
SELECT li.l_orderkey, li.l_linenumber, CAST(j AS INTEGER) AS f,
       round(CASE WHEN j < coalesce(len(k), 0) THEN li.x[k[j + 1] + 1] ELSE 0.0 END, 6) AS v,
       CAST(coalesce(len(k), 0) AS BIGINT) AS d
FROM li LEFT JOIN kept USING (l_orderkey), range(4) r(j)""")
def _dataset_constant(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    x = li.select("l_orderkey", "l_linenumber",
                  F.array("l_quantity", "l_discount", "l_tax",
                          F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0)).alias("x"),
                  F.lit(4).alias("d"))
    out = C.dataset_constant_filter(x, ["l_orderkey"], "x", "d")
    return out.select("l_orderkey", "l_linenumber", F.posexplode_outer("x").alias("f", "v"), "d") \
        .select("l_orderkey", "l_linenumber", F.col("f").cast("int").alias("f"), r6("v").alias("v"),
                F.col("d").cast("bigint").alias("d"))


@register("feature_cap_by_rows", """
SELECT l_suppkey, n_rows, CASE WHEN n_rows <= 10240 THEN 100 WHEN n_rows <= 20000 THEN 80
  WHEN n_rows <= 30000 THEN 60 WHEN n_rows <= 40000 THEN 40 WHEN n_rows <= 50000 THEN 30
  WHEN n_rows <= 60000 THEN 20 WHEN n_rows <= 65000 THEN 15 ELSE 10 END AS cap
FROM (SELECT l_suppkey, CAST(count(*) * 100 AS BIGINT) AS n_rows FROM lineitem GROUP BY l_suppkey) t""")
def _feature_cap(spark, sf_dir):
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg((F.count(F.lit(1)) * 100).alias("n_rows"))
    return g.withColumn("cap", C.feature_cap(F.col("n_rows"), 100))


_PRED_Q = "CASE WHEN n_chars >= 1000 THEN 1 WHEN n_chars >= 100 THEN 0 END"


@register("drop_missing_pairs", f"""
SELECT d.doc_id, {_PRED_Q} AS pred, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE {_PRED_Q} IS NOT NULL AND l.quality IS NOT NULL""")
def _drop_missing(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    pred = F.when(F.col("n_chars") >= 1000, 1).when(F.col("n_chars") >= 100, 0)
    return d.select("doc_id", pred.alias("pred"), "quality").na.drop(subset=["pred", "quality"])


@register("coerce_numeric_or_null", """
SELECT event_id, k FROM (
  SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'x' || json_extract_string(props, '$.k')
                                 ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS k FROM events) t
WHERE k IS NOT NULL""")
def _coerce(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.get_json_object("props", "$.k")
    txt = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), raw)).otherwise(raw)
    return C.to_numeric(e.select("event_id", txt.alias("k")), ["k"])


@register("hint_fallback", """
SELECT event_id, CAST(CASE WHEN v IS NULL THEN 1 ELSE greatest(floor(v), 0) END AS BIGINT) AS row_hint FROM (
  SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_type = 'click' THEN 'bad' END AS DOUBLE),
                            TRY_CAST(CASE WHEN event_type IN ('view', 'click') THEN CAST(user_id - 75 AS VARCHAR) END AS DOUBLE),
                            TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS v FROM events) t""")
def _hint(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = F.create_map(
        F.lit("row_hint"), F.when(F.col("event_type") == "click", F.lit("bad")),
        F.lit("rows"), F.when(F.col("event_type").isin("view", "click"), (F.col("user_id") - 75).cast("string")),
        F.lit("k"), F.get_json_object("props", "$.k"))
    return e.select("event_id", C.row_hint(m, ["row_hint", "rows", "k"]).alias("row_hint"))


_VARIANT = ("CASE WHEN doc_id % 3 = 0 THEN concat(' ', upper(lang)) WHEN doc_id % 3 = 1 THEN upper(lang) "
            "ELSE concat(lang, ' ') END")


@register("label_text_normalise", " UNION ALL ".join(
    f"SELECT '{mode}' AS mode, count(*) AS n, CAST(sum(CASE WHEN {p} = {t} THEN 1 ELSE 0 END) AS BIGINT) AS correct "
    f"FROM documents" for mode, p, t in [
        ("none", _VARIANT, "lang"),
        ("strip", f"trim({_VARIANT})", "trim(lang)"),
        ("lower", f"lower({_VARIANT})", "lower(lang)"),
        ("lower_strip", f"lower(trim({_VARIANT}))", "lower(trim(lang))")]))
def _label_norm(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.pmod(F.col("doc_id"), F.lit(3))
    variant = F.when(k == 0, F.concat(F.lit(" "), F.upper("lang"))).when(k == 1, F.upper("lang")) \
        .otherwise(F.concat("lang", F.lit(" ")))
    d = d.withColumn("pred", variant)
    outs = []
    for mode in M.LABEL_MODES:
        a = M.accuracy(d, "pred", "lang", mode=mode)
        outs.append(a.select(F.lit(mode).alias("mode"), "n", "correct"))
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res

