"""Queries for evaluation aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.operators import metrics as M
from tessera.operators.ordering import stratified_kfold
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.plans.sqlbits import u_sql
from tessera.sources.files import list_files
from tessera.session import scratch_path, table

_DOCS_SQL = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
  CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS pred_quality,
  CASE WHEN d.n_chars < 300 THEN 1 ELSE 0 END AS pred_toxic
  FROM documents d JOIN labels l USING (doc_id))"""


def _docs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return d.select("doc_id", "lang", "source", "n_chars", "quality", "toxic",
                    (F.col("n_chars") >= 1000).cast("int").alias("pred_quality"),
                    (F.col("n_chars") < 300).cast("int").alias("pred_toxic"))


def _per_class_sql(pred: str, true: str) -> str:
    return f"""
t AS (SELECT {true} AS label, count(*) AS support, sum(CASE WHEN {pred} = {true} THEN 1 ELSE 0 END) AS tp
      FROM {_DOCS_SQL} x GROUP BY 1),
p AS (SELECT {pred} AS label, count(*) AS n_pred FROM {_DOCS_SQL} x GROUP BY 1),
c AS (SELECT coalesce(t.label, p.label) AS label, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) - coalesce(tp, 0) AS fp,
             coalesce(support, 0) - coalesce(tp, 0) AS fn, coalesce(support, 0) AS support
      FROM t FULL OUTER JOIN p ON t.label = p.label),
prf AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
                  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM c),
prf2 AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
         FROM prf)"""


@register("accuracy_per_file", f"""
WITH f AS (SELECT CASE WHEN lang IS NULL THEN 'none' ELSE lang END || '-' || k AS file, k, lang FROM (SELECT DISTINCT lang FROM {_DOCS_SQL} x), range(4) r(k)),
m AS (SELECT lang || '-' || doc_id % 3 AS file, CASE WHEN CAST(pred_quality AS VARCHAR) = CAST(quality AS VARCHAR) THEN 1 ELSE 0 END AS ok FROM {_DOCS_SQL} x)
SELECT file, count(ok) AS n, CAST(coalesce(sum(ok), 0) AS BIGINT) AS correct, round(sum(ok) / count(ok), 6) AS accuracy
FROM f LEFT JOIN m USING (file) GROUP BY file""")
def _acc_per_file(spark, sf_dir):
    """Four result files a language, the last without rows; they are listed, read and joined."""
    path = scratch_path(spark, "pred-csv")
    d = _docs(spark, sf_dir).select(F.concat_ws("-", "lang", (F.col("doc_id") % 3).cast("string")).alias("name"), "lang", "doc_id", "pred_quality", "quality")
    d.write.partitionBy("name").option("header", True).csv(path)
    for r in d.select("lang").distinct().collect():   # one row a language
        d.where("false").select("doc_id", "pred_quality", "quality").coalesce(1).write.option("header", True).csv(f"{path}/name={r['lang']}-3")
    back = spark.read.schema("lang string, doc_id long, pred_quality string, quality string").option("header", True).csv(path)
    folder = lambda c: F.regexp_extract(c, r"name=([^/]+)/", 1)
    files = list_files(spark, path, "*.csv").select(folder("path").alias("path")).distinct()
    a = M.accuracy_per_file(back.withColumn("file", folder(F.col("_metadata.file_path"))), files, "pred_quality", "quality")
    return a.select("file", "n", "correct", r6("accuracy").alias("accuracy"))


@register("balanced_accuracy", "WITH " + _per_class_sql("pred_quality", "quality").strip() + """
SELECT round(avg(tp / support), 6) AS balanced_accuracy FROM prf2 WHERE support > 0""")
def _bal(spark, sf_dir):
    b = M.balanced_accuracy(_docs(spark, sf_dir), "pred_quality", "quality")
    return b.select(r6("balanced_accuracy").alias("balanced_accuracy"))


@register("f1_macro", "WITH " + _per_class_sql("pred_toxic", "toxic").strip() + """
SELECT round(avg(f1), 6) AS f1_macro FROM prf2""")
def _f1(spark, sf_dir):
    return M.f1_macro(_docs(spark, sf_dir), "pred_toxic", "toxic").select(r6("f1_macro").alias("f1_macro"))


@register("classification_report", "WITH " + _per_class_sql("pred_quality", "quality").strip() + """
SELECT CAST(label AS VARCHAR) AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM prf2
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM prf2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM prf2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM prf2""")
def _report(spark, sf_dir):
    r = M.classification_report(_docs(spark, sf_dir), "pred_quality", "quality")
    return r.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@register("log_loss", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS s, vec_id // 64 AS mb FROM embeddings),
f AS (SELECT mb, list_max(s) + ln(list_sum(list_transform(s, lambda v: exp(v - list_max(s))))) - s[label + 1] AS ce,
             CASE WHEN list_position(s, list_max(s)) - 1 = label THEN 1.0 ELSE 0.0 END AS hit FROM e),
g AS (SELECT mb, avg(ce) AS ce, avg(hit) AS acc FROM f GROUP BY mb)
SELECT round(sum(ce) / count(*), 6) AS loss, round(sum(acc) / count(*), 6) AS accuracy, count(*) AS n_microbatches FROM g""")
def _log_loss(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        F.col("embedding").cast("array<double>").alias("s"), "label",
        F.floor(F.col("vec_id") / 64).alias("mb"))
    r = M.log_loss(e, "s", "label", "mb")
    return r.select(r6("loss").alias("loss"), r6("accuracy").alias("accuracy"), "n_microbatches")


@register("cv_summary", f"""
WITH x AS (SELECT *, {u_sql('cv', 'doc_id')} AS u FROM {_DOCS_SQL} d),
f AS (SELECT *, CAST((row_number() OVER (PARTITION BY quality ORDER BY u, doc_id) - 1) % 5 AS INTEGER) AS fold FROM x),
per AS (SELECT fold, avg(CASE WHEN pred_quality = quality THEN 1.0 ELSE 0.0 END) AS accuracy FROM f GROUP BY fold)
SELECT 'fold_' || CAST(fold AS VARCHAR) AS metric, round(accuracy, 6) AS accuracy FROM per
UNION ALL SELECT 'mean', round(avg(accuracy), 6) FROM per
UNION ALL SELECT 'std', round(stddev_samp(accuracy), 6) FROM per
UNION ALL SELECT 'oof', round(avg(CASE WHEN pred_quality = quality THEN 1.0 ELSE 0.0 END), 6) FROM f""")
def _cv(spark, sf_dir):
    f = stratified_kfold(_docs(spark, sf_dir), "quality", 5, "cv", ["doc_id"])
    return M.cv_summary(f, "pred_quality", "quality", "fold").select("metric", r6("accuracy").alias("accuracy"))


@register("nan_mean_std", """
WITH x AS (SELECT l_returnflag, l_quantity, l_discount, CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax_f FROM lineitem)
SELECT l_returnflag, feature, round(mean, 6) AS mean, round(std, 6) AS std FROM (
  SELECT l_returnflag, 'l_quantity' AS feature, avg(l_quantity) AS mean,
         greatest(CASE WHEN count(*) > 1 THEN stddev_samp(l_quantity) ELSE stddev_pop(l_quantity) END, 1e-6) AS std
  FROM x GROUP BY 1
  UNION ALL SELECT l_returnflag, 'l_discount', avg(l_discount),
         greatest(CASE WHEN count(*) > 1 THEN stddev_samp(l_discount) ELSE stddev_pop(l_discount) END, 1e-6) FROM x GROUP BY 1
  UNION ALL SELECT l_returnflag, 'tax_f', avg(tax_f),
         greatest(CASE WHEN count(*) > 1 THEN stddev_samp(tax_f) ELSE stddev_pop(tax_f) END, 1e-6) FROM x GROUP BY 1) t""")
def _nan_mean_std(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_quantity", "l_discount", F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("tax_f"))
    r = M.nan_mean_std(li, ["l_quantity", "l_discount", "tax_f"], ["l_returnflag"])
    return r.select("l_returnflag", "feature", r6("mean").alias("mean"), r6("std").alias("std"))


@register("dataset_summary", f"""
SELECT count(*) AS n_rows, 6 AS n_cols, CAST(sum(CASE WHEN u < 0.8 THEN 1 ELSE 0 END) AS BIGINT) AS n_train,
       CAST(sum(CASE WHEN u < 0.8 THEN 0 ELSE 1 END) AS BIGINT) AS n_test, count(DISTINCT quality) AS n_classes
FROM (SELECT *, {u_sql('split', 'doc_id')} AS u FROM {_DOCS_SQL} d) t""")
def _ds_summary(spark, sf_dir):
    d = _docs(spark, sf_dir).withColumn("is_train", uniform("split", "doc_id") < 0.8)
    return M.dataset_summary(d, "quality", "is_train", 6)


@register("task_summary", """
WITH per AS (SELECT p_brand AS task_id, count(*) AS n_items, CAST(sum(p_size) AS BIGINT) AS weight FROM part GROUP BY 1)
SELECT task_id, n_items, weight FROM per
UNION ALL SELECT 'TOTAL', CAST(sum(n_items) AS BIGINT), CAST(sum(weight) AS BIGINT) FROM per""")
def _task_summary(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return M.task_summary(p, "p_brand", "p_size")


def fingerprint_sql(fields_sql: str, source: str, by: str | None = None) -> str:
    """DuckDB twin of metrics.fingerprint."""
    g = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""WITH h AS (SELECT {g}sha256(concat_ws('', {fields_sql})) AS h FROM {source}),
v AS (SELECT {g}('0x' || substr(h, 1, 15))::BIGINT AS a, ('0x' || substr(h, 16, 15))::BIGINT AS b FROM h),
s AS (SELECT {g}count(*) AS n, sum(CAST(a AS HUGEINT)) AS sa, sum(CAST(b AS HUGEINT)) AS sb, bit_xor(a) AS xa, bit_xor(b) AS xb
      FROM v{grp})
SELECT {g}sha256(concat_ws('|', CAST(n AS VARCHAR), CAST(sa AS VARCHAR), CAST(sb AS VARCHAR), CAST(xa AS VARCHAR),
       CAST(xb AS VARCHAR))) AS digest, CAST(n AS BIGINT) AS n FROM s"""


@register("stream_fingerprint", fingerprint_sql(
    "coalesce(CAST(event_id AS VARCHAR), ''), coalesce(CAST(user_id AS VARCHAR), ''), coalesce(event_type, ''), "
    "coalesce(props, '')", "events"))
def _fingerprint(spark, sf_dir):
    return M.fingerprint(table(spark, sf_dir, "events"), ["event_id", "user_id", "event_type", "props"])


_TICK_SPARK_EPOCH = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
_TICK_SQL = """(SELECT CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS time_s, user_id % 4 AS gpu, value,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS fb FROM events)"""


def _ticks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.floor(F.expr(_TICK_SPARK_EPOCH) / 3600000000).cast("bigint").alias("time_s"),
                    F.pmod(F.col("user_id"), F.lit(4)).alias("gpu"), "value",
                    F.when(F.col("event_type") == "error", None).otherwise(F.col("value")).alias("fb"))


@register("group_by_tick_sum", f"""
SELECT time_s, gpu, round(coalesce(sum(value), 0), 6) AS value_sum, round(coalesce(sum(fb), 0), 6) AS fb_sum,
       count(fb) AS n FROM {_TICK_SQL} t GROUP BY 1, 2""")
def _tick_sum(spark, sf_dir):
    r = M.tick_sum(_ticks(spark, sf_dir), ["time_s", "gpu"], ["value", "fb"], "fb")
    return r.select("time_s", "gpu", r6("value_sum").alias("value_sum"), r6("fb_sum").alias("fb_sum"), "n")


@register("group_by_tick_mean", f"""
SELECT time_s, round(avg(value), 6) AS value_mean, round(avg(fb), 6) AS fb_mean FROM {_TICK_SQL} t GROUP BY 1""")
def _tick_mean(spark, sf_dir):
    r = M.tick_mean(_ticks(spark, sf_dir), ["time_s"], ["value", "fb"])
    return r.select("time_s", r6("value_mean").alias("value_mean"), r6("fb_mean").alias("fb_mean"))
