"""Evaluation aggregates.  All are grouped aggregates with map-side partial
aggregation; the per-class tables have one row per class, so the final
combination steps never see the row count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABEL_MODES = ("none", "strip", "lower", "lower_strip")


def normalise_label(c, mode: str = "none") -> Column:
    """Compare labels as text: cast to string, then optional strip / lower."""
    if mode not in LABEL_MODES:
        raise ValueError(f"unknown normalisation {mode}")
    x = (F.col(c) if isinstance(c, str) else c).cast("string")
    if mode in ("strip", "lower_strip"):
        x = F.trim(x)
    if mode in ("lower", "lower_strip"):
        x = F.lower(x)
    return x


def _match(pred: str, true: str, mode: str) -> Column:
    # a missing value reads as the text 'nan' on both sides when rows are kept
    p = F.coalesce(normalise_label(pred, mode), F.lit("nan"))
    t = F.coalesce(normalise_label(true, mode), F.lit("nan"))
    return (p == t).cast("bigint")


def accuracy(df: DataFrame, pred: str, true: str, by: list[str] | None = None, dropna: bool = False,
             mode: str = "none") -> DataFrame:
    """n, correct, accuracy overall (zero rows is an error) or per group."""
    x = df.na.drop(subset=[pred, true]) if dropna else df
    agg = [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_match(pred, true, mode)), F.lit(0)).alias("correct")]
    if by:
        g = x.groupBy(*by).agg(*agg)
        return g.withColumn("accuracy", F.col("correct") / F.col("n"))
    g = x.agg(*agg)
    return g.withColumn("accuracy", F.when(F.col("n") == 0, F.raise_error(F.lit("No rows across all files")))
                        .otherwise(F.col("correct") / F.col("n")))


def accuracy_per_file(df: DataFrame, files: DataFrame, pred: str, true: str, file: str = "file") -> DataFrame:
    """file, n, correct, accuracy of every file of a listing (``path``): one
    without rows has n = 0 and no accuracy."""
    found = accuracy(df, pred, true, by=[file])
    return files.select(F.col("path").alias(file)).join(found, file, "left").select(
        file, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("correct", F.lit(0)).alias("correct"), "accuracy")


def per_class_counts(df: DataFrame, pred: str, true: str) -> DataFrame:
    """label, tp, fp, fn, support over labels in truth U prediction."""
    t = df.groupBy(F.col(true).alias("label")).agg(
        F.count(F.lit(1)).alias("support"),
        F.sum((F.col(pred) == F.col(true)).cast("bigint")).alias("tp"))
    p = df.groupBy(F.col(pred).alias("label")).agg(F.count(F.lit(1)).alias("n_pred"))
    j = t.join(p, "label", "full_outer")
    return j.select("label",
                    F.coalesce("tp", F.lit(0)).alias("tp"),
                    (F.coalesce("n_pred", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fp"),
                    (F.coalesce("support", F.lit(0)) - F.coalesce("tp", F.lit(0))).alias("fn"),
                    F.coalesce("support", F.lit(0)).alias("support"))


def _prf(c: DataFrame) -> DataFrame:
    z = F.lit(0.0)
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), z)
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), z)
    c = c.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.coalesce(F.try_divide(F.col("precision") * F.col("recall") * 2.0, F.col("precision") + F.col("recall")), z)
    return c.withColumn("f1", f1)


def balanced_accuracy(df: DataFrame, pred: str, true: str) -> DataFrame:
    """Mean recall over the classes present in the truth."""
    c = per_class_counts(df, pred, true).where(F.col("support") > 0)
    return c.agg(F.avg(F.col("tp") / F.col("support")).alias("balanced_accuracy"))


def f1_macro(df: DataFrame, pred: str, true: str) -> DataFrame:
    """Unweighted mean F1 over labels in truth U prediction; undefined -> 0."""
    return _prf(per_class_counts(df, pred, true)).agg(F.avg("f1").alias("f1_macro"))


def classification_report(df: DataFrame, pred: str, true: str) -> DataFrame:
    """precision / recall / f1 / support per class, then 'accuracy' (in the f1
    column), 'macro avg' and 'weighted avg' rows."""
    c = _prf(per_class_counts(df, pred, true))
    per = c.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                   F.col("support").cast("bigint").alias("support"))
    tot = F.sum("support")
    macro = c.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.cast("bigint").alias("support"))
    weighted = c.agg(F.lit("weighted avg").alias("label"),
                     (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                     (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                     (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.cast("bigint").alias("support"))
    acc = c.agg(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                F.lit(None).cast("double").alias("recall"), (F.sum("tp") / tot).alias("f1"),
                tot.cast("bigint").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def log_loss(df: DataFrame, scores: str, y: str, microbatch: str) -> DataFrame:
    """Mean cross-entropy of the true class from logits (log-sum-exp) and
    accuracy, each averaged per micro-batch then divided by the number of
    micro-batches and summed -- the trainer's accumulation rule."""
    s = F.col(scores)
    m = F.array_max(s)
    lse = m + F.log(F.aggregate(s, F.lit(0.0), lambda acc, v: acc + F.exp(v - m)))
    ce = lse - F.element_at(s, F.col(y).cast("int") + 1)
    hit = (F.array_position(s, m) - 1 == F.col(y).cast("int")).cast("double")
    per_mb = df.groupBy(microbatch).agg(F.avg(ce).alias("ce"), F.avg(hit).alias("acc"))
    return per_mb.agg((F.sum("ce") / F.count(F.lit(1))).alias("loss"),
                      (F.sum("acc") / F.count(F.lit(1))).alias("accuracy"),
                      F.count(F.lit(1)).alias("n_microbatches"))


def cv_summary(df: DataFrame, pred: str, true: str, fold: str) -> DataFrame:
    """Per-fold accuracy rows + 'mean', 'std' (sample) and 'oof' rows."""
    per = df.groupBy(fold).agg(F.avg((F.col(pred) == F.col(true)).cast("double")).alias("accuracy"))
    folds = per.select(F.concat(F.lit("fold_"), F.col(fold).cast("string")).alias("metric"), "accuracy")
    mean = per.agg(F.lit("mean").alias("metric"), F.avg("accuracy").alias("accuracy"))
    std = per.agg(F.lit("std").alias("metric"), F.stddev_samp("accuracy").alias("accuracy"))
    oof = df.agg(F.lit("oof").alias("metric"), F.avg((F.col(pred) == F.col(true)).cast("double")).alias("accuracy"))
    return folds.unionByName(mean).unionByName(std).unionByName(oof)


def nan_mean_std(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Mean / std ignoring missing; ddof 1 when the table has >1 rows (all
    rows, not non-null ones); std floored at 1e-6.  Long output."""
    n = F.count(F.lit(1))
    aggs = []
    for c in cols:
        std = F.when(n > 1, F.stddev_samp(c)).otherwise(F.stddev_pop(c))
        aggs.append(F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"),
                             F.when(std.isNull(), None).otherwise(F.greatest(std, F.lit(1e-6))).alias("std")))
    g = df.groupBy(*(by or [])).agg(F.array(*aggs).alias("_s"))
    return g.select(*(by or []), F.inline("_s"))


def dataset_summary(df: DataFrame, label: str, is_train: str, n_cols: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(n_cols).alias("n_cols"),
                  F.sum(F.col(is_train).cast("bigint")).alias("n_train"),
                  F.sum((~F.col(is_train)).cast("bigint")).alias("n_test"),
                  F.count_distinct(label).alias("n_classes"))


def task_summary(df: DataFrame, task: str, weight: str) -> DataFrame:
    """Per task rows + weight, then a 'TOTAL' row."""
    per = df.groupBy(F.col(task).cast("string").alias("task_id")).agg(
        F.count(F.lit(1)).alias("n_items"), F.sum(weight).alias("weight"))
    tot = per.agg(F.lit("TOTAL").alias("task_id"), F.sum("n_items").alias("n_items"), F.sum("weight").alias("weight"))
    return per.unionByName(tot)


def record_digest(fields: list[str]) -> Column:
    """sha256 of the fields joined as text (a missing value is '')."""
    return F.sha2(F.concat_ws("", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), 256)


def fingerprint(df: DataFrame, fields: list[str], by: list[str] | None = None) -> DataFrame:
    """Order-independent digest of a record set (and its count).

    Each record's sha256 gives two 60-bit integers; the set digest is the
    sha256 of (count, their decimal sums, their XORs).  Sums and XORs are
    commutative and associative, so the aggregate is computed map-side in one
    pass with no sort and no gathered list -- it holds at any row count
    (sums of 10^12 60-bit values fit DECIMAL(38,0)) -- and duplicates still
    change the digest."""
    h = record_digest(fields)
    a = F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")
    b = F.conv(F.substring(h, 16, 15), 16, 10).cast("bigint")
    x = df.select(*(by or []), a.alias("a"), b.alias("b"))
    g = x.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("sa"),
        F.sum(F.col("b").cast("decimal(38,0)")).alias("sb"), F.bit_xor("a").alias("xa"), F.bit_xor("b").alias("xb"))
    digest = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in ("n", "sa", "sb", "xa", "xb")]), 256)
    return g.select(*(by or []), digest.alias("digest"), "n")


def tick_sum(df: DataFrame, keys: list[str], cols: list[str], present: str) -> DataFrame:
    """Sum per tick key, and the number of present values of ``present``; a sum
    over only missing values is 0."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum") for c in cols],
                                 F.count(present).alias("n"))


def tick_mean(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{c}_mean") for c in cols])


def progress(df: DataFrame, order: str, done: str, elapsed: str, total: int, chunk: Column) -> DataFrame:
    """Running done count, rows/s and ETA along an ordered log."""
    from tessera.operators.ordering import running_sum
    x = running_sum(df, [], [order], F.col(done), chunk, out="done_total")
    rate = F.col("done_total") / F.greatest(F.col(elapsed), F.lit(1e-9))
    return x.withColumn("rows_per_sec", rate).withColumn(
        "eta_sec", (F.lit(total) - F.col("done_total")) / F.greatest(F.col("rows_per_sec"), F.lit(1e-9)))


__all__ = [n for n in dir() if not n.startswith("_")] + ["Window"]
