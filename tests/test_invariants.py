"""Invariants: skew-safe helpers equal plain windows, fits ignore query rows,
results do not depend on the partition count, plans look as intended."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.operators import ordering as O
from tessera.operators import transforms as TR
from tests.conftest import SF001


def test_exact_rank_equals_row_number(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), "id").withColumn("u", uniform("s", "id"))
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("u", "id")))
    got = O.exact_rank(df, ["g"], "u", ["id"], buckets=16, out="r")
    assert got.select("id", "r").exceptAll(want.select("id", "r")).count() == 0


def test_running_sum_and_lag_equal_windows(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id", (F.col("id") % 7).cast("double").alias("v"))
    w = Window.partitionBy("g").orderBy("id")
    want = df.withColumn("run", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
             .withColumn("prev", F.lag("v").over(w))
    got = O.running_sum(df, ["g"], ["id"], F.col("v"), F.floor(F.col("id") / 100), "run")
    got = O.chunked_lag(got, ["g"], "id", "v", F.floor(F.col("id") / 100), "prev")
    assert got.select("id", "run", "prev").exceptAll(want.select("id", "run", "prev")).count() == 0


def test_carry_forward_equals_last_ignorenulls(spark):
    df = spark.range(2000).select(F.lit("f").alias("file"), F.col("id").alias("line_no"),
                                  F.when(F.col("id") % 97 == 0, F.col("id")).alias("h"))
    want = df.withColumn("c", F.last("h", ignorenulls=True).over(
        Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    got = O.carry_forward(df, ["file"], "line_no", "h", F.floor(F.col("line_no") / 300), "c")
    assert got.select("line_no", "c").exceptAll(want.select("line_no", "c")).count() == 0


def test_fit_ignores_query_rows(spark):
    base = spark.createDataFrame([(1, "context", 1.0), (2, "context", 3.0), (3, "query", 1000.0)], "i int, role string, x double")
    s1 = TR.StandardScaleClip(["x"]).fit(base.where("role = 'context'"))
    s2 = TR.StandardScaleClip(["x"]).fit(base.where("role = 'context'").union(base.where("role = 'query' and false")))
    assert s1.mean == s2.mean and s1.mean["x"] == 2.0


def test_partition_count_independent(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    a = O.stratified_kfold(li.repartition(3), "l_returnflag", 5, "kf", key)
    b = O.stratified_kfold(li.repartition(11), "l_returnflag", 5, "kf", key)
    assert a.select(*key, "fold").exceptAll(b.select(*key, "fold")).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_window_in_kfold(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = _plan(O.stratified_kfold(o, "o_orderstatus", 5, "kf", ["o_orderkey"]))
    assert "SinglePartition" not in plan


def test_pushdown_and_pruning(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").where(F.col("l_quantity") > 10).select("l_orderkey")
    plan = _plan(li)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_exact_quantiles_match_percentile(spark):
    # a hot group (g = 0 holds ~1/3 of rows) and many duplicate values
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
                                  (F.col("id") % 97).cast("double").alias("v"))
    probs = [0.0, 0.2, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in O.exact_quantiles(df, "v", probs, ["g"]).collect()}
    want = {r["g"]: r["q"] for r in df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert got.keys() == want.keys()
    for k in got:
        assert all(abs(a - b) < 1e-9 for a, b in zip(got[k], want[k]))
    low = {r["g"]: r["q"][0] for r in O.exact_quantiles(df, "v", [0.5], ["g"], method="lower").collect()}
    disc = {r["g"]: r["m"] for r in df.groupBy("g").agg(
        F.expr("percentile_disc(0.5) within group (order by v)").alias("m")).collect()}
    assert low == disc


def test_quantiles_with_many_ties(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 5.0).otherwise(F.col("id") / 100).alias("v"))
    probs = [i / 17 for i in range(18)]
    assert O.exact_quantiles(df, "v", probs).first()["q"] == df.agg(F.percentile("v", F.array(*[F.lit(p) for p in probs]))).first()[0]
