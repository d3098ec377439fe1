"""Inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.hashing import digest, uniform
from tessera.session import spread, table

LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CONTEXT_FRACTION = 0.3


def li_key() -> list[Column]:
    return [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint"),
            F.col("l_shipdate").cast("date").cast("string")]


def lineitem(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """lineitem with a collision-safe ``row_id`` (md5 of its natural key)."""
    li = spread(table(spark, sf_dir, "lineitem"))
    out = li.withColumn("row_id", digest(*li_key()))
    return out.select("row_id", *(cols or li.columns))


def with_role(df: DataFrame, key: list[Column], seed: str = "role", frac: float = CONTEXT_FRACTION) -> DataFrame:
    return df.withColumn("role", F.when(uniform(seed, *key) < frac, F.lit("context")).otherwise(F.lit("query")))


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
