"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir, scratch_path

#: Rows in one Arrow batch: texts may be long, so a batch holds few of them.
BATCH_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Arrow batch of whole texts takes in a Python worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: cuts the
    lineage, is computed once and survives lost executors."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """One output tuple for each row of ``df``: ``make()`` runs once in a task
    and returns ``f(*columns) -> tuple``.  Only one batch is held at a time."""
    small_batches(df.sparkSession)
    struct = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, out = make(), arrow_schema(struct)
        for b in batches:
            rows = [fn(*r) for r in zip(*(c.to_pylist() for c in b.columns))]
            cols = list(zip(*rows)) if rows else [()] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    return df.mapInArrow(run, struct)


def flat_map_groups(df: DataFrame, keys: list[str], make: Callable[[], Callable], schema: str) -> DataFrame:
    """``f(key, rows) -> iterable of tuples`` for each run of equal ``keys``.
    ``df`` must be partitioned and sorted by ``keys``; the groups of a
    partition stream past, so many small groups cost little.  Callers bound
    the size of a group."""
    small_batches(df.sparkSession)
    struct = T.StructType.fromDDL(schema)
    at = [df.columns.index(k) for k in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, out = make(), arrow_schema(struct)
        key, group, done = None, [], []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done)) if done else [()] * len(out)
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)
            done.clear()
            return batch

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                k = tuple(row[i] for i in at)
                if k != key:
                    if group:
                        done.extend(fn(key, group))
                    key, group = k, []
                    if len(done) >= BATCH_ROWS:
                        yield flush()
                group.append(row)
        if group:
            done.extend(fn(key, group))
        yield flush()

    return df.mapInArrow(run, struct)


def text_of(col: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
