"""Ragged dataset batches.

The reference packs the first ``d`` values of every row of a dataset into one
1-D buffer.  A dataset can be arbitrarily large, so here the packed buffer is
a long table ``(dataset, offset, value)``: offsets are a running sum of the
row lengths (computed per chunk plus a small table of chunk totals), and
unpacking is an equi-join on ``(dataset, offset)``.  No dataset is ever
gathered into one row or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.columns import dataset_constant_filter
from tessera.operators.ordering import exact_rank, running_sum


def ragged_pack(df: DataFrame, dataset: list[str], pos: str, x: str, d: str, chunk: Column) -> DataFrame:
    """(dataset, offset, value) for the first d values of each row, rows in
    ``pos`` order.  d > size(x) is an error."""
    fits = F.when(F.col(d) <= F.size(x), True).otherwise(F.raise_error(F.lit("row length exceeds its array")).cast("boolean"))
    v = running_sum(df.where(fits), dataset, [pos], F.col(d).cast("bigint"), chunk, "_end")
    v = v.withColumn("_start", F.col("_end") - F.col(d))
    return v.select(*dataset, pos, "_start", F.posexplode(F.slice(x, F.lit(1), F.col(d))).alias("j", "value")) \
            .select(*dataset, (F.col("_start") + F.col("j")).alias("offset"), "value")


def row_starts(df: DataFrame, dataset: list[str], pos: str, d: str, chunk: Column) -> DataFrame:
    v = running_sum(df.select(*dataset, pos, d), dataset, [pos], F.col(d).cast("bigint"), chunk, "_end")
    return v.select(*dataset, pos, d, (F.col("_end") - F.col(d)).alias("start"))


def ragged_unpack(packed: DataFrame, starts: DataFrame, dataset: list[str], pos: str, d: str,
                  width: int) -> DataFrame:
    """Rows back from the buffer, zero-filled to ``width``: long form
    (dataset, pos, f, value)."""
    cells = starts.select(*dataset, pos, d, "start", F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("f"))
    cells = cells.withColumn("offset", F.when(F.col("f") < F.col(d), F.col("start") + F.col("f")))
    j = cells.join(packed, [*dataset, "offset"], "left")
    return j.select(*dataset, pos, F.col("f").cast("int").alias("f"),
                    F.when(F.col("f") < F.col(d), F.col("value")).otherwise(F.lit(0.0)).alias("value"))


def dataset_ordinal(df: DataFrame, dataset: str, order: list[str], bucket: Column) -> DataFrame:
    """1-based ordinal of each distinct dataset in ``order`` (exact, bucketed)."""
    ds = df.select(*dict.fromkeys([dataset, *order])).distinct().withColumn("_g", F.lit(0))
    r = exact_rank(ds, ["_g"], order[0], order[1:], out="ordinal", bucket=bucket)
    return r.drop("_g")


def ragged_slice(ordinals: DataFrame, start: int, stop: int, step: int = 1) -> DataFrame:
    """Datasets with 0-based ordinal in range(start, stop, step)."""
    o = F.col("ordinal") - 1
    return ordinals.where((o >= start) & (o < stop) & (F.pmod(o - start, F.lit(step)) == 0))


def rebatch(ordinals: DataFrame, n: int) -> DataFrame:
    """Re-cut to exactly n datasets per batch (the last may be short)."""
    return ordinals.withColumn("new_batch", F.floor((F.col("ordinal") - 1) / n).cast("bigint")) \
                   .withColumn("index", F.pmod(F.col("ordinal") - 1, F.lit(n)).cast("int"))


def batch_group_ids(index: Column, group: int, sub: int) -> tuple[Column, Column]:
    """batch position -> group of ``group`` datasets -> subgroup of ``sub``."""
    return F.floor(index / group).cast("int"), F.floor(F.pmod(index, F.lit(group)) / sub).cast("int")


def microbatch(index: Column, m: int) -> Column:
    return F.floor(index / m).cast("int")


def microbatch_validate(df: DataFrame, mb: list[str], seq_len: str, train_size: str) -> DataFrame:
    g = df.groupBy(*mb).agg(F.count_distinct(seq_len).alias("n_seq_len"),
                            F.count_distinct(train_size).alias("n_train_size"))
    return g.withColumn("valid", (F.col("n_seq_len") == 1) & (F.col("n_train_size") == 1))


def microbatch_sizes(df: DataFrame, mb: list[str], seq_len: str, train_size: str) -> DataFrame:
    """(mb, seq_len, train_size): what the datasets of each micro-batch share.
    Datasets of one micro-batch that differ are an error."""
    g = df.groupBy(*mb).agg(F.min(seq_len).alias(seq_len), F.max(seq_len).alias("_l"), F.min(train_size).alias(train_size), F.max(train_size).alias("_t"))
    shared = lambda c, top, what: F.when(F.col(c).eqNullSafe(F.col(top)), F.col(c)).otherwise(F.raise_error(F.concat(
        F.lit("micro-batch ["), F.concat_ws(", ", *[F.col(k).cast("string") for k in mb]), F.lit(f"]: datasets of different {what}"))))
    return g.select(*mb, shared(seq_len, "_l", "sequence length").alias(seq_len), shared(train_size, "_t", "training size").alias(train_size))


def microbatch_align(df: DataFrame, mb: list[str], pos: str, seq_len: str, x: str, d: str) -> DataFrame:
    """Rows cut to the micro-batch seq_len (its minimum), features to its max d."""
    g = df.groupBy(*mb).agg(F.min(seq_len).alias("_L"), F.max(d).alias("_D"))
    j = df.join(g, mb).where(F.col(pos) < F.col("_L"))
    return j.withColumn(x, F.slice(x, F.lit(1), F.col("_D"))).drop("_L", "_D")


def pad_sequences(df: DataFrame, dataset: str, pos: str, value: str, length: int) -> DataFrame:
    """Every dataset padded to ``length`` positions with 0."""
    grid = df.select(dataset).distinct().select(dataset, F.explode(F.sequence(F.lit(0), F.lit(length - 1))).alias(pos))
    j = grid.join(df.select(dataset, pos, value), [dataset, pos], "left")
    return j.select(dataset, pos, F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias(value))


def dataset_accept(df: DataFrame, repaired: DataFrame, dataset: list[str], x: str, d: str) -> DataFrame:
    """(dataset, attempt, accepted): a dataset is kept if one of its first ``d``
    features varies and ``repaired`` (``ordering.split_repair``) found a split."""
    informative = dataset_constant_filter(df, dataset, x, d).groupBy(*dataset).agg(F.max(d).alias("_informative"))
    return informative.join(repaired, dataset).select(*dataset, "attempt", ((F.col("_informative") >= 1) & F.col("accepted")).alias("accepted"))
