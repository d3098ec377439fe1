"""Queries for ragged dataset batches.  Datasets are
conversations (rows = turns) and orders (rows = line items)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import columns as C
from tessera.operators import ragged as RG
from tessera.plans.q_ordering import REPAIR_SQL, repaired_orders
from tessera.plans.registry import register
from tessera.session import table

_CONV_SQL = """(SELECT conv_id, turn, [CAST(length(text) AS DOUBLE), CAST(turn AS DOUBLE), CAST(conv_id AS DOUBLE)] AS x,
  CAST(1 + turn % 3 AS INTEGER) AS d FROM conversations)"""


def _conv(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn",
                    F.array(F.length("text").cast("double"), F.col("turn").cast("double"),
                            F.col("conv_id").cast("double")).alias("x"),
                    (F.pmod(F.col("turn"), F.lit(3)) + 1).cast("int").alias("d"))


def _chunk():
    return F.floor(F.col("turn") / (1 << 20))


_PACK_SQL = f"""WITH c AS {_CONV_SQL},
s AS (SELECT *, sum(d) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d AS start FROM c),
p AS (SELECT conv_id, start + j AS offset, x[j + 1] AS value FROM s, range(3) r(j) WHERE j < d)"""


@register("ragged_pack", _PACK_SQL + ' SELECT conv_id, CAST(p."offset" AS BIGINT) AS "offset", value FROM p')
def _pack(spark, sf_dir):
    p = RG.ragged_pack(_conv(spark, sf_dir), ["conv_id"], "turn", "x", "d", _chunk())
    return p.select("conv_id", F.col("offset").cast("bigint").alias("offset"), "value")


@register("ragged_unpack", _PACK_SQL + """
SELECT s.conv_id, s.turn, CAST(f AS INTEGER) AS f, CASE WHEN f < s.d THEN p.value ELSE 0.0 END AS value
FROM s CROSS JOIN range(4) r(f) LEFT JOIN p ON p.conv_id = s.conv_id AND f < s.d AND p.offset = s.start + f""")
def _unpack(spark, sf_dir):
    c = _conv(spark, sf_dir)
    packed = RG.ragged_pack(c, ["conv_id"], "turn", "x", "d", _chunk())
    starts = RG.row_starts(c, ["conv_id"], "turn", "d", _chunk())
    return RG.ragged_unpack(packed, starts, ["conv_id"], "turn", "d", 4)


def _ordinals(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return RG.dataset_ordinal(c, "conv_id", ["conv_id"], F.floor(F.col("conv_id") / 4096))


_ORD_SQL = "(SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS ordinal FROM (SELECT DISTINCT conv_id FROM conversations) t)"


@register("ragged_slice", f"""
SELECT conv_id FROM {_ORD_SQL} o WHERE ordinal - 1 >= 10 AND ordinal - 1 < 200 AND (ordinal - 1 - 10) % 3 = 0""")
def _slice(spark, sf_dir):
    return RG.ragged_slice(_ordinals(spark, sf_dir), 10, 200, 3).select("conv_id")


_REBATCH_SQL = """(SELECT conv_id, conv_id // 50 AS batch_id,
  row_number() OVER (ORDER BY conv_id // 50, conv_id) AS ordinal FROM (SELECT DISTINCT conv_id FROM conversations) t)"""


def _rebatched(spark, sf_dir, n=32):
    c = table(spark, sf_dir, "conversations").select("conv_id", F.floor(F.col("conv_id") / 50).alias("batch_id"))
    o = RG.dataset_ordinal(c, "conv_id", ["batch_id", "conv_id"], F.col("batch_id"))
    return RG.rebatch(o, n)


@register("rebatch_exact", f"""
SELECT conv_id, CAST((ordinal - 1) // 32 AS BIGINT) AS new_batch, CAST((ordinal - 1) % 32 AS INTEGER) AS idx FROM {_REBATCH_SQL} o""")
def _rebatch(spark, sf_dir):
    return _rebatched(spark, sf_dir).select("conv_id", "new_batch", F.col("index").alias("idx"))


@register("batch_group_ids", f"""
SELECT conv_id, CAST(((ordinal - 1) % 32) // 8 AS INTEGER) AS grp, CAST((((ordinal - 1) % 32) % 8) // 4 AS INTEGER) AS subgrp
FROM {_REBATCH_SQL} o""")
def _group_ids(spark, sf_dir):
    r = _rebatched(spark, sf_dir)
    g, s = RG.batch_group_ids(F.col("index"), 8, 4)
    return r.select("conv_id", g.alias("grp"), s.alias("subgrp"))


@register("microbatch_assign", f"""
SELECT conv_id, CAST((ordinal - 1) // 32 AS BIGINT) AS new_batch, CAST(((ordinal - 1) % 32) // 5 AS INTEGER) AS mb FROM {_REBATCH_SQL} o""")
def _mb_assign(spark, sf_dir):
    r = _rebatched(spark, sf_dir)
    return r.select("conv_id", "new_batch", RG.microbatch(F.col("index"), 5).alias("mb"))


_MB_SQL = f"""WITH o AS {_REBATCH_SQL},
m AS (SELECT conv_id, (ordinal - 1) // 32 AS new_batch, CAST(((ordinal - 1) % 32) // 5 AS INTEGER) AS mb FROM o),
s AS (SELECT conv_id, count(*) AS seq_len, count(*) // 2 AS train_size FROM conversations GROUP BY 1)"""


def _mb_frame(spark, sf_dir):
    r = _rebatched(spark, sf_dir).select("conv_id", "new_batch", RG.microbatch(F.col("index"), 5).alias("mb"))
    s = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("seq_len"))
    s = s.withColumn("train_size", F.floor(F.col("seq_len") / 2))
    return r.join(s, "conv_id")


@register("microbatch_validate", _MB_SQL + """
SELECT new_batch, mb, count(DISTINCT seq_len) AS n_seq_len, count(DISTINCT train_size) AS n_train_size,
       count(DISTINCT seq_len) = 1 AND count(DISTINCT train_size) = 1 AS valid FROM m JOIN s USING (conv_id) GROUP BY 1, 2""")
def _mb_validate(spark, sf_dir):
    return RG.microbatch_validate(_mb_frame(spark, sf_dir), ["new_batch", "mb"], "seq_len", "train_size")


@register("microbatch_align", _MB_SQL + f""",
c AS {_CONV_SQL},
j AS (SELECT c.*, m.new_batch, m.mb, s.seq_len FROM c JOIN m USING (conv_id) JOIN s USING (conv_id)),
g AS (SELECT new_batch, mb, min(seq_len) AS min_len, max(d) AS max_d FROM j GROUP BY 1, 2)
SELECT conv_id, turn, CAST(len(list_slice(x, 1, max_d)) AS INTEGER) AS n_features FROM j JOIN g USING (new_batch, mb) WHERE turn < min_len""")
def _mb_align(spark, sf_dir):
    f = _mb_frame(spark, sf_dir).join(_conv(spark, sf_dir), "conv_id")
    a = RG.microbatch_align(f, ["new_batch", "mb"], "turn", "seq_len", "x", "d")
    return a.select("conv_id", "turn", F.size("x").alias("n_features"))


@register("pad_sequences", """
WITH m AS (SELECT max(turn) + 1 AS L FROM conversations),
g AS (SELECT conv_id, pos FROM (SELECT DISTINCT conv_id FROM conversations) t, m, range(0, 1000) r(pos) WHERE pos < L)
SELECT g.conv_id, CAST(g.pos AS BIGINT) AS turn, coalesce(CAST(length(c.text) AS DOUBLE), 0.0) AS n_chars
FROM g LEFT JOIN conversations c ON c.conv_id = g.conv_id AND c.turn = g.pos""")
def _pad(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    length = c.agg(F.max("turn") + 1).first()[0]
    x = c.select("conv_id", "turn", F.length("text").alias("n_chars"))
    return RG.pad_sequences(x, "conv_id", "turn", "n_chars", int(length)).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "n_chars")


@register("dataset_accept", f"""
WITH lng AS (SELECT l_orderkey, f, [l_quantity, l_discount, l_tax][f + 1] AS v FROM lineitem, range(3) r(f)),
inf AS (SELECT l_orderkey, count(*) FILTER (WHERE mn < mx) AS n_inf FROM
          (SELECT l_orderkey, f, min(v) mn, max(v) mx FROM lng GROUP BY 1, 2) t GROUP BY 1)
SELECT l_orderkey, attempt, n_inf >= 1 AND accepted AS accepted FROM inf JOIN ({REPAIR_SQL}) r USING (l_orderkey)""")
def _accept(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    x = li.select("l_orderkey", "l_linenumber", F.array("l_quantity", "l_discount", "l_tax").alias("x"), F.lit(3).alias("d"))
    accepted = RG.dataset_accept(x, repaired_orders(spark, sf_dir), ["l_orderkey"], "x", "d")
    return accepted.select("l_orderkey", F.coalesce(F.col("attempt").cast("int"), F.lit(-1)).alias("attempt"), "accepted")
