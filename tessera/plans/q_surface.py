"""Queries for the user-function surface."""

from __future__ import annotations

import time
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import uniform
from tessera.operators import scoring as S
from tessera.operators import work as WK
from tessera.plans.common import r6
from tessera.plans.registry import register
from tessera.plans.sqlbits import u_sql
from tessera.session import scratch_path, table
from tessera.streaming import operators as ST


def handle_tasks(df, task: str, handler, schema: str, context: dict):
    """Run ``handler(items_pdf, context) -> pdf`` once per task; the context is
    read-only and shipped once per executor (broadcast)."""
    bc = df.sparkSession.sparkContext.broadcast(context)
    return df.groupBy(task).applyInPandas(lambda pdf: handler(pdf, bc.value), schema)


@register("udf_task_handler", """
WITH t AS (SELECT p_brand || '#' || CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 AS VARCHAR) AS task_id,
                  CAST(p_size AS DOUBLE) AS weight FROM part)
SELECT task_id, CAST(count(*) AS BIGINT) AS n_items, round(sum(weight) * 2.0, 6) AS scaled_weight, 'done' AS status FROM t GROUP BY 1""")
def _task_handler(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("part_id"), "p_partkey", "p_brand",
                                            F.col("p_size").cast("double").alias("weight"))
    tasks = WK.chunk_fixed(p, ["p_brand"], ["p_partkey"], 10)

    def handler(pdf: pd.DataFrame, ctx: dict) -> pd.DataFrame:
        return pd.DataFrame({"task_id": [pdf["task_id"].iloc[0]], "n_items": [len(pdf)],
                             "scaled_weight": [round(float(pdf["weight"].sum()) * ctx["factor"], 6)],
                             "status": ["done"]})

    return handle_tasks(tasks.select("task_id", "weight"), "task_id", handler,
                        "task_id string, n_items long, scaled_weight double, status string", {"factor": 2.0})


class MeanSimilarity:
    """A user's scorer for ``scoring.block_scores``: the mean dot product with
    the context rows of each class.  Sums and counts by class are all it needs."""

    def __init__(self, n_classes: int):
        self.n_classes, self.width = n_classes, 2 * n_classes

    def partial(self, cx: np.ndarray, cy: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        onehot = np.eye(self.n_classes)[cy.astype(int)]
        counts = np.broadcast_to(onehot.sum(axis=0), (len(x), self.n_classes))
        return np.zeros(len(x)), np.concatenate([x @ (cx.T @ onehot), counts], axis=1)

    def finish(self, s):
        n = self.n_classes
        return F.zip_with(F.slice(s, 1, n), F.slice(s, n + 1, n), lambda a, b: a / F.nullif(b, F.lit(0.0)))


@register("udf_scorer", f"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label, {u_sql('ctx', 'vec_id')} < 0.5 AS is_ctx FROM embeddings),
c AS (SELECT label, i, avg(x[i + 1]) AS m FROM e, range(64) r(i) WHERE is_ctx GROUP BY ALL),
cc AS (SELECT label, list(m ORDER BY i) AS c FROM c GROUP BY label)
SELECT vec_id, CAST(label AS INTEGER) AS class_idx, round(list_sum(list_transform(list_zip(x, c), lambda p: p[1] * p[2])), 6) AS score
FROM (SELECT vec_id, x FROM e WHERE NOT is_ctx) q, cc""")
def _udf_scorer(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label",
        (uniform("ctx", "vec_id") < 0.5).alias("is_ctx"))
    s = S.block_scores(e.where(~F.col("is_ctx")), e.where("is_ctx"), ["vec_id"], "x", "label", MeanSimilarity(10))
    return s.select("vec_id", F.posexplode("scores").alias("class_idx", "score")).where("score IS NOT NULL").select(
        "vec_id", F.col("class_idx").cast("int").alias("class_idx"), r6("score").alias("score"))


@F.pandas_udf(T.StringType())
def without_accents(s: pd.Series) -> pd.Series:
    """Row transform that no built-in function offers, over Arrow batches:
    letters without their accents (canonical decomposition, marks dropped)."""
    def plain(text):
        return None if text is None else unicodedata.normalize("NFC", "".join(
            c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn"))
    return s.map(plain)


@register("udf_row_transform", "SELECT doc_id, md5(strip_accents(text)) AS plain_md5, length(strip_accents(text)) AS n_chars FROM documents")
def _row_transform(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", without_accents("text").alias("plain"))
    return d.select("doc_id", F.md5("plain").alias("plain_md5"), F.length("plain").cast("long").alias("n_chars"))


class SplitLines:
    """A Python UDTF: one output row per line of a text."""

    def eval(self, text: str):
        if text is None:
            return
        for i, line in enumerate(text.split("\n")):
            yield i, len(line)


@register("udtf_file_to_rows", """
WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, CAST(length(unnest(parts)) AS INTEGER) AS n_chars FROM s""")
def _udtf(spark, sf_dir):
    split_lines = F.udtf(SplitLines, returnType="line_no: int, n_chars: int")
    spark.udtf.register("tessera_split_lines", split_lines)
    table(spark, sf_dir, "documents").select("doc_id", "text").createOrReplaceTempView("tessera_documents")
    return spark.sql("SELECT d.doc_id, t.line_no, t.n_chars FROM tessera_documents d, "
                     "LATERAL tessera_split_lines(d.text) t")


from tessera.plans.q_metrics import fingerprint_sql  # noqa: E402
from tessera.operators import metrics as M  # noqa: E402


@register("udaf_fingerprint", fingerprint_sql("CAST(doc_id AS VARCHAR), coalesce(source, '')", "documents", "lang"))
def _udaf(spark, sf_dir):
    """The fingerprint as a user aggregate per group: a composition of
    built-in partial aggregates (no Python, no gathered lists)."""
    return M.fingerprint(table(spark, sf_dir, "documents"), ["doc_id", "source"], by=["lang"])


@register("sink_adapter", "SELECT event_id, event_type FROM events")
def _sink_adapter(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    src = ST.land(e, "adapter-in", 4, order="event_id")
    out = scratch_path(spark, "adapter-out")

    def sink(batch, batch_id):                             # any callable works as a sink
        # one folder per batch, overwritten on a retry: replaying a batch cannot duplicate rows
        batch.select("event_id", "event_type").write.mode("overwrite").json(f"{out}/batch={batch_id}")

    ST.foreach_batch_sink(ST.file_stream(spark, src, e.schema, max_files=2), sink, scratch_path(spark, "ckpt-adapter"))
    return spark.read.schema("event_id bigint, event_type string").json(out).select("event_id", "event_type")

