"""Quality by compression.

Two raw-content zstandard dictionaries are cut from labelled good and bad
texts.  A text close to a dictionary compresses better with it, so the
normalised difference of the two compressed sizes tells good from bad; the
compressed sizes themselves (per byte) tell repetition.  A logistic curve
fitted on labelled rows that gave no dictionary text turns these into a
calibrated score.

Learning reads a bounded sample: at most ``SAMPLE`` labelled rows of each
class, the first by hash of doc_id, and of those with a text of at most
``LONGEST`` bytes; a dictionary takes whole texts up to ``DICTIONARY`` bytes.
Scoring reads every whole text.

Null or empty text scores as the curve's value for an empty text.  Without
labels of both classes every score is the share of good labels (0.5 without
any) and nothing is learnt.  Rows of ``labels`` with null doc_id or label are
left out; a doc_id labelled twice counts with its largest label.  Labels are
matched by doc_id; documents that repeat a doc_id share its label.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, map_rows, small_batches, text_of
from tessera.llm.registry import register

SAMPLE = 2000
LONGEST = 40_000
DICTIONARY = 2 << 20
LEVEL = 3


def held_out_col(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def _features(text: bytes, plain, good, bad) -> list[float]:
    n, a = max(len(text), 1), len(plain.compress(text))
    g, b = len(good.compress(text)), len(bad.compress(text))
    return [1.0, (g - b) / max(g, b), a / (n + 20), (a - g) / a, (a - b) / a, 1 / np.log(n + 8)]


def _compressors(dictionaries: tuple[bytes, bytes]):
    raw = [zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for d in dictionaries]
    return (zstandard.ZstdCompressor(level=LEVEL),
            *(zstandard.ZstdCompressor(level=LEVEL, dict_data=d) for d in raw))


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method for penalised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + l2 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str, keep=None, sample: int = SAMPLE,
                  id_col: str = "doc_id", text_col: str = "text") -> list:
    """(label, text) of at most ``sample`` labelled documents for each label
    0 and 1, the first by hash of doc_id."""
    lab = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
           .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("label")))
    if keep is not None:
        lab = lab.where(keep)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")) \
        .where(F.octet_length("text") <= LONGEST)
    order = F.xxhash64(F.lit("train"), "doc_id")
    rows = []
    for k in (0, 1):
        # the ids first, so that only the sample's texts travel; a fifth more for ids without a short text
        ids = lab.where(F.col("label") == k).orderBy(order, "doc_id").limit(sample + sample // 5)
        got = text.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
        rows += [(k, r["text"]) for r in got.orderBy(order, "doc_id").limit(sample).collect()]
    return rows


def fit(rows: list[tuple[int, str]]) -> dict:
    """Dictionaries from the even rows of each class, the curve from the odd ones."""
    by = {k: [t.encode() for j, t in rows if j == k] for k in (0, 1)}
    if len(by[0]) < 4 or len(by[1]) < 4:
        n = len(by[0]) + len(by[1])
        return {"prior": len(by[1]) / n if n else 0.5}

    def cut(texts: list[bytes]) -> bytes:
        out, size = [], 0
        for t in texts:
            if size + len(t) < DICTIONARY:
                out.append(t)
                size += len(t) + 1
        return b"\n".join(out)

    dictionaries = (cut(by[1][::2]), cut(by[0][::2]))
    tools = _compressors(dictionaries)
    x = np.array([_features(t, *tools) for k in (0, 1) for t in by[k][1::2]])
    y = np.array([k for k in (0, 1) for _ in by[k][1::2]], dtype=float)
    return {"dictionaries": dictionaries, "weights": _logistic(x, y)}


def make_scorer(model: dict):
    if "prior" in model:
        return lambda text: model["prior"]
    tools, w = _compressors(model["dictionaries"]), model["weights"]

    def score(text: str) -> float:
        z = float(np.dot(w, _features(text.encode(), *tools)))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score


def learn(docs: DataFrame, labels: DataFrame, **cols) -> dict:
    """A model from the labelled rows that aren't held out."""
    return fit(training_rows(docs, labels, "quality", ~held_out_col(), **cols))


def score_quality(docs: DataFrame, model: dict, threshold: float = 0.3,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        score = make_scorer(shared.value)
        return lambda i, text: (i, i is not None and zlib.crc32(str(i).encode()) % 5 == 0, score(text))

    out = map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")),
                   make, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: dict, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows that the classifier doesn't reject, with their own columns only."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = make_scorer(shared.value)
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return docs.where(score(text_of(text_col)) >= threshold)


@register("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, learn(docs, documents(spark, sf_dir, "labels")))
