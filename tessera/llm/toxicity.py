"""Toxicity by a classifier chain.

The chain predicts categories one after the other: toxic text of each language
that the labels know, then toxicity as such.  Each link is a logistic model,
linear in hashed features of a document's distinct words (the word and its
first four and five letters, which carries over to inflected and compound
words) and in the probabilities of the earlier links.  Those probabilities
are, in training, out of fold: every labelled text is scored by models that
haven't seen it.

Learning reads a bounded sample, at most ``SAMPLE`` labelled rows that are
toxic and as many that aren't, the first by hash of doc_id, with texts of at
most ``LONGEST`` bytes.  Scoring reads every whole text of every row; the text
alone decides.

Null, empty and wordless texts score as the intercepts say.  Without labels of
both kinds nothing is learnt and every score is the share of toxic labels (0
without any).  Repeated rows are scored alike; an empty table gives no rows.
Labels with null doc_id or toxic are left out.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, map_rows, text_of
from tessera.llm.registry import register

SAMPLE = 2000
LONGEST = 40_000
WIDTH = 1 << 18
FOLDS = 3
EPOCHS = 4
MEMO = 600_000
#: Languages with a link of their own, at most (the most frequent in the sample).
LANGUAGES = 8

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORDS.findall(text.lower()))


def features_of(word: str) -> tuple[int, ...]:
    """Cells of the word, and of its beginnings of four and five letters."""
    parts = [f"w{word}", *(f"p{word[:k]}" for k in (4, 5) if len(word) >= k)]
    return tuple(xxhash.xxh3_64_intdigest(p) % WIDTH for p in parts)


def _cells(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(cell, log of 1 + distinct words with it) of a text."""
    found = [c for w in words_of(text) for c in features_of(w)]
    cells, n = np.unique(np.array(found, np.int64), return_counts=True)
    return cells, n


class Link:
    """A logistic model over cells and the earlier links' probabilities."""

    def __init__(self, weights: np.ndarray, earlier: np.ndarray, bias: float):
        self.weights, self.earlier, self.bias = weights, earlier, bias

    def margin(self, cells, n, before) -> float:
        return float(self.bias + self.weights[cells] @ n + self.earlier @ before)


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_link(rows: list, before: np.ndarray, y: np.ndarray, seed: int = 1) -> Link:
    """Adaptive stochastic gradient on the rows' cells, scaled by the log-ratio
    of each cell's share of positive and negative rows."""
    pos, neg = np.ones(WIDTH), np.ones(WIDTH)
    for (cells, _), label in zip(rows, y):
        (pos if label else neg)[cells] += 1
    scale = np.log((pos / (y.sum() + 1)) / (neg / (len(y) - y.sum() + 1)))
    scale[(pos + neg) < 5] = 0  # seen in fewer than three rows
    w, g2 = np.zeros(WIDTH), np.full(WIDTH, 1e-2)
    a, a2 = np.zeros(before.shape[1]), np.full(before.shape[1], 1e-2)
    bias, b2 = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), 1e-2
    rng = np.random.default_rng(seed)
    balance = np.where(y > 0, len(y) / (2 * max(y.sum(), 1)), len(y) / (2 * max(len(y) - y.sum(), 1)))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            cells, n = rows[i]
            x = scale[cells] * n
            e = (sigmoid(bias + w[cells] @ x + a @ before[i]) - y[i]) * balance[i]
            g = e * x + 1e-5 * w[cells]
            g2[cells] += g * g
            w[cells] -= 0.1 * g / np.sqrt(g2[cells])
            ga = e * before[i]
            a2 += ga * ga
            a -= 0.1 * ga / np.sqrt(a2)
            b2 += e * e
            bias -= 0.1 * e / np.sqrt(b2)
    return Link(w * scale, a, bias)


def fit(rows: list[tuple[str, str | None, int]], seed: int = 1) -> dict:
    """The chain of (text, language, toxic) rows."""
    y = np.array([t for _, _, t in rows], float)
    if not 0 < y.sum() < len(y):
        return {"prior": float(y.mean()) if len(y) else 0.0}
    cells = [_cells(text) for text, _, _ in rows]
    languages = [lang for _, lang, _ in rows]
    known = sorted({x for x, t in zip(languages, y) if t and x}, key=lambda x: (-languages.count(x), x))[:LANGUAGES]
    targets = [(f"toxic {x}", np.array([float(t and lang == x) for lang, t in zip(languages, y)])) for x in sorted(known)]
    targets = [t for t in targets if t[1].sum() >= 2 * FOLDS] + [("toxic", y)]
    fold = np.random.default_rng(seed).permutation(len(rows)) % FOLDS
    before, links = np.zeros((len(rows), 0)), []
    for name, label in targets:
        links.append((name, fit_link(cells, before, label)))
        out = np.zeros(len(rows))
        for k in range(FOLDS):
            seen = np.flatnonzero(fold != k)
            held = fit_link([cells[i] for i in seen], before[seen], label[seen])
            for i in np.flatnonzero(fold == k):
                out[i] = sigmoid(held.margin(*cells[i], before[i]))
        before = np.column_stack([before, out])
    # the threshold that separates the out-of-fold scores of the last link best
    last = before[:, -1]
    steps = np.unique(np.round(last, 3))
    good = [((last >= s) == (y > 0)).mean() for s in steps]
    top = steps[np.flatnonzero(np.array(good) == max(good))]
    return {"links": links, "threshold": float(np.clip(np.median(top), 0.05, 0.95))}


def make_scorer(model: dict):
    """``score(text) -> [probability of each link]``; each distinct word's
    weights in all links are summed once and remembered."""
    if "prior" in model:
        return lambda text: [model["prior"]]
    links = [link for _, link in model["links"]]
    weights = np.stack([link.weights for link in links], axis=1)
    bias = np.array([link.bias for link in links])
    memo: dict[str, np.ndarray] = {}

    def score(text: str) -> list[float]:
        if len(memo) > MEMO:
            memo.clear()
        z = bias.copy()
        for w in words_of(text):
            v = memo.get(w)
            if v is None:
                v = weights[list(features_of(w))].sum(axis=0)
                memo[w] = v = v if v.any() else False
            if v is not False:
                z += v
        out: list[float] = []
        for k, link in enumerate(links):
            out.append(float(sigmoid(z[k] + link.earlier @ np.array(out))))
        return out

    return score


def training_rows(docs: DataFrame, labels: DataFrame, keep=None, sample: int = SAMPLE, id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> list[tuple[str, str | None, int]]:
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)) \
        .groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.max(label_col).cast("int").alias("label"))
    if keep is not None:
        lab = lab.where(keep)
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where(F.octet_length("text") <= LONGEST)
    order = F.xxhash64(F.lit("chain"), "doc_id")
    rows = []
    for k in (0, 1):
        ids = lab.where(F.col("label") == k).orderBy(order, "doc_id").limit(sample + sample // 5)
        got = text.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("t"))
        rows += [(r["t"]["text"], r["t"]["lang"], k) for r in got.orderBy(order, "doc_id").limit(sample).collect()]
    return rows


def score_toxicity(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, toxic, probability, and the whole chain, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [n for n, _ in model.get("links", [("toxic", None)])]
    threshold = model.get("threshold", 0.5)

    def make():
        score = make_scorer(shared.value)

        def one(i, text):
            p = score(text)
            return i, p[-1] >= threshold, p[-1], [{"category": n, "probability": x} for n, x in zip(names, p)]

        return one

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), make,
                    "doc_id long, toxic boolean, probability double, chain array<struct<category:string,probability:double>>")


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, fit(training_rows(docs, documents(spark, sf_dir, "labels"))))
