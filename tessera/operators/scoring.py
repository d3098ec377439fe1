"""In-context scoring: labelled context rows + unlabelled query rows -> class
scores, then un-shift, average, softmax, argmax and decode.

Two built-in scorers stand in for the reference's pretrained network (whose
weights are not available):

* class mean -- negative Euclidean distance to each class centre.  Its fit is
  one grouped aggregate (class x feature centres, bounded by classes x
  features), and scoring is a pure projection: fused over all ensemble
  members, it needs no shuffle and no Python.
* kernel vote -- attention without weights: a softmax over negative scaled
  squared distances to all context rows, summed per context label.  Of few
  features, rows that lie close together are summed at once (``boxes``).

Context and queries may both be of any size: ``block_scores`` deals queries
into groups and context rows into slices, scores each group against each slice
in one place, and merges what the slices say.  A scorer for it is any object
with ``width``, ``partial`` and ``finish`` (see ``KernelVote``).  Scorers that
need their whole context at once plug into ``context_score``, whose context is
broadcast and must stay below a stated cap.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import argmax, array_sum, log_softmax
from tessera.operators import boxes
from tessera.operators.ensemble import ViewConfig, average_arrays, unshift
from tessera.session import stored

SOFTMAX_TEMPERATURE = 0.9   # fixed value: the classifier's default temperature
MAX_BROADCAST_CELLS = 50_000_000
#: Queries of a group, and context rows of a slice.
QUERY_GROUP, CONTEXT_SLICE = 1 << 17, 1 << 18
#: Sums (a query's by class) that a task holds at once, and features of context rows.
HELD_SUMS, HELD_FEATURES = 1 << 23, 1 << 22
#: Queries and context rows that are compared pair by pair at once.
PAIR_QUERIES, PAIR_ROWS = 256, 10_000
#: Outcomes of tree nodes in one partition.
OUTCOMES = 1 << 21
MAX_CELL_PARTITIONS = 1 << 13


# ------------------------------------------------------------ class means
def class_means(ctx: DataFrame, features: list[str], label: str, by: list[str] | None = None) -> dict:
    """{(*by, class): [mean per feature]} from one grouped aggregate."""
    by = by or []
    rows = ctx.groupBy(*by, label).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)]).collect()
    out = {}
    for r in rows:
        k = tuple(r[b] for b in by) + (r[label],)
        out[k] = [r[f"m{i}"] for i in range(len(features))]
    return out


def class_mean_logits(feats: list[Column], centres: list[list[float]]) -> Column:
    """array over classes of -||x - centre_c|| (wide columns, codegen'd)."""
    out = []
    for mu in centres:
        s = None
        for x, m in zip(feats, mu):
            d = (x - F.lit(float(m))) * (x - F.lit(float(m)))
            s = d if s is None else s + d
        out.append(-F.sqrt(s))
    return F.array(*out)


def class_mean_logits_array(x: Column, centres: list[list[float]]) -> Column:
    """Same for an array feature column."""
    out = []
    for mu in centres:
        m = F.array(*[F.lit(float(v)) for v in mu])
        sq = F.zip_with(x, m, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
        out.append(-F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)))
    return F.array(*out)


def with_member_logits(df: DataFrame, features: list[str], label: str, ctx_filter: Column | None,
                       configs: list[ViewConfig], n_classes: int, out: str = "logits",
                       centres: dict | None = None) -> DataFrame:
    """Per-member class-mean logits in one projection per stage: member m
    sees features in pattern order and labels shifted by its offset; its
    logits are rotated back, then the members are averaged.  A permutation
    of the features does not move a centre distance, so members differ only
    by their shift -- but each is evaluated as declared.  Each stage is its
    own column so no expression subtree is duplicated."""
    base = centres if centres is not None else class_means(df.where(ctx_filter), features, label)
    stage = {}
    for c in configs:
        feats = [F.col(features[i]) for i in c.pattern]
        cent = []
        for k in range(n_classes):
            orig = (k - c.shift) % n_classes          # member class k = original class k - shift
            mu = base.get((orig,))
            cent.append([mu[i] for i in c.pattern] if mu else [float("nan")] * len(features))
        stage[f"_lg{c.member}"] = class_mean_logits(feats, cent)
    x = df.withColumns(stage)
    x = x.withColumns({f"_ul{c.member}": unshift(F.col(f"_lg{c.member}"), F.lit(c.shift)) for c in configs})
    x = x.withColumn(out, average_arrays([F.col(f"_ul{c.member}") for c in configs]))
    return x.drop(*stage.keys(), *[f"_ul{c.member}" for c in configs])


def with_ensemble_logits(df: DataFrame, features: dict[str, list[str]], configs: list[ViewConfig], n_classes: int,
                         centres: dict[str, dict], out: str = "logits") -> DataFrame:
    """Class-mean logits averaged over the members.  A distance to a centre
    depends neither on the order of the features nor, once the class shift is
    undone, on the shift; so the distinct views are the normalisers, each scored
    once and weighted by its members."""
    weight = {n: sum(c.norm == n for c in configs) / len(configs) for n in features}
    used = [n for n in features if weight[n]]
    none = [float("nan")]
    x = df.withColumns({f"_lg_{n}": class_mean_logits([F.col(f) for f in features[n]], [
        centres[n].get((k,), none * len(features[n])) for k in range(n_classes)]) for n in used})
    total = F.array(*[sum((F.col(f"_lg_{n}")[k] * F.lit(weight[n]) for n in used[1:]), F.col(f"_lg_{used[0]}")[k] * F.lit(weight[used[0]]))
                      for k in range(n_classes)])
    return x.withColumn(out, total).drop(*[f"_lg_{n}" for n in used])


def with_proba(df: DataFrame, logits: str, out: str = "proba", average_logits: bool = True,
               temperature: float = SOFTMAX_TEMPERATURE) -> DataFrame:
    """softmax with temperature when averaging logits, then row-normalise."""
    x = df
    src = logits
    if average_logits:
        x = x.withColumn("_mx", F.array_max(logits)) \
             .withColumn("_e", F.transform(logits, lambda v: F.exp((v - F.col("_mx")) / F.lit(float(temperature))))) \
             .withColumn("_es", F.aggregate("_e", F.lit(0.0), lambda a, v: a + v)) \
             .withColumn("_sm", F.transform("_e", lambda v: v / F.col("_es")))
        src = "_sm"
    x = x.withColumn("_ns", F.aggregate(src, F.lit(0.0), lambda a, v: a + v)) \
         .withColumn(out, F.transform(src, lambda v: v / F.col("_ns")))
    return x.drop(*[c for c in ("_mx", "_e", "_es", "_sm", "_ns") if c in x.columns])


def predict_index(proba: Column) -> Column:
    return argmax(proba)


# --------------------------------------------------------- kernel scorer
class KernelVote:
    """Softmax-weighted vote of context labels by negative squared distance
    (scaled by the feature count).

    What some context rows say of a query is (m, s): the sums s of exp(logit - m)
    by class.  Two such pairs merge into one, so context rows may come in any pieces."""

    def __init__(self, n_classes: int, temperature: float = 1.0):
        self.width, self.temperature = n_classes, temperature

    def partial(self, cx: np.ndarray, cy: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of few features, rows that lie close together are summed by box (see
        ``boxes``), to 4e-13 of each weight; all others pair by pair."""
        if not boxes.usable(x.shape[1]):
            return self._all_pairs(cx, cy, x)
        m, s, left_x, left_c = boxes.box_sums(cx, cy, x, self.width, x.shape[1] * self.temperature, merge_partials)
        for asked, near in ((~left_x, left_c), (left_x, slice(None))):
            some = cx[near]
            if asked.any() and len(some):
                m[asked], s[asked] = merge_partials(m[asked], s[asked], *self._all_pairs(some, cy[near], x[asked]))
        return m, s

    def _all_pairs(self, cx: np.ndarray, cy: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for k in range(0, len(x), PAIR_QUERIES):
            m, s = None, None
            for c in range(0, len(cx), PAIR_ROWS):
                m2, s2 = self._pairs(cx[c:c + PAIR_ROWS], cy[c:c + PAIR_ROWS], x[k:k + PAIR_QUERIES])
                m, s = (m2, s2) if m is None else merge_partials(m, s, m2, s2)
            found.append((m, s))
        return np.concatenate([m for m, _ in found]), np.concatenate([s for _, s in found])

    def _pairs(self, cx: np.ndarray, cy: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        logit = 2.0 * x @ cx.T
        np.subtract((x * x).sum(axis=1)[:, None], logit, out=logit)
        logit += (cx * cx).sum(axis=1)[None, :]
        np.maximum(logit, 0.0, out=logit)
        logit /= -(max(x.shape[1], 1) * self.temperature)
        m = logit.max(axis=1)
        logit -= m[:, None]
        np.exp(logit, out=logit)
        onehot = np.zeros((len(cy), self.width))
        onehot[np.arange(len(cy)), cy.astype(int)] = 1.0
        return m, logit @ onehot

    @staticmethod
    def finish(s: Column) -> Column:
        total = F.nullif(array_sum(s), F.lit(0.0))
        return F.transform(s, lambda v: v / total)


def merge_partials(m: np.ndarray, s: np.ndarray, m2: np.ndarray, s2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = np.maximum(m, m2)
    with np.errstate(invalid="ignore"):
        a, b = np.where(m == top, 1.0, np.exp(m - top)), np.where(m2 == top, 1.0, np.exp(m2 - top))
    return top, s * a[:, None] + s2 * b[:, None]


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _views_and_most(df: DataFrame, by: list[str]) -> tuple[int, int]:
    """Number of ``by`` and of the rows of the largest."""
    views, most = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n")).first()
    return views, most or 0


def block_scores(query: DataFrame, ctx: DataFrame, keys: list[str], x: str, y: str, scorer, by: list[str] | None = None,
                 out: str = "scores", group: int = QUERY_GROUP, piece: int = CONTEXT_SLICE) -> DataFrame:
    """(by, keys, out): each query scored against all context rows (of its ``by``).

    Queries are dealt by hash into groups, context rows into slices; a pair
    of a group and a slice is worked on in one place, which holds the group and
    takes the slice past it, ``HELD_FEATURES`` numbers at a time.  Each pair gives one (m, s) a
    query, and those of its slices (as many as there are slices) are merged.  No
    side is broadcast, collected or capped.  ``x``: arrays of one length; keys
    are unique.  Without context rows all scores are null.

    All pairs are work that grows with the square of the rows, unless the scorer
    sums what lies close together; a group then costs its queries and a slice its
    rows, so larger slices cost less.  What is moved grows with the square too, by context rows times groups and queries times slices, both counted
    within the largest ``by``; what a task holds does not grow."""
    by = by or []
    group = max(1, min(group, HELD_SUMS // max(1, scorer.width)))
    views, most = _views_and_most(query, by)
    groups = max(1, -(-most // group))
    pieces = max(1, -(-_views_and_most(ctx, by)[1] // piece))
    cell = [*by, "_g", "_s"]
    q = query.select(*by, F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int").alias("_g"),
                     F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_s"), F.lit(0).alias("_kind"),
                     F.col(x).cast("array<double>").alias("_x"), F.lit(None).cast("int").alias("_y"), *[k for k in keys if k not in by])
    c = ctx.select(*by, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_g"),
                   F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(pieces)).cast("int").alias("_s"), F.lit(1).alias("_kind"),
                   F.col(x).cast("array<double>").alias("_x"), F.col(y).cast("int").alias("_y"))
    own = [k for k in keys if k not in by]
    both = q.unionByName(c, allowMissingColumns=True)
    # cells are few bytes and much work: as many partitions, which are not put together by size
    cells = max(1, min(MAX_CELL_PARTITIONS, views * groups * pieces))
    dealt = both.repartition(cells, *cell).sortWithinPartitions(*cell, "_kind").select(*cell, "_kind", "_x", "_y", *own)
    schema = T.StructType([both.schema[k] for k in [*by, *own]] + [T.StructField("_m", T.DoubleType()), T.StructField("_v", T.ArrayType(T.DoubleType()))])
    width, at = scorer.width, len(by)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        cell_of, held, xs, near, m, v = None, [], [], [], None, None

        def scored():
            """What the context rows at hand say is merged into (m, v)."""
            nonlocal xs, near, m, v
            if near:
                xs = [np.concatenate(xs)] if len(xs) > 1 else xs
                m2, v2 = scorer.partial(np.concatenate([c for c, _ in near]), np.concatenate([c for _, c in near]), xs[0])
                m, v = (m2, v2) if m is None else merge_partials(m, v, m2, v2)
                near = []

        def closed():
            if not held:
                return None
            scored()
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            n = rows.num_rows
            top = pa.nulls(n, pa.float64()) if m is None else pa.array(m)  # a slice without rows says nothing
            sums = np.zeros((n, width)) if v is None else v
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()), pa.array(sums.ravel()))
            return pa.RecordBatch.from_arrays([*rows.columns, top, lists], schema=arrow)

        for b in batches:
            marks = list(zip(*(b.column(i).to_pylist() for i in range(at + 3))))
            edges = [0, *(k for k in range(1, len(marks)) if marks[k] != marks[k - 1]), len(marks)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                *now, kind = marks[lo]
                if now != cell_of:
                    if (done := closed()) is not None:
                        yield done
                    cell_of, held, xs, near, m, v = now, [], [], [], None, None
                part = b.slice(lo, hi - lo)
                d = len(part.column(at + 3)[0])
                if kind == 0:
                    held.append(part.select([*range(at), *range(at + 5, part.num_columns)]))
                    xs.append(_matrix(part.column(at + 3), d))
                    continue
                if not held:
                    continue
                near.append((_matrix(part.column(at + 3), d), part.column(at + 4).to_numpy(zero_copy_only=False)))
                if sum(c.size for c, _ in near) >= HELD_FEATURES:
                    scored()
        if (done := closed()) is not None:
            yield done

    said = dealt.mapInArrow(run, schema)
    merged = said.groupBy(*by, *own).agg(F.collect_list(F.struct("_m", "_v")).alias("_l")) \
        .withColumn("_top", F.array_max(F.col("_l")["_m"]))
    none = F.array_repeat(F.lit(0.0), F.lit(width))
    total = F.aggregate("_l", none, lambda acc, e: F.zip_with(
        acc, e["_v"], lambda a, b: a + b * F.coalesce(F.exp(e["_m"] - F.col("_top")), F.lit(0.0))))
    return merged.withColumn("_t", total).select(*by, *own, scorer.finish(F.col("_t")).alias(out))


# ------------------------------------------------------- whole-context scorers
def collect_context(ctx: DataFrame, x: str, y: str, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Bring the capped context to the driver for broadcast: at most ``cap``
    rows (callers pass a hash top-k sample), size checked before collect."""
    n = ctx.count()
    if n > cap:
        raise ValueError(f"context has {n} rows, above its cap {cap}; sample it first")
    pdf = ctx.select(x, y).toPandas()
    xs = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[x]]) if len(pdf) else np.zeros((0, 0))
    if xs.size > MAX_BROADCAST_CELLS:
        raise ValueError("context too large to broadcast")
    return xs, pdf[y].to_numpy()


def context_score(query: DataFrame, keys: list[str], x: str, ctx_x: np.ndarray, ctx_y: np.ndarray, n_classes: int,
                  scorer: Callable[..., np.ndarray], out: str = "scores") -> DataFrame:
    """Score query rows against the broadcast context in Arrow batches:
    ``scorer(ctx_X, ctx_y, n_classes, X) -> (n, C) array``."""
    sc = query.sparkSession.sparkContext
    bx, by_ = sc.broadcast(ctx_x), sc.broadcast(ctx_y)
    key_fields = [query.schema[k] for k in keys]
    schema = T.StructType(key_fields + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def run(batches):
        cx, cy = bx.value, by_.value
        for pdf in batches:
            if len(pdf) == 0:
                continue
            xs = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[x]])
            s = scorer(cx, cy, n_classes, xs)
            res = pdf[keys].copy()
            res[out] = list(s)
            yield res

    return query.select(*keys, x).mapInPandas(run, schema)


# ----------------------------------------------------------- hierarchical
EPSILON = 1e-6   # fixed value: added to a probability before its logarithm


class ClassTreeModel:
    """Many classes through a tree of nodes with few outcomes each, as tables:

    * ``paths`` (class_idx, node_id, group): a row a class and node on its way,
    * ``centres`` (node_id, groups): a row a node, its outcomes with their
      class-mean centres (at most as many as a node may have).

    Both grow with the number of classes, not of rows.  A plan that uses them
    is the same for any number of classes."""

    def __init__(self, dictionary: DataFrame, paths: DataFrame, centres: DataFrame, n_nodes: int, features: list[str], n_paths: int = 1):
        self.dictionary, self.paths, self.centres, self.n_nodes, self.features = dictionary, paths, centres, n_nodes, features
        self.n_paths = n_paths


def fit_class_tree(context: DataFrame, features: list[str], label: str, max_classes: int | None = None) -> ClassTreeModel:
    from tessera.operators import targets as TG
    dictionary = TG.label_dictionary(context, label)
    tree = TG.class_tree(dictionary, max_classes=max_classes or TG.MAX_CLASSES)
    nodes = stored(TG.label_dictionary(tree, "node").select(F.col("label").alias("node"), F.col("class_idx").alias("node_id")), "tree-nodes")
    paths = stored(tree.join(nodes, "node").select("class_idx", "node_id", "group"), "tree-paths")
    x = TG.label_encode(context.select(label, *features), label, dictionary).where(F.col("class_idx").isNotNull())
    # sums by class first, so that the rows meet no node
    sums = x.groupBy("class_idx").agg(*[F.sum(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(features)],
                                      *[F.count(c).alias(f"n{i}") for i, c in enumerate(features)])
    at = sums.join(paths, "class_idx").groupBy("node_id", "group").agg(
        F.array(*[F.sum(f"s{i}") / F.sum(f"n{i}") for i in range(len(features))]).alias("centre"))
    centres = at.groupBy("node_id").agg(F.sort_array(F.collect_list(F.struct("group", "centre"))).alias("groups"))
    return ClassTreeModel(dictionary, paths, stored(centres, "tree-centres"), nodes.count(), features, paths.count())


def node_scores(rows: DataFrame, key: list[str], model: ClassTreeModel, temperature: float = SOFTMAX_TEMPERATURE) -> DataFrame:
    """(key, node_id, group, log_p): log-softmax over the outcomes of every node,
    by negative distance to their centres.

    Rows are dealt by key before they are multiplied by the nodes, about
    ``OUTCOMES`` outcomes a partition, so that the groups of ``chain_rule`` and
    ``best_class`` lie together already: only the rows themselves are shuffled."""
    outcomes = rows.count() * max(1, model.n_paths)
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-outcomes // OUTCOMES))
    x = rows.repartition(parts, *key).select(*key, F.array(*[F.col(c).cast("double") for c in model.features]).alias("_x"),
                    F.explode(F.sequence(F.lit(0), F.lit(model.n_nodes - 1))).alias("node_id"))
    far = lambda g: -F.sqrt(array_sum(F.zip_with("_x", g["centre"], lambda a, b: (a - b) * (a - b))))
    x = x.join(model.centres, "node_id").withColumn("_l", F.transform("groups", far))
    x = x.withColumn("_l", log_softmax("_l", temperature))
    return x.select(*key, "node_id", F.inline(F.arrays_zip(F.col("groups")["group"].alias("group"), F.col("_l").alias("log_p"))))


def chain_rule(scores: DataFrame, key: list[str], model: ClassTreeModel) -> DataFrame:
    """(key, class_idx, p): the product of the outcomes' probabilities on the
    way to each class, as the exponential of a grouped sum of logarithms."""
    on_the_way = scores.join(model.paths, ["node_id", "group"])
    return on_the_way.groupBy(*key, "class_idx").agg(F.exp(F.sum("log_p")).alias("p"))


def tree_logits(p: DataFrame, temperature: float = SOFTMAX_TEMPERATURE) -> DataFrame:
    """T * ln(p + 1e-6), which takes the place of logits."""
    return p.withColumn("score", F.lit(temperature) * F.log(F.col("p") + EPSILON))


def best_class(p: DataFrame, key: list[str]) -> DataFrame:
    """(key, class_idx, p) of the likeliest class, of equal ones the lowest."""
    return p.groupBy(*key).agg(F.min(F.struct((-F.col("p")).alias("m"), "class_idx")).alias("b")) \
        .select(*key, "b.class_idx", (-F.col("b.m")).alias("p"))


def format_probabilities(labels: list[str], proba: Column) -> Column:
    """JSON object label -> probability (labels as text)."""
    return F.to_json(F.map_from_arrays(F.array(*[F.lit(str(l)) for l in labels]), proba))
