"""Queries for ensemble views and in-context scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.arrays import invert_pattern, normalise, permute, rotate_back, softmax
from tessera.functions.hashing import uniform
from tessera.operators import ensemble as EN
from tessera.operators import scoring as S
from tessera.operators import targets as TG
from tessera.operators.transforms import Preprocess
from tessera.plans.classify import _BASE_SQL as _CLS_SQL
from tessera.plans.common import li_key, lineitem, r6, with_role
from tessera.plans.registry import register
from tessera.plans.sqlbits import soft_clip_sql, u_sql
from tessera.session import stored, table

_PART_X = "[CAST(p_size AS DOUBLE), p_retailprice, CAST(p_partkey AS DOUBLE)]"


def _part_x(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_type",
                    F.array(F.col("p_size").cast("double"), F.col("p_retailprice"), F.col("p_partkey").cast("double")).alias("x"))


@register("permute_features", f"""
SELECT p_partkey, CAST(f AS INTEGER) AS f, round(({_PART_X})[[3, 1, 2][f + 1]], 6) AS v FROM part, range(3) r(f)""")
def _permute(spark, sf_dir):
    x = _part_x(spark, sf_dir).select("p_partkey", permute("x", F.array(F.lit(2), F.lit(0), F.lit(1))).alias("x"))
    return x.select("p_partkey", F.posexplode_outer("x").alias("f", "v")).select(
        "p_partkey", F.col("f").cast("int").alias("f"), r6("v").alias("v"))


@register("pattern_mapping", """
SELECT p_partkey, CAST(i AS INTEGER) AS i, CAST((i + p_partkey % 3) % 3 AS INTEGER) AS pos FROM part, range(3) r(i)""")
def _pattern_mapping(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    r = F.pmod(F.col("p_partkey"), F.lit(3)).cast("int")
    # pattern = rotation of (0,1,2) by r: pattern[j] = (j - r) mod 3
    pat = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: F.pmod(j - r, F.lit(3)))
    x = p.select("p_partkey", invert_pattern(pat).alias("inv"))
    return x.select("p_partkey", F.posexplode_outer("inv").alias("i", "pos")).select(
        "p_partkey", F.col("i").cast("int").alias("i"), F.col("pos").cast("int").alias("pos"))


_N_TYPES = 6


def _configs():
    pats = EN.feature_patterns(3, 4, "shift", seed=0)
    return EN.ensemble_configs(pats, _N_TYPES, ["none", "robust"], 8, class_shift=True, seed=0)


def _cfg_sql():
    rows = ", ".join(f"({c.member}, '{c.norm}', {[i + 1 for i in c.pattern]}, {c.shift})" for c in _configs())
    return f"(VALUES {rows}) cfg(member, norm, pattern, shift)"


_TYPE_DICT_SQL = "(SELECT p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS y FROM (SELECT DISTINCT p_type FROM part) t)"


_VIEW_FEATURES = ["p_size", "p_retailprice", "p_partkey"]
_VIEW_SQL = ["CAST(p_size AS DOUBLE)", "p_retailprice", "CAST(p_partkey AS DOUBLE)"]


def _clip_stage_sql(src: str, out: str) -> str:
    n = range(len(_VIEW_FEATURES))
    one = ", ".join(f"avg(f{i}) a{i}, greatest(stddev_samp(f{i}), 1e-6) b{i}" for i in n)
    inside = [f"CASE WHEN f{i} BETWEEN a{i} - 4 * b{i} AND a{i} + 4 * b{i} THEN f{i} END" for i in n]
    two = ", ".join(f"avg({x}) a{i}, greatest(stddev_samp({x}), 1e-6) b{i}" for i, x in zip(n, inside))
    clip = ", ".join(f"{soft_clip_sql(f'f{i}', f'(a{i} - 4 * b{i})', f'(a{i} + 4 * b{i})')} AS f{i}" for i in n)
    return (f"{out}_1 AS (SELECT {one} FROM {src} WHERE is_ctx), {out}_2 AS (SELECT {two} FROM {src}, {out}_1 WHERE is_ctx),\n"
            f"{out} AS (SELECT p_partkey, y, is_ctx, {clip} FROM {src}, {out}_2)")


def _views_sql() -> str:
    """v(p_partkey, is_ctx, member, norm, shift, y, f0, f1, f2): scale, normalise
    and clip as fitted on context rows, then every member's order and shift."""
    n = range(len(_VIEW_FEATURES))
    iqr = [f"(q{i}[3] - q{i}[1]) / 1.3489795003921634" for i in n]
    return f"""
WITH raw AS (SELECT p_partkey, CAST(d.y AS INTEGER) AS y, {u_sql('ctx', 'p_partkey')} < 0.5 AS is_ctx, {", ".join(f"{e} AS f{i}" for i, e in enumerate(_VIEW_SQL))}
             FROM part JOIN {_TYPE_DICT_SQL} d USING (p_type)),
p AS (SELECT {", ".join(f"avg(f{i}) m{i}, stddev_pop(f{i}) + 1e-6 s{i}" for i in n)} FROM raw WHERE is_ctx),
sc AS (SELECT p_partkey, y, is_ctx, {", ".join(f"least(greatest((f{i} - m{i}) / s{i}, -100), 100) AS f{i}" for i in n)} FROM raw, p),
q AS (SELECT {", ".join(f"quantile_cont(f{i}, [0.25, 0.5, 0.75]) q{i}" for i in n)} FROM sc WHERE is_ctx),
rb AS (SELECT p_partkey, y, is_ctx, {", ".join(f"(f{i} - q{i}[2]) / CASE WHEN {iqr[i]} = 0 THEN 1.0 ELSE {iqr[i]} END AS f{i}" for i in n)} FROM sc, q),
{_clip_stage_sql("sc", "c_none")},
{_clip_stage_sql("rb", "c_robust")},
seen AS (SELECT 'none' AS norm, p_partkey, y, is_ctx, [f0, f1, f2] AS x FROM c_none UNION ALL SELECT 'robust', p_partkey, y, is_ctx, [f0, f1, f2] FROM c_robust),
v AS (SELECT p_partkey, is_ctx, CAST(member AS INTEGER) AS member, norm, CAST(shift AS INTEGER) AS shift, CAST((y + shift) % {_N_TYPES} AS INTEGER) AS y,
             x[pattern[1]] AS f0, x[pattern[2]] AS f1, x[pattern[3]] AS f2 FROM seen JOIN {_cfg_sql()} USING (norm))
"""


def _views(spark, sf_dir):
    """All rows of part as every member of the ensemble sees them."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_partkey").alias("key"), *[F.col(c).cast("double") for c in _VIEW_FEATURES[:2]],
                                            (uniform("ctx", "p_partkey") < 0.5).alias("is_ctx"))
    p = TG.label_encode(p, "p_type", TG.label_dictionary(p, "p_type"), "y")
    ctx = p.where("is_ctx").persist()
    fitted = {}
    for norm in ("none", "robust"):
        names = [f"{c}__{norm}" for c in _VIEW_FEATURES]
        fitted[norm] = Preprocess(names, norm).fit(ctx.select(*[F.col(c).cast("double").alias(n) for c, n in zip(_VIEW_FEATURES, names)]))
    ctx.unpersist()
    return EN.normalised_views(p, _VIEW_FEATURES, "y", _configs(), _N_TYPES, fitted)


@register("ensemble_expand", _views_sql() + """
SELECT p_partkey, member, norm, y, round(f0, 6) AS f0, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM v""")
def _expand(spark, sf_dir):
    """Every member's rows: preprocessed by its normaliser, permuted, labels shifted."""
    v = _views(spark, sf_dir)
    return v.select("p_partkey", F.col("member").cast("int").alias("member"), "norm", F.col("y").cast("int").alias("y"),
                    *[r6(F.col("x")[i]).alias(f"f{i}") for i in range(3)])


@register("cross_join_views", f"""
SELECT p_partkey, CAST(member AS INTEGER) AS member, norm, CAST(shift AS INTEGER) AS shift FROM part, {_cfg_sql()}""")
def _cross_views(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey")
    v = p.select("p_partkey", F.inline(EN.configs_column(_configs())))
    return v.select("p_partkey", F.col("member").cast("int").alias("member"), "norm", F.col("shift").cast("int").alias("shift"))


# ---------------------------------------------------------------- kernel
_EMB = "CAST(embedding AS DOUBLE[])"


@register("score_kernel", f"""
WITH e AS (SELECT vec_id, {_EMB} AS x, label, {u_sql('ctx', 'vec_id')} < 0.5 AS is_ctx FROM embeddings),
c AS (SELECT * FROM e WHERE is_ctx),
q AS (SELECT * FROM e WHERE NOT is_ctx),
l AS (SELECT q.vec_id, c.label, -list_sum(list_transform(list_zip(q.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) / 64.0 AS lg
      FROM q, c),
w AS (SELECT vec_id, label, exp(lg - max(lg) OVER (PARTITION BY vec_id)) AS w FROM l),
s AS (SELECT vec_id, label, sum(w) AS w FROM w GROUP BY 1, 2),
t AS (SELECT vec_id, sum(w) AS tot FROM s GROUP BY 1)
SELECT q.vec_id, CAST(k AS INTEGER) AS class_idx, round(coalesce(s.w / t.tot, 0.0), 6) AS score
FROM q CROSS JOIN range(10) r(k) JOIN t ON t.vec_id = q.vec_id LEFT JOIN s ON s.vec_id = q.vec_id AND s.label = k""")
def _score_kernel(spark, sf_dir):
    """All queries against all context rows."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label", (uniform("ctx", "vec_id") < 0.5).alias("is_ctx"))
    s = S.block_scores(e.where("NOT is_ctx"), e.where("is_ctx"), ["vec_id"], "x", "label", S.KernelVote(10))
    return s.select("vec_id", F.posexplode_outer("scores").alias("class_idx", "score")).select(
        "vec_id", F.col("class_idx").cast("int").alias("class_idx"), r6("score").alias("score"))


@register("context_score", _views_sql() + f"""
, l AS (SELECT q.p_partkey, q.member, (c.y - q.shift + {_N_TYPES}) % {_N_TYPES} AS k,
             -((q.f0 - c.f0) * (q.f0 - c.f0) + (q.f1 - c.f1) * (q.f1 - c.f1) + (q.f2 - c.f2) * (q.f2 - c.f2)) / 3.0 AS lg
      FROM v q JOIN v c ON q.member = c.member WHERE c.is_ctx AND NOT q.is_ctx),
w AS (SELECT p_partkey, member, k, exp(lg - max(lg) OVER (PARTITION BY p_partkey, member)) AS w FROM l),
s AS (SELECT p_partkey, member, k, sum(w) AS w FROM w GROUP BY ALL),
t AS (SELECT p_partkey, member, sum(w) AS tot FROM s GROUP BY ALL),
m AS (SELECT p_partkey, member, r.k, coalesce(s.w / tot, 0.0) AS score FROM t CROSS JOIN range({_N_TYPES}) r(k) LEFT JOIN s USING (p_partkey, member, k))
SELECT p_partkey, CAST(k AS INTEGER) AS class_idx, round(avg(score), 6) AS score, count(*) AS n_members FROM m GROUP BY 1, 2""")
def _context_score(spark, sf_dir):
    """Every member scores all query rows of its view against all its context
    rows; class shifts are undone and the members averaged."""
    v = stored(_views(spark, sf_dir).select("p_partkey", "is_ctx", "member", "shift", "x", "y"), "views")
    s = S.block_scores(v.where("NOT is_ctx"), v.where("is_ctx"), ["member", "shift", "p_partkey"], "x", "y", S.KernelVote(_N_TYPES), by=["member", "shift"],
                       piece=1 << 20)  # three features: a slice of few bytes, whose sums by box are made once a group
    a = EN.average_members_long(s.withColumn("scores", EN.unshift(F.col("scores"), F.col("shift"))), ["p_partkey"], "scores")
    return a.select("p_partkey", F.col("class_idx").cast("int").alias("class_idx"), r6("score").alias("score"), "n_members")


@register("unshift_scores", f"""
SELECT vec_id, CAST(i AS INTEGER) AS i,
       round({_EMB}[((i + vec_id % 64) % 64) + 1], 6) AS v FROM embeddings, range(64) r(i)""")
def _unshift(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    s = F.col("embedding").cast("array<double>")
    x = e.select("vec_id", rotate_back(s, F.pmod(F.col("vec_id"), F.lit(64)).cast("int")).alias("s"))
    return x.select("vec_id", F.posexplode_outer("s").alias("i", "v")).select(
        "vec_id", F.col("i").cast("int").alias("i"), r6("v").alias("v"))


@register("average_members", f"""
SELECT vec_id, CAST(k AS INTEGER) AS class_idx, round(avg({_EMB}[m * 8 + k + 1]), 6) AS score, count(*) AS n_members
FROM embeddings, range(8) a(m), range(8) b(k) GROUP BY vec_id, k""")
def _average(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    members = e.select("vec_id", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("member"), "e")
    members = members.select("vec_id", "member", F.slice("e", F.col("member") * 8 + 1, 8).alias("scores"))
    a = EN.average_members_long(members, ["vec_id"], "scores")
    return a.select("vec_id", F.col("class_idx").cast("int").alias("class_idx"), r6("score").alias("score"), "n_members")


@register("softmax_temperature", f"""
WITH e AS (SELECT vec_id, {_EMB} AS s FROM embeddings),
x AS (SELECT vec_id, k, exp((s[k + 1] - list_max(s)) / 0.9) AS v FROM e, range(64) r(k))
SELECT vec_id, CAST(k AS INTEGER) AS class_idx, round(v / sum(v) OVER (PARTITION BY vec_id), 6) AS p FROM x""")
def _softmax(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("s"))
    x = e.select("vec_id", softmax("s", 0.9).alias("p"))
    return x.select("vec_id", F.posexplode_outer("p").alias("class_idx", "p")).select(
        "vec_id", F.col("class_idx").cast("int").alias("class_idx"), r6("p").alias("p"))


@register("normalise_scores", f"""
WITH e AS (SELECT vec_id, list_transform({_EMB}, lambda v: abs(v)) AS s FROM embeddings)
SELECT vec_id, CAST(k AS INTEGER) AS class_idx, round(s[k + 1] / list_sum(s), 6) AS p FROM e, range(64) r(k)""")
def _normalise(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda v: F.abs(v)).alias("s"))
    x = e.select("vec_id", normalise("s").alias("p"))
    return x.select("vec_id", F.posexplode_outer("p").alias("class_idx", "p")).select(
        "vec_id", F.col("class_idx").cast("int").alias("class_idx"), r6("p").alias("p"))


# --------------------------------------------------------- hierarchical
_H_FEATS = ["p_size", "p_retailprice"]


def _tree_levels_sql(depth: int = 3) -> str:
    """paths(class_idx, node, grp): the class tree of at most 10 outcomes a node, ``depth`` levels."""
    levels, last = [], "SELECT class_idx, '' AS node FROM dict"
    for k in range(depth):
        levels.append(f"""lv{k} AS ({last}),
g{k} AS (SELECT *, least(CAST(ceil(n / 10.0) AS BIGINT), 10) AS g FROM (
          SELECT class_idx, node, count(*) OVER (PARTITION BY node) AS n, row_number() OVER (PARTITION BY node ORDER BY class_idx) - 1 AS r FROM lv{k}) t),
y{k} AS (SELECT class_idx, node, n <= 10 AS leaf, CASE WHEN n <= 10 THEN r WHEN r < (n % g) * (n // g + 1) THEN r // (n // g + 1)
              ELSE n % g + (r - (n % g) * (n // g + 1)) // (n // g) END AS grp FROM g{k})""")
        last = f"SELECT class_idx, node || '/' || CAST(grp AS VARCHAR) AS node FROM y{k} WHERE NOT leaf"
    return ",\n".join(levels) + ",\npaths AS (" + " UNION ALL ".join(f"SELECT class_idx, node, grp FROM y{k}" for k in range(depth)) + ")"


def _tree_sql(label: str) -> str:
    means = ", ".join(f"avg({c}) AS c{i}" for i, c in enumerate(_H_FEATS))
    far = " + ".join(f"({c} - c{i}) * ({c} - c{i})" for i, c in enumerate(_H_FEATS))
    return f"""
WITH raw AS (SELECT p_partkey, {label} AS label, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _H_FEATS)}, {u_sql('ctx', 'p_partkey')} < 0.5 AS is_ctx FROM part),
dict AS (SELECT label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS class_idx FROM (SELECT DISTINCT label FROM raw WHERE is_ctx) t),
{_tree_levels_sql()},
cent AS (SELECT node, grp, {means} FROM raw JOIN dict USING (label) JOIN paths USING (class_idx) WHERE is_ctx GROUP BY 1, 2),
l AS (SELECT p_partkey, node, grp, -sqrt({far}) / 0.9 AS l FROM raw, cent WHERE NOT is_ctx),
z AS (SELECT *, l - max(l) OVER (PARTITION BY p_partkey, node) AS z FROM l),
lp AS (SELECT p_partkey, node, grp, z - ln(sum(exp(z)) OVER (PARTITION BY p_partkey, node)) AS lp FROM z),
pr AS (SELECT p_partkey, class_idx, exp(sum(lp)) AS p FROM lp JOIN paths USING (node, grp) GROUP BY 1, 2)
"""


def _tree_rows(spark, sf_dir, label):
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr(label).alias("label"), *[F.col(c).cast("double").alias(c) for c in _H_FEATS],
                                            (uniform("ctx", "p_partkey") < 0.5).alias("is_ctx"))
    model = S.fit_class_tree(p.where("is_ctx"), _H_FEATS, "label")
    scores = S.node_scores(p.where("NOT is_ctx"), ["p_partkey"], model)
    return S.chain_rule(scores, ["p_partkey"], model), model


@register("hierarchical_predict", _tree_sql("p_brand") + """
SELECT p_partkey, d.label AS prediction, round(0.9 * ln(p + 1e-6), 6) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY p DESC, class_idx) AS k FROM pr) t JOIN dict d USING (class_idx) WHERE k = 1""")
def _hier_predict(spark, sf_dir):
    """25 classes: a root and its leaves."""
    p, model = _tree_rows(spark, sf_dir, "p_brand")
    best = S.tree_logits(S.best_class(p, ["p_partkey"]))
    return TG.label_decode(best, "class_idx", model.dictionary, "prediction").select("p_partkey", "prediction", r6("score").alias("score"))


_MANY = "p_partkey * 37 % 101"


@register("join_chain_rule", _tree_sql(_MANY) + "SELECT p_partkey, class_idx, round(p, 6) AS p, round(0.9 * ln(p + 1e-6), 6) AS score FROM pr")
def _chain(spark, sf_dir):
    """P(class) = product of P(outcome | node) down the tree; 101 classes, three levels."""
    p, _ = _tree_rows(spark, sf_dir, _MANY)
    return S.tree_logits(p).select("p_partkey", "class_idx", r6("p").alias("p"), r6("score").alias("score"))


@register("format_predictions", _CLS_SQL + """
SELECT row_id AS id, prediction, x.l_quantity AS col_1, d.y AS label, round(p, 6) AS p
FROM pr2 JOIN pred USING (row_id) JOIN dict d USING (class_idx) JOIN raw x USING (row_id)""")
def _format(spark, sf_dir):
    """The service's rows (prediction, probabilities as JSON, id, passed-through
    columns), of unlabelled input; the JSON is parsed again to compare it."""
    from tessera.operators.columns import passthrough
    from tessera.plans.classify import FEATURES, apply_classifier, fit_classifier
    li = with_role(lineitem(spark, sf_dir), li_key()).select("row_id", *FEATURES, "l_returnflag", "role")
    m = fit_classifier(li.where("role = 'context'"))
    rows = li.where("role = 'query'").drop("l_returnflag", "role").withColumnRenamed("row_id", "id")
    labels = [r["label"] for r in m.dictionary.orderBy("class_idx").collect()]   # C labels
    q = apply_classifier(rows, m)
    extra = passthrough(rows.select(*FEATURES), [1])
    out = q.select("prediction", S.format_probabilities(labels, F.col("proba")).alias("probabilities"), "id", *extra)
    p = F.from_json("probabilities", "map<string,double>")
    return out.select("id", "prediction", "col_1", F.explode(p).alias("label", "p")).withColumn("p", r6("p"))
