"""Flagship: classify lineitem return flags from a categorical and four
numeric columns.

label dictionary -> ordinal codes and imputed numbers -> constant columns out
-> one preprocessing a normaliser (standard scale, none or power, outlier soft
clip), all fitted on context rows only -> ensemble views -> class-mean scores,
once per distinct view -> class shift undone, members averaged ->
softmax(T=0.9) -> normalise -> argmax -> decode -> accuracy on query rows.
Physical plan: small fit aggregates, then projections over the scan and joins
with dictionaries (no shuffle of the row data while those are small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import columns as C
from tessera.operators import metrics as M
from tessera.operators import scoring as S
from tessera.operators import targets as TG
from tessera.operators.ensemble import ensemble_configs, feature_patterns
from tessera.operators.transforms import Preprocess, ToNumerical, nan_to_null
from tessera.plans.common import LI_FEATURES, li_key, lineitem, r6, with_role
from tessera.plans.registry import register
from tessera.plans.sqlbits import LI_KEY_SQL, digest_sql, soft_clip_sql, u_sql
from tessera.session import compiled, table

N_ESTIMATORS = 8
FEATURES = ["l_linestatus", *LI_FEATURES]
LABEL = "l_returnflag"
NORMS = ("none", "power")


class ClassifierModel:
    """Everything fitted on the context: dictionary, encoder, kept features,
    one preprocessing and the class centres of each normaliser, and the member
    configurations (all bounded by classes x features)."""

    def __init__(self, features, dictionary, labels, n_classes, numeric, kept, steps, centres, configs):
        self.features, self.dictionary, self.labels, self.n_classes = features, dictionary, labels, n_classes
        self.numeric, self.kept, self.steps, self.centres, self.configs = numeric, kept, steps, centres, configs


def _under(cols: list[str], norm: str) -> list[str]:
    return [f"{c}__{norm}" for c in cols]


def _views(df: DataFrame, kept: list[str], norm: str) -> DataFrame:
    return df.withColumns({v: F.col(c) for c, v in zip(kept, _under(kept, norm))})


def _ingest(rows: DataFrame, features: list[str]) -> DataFrame:
    """NaN is missing, whatever the file format said."""
    return nan_to_null(rows, [c for c, t in rows.dtypes if c in features and t in ("double", "float")])


def fit_classifier(context: DataFrame, n_estimators: int = N_ESTIMATORS, features: list[str] | None = None) -> ClassifierModel:
    """Fits read only the context rows: once from the source, then in passes
    over the persisted encoded rows."""
    compiled(context.sparkSession)
    features = features or FEATURES
    C.check_feature_contract(features, context, features)
    context = _ingest(context.select(*features, LABEL), features).persist()
    dictionary = TG.label_dictionary(context, LABEL)
    n_classes = dictionary.count()
    TG.check_class_limit(n_classes, grouping=False)
    labels = [r["label"] for r in dictionary.orderBy("class_idx").collect()]
    numeric = ToNumerical([LABEL]).fit(context)
    x = TG.label_encode(numeric.transform(context), LABEL, dictionary, "y").persist()
    kept = C.varying_columns(x, numeric.features)
    steps, centres = {}, {}
    for norm in NORMS:
        views = _under(kept, norm)
        v = _views(x, kept, norm).select(*views, "y")
        steps[norm] = Preprocess(views, norm).fit(v)
        centres[norm] = S.class_means(steps[norm].transform(v), views, "y")
    x.unpersist()
    context.unpersist()
    patterns = feature_patterns(len(kept), n_estimators, "latin", seed=0)
    configs = ensemble_configs(patterns, n_classes, list(NORMS), n_estimators, class_shift=True, seed=0)
    return ClassifierModel(features, dictionary, labels, n_classes, numeric, kept, steps, centres, configs)


def apply_classifier(rows: DataFrame, m: ClassifierModel) -> DataFrame:
    """Projections and joins with small dictionaries; works on batch and
    streaming frames alike, with or without the label column.  The columns of
    ``rows`` stay as they are."""
    compiled(rows.sparkSession)
    C.check_feature_contract(m.features, rows, m.features)
    inner = {c: f"__in_{c}" for c in m.features}
    x = rows.withColumns({v: F.col(c) for c, v in inner.items()})
    x = _ingest(x, list(inner.values()))
    x = m.numeric.with_inputs(inner).transform_columns(x)
    made = list(inner.values())
    for norm in NORMS:
        views = _under(m.kept, norm)
        x = x.withColumns({v: F.col(inner[c]) for c, v in zip(m.kept, views)})
        x = m.steps[norm].transform(x)
        made += views
    x = S.with_ensemble_logits(x, {n: _under(m.kept, n) for n in NORMS}, m.configs, m.n_classes, m.centres, "logits")
    q = S.with_proba(x.drop(*made), "logits", "proba").withColumn("pred_idx", S.predict_index(F.col("proba")))
    # at most MAX_CLASSES labels, as checked: a literal array, no join over the long projection
    return q.withColumn("prediction", F.element_at(F.array(*[F.lit(x) for x in m.labels]), F.col("pred_idx") + 1))


def classify(spark: SparkSession, sf_dir: str, n_estimators: int = N_ESTIMATORS):
    li = with_role(lineitem(spark, sf_dir), li_key()).select("row_id", *FEATURES, LABEL, "role")
    m = fit_classifier(li.where("role = 'context'"), n_estimators)
    return apply_classifier(li.where("role = 'query'"), m), m.dictionary, m.n_classes


_N = range(len(FEATURES))


def _clipped_sql(src: str, out: str) -> str:
    """Two-stage outlier bounds of f0.. over the context rows of src, then the soft clip."""
    a, b = f"{out}_a", f"{out}_b"
    one = ", ".join(f"avg(f{i}) a{i}, greatest(stddev_samp(f{i}), 1e-6) b{i}" for i in _N)
    inside = [f"CASE WHEN f{i} BETWEEN a{i} - 4 * b{i} AND a{i} + 4 * b{i} THEN f{i} END" for i in _N]
    two = ", ".join(f"avg({x}) a{i}, greatest(stddev_samp({x}), 1e-6) b{i}" for i, x in zip(_N, inside))
    clip = ", ".join(f"{soft_clip_sql(f'f{i}', f'(a{i} - 4 * b{i})', f'(a{i} + 4 * b{i})')} AS f{i}" for i in _N)
    return (f"{a} AS (SELECT {one} FROM {src} WHERE is_ctx),\n{b} AS (SELECT {two} FROM {src}, {a} WHERE is_ctx),\n"
            f"{out} AS (SELECT row_id, y, is_ctx, {clip} FROM {src}, {b})")


def _logits_sql(src: str, out: str) -> str:
    means = ", ".join(f"avg(f{i}) c{i}" for i in _N)
    far = " + ".join(f"(f{i} - c{i}) * (f{i} - c{i})" for i in _N)
    return (f"{out}_m AS (SELECT d.class_idx, {means} FROM {src} JOIN dict d USING (y) WHERE is_ctx GROUP BY d.class_idx),\n"
            f"{out} AS (SELECT q.row_id, q.y, m.class_idx, -sqrt({far}) AS logit FROM {src} q, {out}_m m WHERE NOT q.is_ctx)")


def _base_sql() -> str:
    from tessera.plans.q_transforms import _yj_levels, _yj_sql
    levels, last = _yj_levels()
    fill = ", ".join(f"coalesce(raw.{c}, m{i}) AS f{i + 1}" for i, c in enumerate(LI_FEATURES))
    return f"""
WITH raw AS (SELECT {digest_sql(*LI_KEY_SQL)} AS row_id, l_linestatus, {", ".join(LI_FEATURES)}, l_returnflag AS y,
         {u_sql('role', *LI_KEY_SQL)} < 0.3 AS is_ctx FROM lineitem),
code AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT l_linestatus AS v FROM raw WHERE is_ctx AND l_linestatus IS NOT NULL) t),
fill AS (SELECT {", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(LI_FEATURES))} FROM raw WHERE is_ctx),
base AS (SELECT row_id, y, is_ctx, CAST(coalesce(code, -1) AS DOUBLE) AS f0, {fill} FROM raw LEFT JOIN code ON raw.l_linestatus = code.v, fill),
dict AS (SELECT y, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS class_idx
         FROM (SELECT DISTINCT y FROM base WHERE is_ctx AND y IS NOT NULL) t),
p1 AS (SELECT {", ".join(f"avg(f{i}) m{i}, stddev_pop(f{i}) + 1e-6 s{i}" for i in _N)} FROM base WHERE is_ctx),
sc AS (SELECT row_id, y, is_ctx, {", ".join(f"least(greatest((f{i} - m{i}) / s{i}, -100), 100) AS f{i}" for i in _N)} FROM base, p1),
lng AS ({" UNION ALL ".join(f"SELECT {i} AS f, f{i} AS x FROM sc WHERE is_ctx" for i in _N)}),
{levels},
lams AS (SELECT {", ".join(f"round(max(lam) FILTER (f = {i}), 6) AS l{i}" for i in _N)} FROM {last}),
ys AS (SELECT row_id, y, is_ctx, {", ".join(f"{_yj_sql(f'f{i}', f'l{i}')} AS f{i}" for i in _N)} FROM sc, lams),
yst AS (SELECT {", ".join(f"avg(f{i}) m{i}, stddev_pop(f{i}) s{i}" for i in _N)} FROM ys WHERE is_ctx),
pw AS (SELECT row_id, y, is_ctx, {", ".join(f"(f{i} - m{i}) / CASE WHEN s{i} = 0 THEN 1.0 ELSE s{i} END AS f{i}" for i in _N)} FROM ys, yst),
{_clipped_sql("sc", "cn")},
{_clipped_sql("pw", "cp")},
{_logits_sql("cn", "ln_")},
{_logits_sql("cp", "lp_")},
lg AS (SELECT row_id, n.y, class_idx, (n.logit + p.logit) / 2 AS logit FROM ln_ n JOIN lp_ p USING (row_id, class_idx)),
sm AS (SELECT row_id, y, class_idx, exp((logit - max(logit) OVER (PARTITION BY row_id)) / 0.9) AS e FROM lg),
pr AS (SELECT row_id, y, class_idx, e / sum(e) OVER (PARTITION BY row_id) AS p FROM sm),
pr2 AS (SELECT row_id, y, class_idx, p / sum(p) OVER (PARTITION BY row_id) AS p FROM pr),
am AS (SELECT row_id, y, min(class_idx) AS pred_idx FROM
         (SELECT *, max(p) OVER (PARTITION BY row_id) AS mp FROM pr2) t WHERE p = mp GROUP BY row_id, y),
pred AS (SELECT am.row_id, am.y AS l_returnflag, am.pred_idx, d.y AS prediction FROM am JOIN dict d ON d.class_idx = am.pred_idx)
"""


_BASE_SQL = _base_sql()


def _accuracy(spark, sf_dir):
    q, _, _ = classify(spark, sf_dir)
    a = M.accuracy(q, "prediction", "l_returnflag")
    return a.select("n", "correct", r6("accuracy").alias("accuracy"))


register("accuracy_micro", _BASE_SQL + """
SELECT count(*) AS n, CAST(sum(CASE WHEN prediction = l_returnflag THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(sum(CASE WHEN prediction = l_returnflag THEN 1 ELSE 0 END) / count(*), 6) AS accuracy FROM pred
""")(_accuracy)


@register("predict_labels", _BASE_SQL + "SELECT row_id, prediction FROM pred")
def _predict_labels(spark, sf_dir):
    q, _, _ = classify(spark, sf_dir)
    return q.select("row_id", "prediction")


@register("argmax_class", _BASE_SQL + "SELECT row_id, pred_idx FROM pred")
def _argmax(spark, sf_dir):
    q, _, _ = classify(spark, sf_dir)
    return q.select("row_id", "pred_idx")


@register("predict_proba", _BASE_SQL + "SELECT row_id, class_idx, round(p, 6) AS p FROM pr2")
def _predict_proba(spark, sf_dir):
    q, _, _ = classify(spark, sf_dir)
    return q.select("row_id", F.posexplode_outer("proba").alias("class_idx", "p")).select(
        "row_id", F.col("class_idx").cast("int").alias("class_idx"), r6("p").alias("p"))


@register("score_class_mean", _BASE_SQL + "SELECT row_id, class_idx, round(logit, 6) AS logit FROM lg")
def _score_class_mean(spark, sf_dir):
    q, _, _ = classify(spark, sf_dir)
    return q.select("row_id", F.posexplode_outer("logits").alias("class_idx", "logit")).select(
        "row_id", F.col("class_idx").cast("int").alias("class_idx"), r6("logit").alias("logit"))


_DICT_SQL = f"""
WITH raw AS (SELECT l_returnflag AS y, {u_sql('role', *LI_KEY_SQL)} < 0.3 AS is_ctx FROM lineitem),
dict AS (SELECT y, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS class_idx
         FROM (SELECT DISTINCT y FROM raw WHERE is_ctx AND y IS NOT NULL) t)
"""


def _dictionary(spark, sf_dir):
    """All rows and the label dictionary of the context rows."""
    li = with_role(table(spark, sf_dir, "lineitem"), li_key()).select(LABEL, "role")
    return li, TG.label_dictionary(li.where("role = 'context'"), LABEL)


@register("join_label_decode", _BASE_SQL + "SELECT pred_idx, prediction, count(*) AS n FROM pred GROUP BY ALL")
def _decode(spark, sf_dir):
    """Every query row is classified; the predicted classes are decoded by a join with the dictionary."""
    q, d, _ = classify(spark, sf_dir)
    return TG.label_decode(q.groupBy("pred_idx").agg(F.count(F.lit(1)).alias("n")), "pred_idx", d, "prediction")


@register("label_encode", _DICT_SQL + "SELECT y AS label, class_idx FROM dict")
def _label_encode(spark, sf_dir):
    return _dictionary(spark, sf_dir)[1]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accuracy(spark, sf_dir)
