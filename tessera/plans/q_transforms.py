"""Queries for the fitted transforms.  Every fit sees context
rows only (md5-role sample); every transform is applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import transforms as TR
from tessera.plans.common import LI_FEATURES, li_key, lineitem, r6, with_role
from tessera.plans.registry import register
from tessera.plans.sqlbits import LI_KEY_SQL, digest_sql, probit_sql, soft_clip_sql, u_sql
from tessera.session import table

_ROLE = f"{u_sql('role', *LI_KEY_SQL)} < 0.3"


def _li(spark, sf_dir, extra=None):
    li = with_role(lineitem(spark, sf_dir), li_key())
    if extra:
        li = li.withColumns(extra)
    return li


def _li_sql(cols: str) -> str:
    return f"(SELECT {digest_sql(*LI_KEY_SQL)} AS row_id, {_ROLE} AS is_ctx, {cols} FROM lineitem)"


def _out(df, cols):
    return df.select("row_id", *[r6(c).alias(c) for c in cols])


# ------------------------------------------------------------ encode / impute
@register("ordinal_encode", f"""
WITH c AS (SELECT *, {u_sql('ctx', 'c_custkey')} < 0.5 AS is_ctx FROM customer),
d1 AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
       FROM (SELECT DISTINCT c_mktsegment AS v FROM c WHERE is_ctx AND c_mktsegment IS NOT NULL) t),
d2 AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS BIGINT) AS code
       FROM (SELECT DISTINCT c_name AS v FROM c WHERE is_ctx AND c_name IS NOT NULL) t)
SELECT c.c_custkey, coalesce(d1.code, -1) AS c_mktsegment, coalesce(d2.code, -1) AS c_name
FROM c LEFT JOIN d1 ON c.c_mktsegment = d1.v LEFT JOIN d2 ON c.c_name = d2.v""")
def _ordinal(spark, sf_dir):
    from tessera.functions.hashing import uniform
    c = table(spark, sf_dir, "customer").withColumn("is_ctx", uniform("ctx", "c_custkey") < 0.5)
    enc = TR.OrdinalEncode(["c_mktsegment", "c_name"]).fit(c.where("is_ctx"))
    return enc.transform(c).select("c_custkey", "c_mktsegment", "c_name")


@register("mean_impute", f"""
WITH x AS {_li_sql("CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax_f, l_quantity")},
m AS (SELECT avg(tax_f) AS mt, avg(l_quantity) AS mq FROM x WHERE is_ctx)
SELECT row_id, round(coalesce(tax_f, mt), 6) AS tax_f, round(coalesce(l_quantity, mq), 6) AS l_quantity FROM x, m""")
def _impute(spark, sf_dir):
    li = _li(spark, sf_dir, {"tax_f": F.when(F.col("l_linestatus") == "F", F.col("l_tax")),
                             "all_null": F.lit(None).cast("double")})
    imp = TR.MeanImpute(["tax_f", "l_quantity", "all_null"]).fit(li.where("role = 'context'"))
    return _out(imp.transform(li), imp.kept)


@register("to_numerical", f"""
WITH o AS (SELECT *, {u_sql('ctx', 'o_orderkey')} < 0.5 AS is_ctx FROM orders),
d1 AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
       FROM (SELECT DISTINCT o_orderstatus AS v FROM o WHERE is_ctx AND o_orderstatus IS NOT NULL) t),
d2 AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
       FROM (SELECT DISTINCT o_orderpriority AS v FROM o WHERE is_ctx AND o_orderpriority IS NOT NULL) t),
m AS (SELECT avg(o_custkey) AS mc, avg(o_totalprice) AS mp FROM o WHERE is_ctx)
SELECT o.o_orderkey, CAST(coalesce(d1.code, -1) AS DOUBLE) AS o_orderstatus,
       CAST(coalesce(d2.code, -1) AS DOUBLE) AS o_orderpriority,
       round(coalesce(CAST(o_custkey AS DOUBLE), mc), 6) AS o_custkey, round(coalesce(o_totalprice, mp), 6) AS o_totalprice
FROM o LEFT JOIN d1 ON o.o_orderstatus = d1.v LEFT JOIN d2 ON o.o_orderpriority = d2.v, m""")
def _to_numerical(spark, sf_dir):
    from tessera.functions.hashing import uniform
    o = table(spark, sf_dir, "orders").withColumn("is_ctx", uniform("ctx", "o_orderkey") < 0.5)
    t = TR.ToNumerical(exclude=["o_orderkey", "is_ctx"]).fit(o.where("is_ctx"))
    out = t.transform(o)
    return out.select("o_orderkey", *[r6(c).alias(c) for c in t.features])


# ----------------------------------------------------------------- scalers
def _scale_sql(feats):
    p = ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) + 1e-6 s_{c}" for c in feats)
    v = ", ".join(f"round(least(greatest(({c} - m_{c}) / s_{c}, -100), 100), 6) AS {c}" for c in feats)
    return f"""WITH x AS {_li_sql(', '.join(feats))}, p AS (SELECT {p} FROM x WHERE is_ctx)
SELECT row_id, {v} FROM x, p"""


@register("standard_scale_clip", _scale_sql(LI_FEATURES))
def _std_clip(spark, sf_dir):
    li = _li(spark, sf_dir)
    s = TR.StandardScaleClip(LI_FEATURES).fit(li.where("role = 'context'"))
    return _out(s.transform(li), LI_FEATURES)


def _nan_std_sql(c):
    return f"CASE WHEN count(*) > 1 THEN stddev_samp({c}) ELSE stddev_pop({c}) END"


@register("standard_scale_nan", f"""
WITH x AS {_li_sql("l_suppkey, l_quantity, CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax_f")},
p AS (SELECT l_suppkey, avg(l_quantity) mq, CASE WHEN {_nan_std_sql('l_quantity')} IS NULL THEN NULL
             ELSE greatest({_nan_std_sql('l_quantity')}, 1e-6) END sq,
             avg(tax_f) mt, CASE WHEN {_nan_std_sql('tax_f')} IS NULL THEN NULL ELSE greatest({_nan_std_sql('tax_f')}, 1e-6) END st
      FROM x GROUP BY l_suppkey)
SELECT row_id, round(least(greatest((l_quantity - mq) / sq, -100), 100), 6) AS l_quantity,
       CASE WHEN (tax_f - mt) / st IS NOT NULL THEN round(least(greatest((tax_f - mt) / st, -100), 100), 6) END AS tax_f
FROM x JOIN p USING (l_suppkey)""")
def _std_nan(spark, sf_dir):
    li = _li(spark, sf_dir, {"tax_f": F.when(F.col("l_linestatus") == "F", F.col("l_tax"))})
    s = TR.StandardScaleNan(["l_quantity", "tax_f"], ["l_suppkey"]).fit(li)
    return _out(s.transform(li), ["l_quantity", "tax_f"])


# --------------------------------------------------------------- clippers
_SOFT_T = 1.5
_SOFT_COLS = LI_FEATURES


def _soft_sql():
    cols = _SOFT_COLS
    t = _SOFT_T
    s1 = ", ".join(f"avg({c}) a_{c}, greatest(stddev_samp({c}), 1e-6) b_{c}" for c in cols)
    inb = {c: f"CASE WHEN {c} >= a_{c} - {t} * b_{c} AND {c} <= a_{c} + {t} * b_{c} THEN {c} END" for c in cols}
    s2 = ", ".join(f"avg({inb[c]}) a_{c}, greatest(stddev_samp({inb[c]}), 1e-6) b_{c}" for c in cols)
    # clipped prices are ~1e4 with aggregate-order noise ~1e-7: compare at 3 decimals
    v = ", ".join(f"round({soft_clip_sql(c, f'a_{c} - {t} * b_{c}', f'a_{c} + {t} * b_{c}')}, 3) AS {c}" for c in cols)
    return f"""WITH x AS {_li_sql(', '.join(cols))}, s1 AS (SELECT {s1} FROM x WHERE is_ctx),
s2 AS (SELECT {s2} FROM x, s1 WHERE is_ctx)
SELECT row_id, {v} FROM x, s2"""


@register("outlier_soft_clip", _soft_sql())
def _soft(spark, sf_dir):
    li = _li(spark, sf_dir)
    c = TR.OutlierSoftClip(_SOFT_COLS, threshold=_SOFT_T).fit(li.where("role = 'context'"))
    return c.transform(li).select("row_id", *[F.round(c_, 3).alias(c_) for c_ in _SOFT_COLS])


def _hard_sql():
    cols = ["l_quantity", "tax_f"]
    t = _SOFT_T
    def sd(e):
        s = f"CASE WHEN count(*) > 1 THEN stddev_samp({e}) ELSE stddev_pop({e}) END"
        return f"CASE WHEN {s} IS NULL THEN NULL ELSE greatest({s}, 1e-6) END"
    s1 = ", ".join(f"avg({c}) a_{c}, {sd(c)} b_{c}" for c in cols)
    inb = {c: f"CASE WHEN {c} >= a_{c} - b_{c} * {t} AND {c} <= a_{c} + b_{c} * {t} THEN {c} END" for c in cols}
    s2 = ", ".join(f"coalesce(avg({inb[c]}), first(a_{c})) m_{c}, coalesce({sd(inb[c])}, 0.0) d_{c}" for c in cols)
    v = ", ".join(
        f"round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, coalesce(m_{c} - d_{c} * {t}, '-inf'::DOUBLE)), "
        f"coalesce(m_{c} + d_{c} * {t}, 'inf'::DOUBLE)) END, 6) AS {c}" for c in cols)
    return f"""WITH x AS {_li_sql("l_suppkey, l_quantity, CASE WHEN l_linestatus = 'F' THEN l_tax END AS tax_f")},
s1 AS (SELECT l_suppkey, {s1} FROM x GROUP BY l_suppkey),
s2 AS (SELECT l_suppkey, {s2} FROM x JOIN s1 USING (l_suppkey) GROUP BY l_suppkey)
SELECT row_id, {v} FROM x JOIN s2 USING (l_suppkey)"""


@register("outlier_hard_clip", _hard_sql())
def _hard(spark, sf_dir):
    li = _li(spark, sf_dir, {"tax_f": F.when(F.col("l_linestatus") == "F", F.col("l_tax"))})
    out = TR.OutlierHardClip(["l_quantity", "tax_f"], ["l_suppkey"], threshold=_SOFT_T).fit_transform(li)
    return _out(out, ["l_quantity", "tax_f"])


# ------------------------------------------------------------ normalisers
_YJ_COLS = LI_FEATURES


def _yj_sql(x, lam):
    return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {x}) ELSE (pow({x} + 1.0, {lam}) - 1.0) / {lam} END) "
            f"ELSE (CASE WHEN abs({lam} - 2.0) < 1e-12 THEN -ln(1 - {x}) ELSE -(pow(-{x} + 1.0, 2.0 - {lam}) - 1.0) / (2.0 - {lam}) END) END")


def _yj_levels(steps=(0.5, 0.0625, 0.0078125, 0.0009765625, 0.0001220703125)):
    """The lambda of each feature of lng (f, x): 17 points a level, first over
    [-4, 4], then over the two steps around the best."""
    best = lambda level: f"""(SELECT f, arg_max(lam, ll) AS lam FROM (
  SELECT f, lam, -0.5 * count(*) * ln(var_pop({_yj_sql('x', 'lam')})) + (lam - 1.0) * sum(sign(x) * ln(1 + abs(x))) AS ll
  FROM lng JOIN grid{level} USING (f) GROUP BY f, lam) q GROUP BY f)"""
    out = ["grid0 AS (SELECT f, round(-4.0 + 0.5 * k, 9) AS lam FROM (SELECT DISTINCT f FROM lng) a, range(17) r(k))", f"best0 AS {best(0)}"]
    for n, (wide, _) in enumerate(zip(steps, steps[1:]), 1):
        out += [f"grid{n} AS (SELECT f, round(round(lam - {wide!r}, 9) + (round(lam + {wide!r}, 9) - round(lam - {wide!r}, 9)) * k / 16, 9) AS lam "
                f"FROM best{n - 1}, range(17) r(k))", f"best{n} AS {best(n)}"]
    return ",\n".join(out), f"best{len(steps) - 1}"


def _yj_oracle():
    longs = " UNION ALL ".join(f"SELECT {i} AS f, {c} AS x FROM x WHERE is_ctx AND {c} IS NOT NULL"
                               for i, c in enumerate(_YJ_COLS))
    levels, last = _yj_levels()
    lam = ", ".join(f"round(max(lam) FILTER (f = {i}), 6) AS l{i}" for i in range(len(_YJ_COLS)))
    stats = ", ".join(f"avg({_yj_sql(c, f'l{i}')}) m{i}, stddev_pop({_yj_sql(c, f'l{i}')}) s{i}" for i, c in enumerate(_YJ_COLS))
    outs = ", ".join(f"round(({_yj_sql(c, f'l{i}')} - m{i}) / CASE WHEN s{i} = 0 THEN 1.0 ELSE s{i} END, 6) AS {c}"
                     for i, c in enumerate(_YJ_COLS))
    return f"""WITH x AS {_li_sql(', '.join(_YJ_COLS))},
lng AS ({longs}),
{levels},
lams AS (SELECT {lam} FROM {last}),
st AS (SELECT {stats} FROM x, lams WHERE is_ctx)
SELECT row_id, {outs} FROM x, lams, st"""


def _context(li):
    """The labelled rows, persisted by the caller of a fit of several passes."""
    return li.where("role = 'context'").select("row_id", *LI_FEATURES).persist()


@register("power_yeo_johnson", _yj_oracle())
def _yj(spark, sf_dir):
    li = _li(spark, sf_dir)
    ctx = _context(li)
    y = TR.YeoJohnson(_YJ_COLS).fit(ctx)
    ctx.unpersist()
    return _out(y.transform(li), _YJ_COLS)


def _quantile_sql(nq, scaled=False):
    """Normal quantile transform of each feature: exact quantiles at i / (nq - 1)
    of the context, interpolated from both sides, then probit."""
    eps, b = 2.220446049250313e-16, 1e-7
    ctes, cols, joins = [], [], []
    for i, c in enumerate(LI_FEATURES):
        ctes.append(f"""s{i} AS (SELECT list({c} ORDER BY {c}) AS l, count({c}) AS n, {nq} AS nq FROM x WHERE is_ctx AND {c} IS NOT NULL),
k{i} AS (SELECT CASE WHEN l[CAST(floor(pos) AS BIGINT) + 1] = l[CAST(ceil(pos) AS BIGINT) + 1] THEN l[CAST(floor(pos) AS BIGINT) + 1]
    ELSE (ceil(pos) - pos) * l[CAST(floor(pos) AS BIGINT) + 1] + (pos - floor(pos)) * l[CAST(ceil(pos) AS BIGINT) + 1] END AS v, r
  FROM (SELECT l, k / CAST(nq - 1 AS DOUBLE) AS r, k / CAST(nq - 1 AS DOUBLE) * (n - 1) AS pos FROM (SELECT l, n, nq, unnest(range(nq)) AS k FROM s{i}) a) b),
g{i} AS (SELECT v, rf, rl, lead(v) OVER (ORDER BY v) AS vn, lead(rf) OVER (ORDER BY v) AS rfn
  FROM (SELECT v, min(r) AS rf, max(r) AS rl FROM k{i} GROUP BY v) a),
e{i} AS (SELECT min(v) AS lo, max(v) AS hi FROM k{i}),
p{i} AS (SELECT x.row_id, x.is_ctx, CASE WHEN {c} - {b} < lo THEN 0.0 WHEN {c} + {b} > hi THEN 1.0 WHEN {c} = g.v THEN (rf + rl) * 0.5
    ELSE rl + ({c} - g.v) * (rfn - rl) / (vn - g.v) END AS p
  FROM x CROSS JOIN e{i} ASOF LEFT JOIN g{i} g ON x.{c} >= g.v),
z{i} AS (SELECT row_id, is_ctx, least(greatest({probit_sql(f'least(greatest(p, {b}), {1 - b!r})')},
    {probit_sql(f'{b - eps!r}')}), {probit_sql(f'{1 - (b - eps)!r}')}) AS z FROM p{i}),
t{i} AS (SELECT avg(z) AS m, stddev_pop(z) AS s FROM z{i} WHERE is_ctx)""")
        cols.append(f"round((z{i}.z - t{i}.m) / CASE WHEN t{i}.s = 0 THEN 1.0 ELSE t{i}.s END, 6) AS {c}" if scaled else f"round(z{i}.z, 6) AS {c}")
        joins.append(f"JOIN z{i} USING (row_id)" + (f" CROSS JOIN t{i}" if scaled else ""))
    return f"""WITH x AS {_li_sql(', '.join(LI_FEATURES))}, {', '.join(ctes)}
SELECT x.row_id, {', '.join(cols)} FROM x {' '.join(joins)}"""


@register("quantile_normal", _quantile_sql("least(1000, count(*))"))
def _qn(spark, sf_dir):
    li = _li(spark, sf_dir)
    ctx = _context(li)
    q = TR.QuantileNormal(LI_FEATURES).fit(ctx)
    ctx.unpersist()
    return _out(q.transform(li), LI_FEATURES)


@register("quantile_rtdl", _quantile_sql("greatest(least(count(*) // 30, 1000), 10)", scaled=True))
def _qr(spark, sf_dir):
    li = _li(spark, sf_dir)
    ctx = _context(li)
    q = TR.QuantileRtdl(LI_FEATURES, ["row_id"], noise=0.0).fit(ctx)
    ctx.unpersist()
    return _out(q.transform(li), LI_FEATURES)


_RB_COLS = LI_FEATURES


def _robust_sql(src_cols: str, cols, wrap_src: str | None = None):
    q = ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) q_{c}" for c in cols)
    sc = {c: f"CASE WHEN (q_{c}[3] - q_{c}[1]) / 1.3489795003921634 = 0 THEN 1.0 ELSE (q_{c}[3] - q_{c}[1]) / 1.3489795003921634 END"
          for c in cols}
    v = ", ".join(f"round(({c} - q_{c}[2]) / ({sc[c]}), 6) AS {c}" for c in cols)
    return f"WITH x AS {_li_sql(src_cols)}, q AS (SELECT {q} FROM x WHERE is_ctx) SELECT row_id, {v} FROM x, q"


@register("robust_scale", _robust_sql(", ".join(_RB_COLS), _RB_COLS))
def _robust(spark, sf_dir):
    li = _li(spark, sf_dir)
    r = TR.RobustScale(_RB_COLS).fit(li.where("role = 'context'"))
    return _out(r.transform(li), _RB_COLS)


def _pipeline_sql():
    cols = _RB_COLS
    p = ", ".join(f"avg({c}) m_{c}, stddev_pop({c}) + 1e-6 s_{c}" for c in cols)
    sc = ", ".join(f"least(greatest(({c} - m_{c}) / s_{c}, -100), 100) AS {c}" for c in cols)
    q = ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) q_{c}" for c in cols)
    rs = {c: f"CASE WHEN (q_{c}[3] - q_{c}[1]) / 1.3489795003921634 = 0 THEN 1.0 ELSE (q_{c}[3] - q_{c}[1]) / 1.3489795003921634 END"
          for c in cols}
    rv = ", ".join(f"({c} - q_{c}[2]) / ({rs[c]}) AS {c}" for c in cols)
    s1 = ", ".join(f"avg({c}) a_{c}, greatest(stddev_samp({c}), 1e-6) b_{c}" for c in cols)
    inb = {c: f"CASE WHEN {c} >= a_{c} - 4.0 * b_{c} AND {c} <= a_{c} + 4.0 * b_{c} THEN {c} END" for c in cols}
    s2 = ", ".join(f"avg({inb[c]}) a_{c}, greatest(stddev_samp({inb[c]}), 1e-6) b_{c}" for c in cols)
    v = ", ".join(f"round({soft_clip_sql(c, f'a_{c} - 4.0 * b_{c}', f'a_{c} + 4.0 * b_{c}')}, 6) AS {c}" for c in cols)
    return f"""WITH x AS {_li_sql(', '.join(cols))}, p AS (SELECT {p} FROM x WHERE is_ctx),
y AS (SELECT row_id, is_ctx, {sc} FROM x, p), q AS (SELECT {q} FROM y WHERE is_ctx),
z AS (SELECT row_id, is_ctx, {rv} FROM y, q),
s1 AS (SELECT {s1} FROM z WHERE is_ctx), s2 AS (SELECT {s2} FROM z, s1 WHERE is_ctx)
SELECT row_id, {v} FROM z, s2"""


@register("preprocess_pipeline", _pipeline_sql())
def _pipeline(spark, sf_dir):
    li = _li(spark, sf_dir)
    ctx = _context(li)
    p = TR.Preprocess(_RB_COLS, "robust").fit(ctx)
    ctx.unpersist()
    return _out(p.transform(li), _RB_COLS)


@register("minmax_0_999", f"""
WITH x AS {_li_sql("l_quantity, l_extendedprice, 5.0 AS const_c, l_returnflag")},
m AS (SELECT min(l_quantity) a1, max(l_quantity) b1, min(l_extendedprice) a2, max(l_extendedprice) b2 FROM x WHERE is_ctx)
SELECT row_id, round((l_quantity - a1) * 999.0 / (b1 - a1), 6) AS l_quantity,
       round((l_extendedprice - a2) * 999.0 / (b2 - a2), 6) AS l_extendedprice, 0.0 AS const_c, l_returnflag FROM x, m""")
def _minmax(spark, sf_dir):
    li = _li(spark, sf_dir, {"const_c": F.lit(5.0)})
    cols = ["l_quantity", "l_extendedprice", "const_c"]
    m = TR.MinMax999(cols).fit(li.where("role = 'context'"))
    out = m.transform(li)
    return out.select("row_id", *[r6(c).alias(c) for c in cols], "l_returnflag")


@register("zscore_numeric_only", """
WITH m AS (SELECT avg(o_totalprice) a1, stddev_pop(o_totalprice) + 1e-6 s1, avg(o_custkey) a2, stddev_pop(o_custkey) + 1e-6 s2 FROM orders)
SELECT o_orderkey, round((o_totalprice - a1) / s1, 6) AS o_totalprice, round((o_custkey - a2) / s2, 6) AS o_custkey,
       o_orderstatus FROM orders, m""")
def _zscore(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    z = TR.ZScore(["o_totalprice", "o_custkey"]).fit(o)
    out = z.transform(o)
    return out.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), r6("o_custkey").alias("o_custkey"),
                      "o_orderstatus")


@register("scale_by_feature_share", """
SELECT o_orderkey, CAST(f AS INTEGER) AS f, round([o_totalprice, CAST(o_custkey AS DOUBLE)][f + 1] / (2.0 / 10.0), 6) AS v
FROM orders, range(2) r(f)""")
def _share(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    x = o.select("o_orderkey", TR.scale_by_feature_share(
        F.array(F.col("o_totalprice"), F.col("o_custkey").cast("double")), F.lit(2), 10).alias("x"))
    return x.select("o_orderkey", F.posexplode_outer("x").alias("f", "v")).select(
        "o_orderkey", F.col("f").cast("int").alias("f"), r6("v").alias("v"))


@register("pad_features", """
SELECT o_orderkey, CAST(f AS INTEGER) AS f,
       round(CASE WHEN f < 2 THEN [o_totalprice, CAST(o_custkey AS DOUBLE)][f + 1] ELSE 0.0 END, 6) AS v
FROM orders, range(5) r(f)""")
def _pad(spark, sf_dir):
    from tessera.functions.arrays import pad_to
    o = table(spark, sf_dir, "orders")
    x = o.select("o_orderkey", pad_to(F.array(F.col("o_totalprice"), F.col("o_custkey").cast("double")), 5).alias("x"))
    return x.select("o_orderkey", F.posexplode_outer("x").alias("f", "v")).select(
        "o_orderkey", F.col("f").cast("int").alias("f"), r6("v").alias("v"))


_FP_COLS = ["o_totalprice", "o_custkey_d", "o_orderkey_d"]
_FP_PATTERN = [2, 0, 1]


def prepare_ctes(cols, pattern, width: int, by: str, key: str) -> str:
    """From x(key, by, cols): a(key, arr), hard clip, scale, permute, share, pad."""
    t = 4.0
    def sd(e):
        s = f"CASE WHEN count(*) > 1 THEN stddev_samp({e}) ELSE stddev_pop({e}) END"
        return f"CASE WHEN {s} IS NULL THEN NULL ELSE greatest({s}, 1e-6) END"
    s1 = ", ".join(f"avg({c}) a_{c}, {sd(c)} b_{c}" for c in cols)
    inb = {c: f"CASE WHEN {c} >= a_{c} - b_{c} * {t} AND {c} <= a_{c} + b_{c} * {t} THEN {c} END" for c in cols}
    s2 = ", ".join(f"coalesce(avg({inb[c]}), first(a_{c})) m_{c}, coalesce({sd(inb[c])}, 0.0) d_{c}" for c in cols)
    hc = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, coalesce(m_{c} - d_{c} * {t}, '-inf'::DOUBLE)), "
                   f"coalesce(m_{c} + d_{c} * {t}, 'inf'::DOUBLE)) END AS {c}" for c in cols)
    s3 = ", ".join(f"avg({c}) n_{c}, {sd(c)} e_{c}" for c in cols)
    sc = [f"CASE WHEN ({c} - n_{c}) / e_{c} IS NOT NULL THEN least(greatest(({c} - n_{c}) / e_{c}, -100), 100) END" for c in cols]
    arr = "[" + ", ".join([*(f"{sc[i]} / ({len(cols)}.0 / {width}.0)" for i in pattern), *["0.0"] * (width - len(cols))]) + "]"
    return f"""s1 AS (SELECT {by}, {s1} FROM x GROUP BY 1),
s2 AS (SELECT {by}, {s2} FROM x JOIN s1 USING ({by}) GROUP BY 1),
h AS (SELECT {key}, {by}, {hc} FROM x JOIN s2 USING ({by})),
s3 AS (SELECT {by}, {s3} FROM h GROUP BY 1),
a AS (SELECT {key}, {arr} AS arr FROM h JOIN s3 USING ({by}))"""


def _fp_sql():
    return f"""WITH x AS (SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey_d,
                   CAST(o_orderkey AS DOUBLE) AS o_orderkey_d FROM orders),
{prepare_ctes(_FP_COLS, _FP_PATTERN, 5, "o_orderpriority", "o_orderkey")}
SELECT o_orderkey, CAST(f AS INTEGER) AS f, round(arr[f + 1], 6) AS v FROM a, range(5) r(f)"""


@register("feature_prepare", _fp_sql())
def _feature_prepare(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey_d"),
        F.col("o_orderkey").cast("double").alias("o_orderkey_d"))
    x = TR.feature_prepare(o, _FP_COLS, ["o_orderpriority"], _FP_PATTERN, 5)
    return x.select("o_orderkey", F.posexplode_outer("x").alias("f", "v")).select(
        "o_orderkey", F.col("f").cast("int").alias("f"), r6("v").alias("v"))
