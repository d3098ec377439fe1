"""Queries for target and categorical conversion."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tessera.operators import targets as TG
from tessera.operators.transforms import StandardScaleNan
from tessera.plans.q_transforms import prepare_ctes
from tessera.plans.registry import register
from tessera.plans.sqlbits import u_sql
from tessera.session import table


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", "o_custkey")


@register("binarize_median", """
WITH m AS (SELECT o_orderpriority, quantile_disc(o_totalprice, 0.5) AS med FROM orders GROUP BY 1)
SELECT o_orderkey, CAST(o_totalprice > med AS INTEGER) AS y_bin FROM orders JOIN m USING (o_orderpriority)""")
def _binarize(spark, sf_dir):
    b = TG.binarize_median(_orders(spark, sf_dir), "o_totalprice", ["o_orderpriority"])
    return b.select("o_orderkey", "y_bin")


_N_CLASSES = 4


def _rank_boundaries(df, y, by, n_classes, seed):
    return TG.rank_boundaries(df, y, "o_orderkey", n_classes, seed, by)


_RB_SQL = f"""
WITH x AS (SELECT o_orderkey, o_orderpriority, o_totalprice,
                  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r,
                  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
d AS (SELECT DISTINCT o_orderpriority, n FROM x),
dr AS (SELECT o_orderpriority, j, CAST(floor({u_sql('rb', 'o_orderpriority', 'j')} * n) + 1 AS BIGINT) AS r
       FROM d, range({_N_CLASSES - 1}) t(j)),
b AS (SELECT dr.o_orderpriority, x.o_totalprice AS b FROM dr JOIN x USING (o_orderpriority, r))"""


@register("bin_by_rank_boundaries", _RB_SQL + """
SELECT x.o_orderkey, CAST(count(b.b) FILTER (WHERE x.o_totalprice > b.b) AS INTEGER) AS cls
FROM x JOIN b USING (o_orderpriority) GROUP BY x.o_orderkey""")
def _rank_bins(spark, sf_dir):
    o = _orders(spark, sf_dir)
    bnd = _rank_boundaries(o, "o_totalprice", ["o_orderpriority"], _N_CLASSES, "rb")
    x = o.join(bnd, "o_orderpriority")
    return x.select("o_orderkey", TG.count_below(F.col("o_totalprice"), F.col("boundaries")).cast("int").alias("cls"))


_VB = [round(random.Random(11).gauss(0.0, 1.0), 12) for _ in range(_N_CLASSES - 1)]


def _scaled_sql():
    sd = "CASE WHEN count(*) > 1 THEN stddev_samp(o_totalprice) ELSE stddev_pop(o_totalprice) END"
    return f"""WITH p AS (SELECT o_orderpriority, avg(o_totalprice) m, greatest({sd}, 1e-6) s FROM orders GROUP BY 1),
y AS (SELECT o_orderkey, least(greatest((o_totalprice - m) / s, -100), 100) AS y FROM orders JOIN p USING (o_orderpriority)),
c AS (SELECT o_orderkey, CAST({' + '.join(f'CASE WHEN y > {b!r} THEN 1 ELSE 0 END' for b in _VB)} AS INTEGER) AS cls FROM y)"""


def _value_classes(spark, sf_dir):
    o = _orders(spark, sf_dir)
    y = StandardScaleNan(["o_totalprice"], ["o_orderpriority"]).fit(o).transform(o)
    return y.select("o_orderkey", TG.count_below(F.col("o_totalprice"), _VB).cast("int").alias("cls"))


@register("bin_by_value_boundaries", _scaled_sql() + " SELECT o_orderkey, cls FROM c")
def _value_bins(spark, sf_dir):
    return _value_classes(spark, sf_dir)


_PERM = TG.permutation_map(_N_CLASSES, "perm")


@register("permute_classes", _scaled_sql() + f"""
SELECT o_orderkey, CAST({list(_PERM)}[cls + 1] AS INTEGER) AS cls FROM c""")
def _permute(spark, sf_dir):
    c = _value_classes(spark, sf_dir)
    return c.select("o_orderkey", TG.permute_classes(F.col("cls"), _PERM).cast("int").alias("cls"))


@register("reverse_classes", _scaled_sql() + f" SELECT o_orderkey, CAST({_N_CLASSES} - 1 - cls AS INTEGER) AS cls FROM c")
def _reverse(spark, sf_dir):
    c = _value_classes(spark, sf_dir)
    return c.select("o_orderkey", TG.reverse_classes(F.col("cls"), _N_CLASSES).cast("int").alias("cls"))


@register("shift_classes", _scaled_sql() + f" SELECT o_orderkey, CAST((cls + 3) % {_N_CLASSES} AS INTEGER) AS cls FROM c")
def _shift(spark, sf_dir):
    c = _value_classes(spark, sf_dir)
    return c.select("o_orderkey", TG.shift_classes(F.col("cls"), 3, _N_CLASSES).cast("int").alias("cls"))


# ------------------------------------------------- regression as classification
_R2C_FEATURES = ["f0", "f1", "f2", "f3"]
_R2C_CATEGORIES = {"f1": 4, "f3": 6}     # of the four features, two become categories
_R2C_SQL = """SELECT o_orderkey AS id, o_orderpriority AS ds, CAST(o_custkey AS DOUBLE) AS f0, CAST(o_orderkey AS DOUBLE) AS f1,
       CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS f2,
       CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey % 97 AS DOUBLE) END AS f3, o_totalprice AS y FROM orders"""


def _r2c_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("ds"), F.col("o_custkey").cast("double").alias("f0"),
                    F.col("o_orderkey").cast("double").alias("f1"),
                    F.datediff(F.col("o_orderdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double").alias("f2"),
                    F.when(F.col("o_orderkey") % 5 > 0, (F.col("o_custkey") % 97).cast("double")).alias("f3"), F.col("o_totalprice").alias("y"))


def _boundaries_ctes(name: str, src: str, columns: dict[str, int], seed: str) -> str:
    """<name>(ds, col, b): the drawn boundaries of every dataset and column of src."""
    long = " UNION ALL ".join(f"SELECT ds, id, '{c}' AS col, {k} AS k, {c} AS v FROM {src}" for c, k in columns.items())
    return f"""{name}_r AS (SELECT ds, col, k, v, row_number() OVER (PARTITION BY ds, col ORDER BY {u_sql(seed, 'col', 'id')}, id) AS r,
         count(*) OVER (PARTITION BY ds, col) AS n FROM ({long}) t WHERE v IS NOT NULL),
{name}_d AS (SELECT ds, col, CAST(floor({u_sql(seed + ':draw', 'ds', 'col', 'j')} * n) + 1 AS BIGINT) AS r
         FROM (SELECT DISTINCT ds, col, k, n FROM {name}_r) t, range(16) j(j) WHERE j < k - 1),
{name} AS (SELECT ds, col, list(v) AS b FROM {name}_d JOIN {name}_r USING (ds, col, r) GROUP BY ALL)"""


def _categories_ctes(seed: str) -> str:
    """x: the rows, chosen features as categories."""
    cats = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN CAST(len(list_filter(b_{c}.b, lambda e: {c} > e)) AS DOUBLE) END AS {c}" if c in _R2C_CATEGORIES else c
                     for c in _R2C_FEATURES)
    joins = " ".join(f"LEFT JOIN n2c b_{c} ON b_{c}.ds = raw.ds AND b_{c}.col = '{c}'" for c in _R2C_CATEGORIES)
    return f"""raw AS ({_R2C_SQL}),
{_boundaries_ctes("n2c", "raw", _R2C_CATEGORIES, seed)},
x AS (SELECT raw.id, raw.ds, {cats}, y FROM raw {joins})"""


@register("num_to_cat", f"WITH {_categories_ctes('n2c')} SELECT id, f0, f1, f2, f3 FROM x")
def _num_to_cat(spark, sf_dir):
    """Two of four columns of every dataset in categories, by boundaries drawn from its values."""
    return TG.num_to_cat(_r2c_rows(spark, sf_dir), ["ds"], _R2C_CATEGORIES, ["id"], "n2c").select("id", *_R2C_FEATURES)


_R2C_PATTERN = [2, 0, 3, 1]


def _r2c_sql(classes: str) -> str:
    sd = "CASE WHEN count(*) > 1 THEN stddev_samp(y) ELSE stddev_pop(y) END"
    x = ", ".join(f"round(arr[{i + 1}], 6) AS x{i}" for i in range(5))
    return f"""WITH {_categories_ctes('r2c:features')},
{prepare_ctes(_R2C_FEATURES, _R2C_PATTERN, 5, "ds", "id")},
py AS (SELECT ds, avg(y) m, greatest({sd}, 1e-6) s FROM raw GROUP BY 1),
ys AS (SELECT id, ds, least(greatest((y - m) / s, -100), 100) AS y FROM raw JOIN py USING (ds)),
{classes}
SELECT id, {x}, c.y FROM a JOIN c USING (id)"""


_PERMUTED = f"""pr AS (SELECT ds, cls, CASE WHEN count(*) OVER (PARTITION BY ds) = 1 THEN cls
          ELSE row_number() OVER (PARTITION BY ds ORDER BY {u_sql('r2c:classes', 'ds', 'cls')}, cls) - 1 END AS y FROM (SELECT DISTINCT ds, cls FROM k) t),
c AS (SELECT id, CAST(pr.y AS INTEGER) AS y FROM k JOIN pr USING (ds, cls))"""


def _r2c(spark, sf_dir, **how):
    x = TG.regression_to_class(_r2c_rows(spark, sf_dir), ["ds"], _R2C_FEATURES, "y", ["id"], categories=_R2C_CATEGORIES,
                               pattern=_R2C_PATTERN, max_features=5, **how)
    return x.select("id", *[F.round(F.col("x")[i], 6).alias(f"x{i}") for i in range(5)], "y")


@register("regression_to_class", _r2c_sql(f"""{_boundaries_ctes("yb", "ys", {"y": 5}, "r2c:target")},
k AS (SELECT id, ds, CAST(len(list_filter(b, lambda e: y > e)) AS INTEGER) AS cls FROM ys JOIN yb USING (ds)),
{_PERMUTED}"""))
def _reg2cls(spark, sf_dir):
    """Categories, preparation, scaled target, classes by drawn boundaries, renumbered."""
    return _r2c(spark, sf_dir, n_classes=5)


@register("regression_to_class_balanced", _r2c_sql(f"""md AS (SELECT ds, quantile_disc(y, 0.5) AS med FROM ys GROUP BY 1),
k AS (SELECT id, ds, CAST(y > med AS INTEGER) AS cls FROM ys JOIN md USING (ds)),
{_PERMUTED}"""))
def _reg2cls_balanced(spark, sf_dir):
    """Two classes of equal size: above the dataset's lower median or not."""
    return _r2c(spark, sf_dir, n_classes=2, balanced=True)


@register("regression_keep_target", _r2c_sql("c AS (SELECT id, round(y, 6) AS y FROM ys)"))
def _reg_keep(spark, sf_dir):
    """No classes: the scaled target stays a number."""
    return _r2c(spark, sf_dir, n_classes=0).withColumn("y", F.round("y", 6))


@register("quantile_bins_right_closed", """
WITH e AS (SELECT list_distinct(list_sort(quantile_cont(l_extendedprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS edges FROM lineitem),
x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
             CASE WHEN l_linestatus = 'F' THEN l_extendedprice END AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       'C' || CAST(CASE WHEN v IS NULL THEN 0 ELSE least(greatest(len(list_filter(edges, lambda e: v > e)) - 1, 0), len(edges) - 2) END % 10 AS VARCHAR) AS label
FROM x, e""")
def _qbins_right(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    edges = TG.quantile_edges(li, "l_extendedprice", 5).first()["edges"]      # <= 6 fitted edges
    x = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("v"))
    v = F.col("v")
    b = TG.bins_right_closed(v, F.array(*[F.lit(float(e)) for e in edges]))
    return x.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat(F.lit("C"), F.pmod(b, F.lit(10)).cast("string")).alias("label"))


@register("quantile_bins_left_closed", """
WITH e AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS edges FROM orders)
SELECT o_orderkey, CAST(len(list_filter(edges, lambda e: e <= o_totalprice)) AS INTEGER) AS bin FROM orders, e""")
def _qbins_left(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    from tessera.operators.ordering import exact_quantiles
    inner = exact_quantiles(o, "o_totalprice", [0.25, 0.5, 0.75]).first()["q"]
    edges = F.array(*[F.lit(float(e)) for e in inner])   # k-1 fitted edges: bounded, inlined
    return o.select("o_orderkey", TG.bins_left_closed(F.col("o_totalprice"), edges).cast("int").alias("bin"))


@register("class_groups", """
WITH c AS (SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS r, count(*) OVER () AS n
           FROM (SELECT DISTINCT p_brand FROM part) t),
g AS (SELECT *, CAST(least(ceil(n / 10.0), 10) AS BIGINT) AS ng FROM c),
h AS (SELECT *, n // ng AS q, n % ng AS m FROM g)
SELECT p_brand, CAST(CASE WHEN n <= 10 THEN 0 WHEN r < m * (q + 1) THEN r // (q + 1)
                          ELSE m + (r - m * (q + 1)) // q END AS INTEGER) AS grp,
       CAST(count(*) OVER (PARTITION BY CASE WHEN n <= 10 THEN 0 WHEN r < m * (q + 1) THEN r // (q + 1)
                          ELSE m + (r - m * (q + 1)) // q END) AS BIGINT) AS group_size FROM h""")
def _class_groups(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    d = TG.label_dictionary(p, "p_brand")
    tree = TG.class_tree(d)
    root = tree.where("depth = 0").select("class_idx", F.col("group").alias("grp"))
    sizes = root.groupBy("grp").agg(F.count(F.lit(1)).alias("group_size"))
    return d.join(root, "class_idx").join(sizes, "grp").select(
        F.col("label").alias("p_brand"), F.col("grp").cast("int").alias("grp"), "group_size")
