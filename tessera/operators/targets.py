"""Label dictionaries, target binning and class-group trees."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.session import stored

MAX_CLASSES = 10


def label_dictionary(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels -> class_idx 0..C-1, ranked in range partitions
    of the distinct labels."""
    from tessera.operators.transforms import ranked_categories
    d = df.select(F.lit(label).alias("column"), F.col(label).alias("category")).where(F.col("category").isNotNull()).distinct()
    return ranked_categories(d).select(F.col("category").alias("label"), F.col("code").cast("int").alias("class_idx"))


def label_encode(df: DataFrame, label: str, dictionary: DataFrame, out: str = "class_idx") -> DataFrame:
    """Join the dictionary (one row per class); AQE broadcasts it if it is small."""
    d = dictionary.select(F.col("label").alias("_lbl"), F.col("class_idx").alias(out))
    return df.join(d, df[label] == d["_lbl"], "left").drop("_lbl")


def label_decode(df: DataFrame, idx: str, dictionary: DataFrame, out: str = "prediction") -> DataFrame:
    d = dictionary.select(F.col("class_idx").alias("_ci"), F.col("label").alias(out))
    return df.join(d, df[idx] == d["_ci"], "left").drop("_ci")


def check_class_limit(n_classes: int, grouping: bool, max_classes: int = MAX_CLASSES) -> None:
    if n_classes > max_classes and not grouping:
        raise ValueError(f"{n_classes} classes exceed the limit {max_classes} and class grouping is off")


def binarize_median(df: DataFrame, y: str, by: list[str] | None = None, out: str = "y_bin") -> DataFrame:
    """1 if y > the lower median (percentile_disc(0.5) = lower median)."""
    from tessera.operators.ordering import exact_quantiles
    by = by or []
    med = exact_quantiles(df, y, [0.5], by, method="lower").select(*by, F.col("q")[0].alias("_med"))
    j = df.join(med, by, "left") if by else df.withColumn("_med", F.lit(med.first()["_med"]))
    return j.withColumn(out, (F.col(y) > F.col("_med")).cast("int")).drop("_med")


def count_below(v: Column, edges: list[float] | Column, strict: bool = True) -> Column:
    """Number of edges strictly below v (or <= v when strict=False)."""
    arr = edges if isinstance(edges, Column) else F.array(*[F.lit(float(e)) for e in edges])
    return F.size(F.filter(arr, (lambda e: v > e) if strict else (lambda e: v >= e)))


def rank_boundaries(df: DataFrame, y: str, order: str, n_classes: int, seed, by: list[str] | None = None,
                    bucket: Column | None = None) -> DataFrame:
    """C-1 boundaries per dataset drawn from the data with replacement: draw
    j takes the value at rank floor(u_j * n) + 1 in ``order``.  Ranks are
    exact and skew-safe (``ordering.exact_rank``); one array per dataset of
    C-1 values."""
    from tessera.operators.ordering import data_buckets, exact_rank
    by = by or []
    b = bucket if bucket is not None else data_buckets(df, order)
    x = exact_rank(df, by, order, [], out="_r", total="_n", bucket=b)
    n = x.select(*by, "_n").distinct()
    draws = n.select(*by, "_n", F.explode(F.sequence(F.lit(0), F.lit(n_classes - 2))).alias("j"))
    draws = draws.withColumn("_r", (F.floor(uniform(seed, *by, F.col("j")) * F.col("_n")) + 1).cast("bigint"))
    bnd = draws.join(x.select(*by, "_r", F.col(y).alias("b")), [*by, "_r"])
    return bnd.groupBy(*by).agg(F.collect_list("b").alias("boundaries"))


def column_boundaries(df: DataFrame, by: list[str], columns: dict[str, int], key: list[str], seed) -> DataFrame:
    """(by, column, boundaries): of every dataset and column at once, k - 1 of
    its values drawn with replacement (k: the categories of that column), in
    ascending order; a column without values has none.

    One long-form pass: the values of all columns are ranked by hash, in
    sub-buckets where a dataset is large, and draw j takes the value at a
    hashed rank.  ``key`` names a row."""
    from tessera.operators.ordering import exact_rank
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k - 1).alias("_draws"), F.col(c).cast("double").alias("_v")) for c, k in columns.items()])
    long = df.select(*by, *key, F.inline(pairs)).where("_v IS NOT NULL").withColumn("_u", uniform(seed, "column", *key))
    x = stored(exact_rank(long, [*by, "column"], "_u", key, out="_r", total="_n").select(*by, "column", "_draws", "_v", "_r", "_n"), "ranked")
    draws = x.where("_r = 1 AND _draws > 0").select(*by, "column", "_n", F.explode(F.sequence(F.lit(0), F.col("_draws") - 1)).alias("j"))
    draws = draws.select(*by, "column", (F.floor(uniform(f"{seed}:draw", *by, "column", "j") * F.col("_n")) + 1).cast("bigint").alias("_r"))
    return draws.join(x.select(*by, "column", "_r", "_v"), [*by, "column", "_r"]).groupBy(*by, "column") \
        .agg(F.sort_array(F.collect_list("_v")).alias("boundaries"))


def num_to_cat(df: DataFrame, by: list[str], columns: dict[str, int], key: list[str], seed,
               orders: dict[str, list[int]] | None = None) -> DataFrame:
    """``columns`` (name -> number of categories) turned into categories 0..k-1:
    the number of the dataset's boundaries below the value.  ``orders`` may
    rename the categories of a column.  Missing values stay missing; the other
    columns stay as they are."""
    bad = {c: k for c, k in columns.items() if k < 2}
    if bad:
        raise ValueError(f"a categorical column needs at least two categories: {bad}")
    if not columns:
        return df
    found = column_boundaries(df, by, columns, key, seed)
    per_dataset = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("column", "boundaries"))).alias("_edges"))
    x = df.join(per_dataset, by, "left")
    cats = {}
    for c in columns:
        n = count_below(F.col(c).cast("double"), F.col("_edges")[c])
        n = permute_classes(n, orders[c]) if orders and c in orders else n
        cats[c] = F.when(F.col(c).isNotNull(), n.cast("double"))
    return x.withColumns(cats).drop("_edges")


def permute_present(df: DataFrame, by: list[str], cls: str, seed) -> DataFrame:
    """Classes renumbered 0.. within their dataset, in a seeded order of those
    that are present; a dataset of a single class stays as it is."""
    present = df.select(*by, cls).where(F.col(cls).isNotNull()).distinct()
    w = Window.partitionBy(*by)   # one row a class: bounded by the number of classes
    names = present.withColumn("_u", uniform(seed, *by, cls)) \
        .withColumn("_to", F.when(F.count(F.lit(1)).over(w) == 1, F.col(cls)).otherwise(F.row_number().over(w.orderBy("_u", cls)) - 1)).drop("_u")
    return df.join(names, [*by, cls], "left").withColumn(cls, F.col("_to").cast("int")).drop("_to")


def regression_to_class(df: DataFrame, by: list[str], features: list[str], y: str, key: list[str], n_classes: int,
                        categories: dict[str, int] | None = None, pattern: list[int] | None = None, max_features: int | None = None,
                        mode: str = "rank", balanced: bool = False, boundaries: list[float] | None = None, permute: bool = True,
                        seed="r2c") -> DataFrame:
    """A regression dataset (per ``by``) as a classification dataset: chosen
    features become categories, features are prepared into the array ``x``, the
    target is scaled and assigned to classes.

    * ``n_classes`` 0: the scaled target stays a number; 1: an error,
    * 2 and ``balanced``: above the dataset's lower median or not,
    * ``mode`` rank: boundaries drawn from the dataset's targets; value: the
      given ``boundaries`` (n_classes - 1 numbers on the scaled target).

    Classes are then renumbered in a seeded order unless ``permute`` is off."""
    from tessera.operators.transforms import StandardScaleNan, feature_prepare
    if n_classes < 0 or n_classes == 1:
        raise ValueError(f"{n_classes} classes can't be assigned")
    if mode not in ("rank", "value") or mode == "value" and n_classes and len(boundaries or ()) != n_classes - 1:
        raise ValueError(f"mode {mode!r} with boundaries {boundaries!r}")
    x = num_to_cat(df.select(*dict.fromkeys([*by, *key, *features, y])), by, categories or {}, key, f"{seed}:features")
    x = feature_prepare(x, features, by, pattern or list(range(len(features))), max_features or len(features))
    x = StandardScaleNan([y], by).fit(x).transform(x)
    if n_classes == 0:
        return x
    x = stored(x, "prepared")   # read for the boundaries and again for the classes
    if n_classes == 2 and balanced:
        x = binarize_median(x, y, by, out="_cls")
    elif mode == "value":
        x = x.withColumn("_cls", count_below(F.col(y), boundaries))
    else:
        edges = column_boundaries(x, by, {y: n_classes}, key, f"{seed}:target").drop("column")
        x = x.join(edges, by, "left").withColumn("_cls", F.when(F.col(y).isNotNull(), count_below(F.col(y), F.col("boundaries")))).drop("boundaries")
    x = permute_present(x, by, "_cls", f"{seed}:classes") if permute else x
    return x.drop(y).withColumnRenamed("_cls", y)


def permutation_map(n: int, seed) -> list[int]:
    """A seeded permutation of range(n) (small: one entry per class)."""
    import hashlib
    return sorted(range(n), key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())


def permute_classes(c: Column, perm: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(p) for p in perm]), c.cast("int") + 1)


def reverse_classes(c: Column, n_classes) -> Column:
    n = F.lit(n_classes) if isinstance(n_classes, int) else n_classes
    return n - 1 - c


def shift_classes(c: Column, k, n_classes) -> Column:
    k = F.lit(k) if isinstance(k, int) else k
    n = F.lit(n_classes) if isinstance(n_classes, int) else n_classes
    return F.pmod(c + k, n)


def quantile_edges(df: DataFrame, v: str, k: int, by: list[str] | None = None) -> DataFrame:
    """k+1 quantile edges (linear interpolation), distinct and sorted."""
    from tessera.operators.ordering import exact_quantiles
    q = exact_quantiles(df, v, [i / k for i in range(k + 1)], by)
    return q.select(*(by or []), F.array_sort(F.array_distinct("q")).alias("edges"))


def bins_right_closed(v: Column, edges: Column) -> Column:
    """Right-closed bins on unique edges with the lowest edge included:
    bin = #edges strictly below v - 1, at least 0; missing -> 0."""
    b = F.greatest(F.size(F.filter(edges, lambda e: v > e)) - 1, F.lit(0))
    return F.when(v.isNull(), F.lit(0)).otherwise(F.least(b, F.size(edges) - 2))


def bins_left_closed(v: Column, inner_edges: Column) -> Column:
    """Left-closed: number of inner edges e with e <= v."""
    return F.size(F.filter(inner_edges, lambda e: e <= v))


def group_sizes(n: int, max_classes: int = MAX_CLASSES) -> list[int]:
    if n <= max_classes:
        return [n]
    g = min(math.ceil(n / max_classes), max_classes)
    out, rem = [], n
    for i in range(g):
        s = math.ceil(rem / (g - i))
        out.append(s)
        rem -= s
    return out


def group_of_rank(r: Column, n: Column, max_classes: int = MAX_CLASSES) -> Column:
    """Group of the class with 0-based rank r among n classes at one node:
    the greedy ceil split gives (n mod g) groups of ceil(n/g) then floor(n/g)."""
    g = F.least(F.ceil(n / F.lit(max_classes)), F.lit(max_classes))
    q = F.floor(n / g)
    m = F.pmod(n, g)
    big = m * (q + 1)
    grp = F.when(r < big, F.floor(r / (q + 1))).otherwise(m + F.floor((r - big) / q))
    return F.when(n <= max_classes, F.lit(0)).otherwise(grp).cast("int")


def class_tree(classes: DataFrame, label: str = "class_idx", max_classes: int = MAX_CLASSES) -> DataFrame:
    """Class -> group path down the tree: (class_idx, depth, node, group, n_at_node,
    is_leaf).  At an inner node ``group`` is the class's group; at a leaf it is
    the class's position among the leaf's classes.  One small DataFrame pass
    per depth (log_max(C) depth)."""
    cur = classes.select(F.col(label).alias("class_idx")).distinct().withColumn("node", F.lit(""))
    levels = []
    if max_classes < 2:
        raise ValueError("a node of the class tree needs at least two classes")
    for depth in itertools.count():  # until every class has reached a leaf
        w = Window.partitionBy("node")
        x = cur.withColumn("n", F.count(F.lit(1)).over(w)).withColumn(
            "r", (F.row_number().over(w.orderBy("class_idx")) - 1))
        # inside a node: groups of classes; at a leaf each class is its own outcome
        x = x.withColumn("is_leaf", F.col("n") <= max_classes).withColumn(
            "group", F.when(F.col("is_leaf"), F.col("r").cast("int")).otherwise(group_of_rank(F.col("r"), F.col("n"), max_classes))) \
             .withColumn("depth", F.lit(depth))
        levels.append(x.select("class_idx", "depth", "node", "group", F.col("n").alias("n_at_node"), "is_leaf"))
        cur = x.where(~F.col("is_leaf")).select(
            "class_idx", F.concat(F.col("node"), F.lit("/"), F.col("group").cast("string")).alias("node"))
        if cur.isEmpty():
            break
    out = levels[0]
    for l in levels[1:]:
        out = out.unionByName(l)
    return out
