"""Feature selection, column contracts and row-level cleaning (projection +
filter only: no shuffles)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positional_names(n: int, prefix: str = "col_") -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def select_features(df: DataFrame, label: int, include: list[int] | None = None,
                    exclude: list[int] | None = None, id_index: int | None = None,
                    prefix: str = "col_") -> list[str]:
    """Resolve positional feature indices against a ``col_<i>`` frame.

    include: listed indices in listed order; the label or an out-of-range
    index is an error.  exclude: every column but the label (and id) minus the
    blacklist.  Both together, or an empty result, is an error."""
    n = len(df.columns)
    if include and exclude:
        raise ValueError("feature include and exclude lists are mutually exclusive")
    if not 0 <= label < n:
        raise ValueError(f"label index {label} out of range for {n} columns")
    if id_index is not None:
        if not 0 <= id_index < n:
            raise ValueError(f"id index {id_index} out of range for {n} columns")
        if id_index == label:
            raise ValueError("id column may not be the label column")
        if include and id_index in include:
            raise ValueError("id column may not be a feature")
    if include:
        bad = [i for i in include if not 0 <= i < n]
        if bad:
            raise ValueError(f"feature indices out of range: {bad}")
        if label in include:
            raise ValueError("label index may not be a feature")
        idx = list(include)
    else:
        bad = [i for i in exclude or [] if not 0 <= i < n]
        if bad:
            raise ValueError(f"excluded indices out of range: {bad}")
        drop = set(exclude or []) | {label} | ({id_index} if id_index is not None else set())
        idx = [i for i in range(n) if i not in drop]
    if not idx:
        raise ValueError("no feature columns left")
    return [f"{prefix}{i}" for i in idx]


def check_feature_contract(fitted: list[str], df: DataFrame, wanted: list[str]) -> None:
    """A task's feature set must equal the fitted set and exist in the input."""
    if sorted(set(wanted)) != sorted(set(fitted)):
        raise ValueError(f"feature set {wanted} differs from the fitted set {fitted}")
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"input has too few columns; missing {missing}")


def passthrough(df: DataFrame, indices: list[int], prefix: str = "col_") -> list[Column]:
    """Extra output columns ``col_<i>``: duplicates dropped keeping the first,
    out-of-range indices silently skipped."""
    seen, out = set(), []
    for i in indices:
        if i in seen or not 0 <= i < len(df.columns):
            continue
        seen.add(i)
        out.append(F.col(df.columns[i]).alias(f"{prefix}{i}"))
    return out


ID_NAMES = ("id", "row_id")


def dense_sequence_id(df: DataFrame, order: list[str], out: str = "id") -> DataFrame:
    """0..n-1 along ``order`` without a single-partition window.

    The frame is range-partitioned and sorted, cut from its lineage with a
    reliable checkpoint (so ids are stable under task retries), then each row
    gets the count of rows in earlier partitions plus its position in its own
    partition.  The per-partition count table has one row per partition."""
    from tessera.session import cut_lineage
    s = df.repartitionByRange(*order).sortWithinPartitions(*order)
    s = cut_lineage(s.withColumn("_mid", F.monotonically_increasing_id()))
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_loc", F.col("_mid").bitwiseAND((1 << 33) - 1))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.join(F.broadcast(counts.select("_pid", "_off")), "_pid")
    return s.withColumn(out, (F.col("_off") + F.col("_loc")).cast("bigint")).drop("_mid", "_pid", "_loc", "_off")


def drop_target_and_ids(df: DataFrame, label: str, order: list[str]) -> tuple[DataFrame, str]:
    """Drop the label and any ``id``/``row_id`` column (case-insensitive);
    when the frame has no id column, a sequential one is made."""
    ids = [c for c in df.columns if c.lower() in ID_NAMES]
    id_col = ids[0] if ids else "id"
    x = df if ids else dense_sequence_id(df, order, "id")
    keep = [c for c in x.columns if c != label and (c.lower() not in ID_NAMES or c == id_col)]
    return x.select(*keep), id_col


def constant_filter_fit(df: DataFrame, cols: list[str], threshold: int = 1) -> dict[str, int]:
    """Distinct values per column (a missing value counts as one more value);
    returns {column: n_distinct}.  Keep columns with n_distinct > threshold,
    or all of them when the table has <= threshold rows."""
    exprs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        exprs.append((F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"d{i}"))
    r = df.agg(*exprs).first()
    return {"_rows": r["_rows"], **{c: r[f"d{i}"] for i, c in enumerate(cols)}}


def varying_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """The columns with more than one value (missing is a value too), from one
    aggregate of least, greatest and missing; all of them for a single row."""
    r = df.agg(F.count(F.lit(1)).alias("n"), *[x.alias(f"{k}{i}") for i, c in enumerate(cols) for k, x in (
        ("a", F.min(c)), ("b", F.max(c)), ("z", F.count(c)))]).first()
    kept = [c for i, c in enumerate(cols) if r[f"a{i}"] != r[f"b{i}"] or 0 < r[f"z{i}"] < r["n"]]
    return kept if r["n"] > 1 else list(cols)


def constant_filter_report(df: DataFrame, cols: list[str], threshold: int = 1) -> DataFrame:
    """Lazy form: one row per column (feature, n_distinct, keep)."""
    n = F.count(F.lit(1))
    rows = [F.struct(F.lit(c).alias("feature"),
                     (F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).cast("bigint").alias("n_distinct"))
            for c in cols]
    g = df.agg(n.alias("_rows"), F.array(*rows).alias("_r"))
    return g.select("_rows", F.inline("_r")).select(
        "feature", "n_distinct", ((F.col("n_distinct") > threshold) | (F.col("_rows") <= threshold)).alias("keep"))


def constant_filter_keep(stats: dict[str, int], cols: list[str], threshold: int = 1) -> list[str]:
    if stats["_rows"] <= threshold:
        return list(cols)
    return [c for c in cols if stats[c] > threshold]


def dataset_constant_filter(df: DataFrame, dataset: list[str], x: str, d: str) -> DataFrame:
    """Per dataset, drop features (among the first ``d``) whose min == max,
    re-pad to the original width and set the new ``d``.  min/max per
    (dataset, feature) is a partial aggregate; the kept index list per
    dataset is bounded by the feature count."""
    width = F.size(F.col(x))
    long = df.select(*dataset, F.posexplode(F.slice(F.col(x), F.lit(1), F.col(d))).alias("f", "v"))
    keep = long.groupBy(*dataset, "f").agg((F.min("v") < F.max("v")).alias("k")) \
        .groupBy(*dataset).agg(F.sort_array(F.collect_list(F.when(F.col("k"), F.col("f")))).alias("_keep"))
    j = df.join(keep, dataset, "left")
    kept = F.transform(F.coalesce(F.col("_keep"), F.array().cast("array<int>")), lambda i: F.element_at(F.col(x), i + 1))
    padded = F.concat(kept, F.array_repeat(F.lit(0.0).cast(df.schema[x].dataType.elementType),
                                           width - F.size(kept)))
    return j.withColumn(x, padded).withColumn(d, F.size(F.coalesce(F.col("_keep"), F.array()))).drop("_keep")


# Rows -> feature cap steps of the batch generator.
FEATURE_CAP_STEPS = [(10240, 100), (20000, 80), (30000, 60), (40000, 40), (50000, 30), (60000, 20), (65000, 15)]
FEATURE_CAP_TAIL = 10


def feature_cap(n_rows: Column, max_features: int) -> Column:
    expr = None
    for limit, cap in FEATURE_CAP_STEPS:
        v = F.lit(min(cap, max_features))
        expr = F.when(n_rows <= limit, v) if expr is None else expr.when(n_rows <= limit, v)
    return expr.otherwise(F.lit(FEATURE_CAP_TAIL))


def to_numeric(df: DataFrame, cols: list[str], required: list[str] | None = None) -> DataFrame:
    """Bad text -> null via try_cast, then rows with a null key are dropped."""
    x = df.withColumns({c: F.expr(f"try_cast(`{c}` as double)") for c in cols})
    return x.na.drop(subset=required or cols)


def row_hint(m: Column, keys: list[str], default: int = 1) -> Column:
    """First of several alternative keys that parses as a number, floored at 0;
    ``default`` when none does."""
    cands = [F.try_element_at(m, F.lit(k)).try_cast("double") for k in keys]
    v = F.coalesce(*cands)
    return F.when(v.isNull(), F.lit(default)).otherwise(F.greatest(F.floor(v), F.lit(0))).cast("bigint")
