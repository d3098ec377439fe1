"""Fitted column transforms (fit on context rows only, apply to any rows).

Every ``fit`` is one (or two) distributed aggregates whose result has one
number per feature -- bounded by the column count, never by the row count -- so
it is brought to the driver exactly like a Spark ML model's coefficients.
Every ``transform`` is then a pure projection of built-in expressions: it
stays inside whole-stage codegen, needs no shuffle and no join, and Catalyst
folds the fitted constants.

Transforms that the reference applies *per dataset* (the ``by=`` variants)
keep their parameters as a DataFrame keyed by the dataset columns and join
them back; the aggregate is partial (map-side) so a hot dataset does not end
up in one task, and AQE's skew join splits the big side of the join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import uniform
from tessera.functions.numeric import clip, probit, soft_clip
from tessera.session import compiled, stored

# Fixed values that define the reference's transforms.
SCALE_EPS = 1e-6          # added to the population std by the standard scaler
SCALE_CLIP = 100.0        # scaled values are clipped to +-100
STD_FLOOR = 1e-6          # floor applied to missing-aware std estimates
OUTLIER_THRESHOLD = 4.0   # two-stage outlier bounds: mean +- 4 std
IQR_NORMAL = 1.3489795003921634   # norm.ppf(0.75) - norm.ppf(0.25)
QUANTILE_BOUND = 1e-7     # output clip of the normal quantile transform
NORMALIZERS = ("none", "power", "quantile", "quantile_rtdl", "robust")


def _agg_row(df: DataFrame, exprs: dict[str, Column]) -> dict:
    row = df.agg(*[e.alias(k) for k, e in exprs.items()]).first()
    return row.asDict() if row is not None else {k: None for k in exprs}


def _lit(v) -> Column:
    return F.lit(None).cast("double") if v is None else F.lit(float(v))


def _with_row(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach a one-row parameter table as literal columns (collected: its
    size is the number of parameters), instead of a condition-less join."""
    row = params.first()
    return df.withColumns({k: F.lit(v) for k, v in (row.asDict() if row else {}).items()})


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """NaN is not missing in Spark aggregates; convert at ingest."""
    return df.withColumns({c: F.when(F.isnan(F.col(c)), None).otherwise(F.col(c)) for c in cols})


# ----------------------------------------------------------------- scalers
@dataclass
class StandardScaleClip:
    """(x - mean) / (std_pop + 1e-6), clipped to +-100."""
    cols: list[str]
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "StandardScaleClip":
        exprs = {}
        for i, c in enumerate(self.cols):
            exprs[f"m{i}"] = F.avg(c)
            exprs[f"s{i}"] = F.stddev_pop(c)
        r = _agg_row(df, exprs)
        self.mean = {c: r[f"m{i}"] for i, c in enumerate(self.cols)}
        self.scale = {c: (r[f"s{i}"] or 0.0) + SCALE_EPS for i, c in enumerate(self.cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: clip((F.col(c) - _lit(self.mean[c])) / _lit(self.scale[c]), -SCALE_CLIP, SCALE_CLIP)
            for c in self.cols})


@dataclass
class ZScore:
    """(x - mean) / (std_pop + 1e-6) on the numeric block only, no clip."""
    cols: list[str]
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "ZScore":
        s = StandardScaleClip(self.cols).fit(df)
        self.mean, self.scale = s.mean, s.scale
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - _lit(self.mean[c])) / _lit(self.scale[c]) for c in self.cols})


def _std_missing_aware(c: str, n_total: Column) -> Column:
    """numpy nanstd with ddof = 1 if the table has >1 rows (all rows, not non-null)."""
    return F.when(n_total > 1, F.stddev_samp(c)).otherwise(F.stddev_pop(c))


def _floor(std: Column) -> Column:
    # torch clip(min=1e-6) keeps NaN; Spark greatest would turn NULL into 1e-6
    return F.when(std.isNull(), None).otherwise(F.greatest(std, F.lit(STD_FLOOR)))


@dataclass
class StandardScaleNan:
    """Missing-aware scaling: mean/std ignore nulls, std ddof 1 (if >1 rows)
    floored at 1e-6, clip +-100.  ``by`` fits per dataset."""
    cols: list[str]
    by: list[str] = field(default_factory=list)
    params: DataFrame | None = None

    def fit(self, df: DataFrame) -> "StandardScaleNan":
        n = F.count(F.lit(1))
        aggs = []
        for i, c in enumerate(self.cols):
            aggs += [F.avg(c).alias(f"_m{i}"), _floor(_std_missing_aware(c, n)).alias(f"_s{i}")]
        self.params = df.groupBy(*self.by).agg(*aggs)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        j = df.join(self.params, self.by, "left") if self.by else _with_row(df, self.params)
        out = j.withColumns({
            c: clip((F.col(c) - F.col(f"_m{i}")) / F.col(f"_s{i}"), -SCALE_CLIP, SCALE_CLIP)
            for i, c in enumerate(self.cols)})
        return out.drop(*[f"_{k}{i}" for i in range(len(self.cols)) for k in "ms"])


# --------------------------------------------------------------- clippers
@dataclass
class OutlierSoftClip:
    """Two-stage bounds (mean +- t*std, outliers removed, recomputed), then the
    log-soft clip: a = max(x, lo - ln(1+|x|)); min(a, hi + ln(1+|a|))."""
    cols: list[str]
    threshold: float = OUTLIER_THRESHOLD
    lower: dict = field(default_factory=dict)
    upper: dict = field(default_factory=dict)

    def _stats(self, df: DataFrame, mask: dict | None) -> dict:
        n = F.count(F.lit(1))
        exprs = {}
        for i, c in enumerate(self.cols):
            x = F.col(c)
            if mask is not None:
                lo, hi = mask[c]
                x = F.when((x >= _lit(lo)) & (x <= _lit(hi)), x) if lo is not None else F.lit(None).cast("double")
            exprs[f"m{i}"] = F.avg(x)
            exprs[f"s{i}"] = F.when(n > 1, F.stddev_samp(x)).otherwise(F.stddev_pop(x))
        r = _agg_row(df, exprs)
        out = {}
        for i, c in enumerate(self.cols):
            m, s = r[f"m{i}"], r[f"s{i}"]
            s = None if s is None else max(s, STD_FLOOR)
            out[c] = (m, s)
        return out

    def fit(self, df: DataFrame) -> "OutlierSoftClip":
        t = self.threshold
        st1 = self._stats(df, None)
        bounds1 = {c: ((m - t * s, m + t * s) if m is not None and s is not None else (None, None))
                   for c, (m, s) in st1.items()}
        st2 = self._stats(df, bounds1)
        for c, (m, s) in st2.items():
            self.lower[c] = None if m is None or s is None else m - t * s
            self.upper[c] = None if m is None or s is None else m + t * s
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: soft_clip(c, _lit(self.lower[c]), _lit(self.upper[c])) for c in self.cols})


@dataclass
class OutlierHardClip:
    """Per-dataset two-stage bounds with a hard clamp.  Second stage keeps
    lo <= x <= hi; a column with no kept value falls back to the stage-1 mean
    and std 0; undefined bounds become +-infinity."""
    cols: list[str]
    by: list[str] = field(default_factory=list)
    threshold: float = OUTLIER_THRESHOLD

    def fit_transform(self, df: DataFrame) -> DataFrame:
        t = self.threshold
        n = F.count(F.lit(1))
        s1 = []
        for i, c in enumerate(self.cols):
            s1 += [F.avg(c).alias(f"_m{i}"), _floor(_std_missing_aware(c, n)).alias(f"_s{i}")]
        p1 = df.groupBy(*self.by).agg(*s1)
        j = df.join(p1, self.by, "left") if self.by else _with_row(df, p1)
        s2 = []
        for i, c in enumerate(self.cols):
            lo = F.col(f"_m{i}") - F.col(f"_s{i}") * t
            hi = F.col(f"_m{i}") + F.col(f"_s{i}") * t
            kept = F.when((F.col(c) >= lo) & (F.col(c) <= hi), F.col(c))
            m2 = F.coalesce(F.avg(kept), F.first(f"_m{i}"))
            sd2 = F.coalesce(_floor(F.when(n > 1, F.stddev_samp(kept)).otherwise(F.stddev_pop(kept))), F.lit(0.0))
            s2 += [(m2 - sd2 * t).alias(f"_lo{i}"), (m2 + sd2 * t).alias(f"_hi{i}")]
        p2 = j.groupBy(*self.by).agg(*s2)
        out = df.join(p2, self.by, "left") if self.by else _with_row(df, p2)
        # least/greatest skip nulls; a missing input must stay missing
        out = out.withColumns({
            c: F.when(F.col(c).isNull(), None).otherwise(
                F.least(F.greatest(F.col(c), F.coalesce(F.col(f"_lo{i}"), F.lit(float("-inf")))),
                        F.coalesce(F.col(f"_hi{i}"), F.lit(float("inf")))))
            for i, c in enumerate(self.cols)})
        return out.drop(*[f"_{k}{i}" for i in range(len(self.cols)) for k in ("lo", "hi")])


@dataclass
class MinMax999:
    """(x - lo) * 999 / (hi - lo); a constant or non-finite column gives 0."""
    cols: list[str]
    lo: dict = field(default_factory=dict)
    hi: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "MinMax999":
        exprs = {}
        for i, c in enumerate(self.cols):
            exprs[f"a{i}"] = F.min(c)
            exprs[f"b{i}"] = F.max(c)
        r = _agg_row(df, exprs)
        self.lo = {c: r[f"a{i}"] for i, c in enumerate(self.cols)}
        self.hi = {c: r[f"b{i}"] for i, c in enumerate(self.cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c in self.cols:
            lo, hi = self.lo[c], self.hi[c]
            if lo is None or hi is None or not math.isfinite(hi - lo) or hi == lo:
                out[c] = F.lit(0.0)
            else:
                out[c] = (F.col(c) - _lit(lo)) * F.lit(999.0) / _lit(hi - lo)
        return df.withColumns(out)


# ------------------------------------------------------------ normalisers
@dataclass
class RobustScale:
    """(x - median) / (IQR / 1.3489795); zero scale -> 1.  Exact percentiles
    (context-sized fits); ``approx=True`` switches to percentile_approx."""
    cols: list[str]
    approx: bool = False
    center: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "RobustScale":
        from tessera.operators.ordering import exact_quantiles
        qs = {}
        if self.approx:
            arr = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
            r = _agg_row(df, {f"q{i}": F.percentile_approx(c, arr, 100000) for i, c in enumerate(self.cols)})
            qs = {c: r[f"q{i}"] for i, c in enumerate(self.cols)}
        else:
            # exact, without gathering a column in one aggregation buffer; all
            # columns in one long-form pass keyed by feature
            pairs = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("x"))
                              for i, c in enumerate(self.cols)])
            long = df.select(F.inline(pairs))
            rows = exact_quantiles(long, "x", [0.25, 0.5, 0.75], ["f"]).collect()
            got = {r["f"]: r["q"] for r in rows}
            qs = {c: got[i] for i, c in enumerate(self.cols)}
        for i, c in enumerate(self.cols):
            q25, q50, q75 = qs[c]
            s = (q75 - q25) / IQR_NORMAL
            self.center[c], self.scale[c] = q50, (s if s != 0 else 1.0)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - _lit(self.center[c])) / _lit(self.scale[c]) for c in self.cols})


def yeo_johnson(x: Column, lam: Column) -> Column:
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1.0, lam) - 1.0) / lam)
    neg = F.when(F.abs(lam - 2.0) < 1e-12, -F.log1p(-x)).otherwise(
        -(F.pow(-x + 1.0, 2.0 - lam) - 1.0) / (2.0 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def _yeo_johnson_np(x: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """Of a column of values and a row of lambdas."""
    with np.errstate(all="ignore"):
        up, down = np.maximum(x, 0.0), np.maximum(-x, 0.0)
        pos = np.where(np.abs(lam) < 1e-12, np.log1p(up), ((up + 1.0) ** lam - 1.0) / np.where(lam == 0, 1.0, lam))
        two = 2.0 - lam
        neg = np.where(np.abs(two) < 1e-12, -np.log1p(down), -((down + 1.0) ** two - 1.0) / np.where(two == 0, 1.0, two))
        return np.where(x >= 0, pos, neg)


# The lambda search: points of a pass, its first interval, and the last pass's step.
YJ_POINTS, YJ_FIRST, YJ_STEP = 17, (-4.0, 4.0), 2e-4


@dataclass
class YeoJohnson:
    """Per-column lambda by maximum likelihood, then standardise (population
    std, zero std -> 1).

    The rows are read once, into the counts of each column's distinct values;
    one pass over those gives the likelihood of ``YJ_POINTS`` lambdas of every
    column.  While the best is at an end of its interval the next one reaches
    twice as far beyond it; else it is the two steps around the best."""
    cols: list[str]
    lam: dict = field(default_factory=dict)
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    def _counts(self, df: DataFrame) -> DataFrame:
        """(i, v, c): column number, value, rows."""
        pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(self.cols)])
        long = df.select(F.inline(pairs)).where(F.col("v").isNotNull() & ~F.isnan("v"))
        return stored(long.groupBy("i", "v").agg(F.count(F.lit(1)).cast("double").alias("c")), "value-counts")

    def _likelihoods(self, counts: DataFrame, grids: dict[str, list[float]], centre: dict[str, float]) -> dict[str, list[float]]:
        """One pass: each task sums its values' transforms, less that of the
        mean (so that the variance doesn't cancel), for every lambda."""
        at = {self.cols.index(c): np.array(g) for c, g in grids.items()}
        shift = {i: _yeo_johnson_np(np.array([[centre[self.cols[i]] or 0.0]]), lam)[0] for i, lam in at.items()}
        schema = pa.schema([("i", pa.int32()), ("k", pa.int32()), *((c, pa.float64()) for c in ("n", "s", "y", "yy"))])

        def sums(batches):
            total = {i: np.zeros((YJ_POINTS, 4)) for i in at}
            for b in batches:
                of, values, times = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
                for i, lam in at.items():
                    x, n = values[of == i], times[of == i]
                    for k in range(0, len(x), 8192):
                        v, c = x[k:k + 8192, None], n[k:k + 8192, None]
                        with np.errstate(all="ignore"):
                            y = _yeo_johnson_np(v, lam) - shift[i]
                            total[i][:, 0] += c.sum()
                            total[i][:, 1] += (c * np.sign(v) * np.log1p(np.abs(v))).sum()
                            total[i][:, 2] += (c * y).sum(axis=0)
                            total[i][:, 3] += (c * y * y).sum(axis=0)
            rows = [(i, k, *t.tolist()) for i, points in total.items() for k, t in enumerate(points)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        parts = counts.where(F.col("i").isin(list(at))).mapInArrow(sums, "i int, k int, n double, s double, y double, yy double")
        out = {c: [float("-inf")] * YJ_POINTS for c in grids}
        for r in parts.groupBy("i", "k").agg(*[F.sum(c).alias(c) for c in ("n", "s", "y", "yy")]).collect():
            if r["n"]:
                var = r["yy"] / r["n"] - (r["y"] / r["n"]) ** 2
                if math.isfinite(var) and var > 0:
                    c = self.cols[r["i"]]
                    out[c][r["k"]] = -0.5 * r["n"] * math.log(var) + (grids[c][r["k"]] - 1.0) * r["s"]
        return out

    def fit(self, df: DataFrame) -> "YeoJohnson":
        interval = {c: YJ_FIRST for c in self.cols}
        counts = self._counts(df)
        centre = dict.fromkeys(self.cols)
        for r in counts.groupBy("i").agg((F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("m")).collect():  # one row a column
            centre[self.cols[r["i"]]] = r["m"]
        while interval:
            grids = {c: [round(lo + (hi - lo) * k / (YJ_POINTS - 1), 9) for k in range(YJ_POINTS)] for c, (lo, hi) in interval.items()}
            found, interval = self._likelihoods(counts, grids, centre), {}
            for c, ll in found.items():
                k, lams = ll.index(max(ll)), grids[c]
                step = lams[1] - lams[0]
                self.lam[c] = round(lams[k], 6) if math.isfinite(ll[k]) else 1.0
                if not math.isfinite(ll[k]):
                    continue  # constant or empty: no likelihood
                if k == 0:
                    interval[c] = (lams[0] - 2 * (lams[-1] - lams[0]), lams[1])
                elif k == len(lams) - 1:
                    interval[c] = (lams[-2], lams[-1] + 2 * (lams[-1] - lams[0]))
                elif step > YJ_STEP:
                    interval[c] = (lams[k - 1], lams[k + 1])
        exprs = {}
        for i, c in enumerate(self.cols):
            y = yeo_johnson(F.col(c), F.lit(self.lam[c]))
            exprs[f"m{i}"] = F.avg(y)
            exprs[f"s{i}"] = F.stddev_pop(y)
        r = _agg_row(df, exprs)
        for i, c in enumerate(self.cols):
            s = r[f"s{i}"] or 0.0
            self.mean[c], self.scale[c] = r[f"m{i}"], (s if s != 0 else 1.0)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (yeo_johnson(F.col(c), F.lit(self.lam[c])) - _lit(self.mean[c])) / _lit(self.scale[c])
            for c in self.cols})


def _segments(q: list[float], refs: list[float]) -> list[tuple]:
    """Per distinct quantile value u_k: (k, u_k, u_{k+1}, r_first_k, r_last_k, r_first_{k+1}).

    np.interp from both directions, averaged: strictly between u_k and
    u_{k+1} both give the same line from (u_k, r_last_k) to (u_{k+1},
    r_first_{k+1}); exactly at u_k they give r_first_k and r_last_k."""
    vals, first, last = [], {}, {}
    for i, v in enumerate(q):
        if v not in first:
            first[v] = refs[i]
            vals.append(v)
        last[v] = refs[i]
    out = []
    for k, v in enumerate(vals):
        nxt = vals[k + 1] if k + 1 < len(vals) else None
        out.append((k, float(v), None if nxt is None else float(nxt), float(first[v]), float(last[v]),
                    None if nxt is None else float(first[nxt])))
    return out


def _numbers(values: list) -> Column:
    """A literal array of doubles (folded once by the optimiser)."""
    return F.split(F.lit(",".join("NaN" if v is None else repr(float(v)) for v in values)), ",").cast("array<double>")


@dataclass
class QuantileNormal:
    """Empirical CDF from n_quantiles exact quantiles of all rows, then the
    normal quantile function, output clipped at probit(1e-7) / probit(1 - 1e-7).

    The segment of each value is found by binary search (ML ``Bucketizer``
    over the distinct quantiles, JVM-side); its interpolation line comes from
    literal arrays, so a transform is one projection without a join."""
    cols: list[str]
    n_quantiles: int = 1000
    quantiles: dict = field(default_factory=dict)
    refs: list = field(default_factory=list)

    def fit(self, df: DataFrame, noisy: dict[str, Column] | None = None) -> "QuantileNormal":
        from tessera.operators.ordering import exact_quantiles
        n = df.count()
        nq = max(1, min(self.n_quantiles, n))
        self.refs = [i / (nq - 1) for i in range(nq)] if nq > 1 else [0.0]
        pairs = F.array(*[F.struct(F.lit(i).alias("f"), (noisy or {}).get(c, F.col(c)).cast("double").alias("x"))
                          for i, c in enumerate(self.cols)])
        got = {r["f"]: sorted(r["q"]) for r in exact_quantiles(df.select(F.inline(pairs)), "x", self.refs, ["f"]).collect()}
        self.quantiles = {c: got.get(i) for i, c in enumerate(self.cols)}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import Bucketizer
        compiled(df.sparkSession)
        lo_cap = probit(F.lit(QUANTILE_BOUND - 2.220446049250313e-16))
        hi_cap = probit(F.lit(1 - (QUANTILE_BOUND - 2.220446049250313e-16)))
        x = df
        for i, c in enumerate(self.cols):
            q = self.quantiles[c]
            if not q:  # nothing but missing values in the context
                x = x.withColumn(c, F.lit(None).cast("double"))
                continue
            seg = _segments(q, self.refs)
            b = f"_qb{i}"
            x = x.withColumn(c, F.col(c).cast("double"))
            x = Bucketizer(splits=[float("-inf")] + [s[1] for s in seg] + [float("inf")], inputCol=c, outputCol=b,
                           handleInvalid="keep").transform(x)
            at = lambda k: F.try_element_at(_numbers([s[k] for s in seg]), F.greatest(F.col(b).cast("int"), F.lit(1)))  # noqa: B023, E731
            v, here, following, first, last, next_first = F.col(c), at(1), at(2), at(3), at(4), at(5)
            line = last + (v - here) * (next_first - last) / (following - here)
            p = F.when(v == here, (first + last) * 0.5).otherwise(line)
            p = F.when(v - QUANTILE_BOUND < F.lit(q[0]), 0.0).when(v + QUANTILE_BOUND > F.lit(q[-1]), 1.0).otherwise(p)
            x = x.withColumn(f"_p{i}", p)
            z = probit(F.least(F.greatest(F.col(f"_p{i}"), F.lit(QUANTILE_BOUND)), F.lit(1 - QUANTILE_BOUND)))
            x = x.withColumn(c, F.when(v.isNull() | F.isnan(v), None).otherwise(F.least(F.greatest(z, lo_cap), hi_cap))).drop(b, f"_p{i}")
        return x


def normal_draw(seed, *key) -> Column:
    """Standard normal from two hash-seeded uniforms (Box-Muller)."""
    u1 = F.greatest(uniform(f"{seed}:a", *key), F.lit(1e-300))
    u2 = uniform(f"{seed}:b", *key)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


@dataclass
class QuantileRtdl:
    """n_quantiles = max(min(n // 30, 1000), 10); fit on x + sigma*N(0,1) with
    sigma = noise / max(std_pop, noise); then a standard scaler."""
    cols: list[str]
    key: list[str]
    noise: float = 1e-3
    seed: int = 0
    qn: QuantileNormal | None = None
    mean: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "QuantileRtdl":
        n = df.count()
        nq = max(min(n // 30, 1000), 10)
        noisy = None
        if self.noise > 0:
            stds = _agg_row(df, {f"s{i}": F.stddev_pop(c) for i, c in enumerate(self.cols)})
            noisy = {}
            for i, c in enumerate(self.cols):
                sigma = self.noise / max(stds[f"s{i}"] or 0.0, self.noise)
                noisy[c] = F.col(c) + F.lit(sigma) * normal_draw(f"{self.seed}:{c}", *self.key)
        self.qn = QuantileNormal(self.cols, nq).fit(df, noisy)
        t = self.qn.transform(df)
        exprs = {}
        for i, c in enumerate(self.cols):
            exprs[f"m{i}"], exprs[f"s{i}"] = F.avg(c), F.stddev_pop(c)
        r = _agg_row(t, exprs)
        for i, c in enumerate(self.cols):
            s = r[f"s{i}"] or 0.0
            self.mean[c], self.scale[c] = r[f"m{i}"], (s if s != 0 else 1.0)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        t = self.qn.transform(df)
        return t.withColumns({c: (F.col(c) - _lit(self.mean[c])) / _lit(self.scale[c]) for c in self.cols})


@dataclass
class Preprocess:
    """standard scale/clip -> normaliser -> outlier soft clip.

    The reference retries a failed normaliser transform after clipping to the
    training min/max; our normalisers are total functions, so we clip to the
    training range only where the normalised value would be non-finite."""
    cols: list[str]
    method: str = "power"
    key: list[str] = field(default_factory=list)
    seed: int = 0

    def fit(self, df: DataFrame) -> "Preprocess":
        if self.method not in NORMALIZERS:
            raise ValueError(f"Unknown normalization method: {self.method}")
        df = df.select(*dict.fromkeys([*self.cols, *self.key]))
        self.scaler = StandardScaleClip(self.cols).fit(df)
        x = scaled = self.scaler.transform(df).persist()  # read by every later pass
        self.norm = None
        if self.method != "none":
            mm = _agg_row(x, {**{f"a{i}": F.min(c) for i, c in enumerate(self.cols)},
                              **{f"b{i}": F.max(c) for i, c in enumerate(self.cols)}})
            self.x_min = {c: mm[f"a{i}"] for i, c in enumerate(self.cols)}
            self.x_max = {c: mm[f"b{i}"] for i, c in enumerate(self.cols)}
            self.norm = {
                "power": lambda: YeoJohnson(self.cols),
                "quantile": lambda: QuantileNormal(self.cols),
                "quantile_rtdl": lambda: QuantileRtdl(self.cols, self.key, seed=self.seed),
                "robust": lambda: RobustScale(self.cols),
            }[self.method]().fit(x)
            x = self.norm.transform(x)
        self.clipper = OutlierSoftClip(self.cols).fit(x)
        scaled.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        x = self.scaler.transform(df)
        if self.norm is not None:
            if self.method == "power":
                # pow() of an unseen extreme can overflow: clip to the training range first there
                x = x.withColumns({c: F.when(F.abs(yeo_johnson(F.col(c), F.lit(self.norm.lam[c]))) == float("inf"),
                                             clip(c, _lit(self.x_min[c]), _lit(self.x_max[c]))).otherwise(F.col(c))
                                   for c in self.cols})
            x = self.norm.transform(x)
        return self.clipper.transform(x)


# ----------------------------------------------------------- encode/impute
def ranked_categories(vals: DataFrame) -> DataFrame:
    """0-based ``code`` of each distinct (column, category) in binary string
    order: range partitions of the whole string, ranked inside and offset by
    the sizes of the ranges before (a table of one row a column and range).
    Stored between, so both steps see the same ranges."""
    parts = stored(vals.repartitionByRange("column", "category").withColumn("_part", F.spark_partition_id()), "categories")
    sizes = parts.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("column", "_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("column", "_part").orderBy("category")) - 1
    codes = parts.withColumn("_local", local).join(sizes, ["column", "_part"]) \
        .select("column", "category", (F.col("_before") + F.col("_local")).cast("bigint").alias("code"))
    return stored(codes, "dictionary")  # of known size, so joins (a stream's too) choose by it


@dataclass
class OrdinalEncode:
    """Categories sorted ascending (binary string order), 0-based; unseen and
    missing -> -1.  The dictionary stays a DataFrame (category -> code) and is
    joined; AQE broadcasts it only when it is under the broadcast threshold."""
    cols: list[str]
    dictionary: DataFrame | None = None
    fitted: list[str] | None = None   # the names in the dictionary, if others

    def fit(self, df: DataFrame) -> "OrdinalEncode":
        vals = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
                                            for c in self.cols]))).where(F.col("category").isNotNull()).distinct()
        self.dictionary = ranked_categories(vals)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for c, name in zip(self.cols, self.fitted or self.cols):
            d = self.dictionary.where(F.col("column") == name).select(
                F.col("category").alias(f"_cat_{c}"), F.col("code").alias(f"_code_{c}"))
            out = out.join(d, out[c].cast("string") == d[f"_cat_{c}"], "left")
            out = out.withColumn(c, F.coalesce(F.col(f"_code_{c}"), F.lit(-1).cast("bigint"))).drop(f"_cat_{c}", f"_code_{c}")
        return out


@dataclass
class MeanImpute:
    """Missing -> training mean; columns that are entirely missing are dropped."""
    cols: list[str]
    mean: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "MeanImpute":
        r = _agg_row(df, {f"m{i}": F.avg(c) for i, c in enumerate(self.cols)})
        self.mean = {c: r[f"m{i}"] for i, c in enumerate(self.cols)}
        return self

    @property
    def kept(self) -> list[str]:
        return [c for c in self.cols if self.mean[c] is not None]

    def transform(self, df: DataFrame) -> DataFrame:
        gone = [c for c in self.cols if self.mean[c] is None]
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), _lit(self.mean[c])) for c in self.kept}).drop(*gone)


CATEGORICAL_TYPES = ("string", "boolean")
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def classify_columns(df: DataFrame, exclude: list[str] = ()) -> dict[str, list[str]]:
    """Split columns by type: categorical, numeric, dropped (reported)."""
    out = {"categorical": [], "numeric": [], "dropped": []}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        t = f.dataType.simpleString()
        if t in CATEGORICAL_TYPES:
            out["categorical"].append(f.name)
        elif t.split("(")[0] in NUMERIC_TYPES:
            out["numeric"].append(f.name)
        else:
            out["dropped"].append(f.name)
    return out


@dataclass
class ToNumerical:
    """Ordinal-encode categorical columns, mean-impute numeric ones; output
    order is categorical first, then numeric (the column transformer's)."""
    exclude: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame) -> "ToNumerical":
        self.kinds = classify_columns(df, self.exclude)
        self.encoder = OrdinalEncode(self.kinds["categorical"]).fit(df) if self.kinds["categorical"] else None
        self.imputer = MeanImpute(self.kinds["numeric"]).fit(df)
        return self

    @property
    def features(self) -> list[str]:
        return self.kinds["categorical"] + self.imputer.kept

    def with_inputs(self, names: dict[str, str]) -> "ToNumerical":
        """The same fit, for a frame that holds the columns under other names."""
        new = ToNumerical([names.get(c, c) for c in self.exclude])
        new.kinds = {k: [names.get(c, c) for c in v] for k, v in self.kinds.items()}
        new.encoder = None if self.encoder is None else OrdinalEncode([names.get(c, c) for c in self.encoder.cols], self.encoder.dictionary, self.encoder.cols)
        new.imputer = MeanImpute([names.get(c, c) for c in self.imputer.cols], {names.get(c, c): v for c, v in self.imputer.mean.items()})
        return new

    def transform_columns(self, df: DataFrame) -> DataFrame:
        out = self.encoder.transform(df) if self.encoder else df
        return self.imputer.transform(out)

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.transform_columns(df)
        keep = [c for c in out.columns if c in self.exclude]
        return out.select(*keep, *[F.col(c).cast("double").alias(c) for c in self.features])


# ------------------------------------------------------------ array steps
def scale_by_feature_share(arr: Column, n_features: Column, max_features: int) -> Column:
    share = n_features.cast("double") / F.lit(float(max_features))
    return F.transform(arr, lambda x: x / share)


def feature_prepare(df: DataFrame, cols: list[str], by: list[str], pattern: list[int],
                    max_features: int, scale_share: bool = True) -> DataFrame:
    """hard clip -> missing-aware scale -> permute -> share-scale -> pad."""
    x = OutlierHardClip(cols, by).fit_transform(df)
    x = StandardScaleNan(cols, by).fit(x).transform(x)
    arr = F.array(*[F.col(cols[i]).cast("double") for i in pattern])
    if scale_share:
        arr = scale_by_feature_share(arr, F.lit(len(cols)), max_features)
    arr = F.concat(arr, F.array_repeat(F.lit(0.0), F.lit(max(0, max_features - len(cols)))))
    return x.withColumn("x", arr).drop(*cols)
