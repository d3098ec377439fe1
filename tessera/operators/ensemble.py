"""Ensemble views: feature permutations x class shifts x normalisers.

The configuration list is tiny (n_estimators entries of n_features ints) and
is built on the driver from a seed.  Views are applied either as rows
(``expand_views``: an ``explode`` of a literal array -- a Generate in the same
stage, no join) or fused into a single projection (``fused_member_scores``)
so that scoring every member of every row needs no shuffle at all.
"""

from __future__ import annotations

import functools
import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import permute, rotate_back

MAX_FEATURES_FOR_LATIN = 4000


def _by_hash(items, seed) -> list:
    """The items in a seeded order that doesn't depend on any generator's state."""
    return sorted(items, key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())


def _identity(n: int, members: int, seed) -> list[list[int]]:
    return [list(range(n))]


def _rotations(n: int, members: int, seed) -> list[list[int]]:
    return [[(j - turn) % n for j in range(n)] for turn in range(n)]


def _scattered(n: int, members: int, seed) -> list[list[int]]:
    """Distinct permutations while all can be numbered, else one of each seed."""
    if n > 5:
        return [_by_hash(range(n), f"{seed}:{m}") for m in range(members)]
    patterns = []
    for code in _by_hash(range(math.factorial(n)), seed)[:members]:
        left, pattern = list(range(n)), []
        for size in range(n, 0, -1):  # the code's digits in the factorial base pick what is left
            code, digit = divmod(code, size)
            pattern.append(left.pop(digit))
        patterns.append(pattern)
    return patterns


def _latin_rows(n: int, members: int, seed) -> list[list[int]]:
    rows, columns, symbols = (_by_hash(range(n), f"{seed}:{part}") for part in "rcs")
    return [[symbols[(r + c) % n] for c in columns] for r in rows]


_PATTERNS = {"none": _identity, "shift": _rotations, "random": _scattered, "latin": _latin_rows}
PATTERN_METHODS = tuple(_PATTERNS)


def feature_patterns(n_features: int, n_estimators: int, method: str = "latin", seed: int = 0) -> list[list[int]]:
    """Column permutations for the views: none, every rotation, random ones, or
    the rows of a Latin square whose rows, columns and symbols are permuted
    (random beyond ``MAX_FEATURES_FOR_LATIN`` columns).  A single view is the
    identity."""
    if method not in _PATTERNS:
        raise ValueError(f"feature pattern method {method!r} is none of {', '.join(PATTERN_METHODS)}")
    wide = method == "latin" and n_features > MAX_FEATURES_FOR_LATIN
    make = _identity if n_estimators == 1 else _scattered if wide else _PATTERNS[method]
    return make(n_features, n_estimators, seed)


@dataclass
class ViewConfig:
    member: int
    norm: str
    pattern: list[int]
    shift: int


def ensemble_configs(patterns: list[list[int]], n_classes: int, norm_methods: list[str], n_estimators: int,
                     class_shift: bool = True, seed: int = 0) -> list[ViewConfig]:
    """``n_estimators`` views: pairs of pattern and class shift in a seeded
    order, each under every normaliser in turn; members are numbered by
    normaliser, so that those that share one stand together."""
    shifts = range(n_classes) if class_shift and n_estimators > 1 else (0,)
    pairs = _by_hash([(p, s) for p in range(len(patterns)) for s in shifts], f"{seed}:views")
    slots = [(k % len(norm_methods), pairs[k // len(norm_methods)]) for k in range(min(n_estimators, len(pairs) * len(norm_methods)))]
    return [ViewConfig(member, norm_methods[norm], list(patterns[p]), s)
            for member, (norm, (p, s)) in enumerate(sorted(slots, key=lambda slot: slot[0]))]


def configs_column(configs: list[ViewConfig]) -> Column:
    return F.array(*[F.struct(F.lit(c.member).alias("member"), F.lit(c.norm).alias("norm"),
                              F.array(*[F.lit(i) for i in c.pattern]).alias("pattern"),
                              F.lit(c.shift).alias("shift")) for c in configs])


def expand_views(df: DataFrame, x: str, y: str | None, configs: list[ViewConfig], n_classes: int) -> DataFrame:
    """Every row once per member: permuted features, shifted label.  An
    ``explode`` of a literal array (Generate in the same stage, no join);
    the output is n_rows x n_members by definition."""
    v = df.select("*", F.inline(configs_column(configs)))
    v = v.withColumn(x, permute(x, "pattern"))
    if y is not None:
        v = v.withColumn(y, F.when(F.col(y).isNull(), None).otherwise(F.pmod(F.col(y) + F.col("shift"), F.lit(n_classes))))
    return v


def normalised_views(df: DataFrame, features: list[str], y: str | None, configs: list[ViewConfig], n_classes: int,
                     fitted: dict) -> DataFrame:
    """Every row once per member, as the member sees it: ``x`` holds the
    features preprocessed by the member's normaliser (``fitted``: one fitted
    preprocessing each, of columns ``<feature>__<normaliser>``) in the order
    of its pattern, ``y`` the label under its shift.  Preprocessing runs once a row
    and normaliser, before the rows multiply; there is no join or union."""
    made, x = [], df
    for norm, steps in fitted.items():
        names = [f"{f}__{norm}" for f in features]
        x = steps.transform(x.withColumns({n: F.col(f).cast("double") for f, n in zip(features, names)}))
        made += names
    x = x.withColumns({f"_x_{norm}": F.array(*[F.col(f"{f}__{norm}") for f in features]) for norm in fitted}).drop(*made)
    v = x.select("*", F.inline(configs_column(configs)))
    seen = functools.reduce(lambda w, norm: w.when(F.col("norm") == norm, F.col(f"_x_{norm}")), list(fitted)[1:],
                            F.when(F.col("norm") == list(fitted)[0], F.col(f"_x_{list(fitted)[0]}")))
    v = v.withColumn("x", permute(seen, "pattern")).drop(*[f"_x_{n}" for n in fitted])
    if y is not None:
        v = v.withColumn(y, F.pmod(F.col(y) + F.col("shift"), F.lit(n_classes)))
    return v


def unshift(scores: Column, shift: Column) -> Column:
    return rotate_back(scores, shift)


def average_members_long(df: DataFrame, row: list[str], scores: str) -> DataFrame:
    """Mean score per (row, class) over the members actually present."""
    long = df.select(*row, F.posexplode_outer(scores).alias("class_idx", "score"))
    return long.groupBy(*row, "class_idx").agg(F.avg("score").alias("score"),
                                               F.count(F.lit(1)).alias("n_members"))


def average_arrays(arrays: list[Column]) -> Column:
    """Element-wise mean of equally long arrays (fused members, no shuffle)."""
    acc = arrays[0]
    for a in arrays[1:]:
        acc = F.zip_with(acc, a, lambda p, q: p + q)
    n = float(len(arrays))
    return F.transform(acc, lambda v: v / n)
