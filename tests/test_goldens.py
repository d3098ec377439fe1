"""Hand goldens (FIXTURES 8) and small brute-force checks."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import columns as C
from tessera.operators import ordering as O
from tessera.operators import ragged as RG
from tessera.operators import scoring as S
from tessera.operators import targets as TG
from tessera.operators import telemetry as TL
from tessera.operators import transforms as TR
from tessera.operators import work as WK
from tessera.functions.arrays import argmax, rotate_back, rotate_forward, permute, invert_pattern, softmax


def test_class_group_sizes():
    assert TG.group_sizes(25) == [9, 8, 8]
    assert TG.group_sizes(101) == [11] + [10] * 9
    assert TG.group_sizes(11) == [6, 5]
    assert TG.group_sizes(10) == [10]


def test_class_tree_matches_greedy(spark):
    for n in (25, 101, 7):
        d = spark.range(n).select(F.col("id").cast("int").alias("class_idx"))
        tree = TG.class_tree(d)
        root = tree.where("depth = 0").groupBy("group").count().orderBy("group").collect()
        assert [r["count"] for r in root] == (TG.group_sizes(n) if n > 10 else [1] * n)
    t = TG.class_tree(spark.range(101).select(F.col("id").cast("int").alias("class_idx")))
    lvl1 = t.where("depth = 1 AND NOT is_leaf").groupBy("node", "group").count().collect()
    assert sorted(r["count"] for r in lvl1) == [5, 6]


def test_feature_cap(spark):
    df = spark.createDataFrame([(10240,), (10241,), (65001,)], "n long")
    got = [r[0] for r in df.select(C.feature_cap(F.col("n"), 100)).collect()]
    assert got == [100, 80, 10]


def test_binarize_median(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "y double")
    got = [r["y_bin"] for r in TG.binarize_median(df, "y").orderBy("y").collect()]
    assert got == [0, 0, 1, 1]


def _closed_at(weights, limit):
    """Chunk numbers by a plain loop: a chunk closes with the item that reaches the limit."""
    out, chunk, held = [], 0, 0
    for w in weights:
        if held >= limit:
            chunk, held = chunk + 1, 0
        out.append(chunk)
        held += w
    return out


def test_chunk_by_weight_equals_a_loop(spark, monkeypatch):
    """One job holds most items; weights of nothing, ties and fractions; several ranges."""
    rng = random.Random(2)
    jobs = {"a": [rng.choice([0.0, 0.1, 0.2, 1.0, 2.5]) for _ in range(3000)], "b": [0.0, 0.0, 5.0, 5.0, 0.0], "c": [5.0], "d": [0.0], "e": [1.0] * 300}
    monkeypatch.setattr(WK, "ROWS_PER_BUCKET", 256)
    rows = [(j, i, w) for j, ws in jobs.items() for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "job string, pos long, w double")
    got = {(r["job"], r["pos"]): r["chunk"] for r in WK.chunk_by_weight(df, ["job"], ["pos"], "w", 5.0).collect()}
    want = {(j, i): c for j, ws in jobs.items() for i, c in enumerate(_closed_at([round(w * 10) for w in ws], 50))}
    assert got == want
    with pytest.raises(Exception, match="heavier than"):
        WK.chunk_by_weight(df, ["job"], ["pos"], "w", 2.0)


def test_unshift(spark):
    df = spark.createDataFrame([(["a", "b", "c"], 1)], "s array<string>, k int")
    assert df.select(rotate_back("s", F.col("k"))).first()[0] == ["b", "c", "a"]
    assert df.select(rotate_back(rotate_forward("s", F.col("k")), F.col("k"))).first()[0] == ["a", "b", "c"]


def test_permutation_round_trip(spark):
    df = spark.createDataFrame([([10.0, 20.0, 30.0, 40.0], [2, 0, 3, 1])], "x array<double>, p array<int>")
    r = df.select(permute(permute("x", "p"), invert_pattern("p")).alias("y")).first()
    assert r["y"] == [10.0, 20.0, 30.0, 40.0]


def test_ordinal_encode_unseen_and_missing(spark):
    fit = spark.createDataFrame([("b",), ("a",)], "c string")
    enc = TR.OrdinalEncode(["c"]).fit(fit)
    df = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "i int, c string")
    got = [r["c"] for r in enc.transform(df).orderBy("i").collect()]
    assert got == [0, -1, -1]


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.5],)], "s array<double>")
    assert df.select(argmax("s")).first()[0] == 1


def test_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([1000.0, 0.0, -5.0],)], "s array<double>")
    for r in df.select(softmax("s", 0.9).alias("p")).collect():
        assert abs(sum(r["p"]) - 1.0) < 1e-12


def _votes(cx, cy, x, n):
    logit = -((x[:, None, :] - cx[None, :, :]) ** 2).sum(axis=2) / cx.shape[1]
    w = np.exp(logit - logit.max(axis=1, keepdims=True))
    w /= w.sum(axis=1, keepdims=True)
    return np.stack([w[:, cy == k].sum(axis=1) for k in range(n)], axis=1)


def test_block_scores_equal_brute_force_at_any_size(spark):
    """20 000 context rows in slices, queries in groups; far queries, whose weights underflow; no cap."""
    rng = np.random.default_rng(0)
    cx, cy, x = rng.normal(size=(20_000, 5)), rng.integers(0, 3, 20_000), rng.normal(size=(150, 5)) * rng.choice([1.0, 60.0], size=(150, 1))
    ctx = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(cx, cy)], "x array<double>, y int").repartition(6)
    query = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    want = _votes(cx, cy, x, 3)
    for group, piece in ((40, 3000), (1 << 15, 1 << 16)):
        got = S.block_scores(query, ctx, ["id"], "x", "y", S.KernelVote(3), group=group, piece=piece).orderBy("id").collect()
        assert [r["id"] for r in got] == list(range(150))
        assert np.allclose(np.array([r["scores"] for r in got]), want, atol=1e-9)
    few = S.block_scores(query, ctx.limit(3), ["id"], "x", "y", S.KernelVote(3), group=40, piece=1).collect()
    assert len(few) == 150 and all(abs(sum(r["scores"]) - 1) < 1e-9 for r in few)
    none = S.block_scores(query, ctx.where("y > 9"), ["id"], "x", "y", S.KernelVote(3)).collect()
    assert len(none) == 150 and all(r["scores"] == [None] * 3 for r in none)
    assert "Broadcast" not in S.block_scores(query, ctx, ["id"], "x", "y", S.KernelVote(3))._jdf.queryExecution().toString()


def test_kernel_votes_by_box_equal_all_pairs(monkeypatch):
    """Rows that lie close together are summed by box; far, sparse and missing ones pair by pair."""
    rng, pairs = np.random.default_rng(2), []
    compared = S.KernelVote._pairs
    monkeypatch.setattr(S.KernelVote, "_pairs", lambda self, cx, cy, x: (pairs.append(len(cx) * len(x)), compared(self, cx, cy, x))[1])
    made = {"even": lambda n: rng.uniform(-1.7, 1.7, (n, 3)), "heaps": lambda n: rng.uniform(0, 0.4, (n, 2)) + rng.choice([0.0, 30.0, 5000.0], (n, 1)),
            "one value": lambda n: np.full((n, 3), 7.0), "long tails": lambda n: rng.standard_t(2, (n, 1)), "four": lambda n: rng.uniform(0, 1.2, (n, 4))}
    for name, make in made.items():
        for classes, temperature in ((3, 1.0), (3, 0.2)):
            cx, x, vote = make(9000), make(3000), S.KernelVote(classes, temperature)
            cy = rng.integers(0, classes, len(cx))
            cy[cx[:, 0] < np.quantile(cx[:, 0], 0.1)] = 0  # classes that a box lacks
            del pairs[:]
            m, s = vote.partial(cx, cy, x)
            if temperature == 1.0:
                assert sum(pairs) < 0.2 * len(cx) * len(x), name
            want = _votes(cx / temperature ** 0.5, cy, x[:200] / temperature ** 0.5, classes)
            assert np.isfinite(m).all() and np.allclose(s[:200] / s[:200].sum(axis=1, keepdims=True), want, rtol=0, atol=1e-9 if name == "heaps" else 1e-11)
    cx, cy, x = made["even"](9000), rng.integers(0, 3, 9000), made["even"](3000)
    x[5, 1], x[9] = np.nan, 1e300
    with np.errstate(all="ignore"):
        for near in (cx, np.r_[cx, [[0.0, np.nan, 1.0]]]):
            labels = np.r_[cy, 0][:len(near)]
            m, s = S.KernelVote(3).partial(near, labels, x)
            m0, s0 = S.KernelVote(3)._all_pairs(near, labels, x)
            assert np.allclose(s / s.sum(axis=1, keepdims=True), s0 / s0.sum(axis=1, keepdims=True), rtol=0, atol=1e-12, equal_nan=True)


def test_box_sums_in_small_portions(monkeypatch):
    rng = np.random.default_rng(3)
    cx, cy, x = rng.uniform(-0.7, 0.7, (2500, 3)), rng.integers(0, 4, 2500), rng.uniform(-0.7, 0.7, (600, 3))
    whole = S.KernelVote(4).partial(cx, cy, x)
    for names in ({"SUMS": 3000, "ROWS": 50}, {"QUERY_BOXES": 3, "ROWS": 17}):
        with monkeypatch.context() as patched:
            for k, v in names.items():
                patched.setattr(S.boxes, k, v)
            m, s = S.KernelVote(4).partial(cx, cy, x)
        assert np.allclose(s * np.exp(m - whole[0])[:, None], whole[1], rtol=1e-11)


def test_block_scores_of_many_rows_in_few_features(spark):
    """Views with their own rows, in slices that meet in one query; 3 x 10**8 pairs."""
    rng = np.random.default_rng(4)
    cx, cy, cv = rng.uniform(-1.5, 1.5, (60_000, 3)), rng.integers(0, 3, 60_000), rng.integers(0, 2, 60_000)
    x, xv = rng.uniform(-1.5, 1.5, (10_000, 3)), rng.integers(0, 2, 10_000)
    frame = lambda **c: spark.createDataFrame(pd.DataFrame(c))
    ctx = frame(view=cv, x=list(cx), y=cy.astype(np.int32)).repartition(3)
    query = frame(view=xv, id=np.arange(len(x)), x=list(x))
    got = S.block_scores(query, ctx, ["view", "id"], "x", "y", S.KernelVote(3), by=["view"], group=3000, piece=20_000).orderBy("id").toPandas()
    assert got["id"].tolist() == list(range(len(x))) and got["view"].tolist() == xv.tolist()
    some = rng.choice(len(x), 100, replace=False)
    for v in (0, 1):
        here = some[xv[some] == v]
        assert np.allclose(np.stack(got["scores"].to_numpy()[here]), _votes(cx[cv == v], cy[cv == v], x[here], 3), rtol=0, atol=1e-11)


def test_whole_context_scorer(spark):
    ctx = spark.createDataFrame([([0.0], 0), ([9.0], 1)], "x array<double>, y int")
    cx, cy = S.collect_context(ctx, "x", "y", 10)
    nearest = lambda cx, cy, n, x: -np.abs(x - np.array([cx[cy == k].mean() for k in range(n)])[None, :])
    got = S.context_score(spark.createDataFrame([(1, [2.0]), (2, [8.0])], "id long, x array<double>"), ["id"], "x", cx, cy, 2, nearest).collect()
    assert {r["id"]: int(np.argmax(r["scores"])) for r in got} == {1: 0, 2: 1}
    with pytest.raises(ValueError, match="above its cap"):
        S.collect_context(ctx, "x", "y", 1)


def _np_quantile_normal(train, x):
    """Reference algorithm written out in numpy (interp from both sides)."""
    from statistics import NormalDist
    refs = np.linspace(0, 1, len(train))
    q = np.sort(train)          # n_quantiles == n: the knots are the sorted values (no percentile float noise)
    p = 0.5 * (np.interp(x, q, refs) - np.interp(-x, -q[::-1], -refs[::-1]))
    p = np.where(x - 1e-7 < q[0], 0.0, p)
    p = np.where(x + 1e-7 > q[-1], 1.0, p)
    p = np.clip(p, 1e-7, 1 - 1e-7)
    z = np.array([NormalDist().inv_cdf(v) for v in p])
    lo, hi = NormalDist().inv_cdf(1e-7 - np.spacing(1)), NormalDist().inv_cdf(1 - (1e-7 - np.spacing(1)))
    return np.clip(z, lo, hi)


def test_quantile_normal_brute_force(spark):
    train = [1.0, 2.0, 2.0, 2.0, 3.0, 5.0, 8.0, 8.0, 13.0, 21.0]
    probe = [0.0, 1.0, 1.5, 2.0, 2.5, 4.0, 8.0, 10.0, 21.0, 30.0]
    fit = spark.createDataFrame([(v,) for v in train], "x double")
    qn = TR.QuantileNormal(["x"]).fit(fit)
    got = [r["x"] for r in qn.transform(spark.createDataFrame([(i, v) for i, v in enumerate(probe)], "i int, x double"))
           .orderBy("i").collect()]
    want = _np_quantile_normal(np.array(train), np.array(probe))
    assert np.allclose(got, want, atol=1e-6), (got, want)


def test_outlier_bounds_golden(spark):
    vals = [0.0] * 10 + [1.0] * 10 + [100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    c = TR.OutlierSoftClip(["x"], threshold=4.0).fit(df)
    a = np.array(vals)
    m, s = a.mean(), max(a.std(ddof=1), 1e-6)
    keep = a[(a >= m - 4 * s) & (a <= m + 4 * s)]
    m2, s2 = keep.mean(), max(keep.std(ddof=1), 1e-6)
    assert math.isclose(c.lower["x"], m2 - 4 * s2, rel_tol=1e-9)
    assert math.isclose(c.upper["x"], m2 + 4 * s2, rel_tol=1e-9)
    out = [r["x"] for r in c.transform(df).collect()]
    hi = m2 + 4 * s2
    above = max(100.0, c.lower["x"] - math.log1p(100.0))  # the outlier, clipped from below first
    assert max(out) == pytest.approx(min(above, hi + math.log1p(abs(above))), rel=1e-9)


def test_pack_unpack_round_trip(spark):
    rows = [(1, 0, [1.0, 2.0, 3.0], 2), (1, 1, [4.0, 5.0, 6.0], 3), (2, 0, [7.0, 8.0, 9.0], 1)]
    df = spark.createDataFrame(rows, "ds int, pos int, x array<double>, d int")
    packed = RG.ragged_pack(df, ["ds"], "pos", "x", "d", F.lit(0))
    assert [r["value"] for r in packed.where("ds = 1").orderBy("offset").collect()] == [1.0, 2.0, 4.0, 5.0, 6.0]
    starts = RG.row_starts(df, ["ds"], "pos", "d", F.lit(0))
    back = RG.ragged_unpack(packed, starts, ["ds"], "pos", "d", 3).collect()
    got = {(r["ds"], r["pos"], r["f"]): r["value"] for r in back}
    for ds, pos, x, d in rows:
        for f in range(3):
            assert got[(ds, pos, f)] == (x[f] if f < d else 0.0)


def test_ledger_sequence(spark):
    """put a,b; lease a; ack a; lease b; nack b; lease b; extend; lease b; ack b."""
    ev = [("a", "put", 0.0), ("b", "put", 0.0), ("a", "lease", 1.0), ("a", "ack", 2.0), ("b", "lease", 3.0),
          ("b", "nack", 4.0), ("b", "lease", 10.0), ("b", "extend", 11.0), ("b", "lease", 30.0), ("b", "ack", 31.0),
          ("zzz", "ack", 5.0)]
    df = spark.createDataFrame(ev, "task_id string, op string, t double")
    mid = {r["task_id"]: r["state"] for r in WK.ledger_state(df.where("t <= 11"), F.lit(12.0), 5.0, 1.0, 10).collect()}
    assert mid == {"a": "acked", "b": "leased"}
    later = {r["task_id"]: r["state"] for r in WK.ledger_state(df.where("t <= 11"), F.lit(30.0), 5.0, 1.0, 10).collect()}
    assert later["b"] == "visible"
    end = {r["task_id"]: (r["state"], r["attempts"]) for r in WK.ledger_state(df, F.lit(40.0), 5.0, 1.0, 10).collect()}
    assert end == {"a": ("acked", 1), "b": ("acked", 3)}


def test_redaction(spark):
    df = spark.createDataFrame([({"api_key": "x", "Password": "y", "user": "u", "public_key": "p"},)], "m map<string,string>")
    m = df.select(TL.redact(F.col("m"), allow=("public_key",))).first()[0]
    assert m == {"api_key": "***", "Password": "***", "user": "u", "public_key": "p"}


def test_log_line_round_trip(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00+08:00", "w.py:1", "INFO", "start", "7", "")],
                               "ts string, file string, level string, event string, job string, msg string")
    line = TL.render_log_line(F.col("ts"), F.col("file"), F.col("level"), F.col("event"),
                              {"job_id": F.col("job"), "msg": F.col("msg")}, [])
    r = df.select(line.alias("l")).first()["l"]
    assert r == "2024-01-01T00:00:00+08:00|w.py:1|INFO|event=start|job_id=7"
    p = df.select(TL.parse_log_line(F.lit(r)).alias("p")).first()["p"]
    assert p["level"] == "INFO" and p["kv"] == {"event": "start", "job_id": "7"}


def _yj_np(x, lam):
    out = np.empty_like(x)
    pos = x >= 0
    out[pos] = np.log1p(x[pos]) if abs(lam) < 1e-12 else ((x[pos] + 1) ** lam - 1) / lam
    out[~pos] = -np.log1p(-x[~pos]) if abs(lam - 2) < 1e-12 else -((-x[~pos] + 1) ** (2 - lam) - 1) / (2 - lam)
    return out


def test_yeo_johnson_lambda_is_the_likelihood_maximum(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.lognormal(0, 0.6, 300), -rng.lognormal(-1, 0.3, 50)])
    yj = TR.YeoJohnson(["x"]).fit(spark.createDataFrame([(float(v),) for v in x], "x double"))

    def ll(lam):
        y = _yj_np(x, lam)
        return -len(x) / 2 * np.log(y.var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    grid = np.arange(-4, 4.0005, 0.001)
    best = grid[np.argmax([ll(l) for l in grid])]
    assert abs(yj.lam["x"] - best) <= 0.006, (yj.lam["x"], best)


def test_class_tree_probabilities_and_plan_size(spark):
    """Sums of one, the class of a row's own centre first; the plan does not grow with the classes."""
    sizes = set()
    for n in (25, 101):
        rows = spark.range(n * 4).select((F.col("id") % n).alias("label"), (F.col("id") % n * 10.0 + F.col("id") % 3 * 0.01).alias("a"),
                                         (F.col("id") % n * -7.0).alias("b"), "id")
        m = S.fit_class_tree(rows, ["a", "b"], "label")
        p = S.chain_rule(S.node_scores(rows, ["id"], m), ["id"], m)
        assert all(abs(r[0] - 1.0) < 1e-9 for r in p.groupBy("id").agg(F.sum("p")).select("sum(p)").collect())
        best = TG.label_decode(S.best_class(p, ["id"]), "class_idx", m.dictionary, "label").select("id", "label").collect()
        own = sum(r["label"] == r["id"] % n for r in best)
        assert own >= 0.8 * 4 * n, (n, own)   # inner nodes see the means of their groups
        sizes.add(len(S.tree_logits(p)._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert len(sizes) == 1


def test_regression_to_class_edges(spark):
    df = spark.createDataFrame([(d, i, float(i % 7) if i % 4 else None, float(v)) for d, n in (("a", 40), ("b", 1), ("c", 30))
                                for i in range(n) for v in [i if d != "c" else 5.0]], "d string, id long, f double, y double")
    for bad in ({"n_classes": 1}, {"n_classes": -2}, {"n_classes": 3, "mode": "other"}, {"n_classes": 3, "mode": "value", "boundaries": [0.0]}):
        with pytest.raises(ValueError):
            TG.regression_to_class(df, ["d"], ["f"], "y", ["id"], **bad)
    with pytest.raises(ValueError, match="two categories"):
        TG.num_to_cat(df, ["d"], {"f": 1}, ["id"], 0)
    got = TG.regression_to_class(df, ["d"], ["f"], "y", ["id"], 4, categories={"f": 3}, max_features=2)
    rows = {(r["d"], r["id"]): r for r in got.collect()}
    assert len(rows) == 71 and all(0 <= r["y"] < 4 and r["x"][1] == 0.0 for r in rows.values())
    assert len({r["y"] for k, r in rows.items() if k[0] == "c"}) == 1 and all(rows["a", i]["x"][0] is None for i in range(0, 40, 4))
    half = TG.regression_to_class(df, ["d"], ["f"], "y", ["id"], 2, balanced=True, permute=False)
    assert {(r["d"], r["y"]): r["count"] for r in half.groupBy("d", "y").count().collect()} == {("a", 0): 20, ("a", 1): 20, ("b", 0): 1, ("c", 0): 30}
    value = TG.regression_to_class(df, ["d"], ["f"], "y", ["id"], 3, mode="value", boundaries=[-0.5, 0.5], permute=False)
    assert {r["y"] for r in value.where("d = 'a'").collect()} == {0, 1, 2}


def test_missing_values_stay_missing_when_scaled(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0), ("b", None)], "d string, x double")
    got = [(r["d"], r["x"]) for r in TR.StandardScaleNan(["x"], ["d"]).fit(df).transform(df).collect()]
    assert sorted(got, key=str)[:3] == sorted([("a", -1 / 2 ** 0.5), ("a", 1 / 2 ** 0.5), ("a", None)], key=str)
    assert [x for d, x in got if d == "b"] == [None, None]   # one known value has no deviation
    assert sorted((r["x"] is None for r in TR.StandardScaleClip(["x"]).fit(df).transform(df).collect())) == [False] * 3 + [True] * 2


def test_split_repair_reads_invalid_datasets_only(spark, monkeypatch):
    rows = [(d, i, "x" if (i % 2 if d < 5 else i < 4) else "y") for d in range(10) for i in range(8)]
    df = spark.createDataFrame(rows, "d int, i int, label string")
    seen, kept = [], O.split_validity

    def watched(x, *a, **k):
        seen.append({r["d"] for r in x.select("d").distinct().collect()})
        return kept(x, *a, **k)

    monkeypatch.setattr(O, "split_validity", watched)
    got = {r["d"]: r["attempt"] for r in O.split_repair(df, ["d"], "label", "i", 4, ["i"]).collect()}
    assert seen[0] == set(range(10)) and seen[1] == set(range(5, 10)) and all(b <= a for a, b in zip(seen, seen[1:]))
    assert all(got[d] == 0 for d in range(5)) and all(got[d] > 0 for d in range(5, 10))
    one = O.split_repair(df.withColumn("label", F.lit("x")), ["d"], "label", "i", 4, ["i"], n_attempts=2).collect()
    assert len(one) == 10 and not any(r["accepted"] for r in one)


def _fails(df, match):
    with pytest.raises(Exception, match=match):
        df.collect()


def test_guards_fire(spark):
    _fails(O.sample_k(spark.range(3).toDF("x"), 10, 1, ["x"]), "fewer than 10 rows")
    _fails(O.sample_k(spark.range(0).toDF("x"), 10, 1, ["x"]), "fewer than 10 rows")
    assert O.sample_k(spark.range(30).toDF("x"), 10, 1, ["x"]).count() == 10
    df = spark.createDataFrame([(1, 0, [1.0, 2.0], 5)], "ds int, pos int, x array<double>, d int")
    _fails(RG.ragged_pack(df, ["ds"], "pos", "x", "d", F.lit(0)), "row length exceeds")
    wide = spark.range(1).toDF("a").withColumn("b", F.lit(1))
    for bad in ({"exclude": [7]}, {"id_index": 9}):
        with pytest.raises(ValueError):
            C.select_features(wide, label=0, **bad)
    C.check_feature_contract(["b", "a"], wide, ["a", "b"])
    with pytest.raises(ValueError):
        C.check_feature_contract(["a"], wide, ["a", "b"])
    with pytest.raises(ValueError):
        TG.check_class_limit(11, grouping=False)
    for lo, hi, error in ((1, 0.5, ValueError), (5, 5, ValueError), (0.2, 1.0, ValueError), ("a", 2, TypeError)):
        with pytest.raises(error):
            O.validate_train_size_range(lo, hi)
    O.validate_train_size_range(0.1, 0.9)
    O.validate_train_size_range(1, 9)


def test_pair_datasets_needs_a_train_file(spark):
    from tessera.sources import files as FS
    with pytest.raises(FileNotFoundError):
        FS.pair_datasets(spark.createDataFrame([("/a/x/other.csv",)], "path string"))


def test_named_csv_reads_each_header(spark, tmp_path):
    from tessera.sources import files as FS
    (tmp_path / "a.csv").write_text("predicted,true\n1,2\n")
    (tmp_path / "b.csv").write_text("true,predicted\n2,1\n2,3\n")
    got = sorted((r["predicted"], r["true"]) for r in FS.read_named_csv(spark, str(tmp_path), ["predicted", "true"]).collect())
    assert got == [("1", "2"), ("1", "2"), ("3", "2")]
    (tmp_path / "c.csv").write_text("true\n1\n")
    with pytest.raises(Exception, match="missing required columns"):   # when the file is read: it is read once
        FS.read_named_csv(spark, str(tmp_path), ["predicted", "true"]).collect()



def test_repeated_map_keys_last_wins(spark):
    r = spark.range(1).select(TL.parse_log_line(F.lit("t|f|INFO|a=1|b=2|a=3")).alias("p")).first()["p"]
    assert r["kv"] == {"a": "3", "b": "2"}
    many = "t|f|INFO|" + "|".join(f"k{i}={i}" for i in range(1200))
    assert len(spark.range(1).select(TL.parse_log_line(F.lit(many)).alias("p")).first()["p"]["kv"]) == 1200
    m = [F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("1")), F.create_map(F.lit("a"), F.lit("2"))]
    out = WK.items_normalise(spark.createDataFrame([("x",)], "ref string"), ["ref"], None, m).first()
    assert out["metadata"] == {"a": "2", "b": "1"}


def test_extend_without_a_lease_is_ignored(spark):
    ev = [("a", "put", 0.0), ("a", "extend", 1.0), ("b", "put", 0.0), ("b", "lease", 1.0), ("b", "extend", 9.0),
          ("c", "put", 0.0), ("c", "lease", 1.0), ("c", "extend", 4.0)]
    df = spark.createDataFrame(ev, "task_id string, op string, t double")
    got = {r["task_id"]: r["state"] for r in WK.ledger_state(df, F.lit(8.0), 5.0, 1.0, 10).collect()}
    assert got == {"a": "visible", "b": "visible", "c": "leased"}


def test_ledger_of_long_tasks_against_a_fold(spark):
    rng = random.Random(3)
    ops = ["put", "lease", "nack", "extend", "extend", "extend"]
    ev = [(f"t{rng.randrange(12)}", rng.choice(ops), float(rng.randrange(150))) for _ in range(900)] + [("u", "lease", 1.0), (None, "put", 1.0)]
    ev += [(f"v{k}", o, float(t)) for k in range(40) for o, t in [("put", 0), *((rng.choice(ops[1:]), rng.randrange(60)) for _ in range(rng.randrange(12)))]]
    want, now, ttl, delay = {}, 152.0, 6.0, 30.0
    for task in {t for t, op, _ in ev if op == "put" and t}:
        until = back = None
        for t, op in sorted((t, op) for k, op, t in ev if k == task and op != "put"):
            if op == "lease" or op == "extend" and until is not None and t < until:
                until, back = t + ttl, None
            elif op == "nack":
                until, back = None, t + delay
        again = until + delay if until is not None else back
        want[task] = ("leased" if until is not None and now < until else "delayed" if again is not None and now < again else "visible",
                      sum(k == task and op == "lease" for k, op, _ in ev))
    df = spark.createDataFrame(ev, "task_id string, op string, t double").repartition(5)
    state = WK.ledger_state(df, F.lit(now), ttl, delay, 10_000)
    assert {r["task_id"]: (r["state"], r["attempts"]) for r in state.collect()} == want
    assert "collect_list" not in state._jdf.queryExecution().toString()  # no row holds a whole task
    by_time = WK.ledger_state(df, F.lit(now), ttl, delay, 10_000, F.floor(F.col("t") / 7))
    assert {r["task_id"]: (r["state"], r["attempts"]) for r in by_time.collect()} == want
    assert {s for s, _ in want.values()} == {"leased", "delayed", "visible"}


def test_every_class_reaches_a_leaf(spark):
    tree = TG.class_tree(spark.range(1000).select(F.col("id").cast("int").alias("class_idx")), max_classes=3)
    assert tree.where("is_leaf").select("class_idx").distinct().count() == 1000


def test_ordinal_codes_follow_the_whole_string(spark):
    names = [f"Customer#{k:06d}" for k in range(3000)] + ["É", "a", ""]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    codes = {r["category"]: r["code"] for r in TR.OrdinalEncode(["c"]).fit(df).dictionary.collect()}
    assert codes == {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()))}


def test_yeo_johnson_interval_widens(spark):
    x = np.linspace(0.05, 0.95, 4000) ** (-1 / 9.0) - 1
    lam = TR.YeoJohnson(["x"]).fit(spark.createDataFrame([(float(v),) for v in x], "x double")).lam["x"]
    ll = lambda l: -len(x) / 2 * np.log(_yj_np(x, l).var()) + (l - 1) * np.log1p(x).sum()  # noqa: E741, E731
    grid = np.arange(-12, 0, 0.005)
    assert lam < -5 and abs(lam - grid[np.argmax([ll(g) for g in grid])]) < 0.01


def test_quantile_normal_reads_all_rows(spark):
    df = spark.range(30_000).select((F.pow(F.col("id") / 30_000.0, 3) * 1000).alias("x"))
    q = TR.QuantileNormal(["x"], 101).fit(df).quantiles["x"]
    want = df.agg(F.percentile("x", F.array(*[F.lit(i / 100) for i in range(101)]))).first()[0]
    assert np.allclose(q, want, rtol=1e-12)


def test_log_parsers_edge_rows(spark):
    def table(text, file="f"):
        return spark.createDataFrame([(file, i, v) for i, v in enumerate(text.split("\n"))], "file string, line_no long, value string")

    start = lambda s: TL.parse_start_time(table(f"Monitor started at {s}")).first()["start_epoch"]
    assert start("1970-01-01T00:00:10.5") == 10.5 and start("1970-01-01T08:00:01+08:00") == 1 and start("1970-01-02") == 86400
    assert start("1970-01-01T00:00:02Z") == 2 and start("soon") is None
    dmon = "  # GPU pwr temp gtemp\n\n0 10 50 -\n1 x 51 52\nz 1 2 3\n0 9\n# no\n+1 7 8 9 extra"
    got = TL.first_key_ticks(TL.parse_header_driven(table(dmon), TL.DMON_RENAME, "gpu", F.lit(0)), "gpu", F.lit(0))
    assert [(r["gpu"], r["pwr_W"], r["temp_C"], r["tick"]) for r in got.orderBy("line_no").collect()] == [
        (0, 10.0, 50.0, 0), (1, None, 52.0, 0), (1, 7.0, 9.0, 0)]
    io = "12:00:00\nDevice r await %util\nsda 9 1 50\nMon 1 2024\nsda 9 3 x\nsdb 9 5 10\nnoise\n13:00:00 x y z w"
    assert [(r["time_s"], r["util_pct"], r["await_ms"]) for r in TL.parse_iostat(table(io), F.lit(0)).orderBy("time_s").collect()] == [
        (0, 50.0, 1.0), (1, 10.0, 4.0)]
    sar = "12:00:01 eth0 1 2 3\n12:00:01 IFACE a rxkB/s txkB/s\n12:00:01 eth0 10 20 3.5 4.5 0 0\nAverage: eth0 1 2"
    assert [(r["time_s"], r["sum_kBs"]) for r in TL.parse_net(table(sar), F.lit(0), interfaces=True).collect()] == [(0, 30.0)]
    free = "===== a =====\nMem: 1\nSwap\n===== b =====\n===== c =====\nMem: 2"
    assert [r["time_s"] for r in TL.parse_free_memory(table(free), F.lit(0)).orderBy("time_s").collect()] == [0, 1]


def test_chunk_balanced_equal_weights(spark):
    out = WK.chunk_balanced(spark.range(1000).select("id", F.lit(1).alias("w")), "w", "id", 7)
    assert {r["count"] for r in out.groupBy("chunk").count().collect()} <= {142, 143}


def test_sparse_ids_and_a_hot_job(spark):
    df = spark.range(2000).select((F.col("id") * 9_000_000_000_000).alias("k"), F.when(F.col("id") % 10 > 0, "hot").otherwise("cold").alias("job"))
    a = WK.chunk_fixed(df, ["job"], ["k"], 7).select("k", "task_id")
    w = Window.partitionBy("job").orderBy("k")
    b = df.select("k", F.concat_ws("#", "job", F.floor((F.row_number().over(w) - 1) / 7).cast("string")).alias("task_id"))
    assert a.exceptAll(b).count() == 0 and a.count() == 2000


def test_feature_patterns_are_permutations():
    from tessera.operators import ensemble as EN
    for method in EN.PATTERN_METHODS:
        for n, m in ((1, 4), (3, 8), (7, 5)):
            got = EN.feature_patterns(n, m, method, 3)
            assert all(sorted(p) == list(range(n)) for p in got)
            if method in ("shift", "latin") and m > 1:
                assert all(len({p[j] for p in got}) == n for j in range(n))
    assert len({tuple(p) for p in EN.feature_patterns(3, 6, "random", 1)}) == 6
    cfg = EN.ensemble_configs(EN.feature_patterns(3, 8, "latin"), 4, ["none", "power"], 8)
    assert [c.norm for c in cfg] == ["none"] * 4 + ["power"] * 4 and len({(tuple(c.pattern), c.shift, c.norm) for c in cfg}) == 8
    with pytest.raises(ValueError):
        EN.feature_patterns(3, 2, "other")


def test_join_label_decode_counts_predictions(spark):
    import __spark_entry__ as E
    from tests.conftest import SF001
    q = E.queries()
    want = {r["prediction"]: r["n"] for r in q["predict_labels"](spark, SF001).groupBy("prediction").agg(F.count(F.lit(1)).alias("n")).collect()}
    got = q["join_label_decode"](spark, SF001)
    assert set(got.columns) == {"pred_idx", "prediction", "n"} and {r["prediction"]: r["n"] for r in got.collect()} == want


def test_block_scores_count_groups_within_a_view(spark, monkeypatch):
    """What is moved follows the rows of a view, not of all views together."""
    rows = [(v, i, [float(i % 5), float(i % 3)], i % 2) for v in range(8) for i in range(40)]
    df = spark.createDataFrame(rows, "v int, id long, x array<double>, y int")
    got = S.block_scores(df, df, ["v", "id"], "x", "y", S.KernelVote(2), by=["v"], group=40, piece=40)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "hashpartitioning" not in plan and "sequence(0, 0" in plan and got.count() == 320
    one = S.block_scores(df, df, ["v", "id"], "x", "y", S.KernelVote(2), by=["v"], group=7, piece=9)
    assert got.select("v", "id", F.transform("scores", lambda s: F.round(s, 9)).alias("s")).exceptAll(
        one.select("v", "id", F.transform("scores", lambda s: F.round(s, 9)).alias("s"))).count() == 0


def test_split_repair_of_gathered_and_large_datasets_agree(spark, monkeypatch):
    """Rows of invalid datasets are moved once, whatever the attempts; datasets too large for an array come by ranks."""
    rows = [(d, i, "xyz"[(i * (d + 1) // 3) % (2 + d % 2)] if d % 5 else None) for d in range(40) for i in range(2 + d % 9)]
    df = spark.createDataFrame(rows, "d int, i int, label string")
    names, kept = [], O.stored
    monkeypatch.setattr(O, "stored", lambda x, name: names.append(name) or kept(x, name))
    split = lambda: sorted((r["d"], r["attempt"] or -1, r["accepted"]) for r in O.split_repair(df, ["d"], "label", "i", 3, ["i"]).collect())
    gathered = split()
    assert names == ["repair-judged", "repair-gathered"] and len(gathered) == 40 and any(a > 0 for _, a, _ in gathered)
    monkeypatch.setattr(O, "GATHERED", 0)
    assert split() == gathered


def test_values_of_a_row_are_computed_once(spark):
    """An expression inside a lambda is computed for each element: maps and softmaxes took quadratic and cubic time."""
    from tessera.functions.arrays import log_softmax, map_last_wins, softmax
    import time
    entries = F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda i: F.struct((i % 1990).cast("string").alias("key"), (i + F.col("id")).alias("value")))
    scores = F.transform(F.sequence(F.lit(0), F.lit(999)), lambda i: F.sqrt(i + F.col("id").cast("double")))
    start = time.time()
    r = spark.range(3).select(map_last_wins(entries).alias("m"), softmax(scores, 0.5).alias("s"), log_softmax(scores, 0.5).alias("l")).collect()
    assert time.time() - start < 40
    z = np.sqrt(np.arange(1000) + 2.0) / 0.5
    want = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    assert np.allclose(r[2]["s"], want) and np.allclose(r[2]["l"], np.log(want))
    assert len(r[2]["m"]) == 1990 and r[2]["m"]["3"] == 1995 and r[2]["m"]["20"] == 22


def test_class_tree_rows_meet_without_a_shuffle_of_outcomes(spark):
    df = spark.range(300).select("id", (F.col("id") * 37 % 31).alias("label"), (F.col("id") % 7).cast("double").alias("a"))
    model = S.fit_class_tree(df, ["a"], "label")
    p = S.chain_rule(S.node_scores(df, ["id"], model), ["id"], model)
    plan = S.best_class(p, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert all(abs(r["t"] - 1) < 1e-9 for r in p.groupBy("id").agg(F.sum("p").alias("t")).collect())


def test_long_projections_are_compiled(spark):
    from tessera.session import compiled
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        compiled(spark)
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)


def test_chunk_starts_are_not_broadcast(spark, monkeypatch):
    plans, kept = [], WK.stored

    def watched(x, name):
        if name in ("starts", "jump"):
            plans.append((name, x._jdf.queryExecution().executedPlan().toString()))
        return kept(x, name)

    monkeypatch.setattr(WK, "stored", watched)
    df = spark.range(60).select(F.lit("a").alias("job"), F.col("id").alias("pos"), F.lit(1.0).alias("w"))
    got = {r["pos"]: r["chunk"] for r in WK.chunk_by_weight(df, ["job"], ["pos"], "w", 4.0).collect()}
    assert got == {i: i // 4 for i in range(60)}
    rounds = plans[1:]
    assert len(rounds) > 3 and not any("Broadcast" in plan for _, plan in rounds)
