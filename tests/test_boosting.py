"""Boosting, its explanations and the recurrent model against brute force."""
import itertools
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineforge.operators import boosting as B
from lineforge.operators import contributions as C
from lineforge.operators import matrix, models, recurrent


def test_best_splits_against_all_splits():
    rng = np.random.default_rng(1)
    s = B.BoostSettings(min_weight=2.0)
    for missing in (False, True):
        h = rng.integers(0, 3, (40, B.BINS)).astype(float)
        g = rng.normal(size=(40, B.BINS)) * h
        if not missing:
            g[:, B.MISSING] = h[:, B.MISSING] = 0
        gain, at, left, gl, hl = B.best_splits(g, h, s)
        weight = lambda a, b: max(abs(a) - s.l1, 0.0) ** 2 / (b + s.l2)
        for k in range(40):
            best = 0.0
            for cut in range(B.MISSING):
                for with_missing in (False, True):
                    one = list(range(cut + 1)) + ([B.MISSING] if with_missing else [])
                    a, b = g[k, one].sum(), h[k, one].sum()
                    if b >= 2 and h[k].sum() - b >= 2:
                        best = max(best, weight(a, b) + weight(g[k].sum() - a, h[k].sum() - b) - weight(g[k].sum(), h[k].sum()))
            assert math.isclose(gain[k], best, rel_tol=1e-8, abs_tol=1e-12)
            one = list(range(at[k] + 1)) + ([B.MISSING] if left[k] else [])
            assert math.isclose(gl[k], g[k, one].sum(), abs_tol=1e-9) and math.isclose(hl[k], h[k, one].sum(), abs_tol=1e-9)


def frame(spark, n=1500, nulls=0.2, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, 2.0, -1.0) * x[:, 2] + 0.3 * rng.normal(size=n)
    hole = rng.random(n) < nulls
    y[hole] = 9.0 + 0.1 * rng.normal(size=hole.sum())  # what is missing tells something
    rows = [(f"r{i:05d}", *[None if hole[i] and j == 0 else float(v) for j, v in enumerate(x[i])], float(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "current_account_nbr string, a double, b double, c double, d double, y double")


FEATS = ["a", "b", "c", "d"]
SMALL = B.BoostSettings(max_trees=6, max_depth=3, learning_rate=0.3, column_share=0.75)


def test_many_parts_give_the_model_of_one(spark):
    df = frame(spark)
    fit = lambda part_rows: B.fit_boosted(df, FEATS, "y", F.xxhash64("current_account_nbr") % 5 == 0, ["current_account_nbr"], SMALL, part_rows)
    one, many = fit(1 << 18), fit(400)
    assert len(one.trees) == len(many.trees) == 6 and np.allclose(one.errors, many.errors)
    for a, b in zip(one.trees, many.trees):
        for k in ("feature", "bin", "left", "missing_left"):
            assert (a[k] == b[k]).all()
        assert np.allclose(a["value"], b["value"]) and np.allclose(a["cover"], b["cover"])


def test_few_parts_meet_without_an_exchange(spark, monkeypatch):
    df, made = frame(spark, 600), []
    real = B._level_job

    def level_job(blocks, *rest):
        with_exchange = not rest[-1] <= B.FEW_PARTS
        got = real(blocks, *rest)
        made.append((with_exchange, got))
        return got

    monkeypatch.setattr(B, "_level_job", level_job)
    fit = lambda: B.fit_boosted(df, FEATS, "y", F.xxhash64("current_account_nbr") % 5 == 0, ["current_account_nbr"],
                                B.BoostSettings(max_trees=2, max_depth=3, learning_rate=0.3), 100)
    few = fit()
    monkeypatch.setattr(B, "FEW_PARTS", 1)
    many = fit()
    half = len(made) // 2
    assert [w for w, _ in made] == [False] * half + [True] * half
    for (_, (a, e)), (_, (b, f)) in zip(made[:half], made[half:]):
        order = lambda c: np.lexsort((c["feature"], c["node"]))
        assert np.allclose(e, f) and all(np.allclose(a[k][order(a)], b[k][order(b)]) for k in a)
    assert len(few.trees) == len(many.trees) == 2 and np.allclose(few.errors, many.errors)


def test_nulls_take_the_learnt_side_without_imputation(spark):
    df = frame(spark)
    model = models.fit_with_tail(df, FEATS, "y", ["current_account_nbr"], settings=B.BoostSettings(learning_rate=0.3, max_trees=40, max_depth=4))
    got = models.predict_floor(model, df, FEATS, floor=None).select("a", "y", "prediction").toPandas()
    assert (got.prediction[got.a.isna()] - 9.0).abs().mean() < 0.6
    assert (got.prediction - got.y).abs().mean() < 0.6
    sides = [t["missing_left"][t["feature"] == 0] for t in model.trees]
    assert any(len(x) for x in sides)


def test_patience_ends_the_fit_and_cuts_to_the_best(spark):
    s = B.BoostSettings(max_trees=200, patience=8, max_depth=5, learning_rate=0.8, min_weight=1.0)
    model = models.fit_with_tail(frame(spark, 400, seed=9), FEATS, "y", ["current_account_nbr"], settings=s)
    best = int(np.argmin(model.errors))
    assert len(model.trees) == best and len(model.errors) - 1 == best + 8 < 200


def test_odd_tables(spark):
    df = frame(spark, 60)
    none = B.fit_boosted(df.limit(0), FEATS, "y", F.lit(False), ["current_account_nbr"], SMALL)
    assert none.trees == [] and none.predict(df).agg(F.max("prediction")).first()[0] == 0.0
    flat = B.fit_boosted(df.withColumn("y", F.lit(4.0)), FEATS, "y", F.lit(False), ["current_account_nbr"], SMALL)
    assert flat.trees == [] and flat.base == 4.0
    holes = df.withColumn("b", F.lit(None).cast("double")).withColumn("y", F.when(F.col("c") > 0, F.col("y")))
    model = B.fit_boosted(holes.unionByName(holes), FEATS, "y", F.lit(None).cast("boolean"), ["current_account_nbr"], SMALL)
    assert len(model.trees) == 6 and model.errors == [] and model.predict(holes.limit(0)).count() == 0
    assert all((t["feature"] != 1).all() for t in model.trees)


def test_saved_model_predicts_the_same(spark, tmp_path):
    df = frame(spark, 300)
    model = B.fit_boosted(df, FEATS, "y", F.lit(False), ["current_account_nbr"], SMALL)
    again = B.BoostedTrees.load(spark, model.save(spark, str(tmp_path / "m")))
    x = np.array([[np.nan, 1, 2, 3], [0.1, -1, np.nan, 0], [5, 5, 5, 5]], float)
    assert (again.raw(x) == model.raw(x)).all() and again.features == FEATS
    assert math.isclose(sum(v for _, v in model.importances()), 1.0)


def _exact(tree, x, n_feat):
    def value(node, known):
        if tree["left"][node] < 0:
            return tree["value"][node]
        f, l, r = tree["feature"][node], tree["left"][node], tree["right"][node]
        if f in known:
            left = tree["missing_left"][node] if np.isnan(x[f]) else x[f] <= tree["threshold"][node]
            return value(l if left else r, known)
        return (tree["cover"][l] * value(l, known) + tree["cover"][r] * value(r, known)) / tree["cover"][node]

    phi = np.zeros(n_feat)
    for i in range(n_feat):
        others = [j for j in range(n_feat) if j != i]
        for k in range(len(others) + 1):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(n_feat - k - 1) / math.factorial(n_feat)
                phi[i] += w * (value(0, set(s) | {i}) - value(0, set(s)))
    return phi


def test_contributions_with_nulls_are_exact_shapley_values(spark):
    df = frame(spark, 400)
    s = B.BoostSettings(max_trees=5, max_depth=5, learning_rate=0.5, column_share=1.0)
    model = B.fit_boosted(df, FEATS, "y", F.lit(False), ["current_account_nbr"], s)
    got = C.explain(df, model, FEATS, zero_fill=False).toPandas().set_index("current_account_nbr")
    given = df.toPandas().set_index("current_account_nbr")
    assert given.a.isna().sum() > 20
    for name in list(given.index[given.a.isna()][:4]) + list(given.index[:6]):
        x = given.loc[name, FEATS].to_numpy(dtype=float)
        phi = got.loc[name, [f"contrib_{f}" for f in FEATS]].to_numpy(dtype=float)
        assert np.allclose(phi, sum(_exact(t, x, 4) for t in model.trees), atol=1e-9)
        assert math.isclose(got.loc[name, "base_value"] + phi.sum(), model.raw(x[None])[0], abs_tol=1e-9)


@pytest.mark.parametrize("parts", [1, 7])
def test_positional_tail_is_the_last_rows(spark, parts):
    rows = [(f"k{i % 50:02d}", i) for i in range(503)] + [(None, 1000), (None, 1001)]
    df = spark.createDataFrame(rows, "current_account_nbr string, month int").repartition(parts, "month")
    got = matrix.positional_tail(df, 0.2, ["current_account_nbr", "month"]).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))[-101:]
    assert sorted((r[0], r[1]) for r in got if r.is_validation) == sorted(want) and len(got) == 505
    assert matrix.positional_tail(df.limit(0), 0.2, ["month"]).count() == 0
    with pytest.raises(ValueError):
        matrix.positional_tail(df.limit(4), 0.2, ["month"])


def test_recurrent_gradient_against_differences():
    s = recurrent.RecurrentSettings(first=5, second=4, dense=3)
    rng = np.random.default_rng(2)
    flat = recurrent.initial(2, s) + 0.05 * rng.normal(size=recurrent.initial(2, s).size)
    x, y = rng.normal(size=(6, 4, 2)), rng.normal(size=6)
    g, loss = recurrent.gradient(flat, x, y, s)
    assert math.isclose(loss, float(((recurrent.forward(flat, x, s) - y) ** 2).sum()), rel_tol=1e-12)
    for k in rng.choice(flat.size, 60, replace=False):
        step = np.zeros_like(flat)
        step[k] = 1e-6
        up, down = (((recurrent.forward(flat + d, x, s) - y) ** 2).sum() for d in (step, -step))
        assert math.isclose(g[k], (up - down) / 2e-6, rel_tol=1e-5, abs_tol=1e-6)


def test_recurrent_model_learns_and_stops(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2, 5))
    y = 50 + 10 * x[:, 0, -1] + 5 * x[:, 1].sum(1)
    df = spark.createDataFrame([(f"k{i:04d}", x[i].ravel().tolist(), float(y[i])) for i in range(600)],
                               "current_account_nbr string, features array<double>, target double")
    s = recurrent.RecurrentSettings(first=10, second=8, dense=6, rate=0.05, epochs=40, patience=6, dropout=0.0)
    model = recurrent.fit_recurrent(df, 2, ["current_account_nbr"], s)
    pred = recurrent.predict_recurrent(model, df, 2).toPandas()
    assert ((pred.prediction - pred.target) ** 2).mean() < 0.25 * pred.target.var()
    assert min(model.losses) < 0.5 * model.losses[0] and len(model.losses) <= 41
    empty = recurrent.fit_recurrent(df.limit(0), 2, ["current_account_nbr"], s)
    assert recurrent.predict_recurrent(empty, df.limit(0), 2).count() == 0


def test_bins_find_the_leaves_that_rows_of_values_do():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(4000, 4))
    x[rng.random(x.shape) < 0.2] = np.nan
    y = np.nan_to_num(x[:, 0]) * 3 + np.isnan(x[:, 1]) + rng.normal(size=4000)
    edges = [np.unique(np.quantile(c[~np.isnan(c)], np.arange(1, 63) / 63)) for c in x.T]
    bins = np.array([np.where(np.isnan(c), B.MISSING, np.searchsorted(e, c)) for e, c in zip(edges, x.T)]).astype(np.uint8)
    row = {"bins": bins.tobytes(), "y": y.tobytes(), "score": np.zeros(4000).tobytes(), "val": np.zeros(4000, np.uint8).tobytes(),
           "seed": rng.integers(0, 2 ** 62, 4000).tobytes()}
    for depth in (1, 4, 9):  # the last one with more nodes than a byte counts
        s = B.BoostSettings(max_depth=depth, min_weight=0.5, l1=0.0, row_share=1.0, column_share=1.0)
        tree = B.Rounds(4, edges, s).next_tree(lambda level: B._level_here([B._Block(row, 4)], level, s))
        assert depth < 9 or len(tree["value"]) > 256
        model = B.BoostedTrees(FEATS, 0.0, [tree])
        assert (tree["value"][B.binned_leaves(tree, bins)] == model.raw(x)).all()


def test_scores_are_kept_between_trees_and_let_go(spark, monkeypatch):
    added, packed = [], []
    rescored, pack = B._rescored, B.pack_blocks
    monkeypatch.setattr(B, "_rescored", lambda blocks, tree, n: added.append(tree) or rescored(blocks, tree, n))
    monkeypatch.setattr(B, "pack_blocks", lambda df, *a: packed.append(df.rdd.getNumPartitions()) or pack(df, *a))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = B.fit_boosted(frame(spark), FEATS, "y", F.lit(False), ["current_account_nbr"], SMALL, 50)
    # each tree is evaluated once, not by every level of the trees after it
    assert len(added) == len(model.trees) == 6 and all(a is t for a, t in zip(added, model.trees))
    assert packed == [max(spark.sparkContext.defaultParallelism, 8)]  # 1,500 rows: 30 parts, of four times 50 rows 8
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_chunks_give_the_gradient_of_the_whole(monkeypatch):
    s = recurrent.RecurrentSettings(first=5, second=4, dense=3)
    rng = np.random.default_rng(8)
    flat = recurrent.initial(2, s) + 0.3 * rng.normal(size=len(recurrent.initial(2, s)))
    x, y = rng.normal(size=(11, 6, 2)), rng.normal(size=11)
    x[0] *= 1e4  # gates far on either side
    found = []
    for rows in (256, 4):
        monkeypatch.setattr(recurrent, "CHUNK", rows)
        found.append((*recurrent.gradient(flat, x, y, s, np.random.default_rng(2)), recurrent.forward(flat, x, s)))
    assert all(np.allclose(a, b, rtol=1e-12, atol=1e-12) and np.isfinite(a).all() for a, b in zip(*found))
    assert recurrent.forward(flat, x[:0], s).shape == (0,)


def test_tasks_together_give_the_model_of_one(spark, monkeypatch):
    df, made, jobs = frame(spark), [], []
    real = B._rounds_together
    monkeypatch.setattr(B, "_rounds_together", lambda *a: made.append(a[2:]) or real(*a))
    monkeypatch.setattr(B, "_level_job", lambda *a: jobs.append(a))
    monkeypatch.setattr(B, "TOGETHER", 4)  # six trees: the scores are handed on once
    monkeypatch.setattr(B, "JOINED", 100)
    monkeypatch.setattr(B, "BLOCK", 70)
    s = B.BoostSettings(max_trees=6, max_depth=5, learning_rate=0.3, column_share=0.75)
    fit = lambda rows: B.fit_boosted(df, FEATS, "y", F.xxhash64("current_account_nbr") % 5 == 0, ["current_account_nbr"], s, rows, together=True)
    one, many = fit(1 << 18), fit(400)
    assert [tasks for tasks, _ in made] == [min(B.task_slots(spark), 4)] * 2 and not jobs  # no job for a level
    assert not any(os.path.exists(folder) for _, folder in made)
    assert len(one.trees) == len(many.trees) == 6 and np.allclose(one.errors, many.errors)
    for a, b in zip(one.trees, many.trees):
        for k in ("feature", "bin", "left", "missing_left"):
            assert (a[k] == b[k]).all()
        assert np.allclose(a["value"], b["value"]) and (a["cover"] == b["cover"]).all()


def test_tasks_meet_only_where_they_can(spark, monkeypatch):
    monkeypatch.setattr(B, "_rounds_together", lambda *a: pytest.fail("the tasks cannot meet"))
    fit = lambda: B.fit_boosted(frame(spark, 600), FEATS, "y", F.lit(False), ["current_account_nbr"],
                                B.BoostSettings(max_trees=1, max_depth=2), 100, together=True)
    for name, value in (("shared_folder", lambda _: None), ("task_slots", lambda _: 1)):
        with monkeypatch.context() as m:
            m.setattr(B, name, value)
            assert len(fit().trees) == 1
    monkeypatch.setattr(B, "TOGETHER_ROWS", 10)
    assert len(fit().trees) == 1


def test_only_rows_on_their_way_are_routed():
    rng = np.random.default_rng(12)
    bins = rng.integers(0, B.BINS, (3, 500)).astype(np.uint8)
    tree = {k: np.repeat(v, 7) for k, v in B.empty_tree(0.0, 0.0).items()}
    tree["feature"][:3], tree["bin"][:3] = [0, 1, 2], [30, 10, 50]
    tree["left"][:3], tree["right"][:3], tree["missing_left"][:3] = [1, 3, 5], [2, 4, 6], [True, False, True]
    whole = B.binned_leaves(tree, bins)
    first = {k: v.copy() for k, v in tree.items()}
    first["left"][1:] = first["right"][1:] = -1
    assert (B.binned_leaves(tree, bins, B.binned_leaves(first, bins)) == whole).all()
    model = B.leaves(tree, lambda f, r: bins[f, r], lambda v, n: v <= tree["bin"][n], lambda v: v == B.MISSING, 500)
    assert (whole == model).all() and set(whole) == {3, 4, 5, 6}


def test_leaves_side_by_side_share_a_look_up():
    rng = np.random.default_rng(15)
    x = rng.normal(size=(3000, 4))
    x[rng.random(x.shape) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0]) * 3 + np.isnan(x[:, 1]) * np.nan_to_num(x[:, 2]) + rng.normal(size=3000)
    edges = [np.unique(np.quantile(c[~np.isnan(c)], np.arange(1, 63) / 63)) for c in x.T]
    bins = np.array([np.where(np.isnan(c), B.MISSING, np.searchsorted(e, c)) for e, c in zip(edges, x.T)]).astype(np.uint8)
    row = {"bins": bins.tobytes(), "y": y.tobytes(), "score": np.zeros(3000).tobytes(), "val": np.zeros(3000, np.uint8).tobytes(),
           "seed": rng.integers(0, 2 ** 62, 3000).tobytes()}
    for depth in (1, 2, 6, 9):
        s = B.BoostSettings(max_depth=depth, min_weight=20.0 if depth < 9 else 3.0, row_share=1.0, column_share=1.0)
        tree = B.Rounds(4, edges, s).next_tree(lambda level: B._level_here([B._Block(row, 4)], level, s))
        roots, n_leaves = C.leaf_groups(tree), int((tree["left"] < 0).sum())
        explainer = C.Explainer([tree], [2.0], 4)
        # a look-up for each group: far fewer than leaves
        assert len(explainer.groups[0]) == len(roots) and (depth < 6 or 2 * len(roots) < n_leaves)
        phi, pred = explainer.contributions(x[:40])
        assert (pred == 2.0 * B.BoostedTrees(FEATS, 0.0, [tree]).raw(x[:40])).all()
        assert np.allclose(phi, [2.0 * _exact(tree, r, 4) for r in x[:40]], atol=1e-9)
    alone = C.Explainer([B.empty_tree(3.0, 5.0)], [1.0], 4).contributions(x[:2])
    assert (alone[0] == 0).all() and (alone[1] == 3.0).all()
