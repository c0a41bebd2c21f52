"""Model invariants and brute-force checks on small fixtures."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paths import SF_CHECK, SF_SMALL
from lineforge.operators import contributions as C
from lineforge.operators import forecast, iforest
from lineforge.plans.catalog_reports import ANOMALY_COLS
from lineforge.plans.context import CUTOFF_MONTH, context


def _holt_numpy(ys, a, b):
    level, trend, sse = ys[0], ys[1] - ys[0], 0.0
    for y in ys:
        err = y - (level + trend)
        new_level = a * y + (1 - a) * (level + trend)
        trend = b * (new_level - level) + (1 - b) * trend
        level = new_level
        sse += err * err
    return max(3 * level + 6 * trend, 0.0), sse


def test_holt_matches_plain_recursion(spark):
    ctx = context(spark, SF_SMALL)
    series = forecast.monthly_series(ctx.cm, end_month=CUTOFF_MONTH)
    got = {r.current_account_nbr: r for r in forecast.holt_forecast(series).collect()}
    rows = series.collect()
    assert rows, "no eligible series"
    for r in rows[:40]:
        best = min((_holt_numpy(r.ys, a, b) + (a, b) for a, b in forecast.DEFAULT_GRID),
                   key=lambda t: (t[1], t[0], t[2], t[3]))
        g = got[r.current_account_nbr]
        assert math.isclose(g.hw_predicted_q4_spend, best[0], rel_tol=1e-9, abs_tol=1e-6)
        assert (g.alpha, g.beta) == (best[2], best[3])


def test_isolation_forest_share_and_scores(spark):
    df = entry.queries()["isolation_forest"](spark, SF_CHECK)
    pdf = df.toPandas()
    n = len(pdf)
    rate = entry.queries()["contamination_rate"](spark, SF_CHECK).first()["contamination"]
    assert set(pdf.anomaly_flag.unique()) <= {0, 1}
    # numpy-style percentile: the flagged share is within one row of the contamination
    assert abs(pdf.anomaly_flag.sum() - rate * n) <= 1.0
    assert (pdf.anomaly_score[pdf.anomaly_flag == 1] < 0).all()
    assert (pdf.anomaly_score[pdf.anomaly_flag == 0] >= 0).all()


def test_isolation_forest_scoring_matches_direct_traversal(spark):
    ctx = context(spark, SF_SMALL)
    feats = ctx.anomaly_features
    nodes, meta = iforest.fit_isolation_forest(feats, ANOMALY_COLS, n_trees=10, max_samples=64, seed=7)
    scored = iforest.score_isolation_forest(feats, nodes, meta, ANOMALY_COLS).toPandas().set_index("current_account_nbr")
    npdf = nodes.toPandas()
    x = feats.select("current_account_nbr", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                               for c in ANOMALY_COLS]).toPandas()
    c_psi = iforest.average_path_length([meta["psi"]])[0]
    for _, row in x.head(25).iterrows():
        total = 0.0
        for t, tree in npdf.groupby("tree"):
            tree = tree.set_index("node")
            node = 0
            while tree.loc[node, "feature"] >= 0:
                f = ANOMALY_COLS[int(tree.loc[node, "feature"])]
                node = int(tree.loc[node, "left_child"] if row[f] < tree.loc[node, "threshold"]
                           else tree.loc[node, "right_child"])
            total += tree.loc[node, "depth"] + iforest.average_path_length([tree.loc[node, "size"]])[0]
        expected = -2.0 ** (-(total / npdf.tree.nunique()) / c_psi)
        assert math.isclose(scored.loc[row.current_account_nbr, "score"], expected, rel_tol=1e-9)


def test_isolation_forest_is_repeatable(spark):
    ctx = context(spark, SF_SMALL)
    a = iforest.isolation_forest(ctx.anomaly_features, ANOMALY_COLS, 0.05, n_trees=20, seed=3).toPandas()
    b = iforest.isolation_forest(ctx.anomaly_features, ANOMALY_COLS, 0.05, n_trees=20, seed=3).toPandas()
    a = a.sort_values("current_account_nbr").reset_index(drop=True)
    b = b.sort_values("current_account_nbr").reset_index(drop=True)
    assert (a.anomaly_flag == b.anomaly_flag).all()
    assert np.allclose(a.anomaly_score, b.anomaly_score)


def _brute_shap(tree, x, n_feat):
    def value(node, s):
        if tree["left"][node] < 0:
            return tree["value"][node]
        f = tree["feature"][node]
        l, r = tree["left"][node], tree["right"][node]
        if f in s:
            return value(l if x[f] <= tree["threshold"][node] else r, s)
        c = tree["cover"][node]
        return (tree["cover"][l] * value(l, s) + tree["cover"][r] * value(r, s)) / c

    phi = np.zeros(n_feat)
    for i in range(n_feat):
        others = [j for j in range(n_feat) if j != i]
        for k in range(len(others) + 1):
            for s in itertools.combinations(others, k):
                w = math.factorial(k) * math.factorial(n_feat - k - 1) / math.factorial(n_feat)
                phi[i] += w * (value(0, set(s) | {i}) - value(0, set(s)))
    return phi


def test_tree_shap_matches_brute_force(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4))
    y = 3 * x[:, 0] + np.where(x[:, 1] > 0, 2.0, -1.0) * x[:, 2] + 0.1 * rng.normal(size=200)
    df = spark.createDataFrame([(f"r{i}", *map(float, x[i]), float(y[i])) for i in range(200)],
                               "current_account_nbr string, a double, b double, c double, d double, y double")
    feats = ["a", "b", "c", "d"]
    model = GBTRegressor(featuresCol="features", labelCol="y", maxIter=4, maxDepth=3, seed=1) \
        .fit(VectorAssembler(inputCols=feats, outputCol="features").transform(df))
    contrib = C.explain(df, model, feats).toPandas().set_index("current_account_nbr")
    trees, weights, _ = C.tree_tables(model, spark)
    for i in range(0, 200, 25):
        expected = sum(w * _brute_shap(t, x[i], 4) for t, w in zip(trees, weights))
        got = contrib.loc[f"r{i}", [f"contrib_{f}" for f in feats]].to_numpy(dtype=float)
        assert np.allclose(got, expected, atol=1e-9)
        row = contrib.loc[f"r{i}"]
        assert math.isclose(row.base_value + got.sum(), row.raw_prediction, abs_tol=1e-9)
    pred = model.transform(VectorAssembler(inputCols=feats, outputCol="features").transform(df)) \
        .select("current_account_nbr", "prediction").toPandas().set_index("current_account_nbr")
    assert np.allclose(contrib.raw_prediction, pred.loc[contrib.index, "prediction"], atol=1e-9)


@pytest.mark.parametrize("name", ["spend_gbt", "credit_adjuster", "sequence_forecast"])
def test_regression_metrics_are_finite(spark, name):
    r = entry.queries()[name](spark, SF_SMALL).first()
    assert r.n > 0 and math.isfinite(r.mae) and math.isfinite(r.rmse) and r.mae <= r.rmse + 1e-9


def test_predictions_floored_and_model_reload_equal(spark):
    q = entry.queries()
    assert q["predict_q4"](spark, SF_SMALL).where(F.col("xgb_predicted_q4_spend") < 0).count() == 0
    sink = q["model_sink"](spark, SF_SMALL)
    assert sink.count() > 0 and sink.where(~F.col("equal")).count() == 0


def test_recommendations_respect_rules(spark):
    out = entry.queries()["recommendation_run"](spark, SF_SMALL)
    ctx = context(spark, SF_SMALL)
    j = out.join(ctx.base.select("current_account_nbr", "cu_line_incr_excl_flag"), "current_account_nbr")
    excl = F.upper(F.col("cu_line_incr_excl_flag")) == "Y"
    assert j.where(excl & (F.col("adjustment_delta") > 0)).count() == 0
    assert j.where((F.col("current_credit_line") == 0) & (F.col("recommended_credit_line") != 0)).count() == 0
    assert out.count() == ctx.base.count()


def test_classifier_and_clusters(spark):
    q = entry.queries()
    report = {r.class_name: r for r in q["segment_classifier"](spark, SF_SMALL).collect()}
    assert {"accuracy", "macro avg", "weighted avg"} <= set(report)
    assert 0.0 <= report["accuracy"].f1 <= 1.0
    clusters = q["cluster_distribution"](spark, SF_SMALL).collect()
    assert 1 <= len(clusters) <= 6


def test_holt_estimated_is_the_least_squares_start(spark):
    ctx = context(spark, SF_SMALL)
    series = forecast.monthly_series(ctx.cm, end_month=CUTOFF_MONTH)
    got = {r.current_account_nbr: r for r in forecast.holt_estimated(series).collect()}
    for r in series.collect()[:25]:
        ys = np.array(r.ys, dtype=float)
        g = got[r.current_account_nbr]

        def errors(a, b, l0, b0):
            level, trend, out = l0, b0, []
            for y in ys:
                out.append(y - (level + trend))
                new_level = a * y + (1 - a) * (level + trend)
                trend = b * (new_level - level) + (1 - b) * trend
                level = new_level
            return np.array(out), level, trend

        best = None
        for a, b in forecast.DEFAULT_GRID:
            e0, _, _ = errors(a, b, 0.0, 0.0)
            el = errors(a, b, 1.0, 0.0)[0] - e0
            eb = errors(a, b, 0.0, 1.0)[0] - e0
            sol = np.linalg.lstsq(np.stack([el, eb], axis=1), -e0, rcond=None)[0]
            e, level, trend = errors(a, b, sol[0], sol[1])
            cand = (float(e @ e), max(3 * level + 6 * trend, 0.0), a, b)
            if best is None or cand < best:
                best = cand
        assert (g.alpha, g.beta) == (best[2], best[3])
        assert math.isclose(g.sse, best[0], rel_tol=1e-6, abs_tol=1e-3)
        assert math.isclose(g.hw_predicted_q4_spend, best[1], rel_tol=1e-6, abs_tol=1e-3)


def test_account_base_has_one_row_per_account(spark):
    from lineforge.operators.accounts import assert_one_row_per_account
    ctx = context(spark, SF_SMALL)
    assert assert_one_row_per_account(ctx.base).count() == 0


def test_gbt_and_kmeans_are_repeatable_with_a_fixed_seed(spark):
    from lineforge.operators import models
    from lineforge.operators.segments import CLASSIFICATION_FEATURES
    from lineforge.plans.catalog_reports import _q4_frame
    df, feats, target = _q4_frame(spark, SF_SMALL)
    train = df.where(F.col("split") == "train")
    test = df.where(F.col("split") == "test")
    settings = models.BoostSettings(max_trees=6, max_depth=3, learning_rate=0.3)
    preds = []
    for _ in range(2):
        model = models.fit_with_tail(train, feats, target, ["current_account_nbr", "month"], settings=settings)
        p = models.predict_floor(model, test, feats).select("current_account_nbr", "month", "prediction")
        preds.append(p.orderBy("current_account_nbr", "month").toPandas())
    assert np.array_equal(preds[0].prediction.to_numpy(), preds[1].prediction.to_numpy())
    seg = context(spark, SF_SMALL).segments
    a, _, cost_a = models.kmeans_clusters(seg, CLASSIFICATION_FEATURES, k=4, seeds=(7,))
    b, _, cost_b = models.kmeans_clusters(seg, CLASSIFICATION_FEATURES, k=4, seeds=(7,))
    assert math.isclose(cost_a, cost_b, rel_tol=1e-12)
    ja = a.select("current_account_nbr", "cluster_id").orderBy("current_account_nbr").toPandas()
    jb = b.select("current_account_nbr", "cluster_id").orderBy("current_account_nbr").toPandas()
    assert (ja.cluster_id.to_numpy() == jb.cluster_id.to_numpy()).all()


def test_refined_holt_only_lowers_the_error(spark):
    from lineforge.operators import forecast
    from lineforge.plans.catalog_models import _series
    series = _series(context(spark, SF_SMALL))
    grid = {r.current_account_nbr: r.sse for r in forecast.holt_estimated(series).collect()}
    fine = {r.current_account_nbr: r for r in forecast.holt_estimated(series, refine=6).collect()}
    assert set(grid) == set(fine)
    assert all(r.sse <= grid[a] * (1 + 1e-9) + 1e-6 and 0 < r.alpha < 1 and 0 < r.beta < 1 for a, r in fine.items())
    assert sum(r.sse < grid[a] * 0.999 for a, r in fine.items()) > len(fine) / 2


def test_large_inputs_of_long_fits_use_every_core(spark, monkeypatch):
    from lineforge.operators import models
    from lineforge.session import task_slots
    df = spark.createDataFrame([(f"k{i:04d}" if i % 50 else None, float(i)) for i in range(900)], "current_account_nbr string, x double")
    monkeypatch.setattr(models, "dealt_into", lambda df, parts, *keys: dealt.append(parts) or df.repartition(parts, *keys))
    for rows, least in ((900, None), (500, 2), (100, 9)):
        dealt = []
        monkeypatch.setattr(models, "TASK_ROWS", rows)
        kept = models._kept_dealt(df, "kept", task_slots(spark))
        assert dealt == ([max(least, task_slots(spark))] if least else [])
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, df.collect()))


def test_forest_keeps_the_rows_nodes(spark, monkeypatch):
    from lineforge.operators import models
    asked, real = [], models.RandomForestClassifier
    monkeypatch.setattr(models, "RandomForestClassifier", lambda **k: asked.append(k) or real(**k))
    df = spark.createDataFrame([(f"k{i:03d}", float(i % 17), float(i % 5), i % 3) for i in range(300)],
                               "current_account_nbr string, x double, z double, segment_label int")
    models.fit_segment_classifier(df, ["x", "z"], num_trees=5, max_depth=6)
    assert asked[0]["cacheNodeIds"] and asked[0]["checkpointInterval"] == 10
    rows = models._assembler(["x", "z"]).transform(df.withColumn("class_weight", F.lit(1.0))).coalesce(1)
    kept, walked = (real(**asked[0] | {"cacheNodeIds": c}).fit(rows).toDebugString.split("\n")[1:] for c in (True, False))
    assert kept == walked and len(kept) > 20  # the same trees
