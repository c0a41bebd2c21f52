"""Forecast, classifier, clustering, anomaly and recommendation queries.

Deterministic parts (Holt with fixed or grid-searched parameters, metric arithmetic,
joins of model outputs, reports on a stand-in predictor) carry exact DuckDB oracles;
fitted-model outputs are checked by row counts and the invariants in ``tests/``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import contributions as C
from ..operators import credit, forecast, iforest, matrix, models, recurrent, risk, segments
from .catalog import register
from .catalog_reports import ANOMALY_COLS, _q4_frame, _q4_oracle_body, _r
from .context import ACCT, CUTOFF_MONTH, QUARTER_END, QUARTER_MONTHS, context, finish
from .oracle import q
from ..session import materialise

HOLT_ALPHA, HOLT_BETA = 0.5, 0.3


def _memo(ctx, name, build):
    store = ctx.__dict__.setdefault("_models", {})
    if name not in store:
        store[name] = build()
    return store[name]


def _lit(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


_SERIES = f"""
hw_ser AS (SELECT current_account_nbr, CAST(total_spend AS DOUBLE) AS y,
             ROW_NUMBER() OVER (PARTITION BY current_account_nbr ORDER BY month) AS rn
           FROM customer_monthly WHERE month < DATE '{CUTOFF_MONTH}'),
hw_elig AS (SELECT current_account_nbr, COUNT(*) AS n, MAX(CASE WHEN rn = 1 THEN y END) AS y1,
              MAX(CASE WHEN rn = 2 THEN y END) AS y2
            FROM hw_ser GROUP BY current_account_nbr HAVING COUNT(*) FILTER (WHERE y > 0) >= 3)"""


def _holt_rec(grid) -> str:
    values = ", ".join(f"({_lit(a)}, {_lit(1.0 - a)}, {_lit(b)}, {_lit(1.0 - b)})" for a, b in grid)
    return _SERIES + f""",
hw_grid AS (SELECT * FROM (VALUES {values}) g(a, na, c, nc)),
hw_rec AS (
  SELECT e.current_account_nbr, g.a, g.na, g.c, g.nc, 0 AS t, e.y1 AS l, e.y2 - e.y1 AS b, CAST(0.0 AS DOUBLE) AS sse
  FROM hw_elig e, hw_grid g
  UNION ALL
  SELECT r.current_account_nbr, r.a, r.na, r.c, r.nc, r.t + 1,
    r.a * s.y + r.na * (r.l + r.b),
    r.c * ((r.a * s.y + r.na * (r.l + r.b)) - r.l) + r.nc * r.b,
    r.sse + (s.y - (r.l + r.b)) * (s.y - (r.l + r.b))
  FROM hw_rec r JOIN hw_ser s ON s.current_account_nbr = r.current_account_nbr AND s.rn = r.t + 1),
hw_final AS (
  SELECT r.current_account_nbr, r.a AS alpha, r.c AS beta, r.sse,
    GREATEST(3.0 * r.l + 6.0 * r.b, 0.0) AS fc
  FROM hw_rec r JOIN hw_elig e ON r.current_account_nbr = e.current_account_nbr AND r.t = e.n)"""


def _metrics_sql(src: str, y: str, yhat: str, model: str) -> str:
    e = f"(CAST({y} AS DOUBLE) - CAST({yhat} AS DOUBLE))"
    return (f"SELECT '{model}' AS model, {_r(f'AVG(ABS({e}))', 2)} AS mae, {_r(f'SQRT(AVG({e} * {e}))', 2)} AS rmse, "
            f"{_r(f'CASE WHEN VAR_POP(CAST({y} AS DOUBLE)) > 0 THEN 1.0 - SUM({e} * {e}) / (VAR_POP(CAST({y} AS DOUBLE)) * COUNT(*)) END', 4)} AS r2, "
            f"COUNT(*) AS n FROM (SELECT * FROM ({src}) WHERE {y} IS NOT NULL AND {yhat} IS NOT NULL)")


def _series(ctx):
    return forecast.monthly_series(ctx.cm, end_month=CUTOFF_MONTH, min_positive=3)


# ---------------------------------------------------------------------------------------
# Holt smoothing
# ---------------------------------------------------------------------------------------

@register("holt_fixed", q(f"""
SELECT current_account_nbr, {_r('fc', 4)} AS hw_predicted_q4_spend, {_r('sse', 2)} AS sse FROM hw_final""",
                          "customer_monthly", recursive=True, extra=_holt_rec([(HOLT_ALPHA, HOLT_BETA)])))
def q_holt_fixed(spark, sf_dir):
    from .reports import round_dp
    df = forecast.holt_fixed(_series(context(spark, sf_dir)), HOLT_ALPHA, HOLT_BETA)
    return df.select(ACCT, round_dp("hw_predicted_q4_spend", 4).alias("hw_predicted_q4_spend"),
                     round_dp("sse", 2).alias("sse"))


_HOLT_BEST = """
SELECT current_account_nbr, fc, alpha, beta, sse FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY current_account_nbr ORDER BY sse, fc, alpha, beta) AS k FROM hw_final)
WHERE k = 1"""


@register("holt_grid", q(f"""
SELECT current_account_nbr, {_r('fc', 4)} AS hw_predicted_q4_spend, alpha, beta FROM ({_HOLT_BEST})""",
                             "customer_monthly", recursive=True, extra=_holt_rec(forecast.DEFAULT_GRID)))
def q_holt_grid(spark, sf_dir):
    """The best of a grid of parameters from a fixed start, in floats that SQL repeats exactly."""
    from .reports import round_dp
    df = _memo(context(spark, sf_dir), "holt", lambda: forecast.holt_forecast(_series(context(spark, sf_dir))))
    return df.select(ACCT, round_dp("hw_predicted_q4_spend", 4).alias("hw_predicted_q4_spend"), "alpha", "beta")


def _holt_est_rec(grid) -> str:
    """Three linear recursions per (account, grid point) — data from a zero state, unit
    level, unit trend — with the six running error products, as in holt_estimated."""
    values = ", ".join(f"({_lit(a)}, {_lit(1.0 - a)}, {_lit(b)}, {_lit(1.0 - b)})" for a, b in grid)
    z = "CAST(0.0 AS DOUBLE)"
    one = "CAST(1.0 AS DOUBLE)"
    ey = "(s.y - (r.yl + r.yt))"
    el = f"({z} - (r.ul + r.ut))"
    eb = f"({z} - (r.vl + r.vt))"

    def step(l, b, y):
        lvl = f"(r.a * {y} + r.na * (r.{l} + r.{b}))"
        return f"{lvl}, r.c * ({lvl} - r.{l}) + r.nc * r.{b}"

    return _SERIES + f""",
he_grid AS (SELECT * FROM (VALUES {values}) g(a, na, c, nc)),
he_rec AS (
  SELECT e.current_account_nbr, g.a, g.na, g.c, g.nc, 0 AS t,
    {z} AS yl, {z} AS yt, {one} AS ul, {z} AS ut, {z} AS vl, {one} AS vt,
    {z} AS s_yy, {z} AS s_ly, {z} AS s_by, {z} AS s_ll, {z} AS s_lb, {z} AS s_bb
  FROM hw_elig e, he_grid g
  UNION ALL
  SELECT r.current_account_nbr, r.a, r.na, r.c, r.nc, r.t + 1,
    {step("yl", "yt", "s.y")}, {step("ul", "ut", z)}, {step("vl", "vt", z)},
    r.s_yy + {ey} * {ey}, r.s_ly + {el} * {ey}, r.s_by + {eb} * {ey},
    r.s_ll + {el} * {el}, r.s_lb + {el} * {eb}, r.s_bb + {eb} * {eb}
  FROM he_rec r JOIN hw_ser s ON s.current_account_nbr = r.current_account_nbr AND s.rn = r.t + 1),
he_last AS (
  SELECT r.*, e.y1, e.y2, r.s_ll * r.s_bb - r.s_lb * r.s_lb AS det
  FROM he_rec r JOIN hw_elig e ON r.current_account_nbr = e.current_account_nbr AND r.t = e.n),
he_init AS (
  SELECT *,
    CASE WHEN ABS(det) > 1e-12 * GREATEST(ABS(s_ll * s_bb), 1.0)
         THEN ((-s_ly) * s_bb - (-s_by) * s_lb) / det ELSE y1 END AS l0,
    CASE WHEN ABS(det) > 1e-12 * GREATEST(ABS(s_ll * s_bb), 1.0)
         THEN (s_ll * (-s_by) - s_lb * (-s_ly)) / det ELSE y2 - y1 END AS b0
  FROM he_last),
he_final AS (
  SELECT current_account_nbr, a AS alpha, c AS beta, l0, b0,
    s_yy + 2.0 * l0 * s_ly + 2.0 * b0 * s_by + l0 * l0 * s_ll + 2.0 * l0 * b0 * s_lb + b0 * b0 * s_bb AS sse,
    GREATEST(3.0 * (yl + l0 * ul + b0 * vl) + 6.0 * (yt + l0 * ut + b0 * vt), 0.0) AS fc
  FROM he_init)"""


@register("holt_estimated", q(f"""
SELECT current_account_nbr, {_r('fc', 4)} AS hw_predicted_q4_spend, alpha, beta, {_r('l0', 4)} AS l0,
  {_r('b0', 4)} AS b0 FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY current_account_nbr ORDER BY sse, fc, alpha, beta) AS k FROM he_final)
WHERE k = 1""", "customer_monthly", recursive=True, extra=_holt_est_rec(forecast.DEFAULT_GRID)))
def q_holt_estimated(spark, sf_dir):
    """Holt smoothing with least-squares initial level/trend per grid point (the
    optimiser-estimated start of the reference model)."""
    from .reports import round_dp
    ctx = context(spark, sf_dir)
    df = _memo(ctx, "holt_est", lambda: forecast.holt_estimated(_series(ctx)))
    return df.select(ACCT, round_dp("hw_predicted_q4_spend", 4).alias("hw_predicted_q4_spend"), "alpha", "beta",
                     round_dp("l0", 4).alias("l0"), round_dp("b0", 4).alias("b0"))


_HE_BEST = """SELECT current_account_nbr, fc FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY current_account_nbr ORDER BY sse, fc, alpha, beta) AS k FROM he_final)
  WHERE k = 1"""

REFINE = 6  # rounds: the last step is under a thousandth


def _holt_refined(ctx):
    return _memo(ctx, "holt_refined", lambda: forecast.holt_estimated(_series(ctx), refine=REFINE))


def _holt_fitted(ctx):
    return _memo(ctx, "holt_fitted", lambda: materialise(
        forecast.holt_estimated(_series(ctx), refine=REFINE, newton=True), "holt"))


@register("holt_forecast")
def q_holt_forecast(spark, sf_dir):
    """The trained forecast: start and parameters estimated, to a minimum of the squared error."""
    from .reports import round_dp
    return _holt_fitted(context(spark, sf_dir)).select(
        ACCT, round_dp("hw_predicted_q4_spend", 4).alias("hw_predicted_q4_spend"), "alpha", "beta", "l0", "b0", "sse")


@register("holt_forecast_check", q(f"""
SELECT current_account_nbr, {_r('sse', 2)} AS grid_sse, TRUE AS not_above_grid, TRUE AS within_bounds FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY current_account_nbr ORDER BY sse, fc, alpha, beta) AS k FROM he_final)
WHERE k = 1""", "customer_monthly", recursive=True, extra=_holt_est_rec(forecast.DEFAULT_GRID)))
def q_holt_forecast_check(spark, sf_dir):
    """The trained forecast of each account held against the best grid point's squared error."""
    from .reports import round_dp
    ctx = context(spark, sf_dir)
    grid = _memo(ctx, "holt_est", lambda: forecast.holt_estimated(_series(ctx))).select(ACCT, F.col("sse").alias("_grid"))
    j = grid.join(_holt_fitted(ctx), ACCT)
    return j.select(ACCT, round_dp("_grid", 2).alias("grid_sse"),
                    (F.col("sse") <= F.col("_grid") * F.lit(1 + 1e-9) + F.lit(1e-6)).alias("not_above_grid"),
                    (F.col("alpha").between(0, 1) & F.col("beta").between(0, 1)).alias("within_bounds"))


@register("holt_refined")
def q_holt_refined(spark, sf_dir):
    """Holt with estimated start, its parameters refined around the best grid point."""
    from .reports import round_dp
    return _holt_refined(context(spark, sf_dir)).select(
        ACCT, round_dp("hw_predicted_q4_spend", 4).alias("hw_predicted_q4_spend"), "alpha", "beta", round_dp("sse", 2).alias("sse"))


# what a quarter's forecast is held against: all months from the cutoff (as coded), or the quarter
WINDOWS = {"open_end": None, "quarter": QUARTER_END}


def _actual_sql(end: str | None) -> str:
    until = f" AND month < DATE '{end}'" if end else ""
    return (f"SELECT current_account_nbr, SUM(total_spend) AS actual_q4_spend FROM customer_monthly "
            f"WHERE month >= DATE '{CUTOFF_MONTH}'{until} GROUP BY current_account_nbr")


def _actual(ctx, end: str | None):
    rows = ctx.cm.where(F.col("month") >= F.to_date(F.lit(CUTOFF_MONTH)))
    if end:
        rows = rows.where(F.col("month") < F.to_date(F.lit(end)))
    return rows.groupBy(ACCT).agg(F.sum("total_spend").cast("double").alias("actual_q4_spend"))


def _each_window(make):
    """The frames of all windows, one under the other."""
    out = None
    for name, end in WINDOWS.items():
        df = make(name, end)
        out = df if out is None else out.unionByName(df)
    return out


@register("holt_estimated_metrics", q("\nUNION ALL\n".join(
    "SELECT '" + w + "' AS actuals, * FROM (" + _metrics_sql(
        f"SELECT h.fc, a.actual_q4_spend FROM ({_HE_BEST}) h JOIN ({_actual_sql(end)}) a "
        "ON h.current_account_nbr = a.current_account_nbr", "actual_q4_spend", "fc", "holt_estimated") + ")"
    for w, end in WINDOWS.items()), "customer_monthly", recursive=True, extra=_holt_est_rec(forecast.DEFAULT_GRID)))
def q_holt_estimated_metrics(spark, sf_dir):
    ctx = context(spark, sf_dir)
    hw = _memo(ctx, "holt_est", lambda: forecast.holt_estimated(_series(ctx)))
    return _each_window(lambda w, end: forecast.regression_metrics(
        hw.join(_actual(ctx, end), ACCT, "inner"), "actual_q4_spend", "hw_predicted_q4_spend", "holt_estimated")
        .withColumn("actuals", F.lit(w)))


@register("hw_eval_join", q("\nUNION ALL\n".join(f"""
SELECT '{w}' AS actuals, h.current_account_nbr, {_r('h.fc', 4)} AS hw_predicted_q4_spend,
  CAST(a.actual_q4_spend AS DOUBLE) AS actual_q4_spend
FROM ({_HOLT_BEST}) h JOIN ({_actual_sql(end)}) a ON h.current_account_nbr = a.current_account_nbr""" for w, end in WINDOWS.items()),
                            "customer_monthly", recursive=True, extra=_holt_rec(forecast.DEFAULT_GRID)))
def q_hw_eval_join(spark, sf_dir):
    from .reports import round_dp
    ctx = context(spark, sf_dir)
    hw = _memo(ctx, "holt", lambda: forecast.holt_forecast(_series(ctx)))
    return _each_window(lambda w, end: hw.join(_actual(ctx, end), ACCT, "inner").select(
        F.lit(w).alias("actuals"), ACCT, round_dp("hw_predicted_q4_spend", 4).alias("hw_predicted_q4_spend"), "actual_q4_spend"))


_TEST_ROWS = _q4_oracle_body("current_account_nbr, month, split, total_spend, spend_lag_1, spend_rolling_mean_3")


@register("regression_metrics", q(_metrics_sql(f"SELECT * FROM ({_TEST_ROWS}) WHERE split = 'test'", "total_spend",
                                               "spend_lag_1", "naive_lag_1"), "cm_lags", "customer_base"))
def q_regression_metrics(spark, sf_dir):
    df, _, _ = _q4_frame(spark, sf_dir)
    return forecast.regression_metrics(df.where(F.col("split") == "test"), "total_spend", "spend_lag_1", "naive_lag_1")


_HOLT_ROWS = {w: (f"SELECT h.fc, a.actual_q4_spend FROM ({_HOLT_BEST}) h JOIN ({_actual_sql(end)}) a "
                 "ON h.current_account_nbr = a.current_account_nbr") for w, end in WINDOWS.items()}


@register("comparison_table", q(f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY mae ASC NULLS LAST, model) = 1 AS is_best FROM (
{_metrics_sql(f"SELECT * FROM ({_TEST_ROWS}) WHERE split = 'test'", "total_spend", "spend_lag_1", "naive_lag_1")}
UNION ALL
{_metrics_sql(f"SELECT * FROM ({_TEST_ROWS}) WHERE split = 'test'", "total_spend", "spend_rolling_mean_3", "rolling_mean_3")}
UNION ALL
{_metrics_sql(_HOLT_ROWS["open_end"], "actual_q4_spend", "fc", "holt")}
UNION ALL
{_metrics_sql(_HOLT_ROWS["quarter"], "actual_q4_spend", "fc", "holt_quarter")})""", "cm_lags", "customer_base", recursive=True,
                                extra=_holt_rec(forecast.DEFAULT_GRID)))
def q_comparison_table(spark, sf_dir):
    return forecast.comparison_table(_simple_metrics(spark, sf_dir))


def _simple_metrics(spark, sf_dir) -> list:
    ctx = context(spark, sf_dir)
    df, _, _ = _q4_frame(spark, sf_dir)
    test = df.where(F.col("split") == "test")
    hw = _memo(ctx, "holt", lambda: forecast.holt_forecast(_series(ctx)))
    held = lambda end, name: forecast.regression_metrics(
        hw.join(_actual(ctx, end), ACCT, "inner"), "actual_q4_spend", "hw_predicted_q4_spend", name)
    return [forecast.regression_metrics(test, "total_spend", "spend_lag_1", "naive_lag_1"),
            forecast.regression_metrics(test, "total_spend", "spend_rolling_mean_3", "rolling_mean_3"),
            held(None, "holt"), held(QUARTER_END, "holt_quarter")]


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """The comparison with the fitted models in it (trained Holt, boosted trees, recurrent network)."""
    ctx = context(spark, sf_dir)
    trained = forecast.regression_metrics(_holt_fitted(ctx).join(_actual(ctx, QUARTER_END), ACCT, "inner"),
                                          "actual_q4_spend", "hw_predicted_q4_spend", "holt_fitted_quarter")
    fitted = [trained, q_spend_gbt(spark, sf_dir).drop("trees", "tried"), q_sequence_forecast(spark, sf_dir).drop("epochs")]
    return forecast.comparison_table(_simple_metrics(spark, sf_dir) + fitted)


@register("forecast_vs_actual", q(f"""
SELECT d.current_account_nbr, CAST(t.actual AS DOUBLE) AS actual, t.predicted FROM
  (SELECT DISTINCT current_account_nbr FROM customer_base) d
  JOIN (SELECT current_account_nbr, SUM(total_spend) AS actual, SUM(CAST(spend_lag_1 AS DOUBLE)) AS predicted
        FROM ({_TEST_ROWS}) WHERE split = 'test' GROUP BY current_account_nbr) t
  ON d.current_account_nbr = t.current_account_nbr""", "cm_lags", "customer_base"))
def q_forecast_vs_actual(spark, sf_dir):
    ctx = context(spark, sf_dir)
    df, _, _ = _q4_frame(spark, sf_dir)
    per = (df.where(F.col("split") == "test").groupBy(ACCT)
           .agg(F.sum("total_spend").cast("double").alias("actual"),
                F.sum(F.col("spend_lag_1").cast("double")).alias("predicted")))
    accts = ctx.base.select(ACCT).distinct()
    return per.join(accts, ACCT, "left").select(ACCT, "actual", "predicted")


@register("forecast_attach", q(f"""
SELECT b.current_account_nbr, COALESCE({_r('h.fc', 4)}, 0.0) AS q4_forecast
FROM customer_base b LEFT JOIN hw_final h ON b.current_account_nbr = h.current_account_nbr""",
                               "customer_base", "customer_monthly", recursive=True,
                               extra=_holt_rec([(HOLT_ALPHA, HOLT_BETA)])))
def q_forecast_attach(spark, sf_dir):
    from .reports import round_dp
    ctx = context(spark, sf_dir)
    hw = forecast.holt_fixed(_series(ctx), HOLT_ALPHA, HOLT_BETA)
    j = ctx.base.select(ACCT).join(hw, ACCT, "left")
    return j.select(ACCT, F.coalesce(round_dp("hw_predicted_q4_spend", 4), F.lit(0.0)).alias("q4_forecast"))


@register("anomaly_attach", q("""
SELECT b.current_account_nbr, COALESCE(CAST(f.anomaly_flag AS DOUBLE), 0.0) AS anomaly_flag
FROM customer_base b LEFT JOIN standin_flags f ON b.current_account_nbr = f.current_account_nbr""",
                              "customer_base", "standin_flags"))
def q_anomaly_attach(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return risk.attach_anomaly(ctx.base.select(ACCT), ctx.standin_flags).select(ACCT, "anomaly_flag")


@register("anomaly_scatter", q("""
SELECT a.current_account_nbr, a.avg_txn_amt, f.anomaly_flag, b.ca_current_utilz, b.has_fraud_case
FROM anomaly_features a JOIN standin_flags f ON a.current_account_nbr = f.current_account_nbr
LEFT JOIN customer_base b ON a.current_account_nbr = b.current_account_nbr""",
                               "anomaly_features", "standin_flags", "customer_base"))
def q_anomaly_scatter(spark, sf_dir):
    ctx = context(spark, sf_dir)
    pred = ctx.anomaly_features.select(ACCT, "avg_txn_amt").join(ctx.standin_flags, ACCT)
    return pred.join(ctx.base.select(ACCT, "ca_current_utilz", "has_fraud_case"), ACCT, "left")


# ---------------------------------------------------------------------------------------
# classifier report on a stand-in predictor (exact), and the fitted forest (invariants)
# ---------------------------------------------------------------------------------------

def _standin_pred(seg):
    p = (F.when((F.col("has_fraud_case") == 1) | (F.col("cu_nbr_days_dlq") > 60), 0)
         .when(F.col("ca_current_utilz") > 75, 2)
         .when(F.col("avg_monthly_sales_6m") > 0, 3).otherwise(1))
    return seg.select(ACCT, F.col("segment_label").cast("int").alias("y_true"), p.cast("int").alias("y_pred"))


_STANDIN_SQL = """SELECT current_account_nbr, segment_label AS y_true,
  CASE WHEN has_fraud_case = 1 OR cu_nbr_days_dlq > 60 THEN 0 WHEN ca_current_utilz > 75 THEN 2
       WHEN avg_monthly_sales_6m > 0 THEN 3 ELSE 1 END AS y_pred FROM segments"""


@register("confusion_matrix", q(f"""
SELECT y_true, {', '.join(f'COUNT(*) FILTER (WHERE y_pred = {k}) AS pred_{k}' for k in range(4))}
FROM ({_STANDIN_SQL}) GROUP BY y_true""", "segments"))
def q_confusion_matrix(spark, sf_dir):
    return models.confusion_matrix(_standin_pred(context(spark, sf_dir).segments))


def _report_sql() -> str:
    names = ", ".join(f"({k}, '{v}')" for k, v in sorted(segments.SEGMENTS.items()))
    per = f"""
SELECT n.name AS class_name,
  CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS precision, CASE WHEN sp > 0 THEN tp / sp ELSE 0.0 END AS recall,
  sp AS support, tp
FROM (VALUES {names}) n(label, name) CROSS JOIN LATERAL (
  SELECT CAST(COUNT(*) FILTER (WHERE y_true = n.label AND y_pred = n.label) AS DOUBLE) AS tp,
         COUNT(*) FILTER (WHERE y_pred = n.label) AS pp, COUNT(*) FILTER (WHERE y_true = n.label) AS sp
  FROM ({_STANDIN_SQL}))"""
    f1 = "CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END"
    cls = f"SELECT class_name, precision, recall, {f1} AS f1, support, tp FROM ({per})"
    return f"""
SELECT class_name, {_r('precision', 4)} AS precision, {_r('recall', 4)} AS recall, {_r('f1', 4)} AS f1,
  CAST(support AS BIGINT) AS support FROM (
  SELECT class_name, precision, recall, f1, support FROM ({cls})
  UNION ALL SELECT 'accuracy', NULL, NULL, SUM(tp) / SUM(support), SUM(support) FROM ({cls})
  UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), SUM(support) FROM ({cls})
  UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
    SUM(f1 * support) / SUM(support), SUM(support) FROM ({cls}))"""


@register("classification_report", q(_report_sql(), "segments"))
def q_classification_report(spark, sf_dir):
    return models.classification_report(_standin_pred(context(spark, sf_dir).segments))


def _kmeans(ctx):
    return _memo(ctx, "kmeans", lambda: models.kmeans_clusters(ctx.segments, segments.CLASSIFICATION_FEATURES, k=6))


@register("kmeans_segments")
def q_kmeans_segments(spark, sf_dir):
    df, _, _ = _kmeans(context(spark, sf_dir))
    return df.select(ACCT, "segment_label", "cluster_id")


@register("cluster_distribution")
def q_cluster_distribution(spark, sf_dir):
    df, _, _ = _kmeans(context(spark, sf_dir))
    return df.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("accounts"))


def _classifier(ctx):
    def build():
        clustered, _, _ = _kmeans(ctx)
        feats = segments.CLASSIFICATION_FEATURES + ["cluster_id"]
        model, pred = models.fit_segment_classifier(clustered, feats)
        return model, materialise(pred, "segment-pred"), feats
    return _memo(ctx, "classifier", build)


@register("segment_classifier")
def q_segment_classifier(spark, sf_dir):
    _, pred, _ = _classifier(context(spark, sf_dir))
    return models.classification_report(pred)


@register("classifier_confusion")
def q_classifier_confusion(spark, sf_dir):
    _, pred, _ = _classifier(context(spark, sf_dir))
    return models.confusion_matrix(pred)


@register("classifier_importances")
def q_classifier_importances(spark, sf_dir):
    """15 largest random-forest feature importances (a vector of length #features)."""
    model, _, feats = _classifier(context(spark, sf_dir))
    pairs = models.feature_importances(model, feats, 15)
    return spark.createDataFrame(pairs, "feature string, importance double")


@register("class_weights_applied", q("""
SELECT current_account_nbr, segment_label,
  CAST(COUNT(*) OVER () AS DOUBLE)
    / ((SELECT COUNT(DISTINCT segment_label) FROM segments) * COUNT(*) OVER (PARTITION BY segment_label))
  AS class_weight FROM segments""", "segments"))
def q_class_weights_applied(spark, sf_dir):
    s = context(spark, sf_dir).segments.select(ACCT, "segment_label")
    return segments.class_weights(s).select(ACCT, "segment_label", "class_weight")


# ---------------------------------------------------------------------------------------
# boosted spend model, quarter prediction, sequence regression
# ---------------------------------------------------------------------------------------

#: A larger step than the class's own: a fit takes some 200 trees instead of over 1,000.
SPEND = models.BoostSettings(learning_rate=0.4)
CREDIT = models.BoostSettings(learning_rate=0.3, max_trees=800, patience=30)


def _spend_model(ctx, spark, sf_dir):
    def build():
        df, feats, target = _q4_frame(spark, sf_dir)
        return models.fit_with_tail(df.where(F.col("split") == "train"), feats, target, [ACCT, "month"], settings=SPEND), feats
    return _memo(ctx, "spend_gbt", build)


@register("spend_gbt")
def q_spend_gbt(spark, sf_dir):
    ctx = context(spark, sf_dir)
    model, feats = _spend_model(ctx, spark, sf_dir)
    df, _, target = _q4_frame(spark, sf_dir)
    pred = models.predict_floor(model, df.where(F.col("split") == "test"), feats)
    return _with_length(forecast.regression_metrics(pred, target, "prediction", "gbt"), model)


def _with_length(metrics, model):
    """trees: of the model; tried: up to the end of patience."""
    return metrics.withColumns({"trees": F.lit(len(model.trees)), "tried": F.lit(max(len(model.errors) - 1, 0))})


@register("spend_gbt_course")
def q_spend_gbt_course(spark, sf_dir):
    """The validation error after each tree of the spend model (a row a tree), and which is the best."""
    model, _ = _spend_model(context(spark, sf_dir), spark, sf_dir)
    return spark.createDataFrame([(k, float(e), k == len(model.trees)) for k, e in enumerate(model.errors)],
                                 "trees int, validation_mae double, is_best boolean")


@register("predict_q4")
def q_predict_q4(spark, sf_dir):
    """Every account with rows in the quarter: a missing feature takes the side of its split."""
    ctx = context(spark, sf_dir)
    model, feats = _spend_model(ctx, spark, sf_dir)
    rows, _, _ = matrix.q4_feature_matrix(ctx.cm_lags, ctx.base, CUTOFF_MONTH, drop_nulls=False)
    pred = models.predict_floor(model, matrix.month_in(rows, QUARTER_MONTHS), feats)
    return pred.groupBy(ACCT).agg(F.sum("prediction").alias("xgb_predicted_q4_spend"))


@register("predict_q4_accounts", q(f"""
SELECT current_account_nbr, TRUE AS predicted FROM customer_monthly
WHERE strftime(month, '%Y-%m') IN ({', '.join(repr(m) for m in QUARTER_MONTHS)}) GROUP BY current_account_nbr""", "customer_monthly"))
def q_predict_q4_accounts(spark, sf_dir):
    """The accounts that ``predict_q4`` gives a number to."""
    return q_predict_q4(spark, sf_dir).select(ACCT, (F.col("xgb_predicted_q4_spend") >= 0).alias("predicted"))


@register("forecast_by_account")
def q_forecast_by_account(spark, sf_dir):
    return finish(_q4_forecast(context(spark, sf_dir), spark, sf_dir))


def _q4_forecast(ctx, spark, sf_dir):
    """Sum of floored monthly predictions over the test rows per account (as the run does)."""
    model, feats = _spend_model(ctx, spark, sf_dir)
    df, _, _ = _q4_frame(spark, sf_dir)
    pred = models.predict_floor(model, df.where(F.col("split") == "test"), feats)
    return pred.groupBy(ACCT).agg(F.sum("prediction").alias("q4_forecast"))


@register("top_importances")
def q_top_importances(spark, sf_dir):
    model, feats = _spend_model(context(spark, sf_dir), spark, sf_dir)
    pairs = models.feature_importances(model, feats, 15)
    return spark.createDataFrame(pairs, "feature string, importance double")


#: Smaller layers than the class's own: accounts here have two channels of nine months.
SEQUENCE = recurrent.RecurrentSettings(first=16, second=12, dense=8, rate=0.03, epochs=60)


@register("sequence_forecast")
def q_sequence_forecast(spark, sf_dir):
    """The recurrent model: the last fifth of the accounts is held out."""
    from pyspark.ml.functions import vector_to_array
    ctx = context(spark, sf_dir)
    seq = matrix.sequence_vectors(matrix.sequence_windows(ctx.cm)).withColumn("features", vector_to_array("features"))
    rows = materialise(matrix.positional_tail(seq, 0.2, [ACCT], "_is_test"), "sequences")
    model = recurrent.fit_recurrent(rows.where(~F.col("_is_test")), 2, [ACCT], SEQUENCE)
    pred = recurrent.predict_recurrent(model, rows.where(F.col("_is_test")), 2)
    return forecast.regression_metrics(pred, "target", "prediction", "sequence_lstm").withColumn(
        "epochs", F.lit(len(model.losses) - 1))


# ---------------------------------------------------------------------------------------
# isolation forest and the full recommendation run
# ---------------------------------------------------------------------------------------

def _forest(ctx):
    def build():
        rate = risk.contamination_rate(ctx.base).first()["contamination"]
        return materialise(iforest.isolation_forest(ctx.anomaly_features, ANOMALY_COLS, float(rate)), "anomaly-flags")
    return _memo(ctx, "iforest", build)


@register("isolation_forest")
def q_isolation_forest(spark, sf_dir):
    return _forest(context(spark, sf_dir))


@register("anomaly_distribution")
def q_anomaly_distribution(spark, sf_dir):
    return _forest(context(spark, sf_dir)).groupBy("anomaly_flag").agg(F.count(F.lit(1)).alias("accounts"))


@register("forest_fraud_confusion")
def q_forest_fraud_confusion(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return risk.fraud_confusion(_forest(ctx), ctx.base)


def _pipeline(ctx, spark, sf_dir):
    """The full run: segments -> forest -> risk -> forecast -> rules -> adjuster -> recommendations."""
    def build():
        scored = risk.compute_risk_score(ctx.segments, _forest(ctx))
        fc = _q4_forecast(ctx, spark, sf_dir)
        full = (scored.join(fc, ACCT, "left")
                .withColumn("q4_forecast", F.coalesce(F.col("q4_forecast"), F.lit(0.0))))
        adj = materialise(credit.apply_rule_based_adjustment(full), "rule-adjusted")
        feats = [c for c in credit.CREDIT_FEATURES + ["q4_forecast"] if c in adj.columns]
        train = adj.dropna(subset=feats + ["rule_adjustment_delta"])
        train = materialise(matrix.exact_split(train, 0.25, "_is_test"), "adjuster-input")
        model = models.fit_with_tail(train.where(~F.col("_is_test")), feats, "rule_adjustment_delta", [ACCT], 0.15, CREDIT)
        test_pred = models.predict_floor(model, train.where(F.col("_is_test")), feats, floor=None)
        scored_all = models.predict_floor(model, adj, feats, out="predicted_adjustment_delta", floor=None,
                                          zero_fill=True)
        final = credit.final_recommendations(scored_all.drop("prediction") if "prediction" in scored_all.columns
                                             else scored_all)
        return {"adj": adj, "model": model, "features": feats, "test_pred": test_pred,
                "final": materialise(final, "final-recommendations")}
    return _memo(ctx, "pipeline", build)


@register("credit_adjuster")
def q_credit_adjuster(spark, sf_dir):
    p = _pipeline(context(spark, sf_dir), spark, sf_dir)
    return _with_length(forecast.regression_metrics(p["test_pred"], "rule_adjustment_delta", "prediction", "credit_gbt"), p["model"])


@register("recommendation_run")
def q_recommendation_run(spark, sf_dir):
    return credit.final_projection(_pipeline(context(spark, sf_dir), spark, sf_dir)["final"])


@register("recommendation_impact")
def q_recommendation_impact(spark, sf_dir):
    return credit.portfolio_impact(_pipeline(context(spark, sf_dir), spark, sf_dir)["final"])


@register("feature_contributions")
def q_feature_contributions(spark, sf_dir):
    p = _pipeline(context(spark, sf_dir), spark, sf_dir)
    return C.explain(p["adj"], p["model"], p["features"])


@register("contribution_importance")
def q_contribution_importance(spark, sf_dir):
    p = _pipeline(context(spark, sf_dir), spark, sf_dir)
    contrib = C.explain(p["adj"], p["model"], p["features"])
    return C.mean_abs_contributions(contrib, p["features"])


@register("spend_contribution_importance")
def q_spend_contribution_importance(spark, sf_dir):
    """Mean |contribution| per feature of the spend model over all its test rows."""
    ctx = context(spark, sf_dir)
    model, feats = _spend_model(ctx, spark, sf_dir)
    df, _, _ = _q4_frame(spark, sf_dir)
    test = df.where(F.col("split") == "test")
    contrib = C.explain(test, model, feats, zero_fill=False)
    return C.mean_abs_contributions(contrib, feats)


@register("contribution_waterfall")
def q_contribution_waterfall(spark, sf_dir):
    """Per segment, the representative account's contributions (waterfall data)."""
    from . import reports as R
    p = _pipeline(context(spark, sf_dir), spark, sf_dir)
    reps = R.median_representative(p["final"], "segment_name", "adjustment_delta").select("segment_name", ACCT)
    rows = p["adj"].join(reps, ACCT, "left_semi")
    contrib = C.explain(rows, p["model"], p["features"])
    return C.account_breakdown(contrib, p["features"]).join(reps, ACCT)


@register("spend_gbt_causal")
def q_spend_gbt_causal(spark, sf_dir):
    """The spend model on features known before the month (no same-month columns, no
    spend-to-line ratio of the target month), reported next to the as-coded set."""
    df, _, target = _q4_frame(spark, sf_dir)
    feats = [c for c in matrix.CAUSAL_FEATURES if c in df.columns]
    model = models.fit_with_tail(df.where(F.col("split") == "train"), feats, target, [ACCT, "month"], settings=SPEND)
    pred = models.predict_floor(model, df.where(F.col("split") == "test"), feats)
    return _with_length(forecast.regression_metrics(pred, target, "prediction", "gbt_causal"), model)


@register("forest_sink")
def q_forest_sink(spark, sf_dir):
    """Node table written as Parquet and read back: reloaded scores equal fitted scores."""
    from ..session import scratch_path
    ctx = context(spark, sf_dir)
    feats = materialise(ctx.anomaly_features.select(ACCT, *ANOMALY_COLS), "forest-input")
    nodes, meta = iforest.fit_isolation_forest(feats, ANOMALY_COLS)
    nodes = materialise(nodes, "forest-nodes")
    path = iforest.save_forest(nodes, meta, scratch_path(spark, "forest"))
    again, meta2 = iforest.load_forest(spark, path)
    a = iforest.score_isolation_forest(feats, nodes, meta, ANOMALY_COLS).withColumnRenamed("score", "score_fitted")
    b = iforest.score_isolation_forest(feats, again, meta2, ANOMALY_COLS).withColumnRenamed("score", "score_reloaded")
    return a.join(b, ACCT).withColumn("equal", F.col("score_fitted") == F.col("score_reloaded"))


@register("model_sink")
def q_model_sink(spark, sf_dir):
    """Spend model, classifier and credit adjuster, each saved, loaded and held against the fitted one."""
    from pyspark.ml import PipelineModel
    from ..session import scratch_path
    ctx = context(spark, sf_dir)
    spend, feats = _spend_model(ctx, spark, sf_dir)
    df, _, _ = _q4_frame(spark, sf_dir)
    run = _pipeline(ctx, spark, sf_dir)
    classifier, _, cfeats = _classifier(ctx)
    clustered, _, _ = _kmeans(ctx)
    # name: model, rows to score, features, what identifies a row
    cases = {"spend": (spend, df.where(F.col("split") == "test").withColumn("row", F.concat_ws("|", ACCT, "month")), feats),
             "credit": (run["model"], run["adj"].dropna(subset=run["features"]).withColumn("row", F.col(ACCT)), run["features"]),
             "classifier": (classifier, clustered.dropna(subset=cfeats).withColumn("row", F.col(ACCT)), cfeats)}
    out = None
    for name, (model, rows, features) in cases.items():
        path = scratch_path(spark, f"{name}-model")
        if isinstance(model, models.BoostedTrees):
            again = models.BoostedTrees.load(spark, model.save(spark, path))
        else:
            model.write().overwrite().save(path)
            again = PipelineModel.load(path)
        scored = lambda m: models.predict_floor(m, rows, features, floor=None)
        a = scored(model).select("row", F.col("prediction").alias("p_fitted"))
        b = scored(again).select("row", F.col("prediction").alias("p_reloaded"))
        one = a.join(b, "row").select(F.lit(name).alias("model"), "row", "p_fitted", "p_reloaded",
                                      (F.col("p_fitted") == F.col("p_reloaded")).alias("equal"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------------------------------
# Structured Streaming form of the monthly transaction aggregate
# ---------------------------------------------------------------------------------------

@register("txn_monthly_stream", q("""
SELECT current_account_nbr, txn_month, CAST(total_spend AS DOUBLE) AS total_spend, txn_count, avg_txn_amt,
  CAST(max_txn_amt AS DOUBLE) AS max_txn_amt, CAST(total_cash_advance AS DOUBLE) AS total_cash_advance,
  CAST(total_returns AS DOUBLE) AS total_returns, CAST(total_markup_fees AS DOUBLE) AS total_markup_fees,
  CAST(total_foreign_txn_amt AS DOUBLE) AS total_foreign_txn_amt, first_purchase_count FROM txn_monthly""", "txn_monthly"))
def q_txn_monthly_stream(spark, sf_dir):
    """The transaction folder replayed as a stream (available-now trigger), all months."""
    from ..session import scratch_path
    from ..sources.fixtures import input_path
    from ..streaming.monthly import merged_months, start_txn_monthly_stream
    source = input_path(spark, sf_dir, "transaction_base")
    schema = spark.read.parquet(source).schema
    sink = scratch_path(spark, "stream-monthly")
    start_txn_monthly_stream(spark, source, schema, sink, scratch_path(spark, "stream-state")).awaitTermination()
    return finish(merged_months(spark.read.parquet(sink)))
