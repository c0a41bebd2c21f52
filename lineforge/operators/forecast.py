"""Quarter-spend forecasts: Holt smoothing per account, boosted trees, sequence
regression, and the shared regression metrics.

Holt's additive-trend smoothing works on one sorted array per account (bounded by the
number of months, whatever the transaction volume).  With fixed parameters the recursion
is a JVM higher-order ``aggregate``; the per-account grid search over the parameters is
an Arrow-batched numpy loop over (accounts x grid) that performs the identical float
operations — no per-account Python call, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCT = "current_account_nbr"

# Default grid of (alpha, beta) smoothing parameters searched per account.
ALPHAS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
BETAS = (0.05, 0.1, 0.2, 0.3, 0.5)
DEFAULT_GRID = tuple((a, b) for a in ALPHAS for b in BETAS)


def monthly_series(cm: DataFrame, end_month: str | None = None, min_positive: int = 3,
                   value: str = "total_spend") -> DataFrame:
    """Per account: month-sorted spend array (``ys``) of the months before ``end_month``,
    kept when at least ``min_positive`` months are > 0."""
    src = cm if end_month is None else cm.where(F.col("month") < F.to_date(F.lit(end_month)))
    pts = F.struct(F.col("month"), F.col(value).cast("double").alias("y"))
    g = (src.groupBy(ACCT)
         .agg(F.array_sort(F.collect_list(pts)).alias("_pts"),
              F.count_if(F.col(value) > 0).alias("positive_months")))
    return (g.where(F.col("positive_months") >= min_positive)
            .select(ACCT, F.transform("_pts", lambda p: p["y"]).alias("ys"), "positive_months"))


def _holt_final(ys: Column, alpha: float, beta: float) -> Column:
    """struct(l, b, sse) after running the recursion over ``ys``:
    l0 = y1, b0 = y2 - y1; l_t = a*y_t + (1-a)*(l + b); b_t = c*(l_t - l) + (1-c)*b;
    sse accumulates (y_t - (l + b))^2."""
    a, na, c, nc = F.lit(alpha), F.lit(1.0 - alpha), F.lit(beta), F.lit(1.0 - beta)
    init = F.struct(F.element_at(ys, 1).alias("l"),
                    (F.element_at(ys, 2) - F.element_at(ys, 1)).alias("b"),
                    F.lit(0.0).alias("sse"))

    def step(acc, y):
        level = a * y + na * (acc["l"] + acc["b"])
        trend = c * (level - acc["l"]) + nc * acc["b"]
        err = y - (acc["l"] + acc["b"])
        return F.struct(level.alias("l"), trend.alias("b"), (acc["sse"] + err * err).alias("sse"))

    return F.aggregate(ys, init, step)


def holt_sum_forecast(state: Column, horizon: int = 3) -> Column:
    """Sum of the next ``horizon`` forecasts l + h*b (h = 1..horizon), floored at 0."""
    steps = horizon * (horizon + 1) / 2.0
    return F.greatest(F.lit(float(horizon)) * state["l"] + F.lit(steps) * state["b"], F.lit(0.0))


def holt_fixed(series: DataFrame, alpha: float, beta: float, horizon: int = 3) -> DataFrame:
    """Forecast with given smoothing parameters."""
    st = _holt_final(F.col("ys"), alpha, beta)
    return series.select(ACCT, holt_sum_forecast(st, horizon).alias("hw_predicted_q4_spend"),
                         st["sse"].alias("sse"))


def holt_forecast(series: DataFrame, grid=DEFAULT_GRID, horizon: int = 3) -> DataFrame:
    """Per account: smoothing parameters with the least in-sample squared one-step error
    (ties: smaller forecast, then smaller alpha/beta) and the resulting quarter forecast.

    The grid search is the hot loop (accounts x grid points x months), so it runs as an
    Arrow-batched ``mapInPandas``: each batch of accounts is one (accounts x grid) numpy
    state advanced month by month — the same IEEE operations, in the same order, as the
    JVM recursion of :func:`holt_fixed`, so results agree bit for bit."""
    import numpy as np
    import pandas as pd

    alphas = np.array([a for a, _ in grid], dtype=float)
    betas = np.array([b for _, b in grid], dtype=float)
    n_alphas, n_betas = 1.0 - alphas, 1.0 - betas
    steps = horizon * (horizon + 1) / 2.0

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            lens = pdf["ys"].map(len).to_numpy()
            t_max = int(lens.max())
            ys = np.zeros((len(pdf), t_max))
            for i, arr in enumerate(pdf["ys"]):
                ys[i, :len(arr)] = arr
            level = np.repeat(ys[:, :1], len(grid), axis=1)
            trend = np.repeat(ys[:, 1:2] - ys[:, :1], len(grid), axis=1)
            sse = np.zeros_like(level)
            for t in range(t_max):
                live = (t < lens)[:, None]
                y = ys[:, t:t + 1]
                new_level = alphas * y + n_alphas * (level + trend)
                new_trend = betas * (new_level - level) + n_betas * trend
                err = y - (level + trend)
                new_sse = sse + err * err
                level = np.where(live, new_level, level)
                trend = np.where(live, new_trend, trend)
                sse = np.where(live, new_sse, sse)
            fc = np.maximum(float(horizon) * level + steps * trend, 0.0)
            a_b = np.broadcast_to(alphas, fc.shape)
            b_b = np.broadcast_to(betas, fc.shape)
            best = np.lexsort((b_b, a_b, fc, sse), axis=-1)[:, 0]
            rows = np.arange(len(pdf))
            yield pd.DataFrame({ACCT: pdf[ACCT].to_numpy(), "hw_predicted_q4_spend": fc[rows, best],
                                "alpha": alphas[best], "beta": betas[best], "sse": sse[rows, best]})

    return _dealt_series(series).mapInPandas(
        run, f"{ACCT} string, hw_predicted_q4_spend double, alpha double, beta double, sse double")


def _dealt_series(series: DataFrame) -> DataFrame:
    """The series over all cores: much work for few bytes, which would be coalesced by their size."""
    return series.select(ACCT, "ys").repartition(series.sparkSession.sparkContext.defaultParallelism, ACCT)


def _holt_states(ys, lens, alphas, betas, horizon: int):
    """Least-squares start and fit of every (account, parameter pair): alphas, betas are (n, g) or
    (1, g).  Returns sse, forecast, l0, b0, each (n, g).

    For fixed (alpha, beta) the one-step errors are linear in the initial state:
    e_t = e^y_t + l0 * e^l_t + b0 * e^b_t, where e^y runs the recursion on the data from a
    zero state and e^l, e^b run it on zero data from unit level / unit trend.  The
    (l0, b0) minimising the squared errors solve a 2x2 normal system; l0 = y1, b0 = y2 - y1 when
    the system is singular."""
    import numpy as np

    n, g = len(ys), alphas.shape[1]
    steps = horizon * (horizon + 1) / 2.0
    # three linear runs: data from zero state, unit level, unit trend
    lv = np.zeros((3, n, g))
    tr = np.zeros((3, n, g))
    lv[1] = 1.0
    tr[2] = 1.0
    sums = {k: np.zeros((n, g)) for k in ("yy", "ly", "by", "ll", "lb", "bb")}
    for t in range(int(lens.max())):
        live = (t < lens)[:, None]
        y = np.stack([ys[:, t:t + 1] * np.ones((1, g)), np.zeros((n, g)), np.zeros((n, g))])
        err = y - (lv + tr)
        new_l = alphas * y + (1.0 - alphas) * (lv + tr)
        new_b = betas * (new_l - lv) + (1.0 - betas) * tr
        for k, (i, j) in {"yy": (0, 0), "ly": (1, 0), "by": (2, 0), "ll": (1, 1), "lb": (1, 2), "bb": (2, 2)}.items():
            sums[k] = np.where(live, sums[k] + err[i] * err[j], sums[k])
        lv = np.where(live, new_l, lv)
        tr = np.where(live, new_b, tr)
    a11, a12, a22 = sums["ll"], sums["lb"], sums["bb"]
    r1, r2 = -sums["ly"], -sums["by"]
    det = a11 * a22 - a12 * a12
    ok = np.abs(det) > 1e-12 * np.maximum(np.abs(a11 * a22), 1.0)
    safe = np.where(ok, det, 1.0)
    l0 = np.where(ok, (r1 * a22 - r2 * a12) / safe, np.repeat(ys[:, :1], g, axis=1))
    b0 = np.where(ok, (a11 * r2 - a12 * r1) / safe, np.repeat(ys[:, 1:2] - ys[:, :1], g, axis=1))
    sse = (sums["yy"] + 2 * l0 * sums["ly"] + 2 * b0 * sums["by"] + l0 * l0 * a11
           + 2 * l0 * b0 * a12 + b0 * b0 * a22)
    level = lv[0] + l0 * lv[1] + b0 * lv[2]
    trend = tr[0] + l0 * tr[1] + b0 * tr[2]
    return sse, np.maximum(float(horizon) * level + steps * trend, 0.0), l0, b0


def _newton(ys, lens, a, b, horizon: int, rounds: int = 40):
    """Damped Newton steps from (a, b), each (n,), for all accounts at once, within (0, 1).

    The start is solved inside (:func:`_holt_states`), so only the two parameters move.  The errors'
    derivatives by them, and by the start, are carried through the recursion; with the start
    eliminated they make a 2 x 2 system an account (Gauss and Newton's, damped as Levenberg does).
    A step is taken only where it lowers the squared error, so no account ends above its start.
    Returns a, b, sse, forecast, l0, b0."""
    import numpy as np

    def states(at, a, b):
        return [v[:, 0] for v in _holt_states(ys[at], lens[at], a[:, None], b[:, None], horizon)]

    def normal(at, a, b, level, trend):
        """J'J (4 x 4, in the order alpha, beta, level, trend) and J'e at the point."""
        y, n = ys[at], len(at)
        dl, db = np.zeros((4, n)), np.zeros((4, n))
        dl[2], db[3] = 1.0, 1.0
        jj, je = np.zeros((n, 4, 4)), np.zeros((n, 4))
        for t in range(int(lens[at].max())):
            live = t < lens[at]
            err = y[:, t] - (level + trend)
            j = np.where(live, -(dl + db), 0.0)
            jj += j.T[:, :, None] * j.T[:, None, :]
            je += (j * err).T
            new_level = a * y[:, t] + (1 - a) * (level + trend)
            nl = (1 - a) * (dl + db)
            nl[0] += err
            nb = b * (nl - dl) + (1 - b) * db
            nb[1] += (new_level - level) - trend
            new_trend = b * (new_level - level) + (1 - b) * trend
            level, trend = np.where(live, new_level, level), np.where(live, new_trend, trend)
            dl, db = np.where(live, nl, dl), np.where(live, nb, db)
        return jj, je

    a, b, at = a.copy(), b.copy(), np.arange(len(a))
    won = states(at, a, b)  # sse, forecast, l0, b0
    damp = np.full(len(a), 1e-3)
    for _ in range(rounds):
        if not len(at):
            break
        jj, je = normal(at, a[at], b[at], won[2][at], won[3][at])
        ridge = 1e-12 * (1.0 + np.trace(jj[:, 2:, 2:], axis1=1, axis2=2))
        inner = jj[:, 2:, 2:] + ridge[:, None, None] * np.eye(2)
        solved = np.linalg.solve(inner, np.concatenate([jj[:, 2:, :2], je[:, 2:, None]], axis=2))
        h = jj[:, :2, :2] - jj[:, :2, 2:] @ solved[:, :, :2]
        g = je[:, :2] - (jj[:, :2, 2:] @ solved[:, :, 2:])[:, :, 0]
        size = np.maximum(np.trace(h, axis1=1, axis2=2), 1e-300)
        # at a bound that the step would leave, only the other parameter moves
        p = np.stack([a[at], b[at]], axis=1)
        fixed = ((p <= LEAST) & (g > 0)) | ((p >= MOST) & (g < 0))
        g = np.where(fixed, 0.0, g)
        h = np.where(fixed[:, :, None] | fixed[:, None, :], 0.0, h) + (damp[at] * size)[:, None, None] * np.eye(2)
        q = np.clip(p - np.linalg.solve(h, g[:, :, None])[:, :, 0], LEAST, MOST)
        trial, old = states(at, q[:, 0], q[:, 1]), won[0][at]
        better = trial[0] < old
        gain = np.where(better, (old - trial[0]) / np.maximum(old, 1e-300), 0.0)
        up = at[better]
        a[up], b[up] = q[better, 0], q[better, 1]
        for k, v in enumerate(trial):
            won[k][up] = v[better]
        damp[at] = np.clip(np.where(better, damp[at] / 5, damp[at] * 10), 1e-12, 1e12)
        at = at[np.where(better, gain > 1e-10, damp[at] < 1e7)]  # the others have come to rest
    return a, b, *won


LEAST, MOST = 1e-4, 0.9999  # of the smoothing parameters


def holt_estimated(series: DataFrame, grid=DEFAULT_GRID, horizon: int = 3, refine: int = 0, newton: bool = False) -> DataFrame:
    """Holt smoothing with estimated initial level and trend, per account.

    The pair of the grid with the least squared error wins, with the least-squares start of each.
    ``refine`` rounds then search around it: eight neighbours at a step that halves every round,
    starting from half the grid's, so the parameters are no longer bound to the grid.  ``newton``
    goes on from there to the nearest minimum, never above (:func:`_newton`).
    Arrow-batched, vectorised over (accounts x pairs)."""
    import numpy as np
    import pandas as pd

    alphas = np.array([[a for a, _ in grid]], dtype=float)
    betas = np.array([[b for _, b in grid]], dtype=float)
    around = np.array([(i, j) for i in (0, -1, 1) for j in (0, -1, 1)], dtype=float)

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            lens = pdf["ys"].map(len).to_numpy()
            ys = np.zeros((len(pdf), int(lens.max())))
            for i, arr in enumerate(pdf["ys"]):
                ys[i, :len(arr)] = arr
            rows, a, b = np.arange(len(pdf)), alphas, betas
            for k in range(refine + 1):
                sse, fc, l0, b0 = _holt_states(ys, lens, a, b, horizon)
                best = np.lexsort((np.broadcast_to(b, fc.shape), np.broadcast_to(a, fc.shape), fc, sse), axis=-1)[:, 0]
                won = {"alpha": np.broadcast_to(a, fc.shape)[rows, best], "beta": np.broadcast_to(b, fc.shape)[rows, best],
                       "hw_predicted_q4_spend": fc[rows, best], "l0": l0[rows, best], "b0": b0[rows, best],
                       "sse": sse[rows, best]}
                step = 0.05 / 2 ** k
                a = np.clip(won["alpha"][:, None] + step * around[None, :, 0], LEAST, MOST)
                b = np.clip(won["beta"][:, None] + step * around[None, :, 1], LEAST, MOST)
            if newton:
                names = ("alpha", "beta", "sse", "hw_predicted_q4_spend", "l0", "b0")
                won = dict(zip(names, _newton(ys, lens, won["alpha"], won["beta"], horizon)))
            yield pd.DataFrame({ACCT: pdf[ACCT].to_numpy(), "hw_predicted_q4_spend": won["hw_predicted_q4_spend"],
                                "alpha": won["alpha"], "beta": won["beta"], "l0": won["l0"], "b0": won["b0"],
                                "sse": won["sse"]})

    return _dealt_series(series).mapInPandas(
        run, f"{ACCT} string, hw_predicted_q4_spend double, alpha double, beta double, l0 double, b0 double, sse double")


def holt_forecast_jvm(series: DataFrame, grid=DEFAULT_GRID, horizon: int = 3) -> DataFrame:
    """The same grid search as JVM higher-order functions only (one ``aggregate`` per grid
    point); kept as the reference form of :func:`holt_forecast` for small grids."""
    cands = []
    for a, b in grid:
        st = _holt_final(F.col("ys"), a, b)
        cands.append(F.struct(st["sse"].alias("sse"), holt_sum_forecast(st, horizon).alias("fc"),
                              F.lit(a).alias("alpha"), F.lit(b).alias("beta")))
    best = F.array_min(F.array(*cands))
    return series.select(ACCT, best["fc"].alias("hw_predicted_q4_spend"), best["alpha"].alias("alpha"),
                         best["beta"].alias("beta"), best["sse"].alias("sse"))


def regression_metrics(df: DataFrame, y: str, yhat: str, model: str | None = None) -> DataFrame:
    """MAE, RMSE (2 dp) and R^2 (4 dp) in one aggregate (no collect)."""
    from ..plans.reports import round_dp
    e = F.col(y).cast("double") - F.col(yhat).cast("double")
    df = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())  # n, variance and errors over the same rows
    stats = df.agg(F.avg(F.abs(e)).alias("_mae"), F.avg(e * e).alias("_mse"),
                   F.sum(e * e).alias("_ssr"), F.var_pop(F.col(y).cast("double")).alias("_var"),
                   F.count(F.lit(1)).alias("n"))
    r2 = F.when(F.col("_var") > 0, F.lit(1.0) - F.col("_ssr") / (F.col("_var") * F.col("n")))
    out = stats.select(round_dp(F.col("_mae"), 2).alias("mae"), round_dp(F.sqrt(F.col("_mse")), 2).alias("rmse"),
                       round_dp(r2, 4).alias("r2"), "n")
    if model is not None:
        out = out.select(F.lit(model).alias("model"), "*")
    return out


def comparison_table(metric_frames: list[DataFrame]) -> DataFrame:
    """Union of per-model metric rows with a flag on the lowest MAE (ties: model name)."""
    from pyspark.sql import Window
    allm = metric_frames[0]
    for m in metric_frames[1:]:
        allm = allm.unionByName(m)
    # one row per model: the window spans a handful of rows
    w = Window.orderBy(F.col("mae").asc_nulls_last(), F.col("model"))
    return allm.withColumn("is_best", F.row_number().over(w) == 1)
