"""Portfolio reports and profiling, as single-pass aggregates.

Wide summaries are computed as one aggregate over all requested columns and then
unpivoted (``stack``) — the data is scanned once and nothing is multiplied before the
shuffle.  Quantiles are exact at any size (``operators.quantiles``), without ever holding a
group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, DoubleType, NumericType

from ..operators.quantiles import exact_quantiles
from ..session import materialise

ACCT = "current_account_nbr"


def round_dp(col, digits: int) -> Column:
    """Half-up rounding written as plain IEEE operations (same result in every engine)."""
    c = F.col(col) if isinstance(col, str) else col
    k = float(10 ** digits)
    return (F.when(c < 0, -F.floor(-c * F.lit(k) + F.lit(0.5)) / F.lit(k))
            .otherwise(F.floor(c * F.lit(k) + F.lit(0.5)) / F.lit(k))).cast("double")


def _stack(n_cols: int, names: list[str], fields: list[str]) -> str:
    parts = []
    for i, name in enumerate(names):
        parts.append(f"'{name}'")
        parts.extend(f"`{f}_{i}`" for f in fields)
    return f"stack({n_cols}, {', '.join(parts)}) as (column_name, {', '.join(fields)})"


def portfolio_monthly(cm: DataFrame) -> DataFrame:
    """Per month: total spend, mean spend per account-month, distinct active accounts."""
    return (cm.groupBy("month")
            .agg(F.sum("total_spend").alias("_s"), F.count("total_spend").alias("_n"),
                 F.count_distinct(ACCT).alias("active_accounts"))
            .select("month", F.col("_s").cast("double").alias("total_spend"),
                    (F.col("_s").cast("double") / F.col("_n")).alias("avg_spend"), "active_accounts"))


_QUANTILES = {"p25": 0.25, "p50": 0.5, "median": 0.5, "p75": 0.75}


def _quantile_columns(df: DataFrame, cols: list[str], names: list[str], digits: int, discrete: bool,
                      group: str | None = None) -> DataFrame:
    """One row per column (and group) with the named quantiles."""
    q = exact_quantiles(df, cols, sorted({_QUANTILES[x] for x in names}), group, discrete)
    keys = ([group] if group else []) + ["column_name"]
    value = F.col("value") if discrete else round_dp("value", digits)
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("q") == _QUANTILES[x], value)).alias(x) for x in names])


def summary_stats(df: DataFrame, cols: list[str], stats=("count", "mean", "std", "min", "p25", "p50", "p75", "max"),
                  digits: int = 4, interpolate: bool = True) -> DataFrame:
    """Long-form describe: one row per column with the requested statistics.

    Quantiles are exact at any size: linear between ranks as pandas' describe does
    (``interpolate``), or the order statistic at rank ceil(q*n)."""
    aggs = []
    plain = [s for s in stats if s not in _QUANTILES]
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        spec = {
            "count": F.count(x).cast("long"),
            "mean": round_dp(F.avg(x), digits),
            "std": round_dp(F.stddev_samp(x), digits),
            "min": F.min(x),
            "max": F.max(x),
        }
        aggs.extend(spec[s].alias(f"{s}_{i}") for s in plain)
    names = [s for s in stats if s in _QUANTILES]
    one = df.agg(*aggs).selectExpr(_stack(len(cols), cols, plain))
    if names:
        one = one.join(_quantile_columns(df, cols, names, digits, not interpolate), "column_name", "left")
    return one.select("column_name", *stats)


def grouped_summary(df: DataFrame, group: str, col: str, digits: int = 2) -> DataFrame:
    """Per group: count, mean, std, min, quartiles (linear between ranks), max of one column (rounded)."""
    x = F.col(col).cast("double")
    plain = df.groupBy(group).agg(
        F.count(x).alias("count"), round_dp(F.avg(x), digits).alias("mean"),
        round_dp(F.stddev_samp(x), digits).alias("std"), round_dp(F.min(x), digits).alias("min"),
        round_dp(F.max(x), digits).alias("max"))
    q = _quantile_columns(df, [col], ["p25", "p50", "p75"], digits, False, group).withColumnRenamed(group, "_g")
    return (plain.join(q, F.col(group).eqNullSafe(F.col("_g")), "left")
            .select(group, "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def non_null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: non-null count and row count."""
    one = df.agg(*[F.count(c).alias(f"non_null_{i}") for i, c in enumerate(cols)],
                 *[F.count(F.lit(1)).alias(f"total_{i}") for i, _ in enumerate(cols)])
    return one.selectExpr(_stack(len(cols), cols, ["non_null", "total"]))


def _is_missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    m = F.col(c).isNull()
    if isinstance(t, (DoubleType, FloatType)):
        m = m | F.isnan(F.col(c))
    return m


def missing_summary(df: DataFrame, with_dtype: bool = False) -> DataFrame:
    """Columns with any missing value: count and percentage (2 dp), sorted desc."""
    cols = df.columns
    one = df.agg(*[F.count_if(_is_missing(df, c)).alias(f"missing_count_{i}") for i, c in enumerate(cols)],
                 F.count(F.lit(1)).alias("_total"))
    long = one.selectExpr("_total", _stack(len(cols), cols, ["missing_count"]))
    long = (long.where(F.col("missing_count") > 0)
            .withColumn("missing_pct", round_dp(F.col("missing_count") / F.col("_total") * F.lit(100.0), 2))
            .drop("_total"))
    if with_dtype:
        types = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
        long = long.withColumn("dtype", F.element_at(types, F.col("column_name")))
    return long.orderBy(F.col("missing_pct").desc(), F.col("column_name"))


def missing_shares(df: DataFrame) -> DataFrame:
    cols = df.columns
    one = df.agg(*[F.avg(_is_missing(df, c).cast("double")).alias(f"missing_share_{i}") for i, c in enumerate(cols)])
    return one.selectExpr(_stack(len(cols), cols, ["missing_share"]))


def drop_high_missing(df: DataFrame, threshold: float = 0.70) -> tuple[DataFrame, DataFrame]:
    """``(df_without_dropped_columns, verdicts)``; verdicts = column, share, dropped.

    The verdict table has one row per column (bounded by the schema), so reading it on
    the driver to build the projection is a schema operation, not a data pull."""
    verdicts = missing_shares(df).withColumn("dropped", F.col("missing_share") > F.lit(threshold))
    dropped = [r.column_name for r in verdicts.where("dropped").select("column_name").collect()]
    return df.drop(*dropped), verdicts


def correlation_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) of every pair i < j over the rows where both are there.

    One pass: each task sums the products of its rows' columns, shifted by the columns' means (one
    number a column) so that nothing cancels, and gives one row a pair; these are added up."""
    import numpy as np
    import pyarrow as pa

    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    k = len(cols)
    i, j = np.triu_indices(k, 1)

    def sums(batches):
        n, s, ss, p = (np.zeros((k, k)) for _ in range(4))
        for b in batches:
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(k)], axis=1) - shift
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            m = there.astype(float)
            n += m.T @ m
            s += x.T @ m           # sum of column a over the rows where b is there
            ss += (x * x).T @ m
            p += x.T @ x
        yield pa.RecordBatch.from_pydict({
            "i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "sx": s[i, j], "sy": s[j, i],
            "sxx": ss[i, j], "syy": ss[j, i], "sxy": p[i, j]})

    kinds = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    parts = df.select(*[F.col(c).cast("double").alias(f"c_{q}") for q, c in enumerate(cols)]).mapInArrow(sums, kinds)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def correlation_pairs(df: DataFrame, cols: list[str], digits: int | None = 4) -> DataFrame:
    """|Pearson r| for every pair (i < j) on pair-complete rows; constant column -> null.
    ``digits`` None: unrounded."""
    m = correlation_moments(df, cols)
    n = F.when(F.col("n") > 0, F.col("n"))
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    tiny = lambda v, s: v <= F.lit(1e-12) * F.col(s)  # noqa: E731  rounding of a constant column
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / n
    r = F.when(~tiny(vx, "sxx") & ~tiny(vy, "syy"), F.abs(cov / (F.sqrt(vx) * F.sqrt(vy))))
    names = F.array(*[F.lit(c) for c in cols])
    return m.select(names[F.col("i")].alias("col_a"), names[F.col("j")].alias("col_b"),
                    (r if digits is None else round_dp(r, digits)).alias("abs_corr"))


def correlated_drops(df: DataFrame, cols: list[str], threshold: float = 0.85) -> DataFrame:
    """Per column: dropped when some later column correlates above the threshold
    (the earlier column of a pair is the one removed, as coded); r is not rounded first."""
    pairs = correlation_pairs(df, cols, None)
    order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
    flags = pairs.groupBy("col_a").agg(F.max(F.coalesce(F.col("abs_corr") > F.lit(threshold), F.lit(False))).alias("dropped"))
    all_cols = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    out = all_cols.join(flags.withColumnRenamed("col_a", "column_name"), "column_name", "left")
    return out.select("column_name", F.coalesce(F.col("dropped"), F.lit(False)).alias("dropped"),
                      F.element_at(order, F.col("column_name")).alias("position"))


def drop_correlated(df: DataFrame, threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """``(df_without_dropped_columns, verdicts)`` over all numeric columns of ``df``."""
    verdicts = materialise(correlated_drops(df, numeric_columns(df), threshold), "verdicts")
    dropped = [r.column_name for r in verdicts.where("dropped").collect()]  # one row a column
    return df.drop(*dropped), verdicts


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def profile_categorical(df: DataFrame, col: str, top_n: int = 20) -> DataFrame:
    """Top-n value counts (null is a value) with percentage of all rows (2 dp)."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    # the row total is a one-number summary of the frame
    n = df.agg(F.count(F.lit(1)).alias("_total")).first()["_total"]
    return (counts.withColumn("pct", round_dp(F.col("count") / F.lit(float(n or 1)) * F.lit(100.0), 2))
            .orderBy(F.col("count").desc(), F.col("value").asc_nulls_first()).limit(top_n))


def histogram(df: DataFrame, col: str, width: float, lo: float, hi: float) -> DataFrame:
    """Equal-width bins over [lo, hi]; the top edge falls in the last bin."""
    n_bins = int(round((hi - lo) / width))
    idx = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1))
    return (df.where(F.col(col).isNotNull()).groupBy(idx.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select((F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"), "count"))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def median_representative(df: DataFrame, group: str, value: str, key: str = ACCT) -> DataFrame:
    """Per group the (lowest-key) account whose value is the group's lower median.

    The median is exact at any size; the account is found with a join on (group, value) and a
    min — no group is sorted in one task."""
    med = exact_quantiles(df, [value], [0.5], group, discrete=True).select(F.col(group).alias("_g"), F.col("value").alias("_median"))
    j = df.join(med, F.col(group).eqNullSafe(F.col("_g")) & (F.col(value) == F.col("_median")))
    return j.groupBy(group).agg(F.min(key).alias(key), F.first("_median").alias(value))


def hash_sample(df: DataFrame, n: int, key: str = ACCT, seed: int = 42) -> DataFrame:
    """A reproducible sample of at most n rows: smallest md5(seed|key) first."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def spend_heatmap_wide(cm: DataFrame, top_n: int = 200, months: list[str] | None = None) -> DataFrame:
    """Account x month pivot of mean spend for the top-n spenders, missing cells 0.

    The months are read from the data — one value per month, a bounded list; ``months`` have a
    column each in any case, so no month of the data is left out."""
    sums = cm.groupBy(ACCT).agg(F.sum("total_spend").alias("_s"))
    top = top_k(sums, top_n, [F.col("_s").desc(), F.col(ACCT)]).select(ACCT)
    rows = (cm.join(top, ACCT, "left_semi")
            .withColumn("month_str", F.date_format("month", "yyyy-MM")))
    seen = {r.month_str for r in rows.where(F.col("month_str").isNotNull()).select("month_str").distinct().collect()}
    months = sorted(seen | set(months or ()))
    wide = rows.groupBy(ACCT).pivot("month_str", months).agg(F.avg(F.col("total_spend").cast("double")))
    return wide.fillna(0.0, subset=months)
