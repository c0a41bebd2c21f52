"""Report, profiling, split and matrix queries with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.status import extract_month, parse_dates
from ..operators import matrix, segments
from ..sources import ingest, tables
from ..session import materialise, scratch_path
from . import reports as R
from .catalog import ACCT, QP, register
from .context import CUTOFF_MONTH, QUARTER_MONTHS, context, finish
from .oracle import q


def _r(expr: str, d: int) -> str:
    k = f"{10 ** d}.0"
    return (f"CAST(CASE WHEN ({expr}) < 0 THEN -FLOOR(-({expr}) * {k} + 0.5) / {k} "
            f"ELSE FLOOR(({expr}) * {k} + 0.5) / {k} END AS DOUBLE)")


def _qsel(q_: float) -> str:
    return f"MAX(CASE WHEN rn = GREATEST(CAST(CEIL({q_} * n) AS BIGINT), 1) THEN x END)"


def _qcont(q_: float, digits: int) -> str:
    """Linear-interpolated quantile (pandas/numpy rule), rounded like the Spark side."""
    return _r(f"QUANTILE_CONT(x, {q_})", digits)


def _describe_sql(table: str, cols, stats, digits: int = 4, group: str | None = None,
                  round_all: bool = False, interpolate: bool = False) -> str:
    """Long-form describe in DuckDB: mean/std rounded half-up to ``digits``; quantiles by
    rank ceil(q*n) (the rank rule of the Spark sketch); ``round_all`` also rounds
    min/max/quantiles."""
    def rnd(expr: str) -> str:
        return _r(expr, digits) if round_all else expr

    parts = []
    for c in cols:
        part_by = f"PARTITION BY {group} " if group else ""
        sel = {
            "count": "COUNT(x) AS count",
            "mean": f"{_r('AVG(x)', digits)} AS mean",
            "std": f"{_r('STDDEV_SAMP(x)', digits)} AS std",
            "min": f"{rnd('MIN(x)')} AS min",
            "p25": f"{_qcont(0.25, digits) if interpolate else rnd(_qsel(0.25))} AS p25",
            "p50": f"{_qcont(0.5, digits) if interpolate else rnd(_qsel(0.5))} AS p50",
            "median": f"{_qcont(0.5, digits) if interpolate else rnd(_qsel(0.5))} AS median",
            "p75": f"{_qcont(0.75, digits) if interpolate else rnd(_qsel(0.75))} AS p75",
            "max": f"{rnd('MAX(x)')} AS max",
        }
        head = f"{group}, " if group else f"'{c}' AS column_name, "
        inner = (f"SELECT {group + ', ' if group else ''}CAST({c} AS DOUBLE) AS x, "
                 f"ROW_NUMBER() OVER ({part_by}ORDER BY CAST({c} AS DOUBLE) ASC NULLS LAST) AS rn, "
                 f"COUNT({c}) OVER ({part_by.strip()}) AS n FROM {table}")
        parts.append(f"SELECT {head}{', '.join(sel[s] for s in stats)} FROM ({inner})"
                     + (f" GROUP BY {group}" if group else ""))
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------------------------------
# 2.4 aggregations and reports
# ---------------------------------------------------------------------------------------

@register("portfolio_monthly", q("""
SELECT month, CAST(SUM(total_spend) AS DOUBLE) AS total_spend, CAST(SUM(total_spend) AS DOUBLE) / COUNT(total_spend) AS avg_spend,
  COUNT(DISTINCT current_account_nbr) AS active_accounts FROM customer_monthly GROUP BY month""", "customer_monthly"))
def q_portfolio_monthly(spark, sf_dir):
    return R.portfolio_monthly(context(spark, sf_dir).cm)


DERIVED_COLS = ["delinquent_cycle_count", "max_delinquency_level", "risk_flag_count", "avg_monthly_sales_6m",
                "sales_trend_slope", "utilization_ratio", "otb_ratio", "has_fraud_case"]


@register("derived_summary", q(_describe_sql("customer_base", DERIVED_COLS, ["mean", "median", "min", "max"],
                                             interpolate=True),
                               "customer_base"))
def q_derived_summary(spark, sf_dir):
    return R.summary_stats(context(spark, sf_dir).base, DERIVED_COLS, stats=("mean", "median", "min", "max"))


LAG_COLS = ["spend_lag_1", "spend_lag_2", "spend_lag_3", "spend_rolling_mean_3", "spend_rolling_std_3"]


@register("lag_coverage", q("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null, COUNT(*) AS total FROM cm_lags" for c in LAG_COLS), "cm_lags"))
def q_lag_coverage(spark, sf_dir):
    return R.non_null_counts(context(spark, sf_dir).cm_lags, LAG_COLS)


@register("fraud_rate", q(f"""
SELECT has_fraud_case, COUNT(*) AS accounts, {_r('COUNT(*) / (SELECT COUNT(*) FROM customer_base) * 100.0', 2)} AS pct
FROM customer_base GROUP BY has_fraud_case""", "customer_base"))
def q_fraud_rate(spark, sf_dir):
    base = context(spark, sf_dir).base
    counts = base.groupBy("has_fraud_case").agg(F.count(F.lit(1)).alias("accounts"))
    total = base.agg(F.count(F.lit(1)).alias("n")).first()["n"]  # one-number summary
    return counts.withColumn("pct", R.round_dp(F.col("accounts") / F.lit(float(total or 1)) * F.lit(100.0), 2))


@register("fraud_txn_rate", q(f"""
SELECT CAST(SUM(is_fraud_txn) AS BIGINT) AS fraud_txns, COUNT(*) AS transactions,
  {_r('AVG(CAST(is_fraud_txn AS DOUBLE)) * 100.0', 4)} AS fraud_txn_pct
FROM (SELECT CASE WHEN f.current_account_nbr IS NOT NULL THEN 1 ELSE 0 END AS is_fraud_txn
      FROM transaction_base t LEFT JOIN fraud_claim_tran f ON t.current_account_nbr = f.current_account_nbr
        AND CAST(t.transaction_date AS DATE) = CAST(f.transaction_dt AS DATE) AND ABS(t.transaction_amt - f.transaction_am) < 0.01)
""", "transaction_base", "fraud_claim_tran"))
def q_fraud_txn_rate(spark, sf_dir):
    from ..operators import fraud
    t = context(spark, sf_dir).t
    df = fraud.txn_fraud_flag(t["transaction_base"], t["fraud_claim_tran"])
    return df.agg(F.sum("is_fraud_txn").cast("long").alias("fraud_txns"), F.count(F.lit(1)).alias("transactions"),
                  R.round_dp(F.avg(F.col("is_fraud_txn").cast("double")) * F.lit(100.0), 4).alias("fraud_txn_pct"))


RULE_DESCRIBE = ["adjustment_pct", "rule_recommended_line", "rule_adjustment_delta"]


@register("describe_frame", q(_describe_sql("rule_adj", RULE_DESCRIBE, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
                                            interpolate=True),
                              "rule_adj"))
def q_describe_frame(spark, sf_dir):
    return R.summary_stats(context(spark, sf_dir).rule_adj, RULE_DESCRIBE)


def _base_columns() -> list[str]:
    from .oracle import SNAP_COLS
    return (["current_account_nbr", "payment_hist_1_12_mths", "card_activation_date", "external_status_reason_code",
             "market_segment", "confidence_level"] + SNAP_COLS
            + ["has_fraud_case", "max_fraud_amt", "delinquent_cycle_count", "max_delinquency_level", "risk_flag_count",
               "avg_monthly_sales_6m", "sales_trend_slope", "utilization_ratio", "otb_ratio"])


_SPARK_TYPE = ("CASE typeof(ANY_VALUE({c})) WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' "
               "WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DATE' THEN 'date' "
               "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(typeof(ANY_VALUE({c}))) END")


@register("missing_summary", q("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
    f"{_r(f'COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) * 100.0', 2)} AS missing_pct, "
    f"{_SPARK_TYPE.format(c=c)} AS dtype FROM customer_base"
    for c in _base_columns()) + ") WHERE missing_count > 0", "customer_base"))
def q_missing_summary(spark, sf_dir):
    return R.missing_summary(context(spark, sf_dir).base, with_dtype=True)


@register("profile_categorical", q(f"""
SELECT external_status_reason_code AS value, COUNT(*) AS count,
  {_r('COUNT(*) / (SELECT COUNT(*) FROM account_dim) * 100.0', 2)} AS pct
FROM account_dim GROUP BY external_status_reason_code ORDER BY count DESC, value ASC NULLS FIRST LIMIT 20""", "account_dim"))
def q_profile_categorical(spark, sf_dir):
    return R.profile_categorical(context(spark, sf_dir).t["account_dim"], "external_status_reason_code", 20)


@register("actual_q4", q(f"""
SELECT current_account_nbr, CAST(SUM(total_spend) AS DOUBLE) AS actual_q4_spend FROM customer_monthly
WHERE month >= DATE '{CUTOFF_MONTH}' GROUP BY current_account_nbr""", "customer_monthly"))
def q_actual_q4(spark, sf_dir):
    cm = context(spark, sf_dir).cm
    return (cm.where(F.col("month") >= F.to_date(F.lit(CUTOFF_MONTH))).groupBy(ACCT)
            .agg(F.sum("total_spend").cast("double").alias("actual_q4_spend")))


@register("segment_distribution", q("SELECT segment_name, COUNT(*) AS accounts FROM segments GROUP BY segment_name", "segments"))
def q_segment_distribution(spark, sf_dir):
    return context(spark, sf_dir).segments.groupBy("segment_name").agg(F.count(F.lit(1)).alias("accounts"))


@register("segment_summary", q(f"""
SELECT segment_name, COUNT(current_account_nbr) AS account_count,
  CAST(ROUND(SUM(CAST(cu_crd_line AS DECIMAL(20,4))), 2) AS DOUBLE) AS total_credit_exposure,
  {_r('AVG(ca_current_utilz)', 4)} AS avg_utilization, {_r('AVG(cu_cur_balance)', 4)} AS avg_balance
FROM segments GROUP BY segment_name""", "segments"))
def q_segment_summary(spark, sf_dir):
    s = context(spark, sf_dir).segments
    return s.groupBy("segment_name").agg(
        F.count(ACCT).alias("account_count"),
        F.round(F.sum(F.col("cu_crd_line").cast("decimal(20,4)")), 2).cast("double").alias("total_credit_exposure"),
        R.round_dp(F.avg("ca_current_utilz"), 4).alias("avg_utilization"),
        R.round_dp(F.avg("cu_cur_balance"), 4).alias("avg_balance"))


PROFILE_COLS = ["cu_bhv_scr", "cu_crd_bureau_scr", "ca_current_utilz", "avg_monthly_sales_6m", "cu_nbr_days_dlq",
                "ca_nsf_count_lst_12_months", "delinquent_cycle_count", "cu_crd_line"]


@register("segment_profile", q("SELECT segment_name, " + ", ".join(
    f"{_r(f'AVG(CAST({c} AS DOUBLE))', 2)} AS {c}" for c in PROFILE_COLS) + " FROM segments GROUP BY segment_name",
                               "segments"))
def q_segment_profile(spark, sf_dir):
    s = context(spark, sf_dir).segments
    return s.groupBy("segment_name").agg(*[R.round_dp(F.avg(F.col(c).cast("double")), 2).alias(c) for c in PROFILE_COLS])


@register("risk_by_segment", q(_describe_sql("risk", ["risk_score"], ["count", "mean", "std", "min", "p25", "p50", "p75", "max"],
                                             digits=2, group="segment_name", round_all=True, interpolate=True), "risk"))
def q_risk_by_segment(spark, sf_dir):
    return R.grouped_summary(context(spark, sf_dir).risk, "segment_name", "risk_score", 2)


@register("risk_distribution", q(_describe_sql("risk", ["risk_score"], ["mean", "median", "std", "min", "max"], digits=4,
                                               interpolate=True), "risk"))
def q_risk_distribution(spark, sf_dir):
    return R.summary_stats(context(spark, sf_dir).risk, ["risk_score"], stats=("mean", "median", "std", "min", "max"))


@register("risk_histogram", q("""
SELECT 0.0 + bin * 2.0 AS bin_start, 0.0 + (bin + 1) * 2.0 AS bin_end, COUNT(*) AS count
FROM (SELECT LEAST(CAST(FLOOR((risk_score - 0.0) / 2.0) AS BIGINT), 49) AS bin FROM risk WHERE risk_score IS NOT NULL)
GROUP BY bin""", "risk"))
def q_risk_histogram(spark, sf_dir):
    return R.histogram(context(spark, sf_dir).risk, "risk_score", 2.0, 0.0, 100.0)


# ---------------------------------------------------------------------------------------
# 2.6 sorts, limits, top-k; 2.7 distinct
# ---------------------------------------------------------------------------------------

@register("top_spenders", q("""
SELECT current_account_nbr, CAST(SUM(total_spend) AS DOUBLE) AS total_spend FROM customer_monthly
GROUP BY current_account_nbr ORDER BY SUM(total_spend) DESC, current_account_nbr LIMIT 200""", "customer_monthly"))
def q_top_spenders(spark, sf_dir):
    cm = context(spark, sf_dir).cm
    sums = cm.groupBy(ACCT).agg(F.sum("total_spend").alias("_s"))
    return (R.top_k(sums, 200, [F.col("_s").desc(), F.col(ACCT)])
            .select(ACCT, F.col("_s").cast("double").alias("total_spend")))


@register("top_accounts_semi", q("""
SELECT m.current_account_nbr, m.month, CAST(m.total_spend AS DOUBLE) AS total_spend FROM customer_monthly m
WHERE m.current_account_nbr IN (SELECT current_account_nbr FROM customer_monthly GROUP BY current_account_nbr
                                ORDER BY SUM(total_spend) DESC, current_account_nbr LIMIT 200)""", "customer_monthly"))
def q_top_accounts_semi(spark, sf_dir):
    cm = context(spark, sf_dir).cm
    top = R.top_k(cm.groupBy(ACCT).agg(F.sum("total_spend").alias("_s")), 200, [F.col("_s").desc(), F.col(ACCT)])
    return finish(cm.join(top.select(ACCT), ACCT, "left_semi").select(ACCT, "month", "total_spend"))


@register("spend_heatmap", q("""
SELECT m.current_account_nbr, strftime(m.month, '%Y-%m') AS month_str, AVG(CAST(m.total_spend AS DOUBLE)) AS avg_spend
FROM customer_monthly m
WHERE m.current_account_nbr IN (SELECT current_account_nbr FROM customer_monthly GROUP BY current_account_nbr
                                ORDER BY SUM(total_spend) DESC, current_account_nbr LIMIT 200)
GROUP BY m.current_account_nbr, strftime(m.month, '%Y-%m')""", "customer_monthly"))
def q_spend_heatmap(spark, sf_dir):
    cm = context(spark, sf_dir).cm
    top = R.top_k(cm.groupBy(ACCT).agg(F.sum("total_spend").alias("_s")), 200, [F.col("_s").desc(), F.col(ACCT)])
    rows = cm.join(top.select(ACCT), ACCT, "left_semi")
    return (rows.groupBy(ACCT, F.date_format("month", "yyyy-MM").alias("month_str"))
            .agg(F.avg(F.col("total_spend").cast("double")).alias("avg_spend")))


# Months of the test data, for the wide form's SQL; the query adds what other months the data have.
HEATMAP_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]


@register("spend_heatmap_wide", q("SELECT current_account_nbr, " + ", ".join(
    f"COALESCE(AVG(CAST(total_spend AS DOUBLE)) FILTER (WHERE strftime(month, '%Y-%m') = '{m}'), 0.0) AS \"{m}\"" for m in HEATMAP_MONTHS)
    + """ FROM customer_monthly
WHERE current_account_nbr IN (SELECT current_account_nbr FROM customer_monthly GROUP BY current_account_nbr
                              ORDER BY SUM(total_spend) DESC, current_account_nbr LIMIT 200)
GROUP BY current_account_nbr""", "customer_monthly"))
def q_spend_heatmap_wide(spark, sf_dir):
    """Wide form of the heatmap: one column per month, missing cells 0."""
    return R.spend_heatmap_wide(context(spark, sf_dir).cm, 200, HEATMAP_MONTHS)


@register("output_head_tail", q("""
SELECT * FROM (SELECT 'head' AS part, current_account_nbr, adjustment_delta FROM final_recs
               ORDER BY adjustment_delta DESC, current_account_nbr LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'tail' AS part, current_account_nbr, adjustment_delta FROM final_recs
               ORDER BY adjustment_delta ASC, current_account_nbr LIMIT 5)""", "final_recs", **QP))
def q_output_head_tail(spark, sf_dir):
    f = context(spark, sf_dir).final_recs.select(ACCT, "adjustment_delta")
    head = R.top_k(f, 10, [F.col("adjustment_delta").desc(), F.col(ACCT)]).withColumn("part", F.lit("head"))
    tail = R.top_k(f, 5, [F.col("adjustment_delta").asc(), F.col(ACCT)]).withColumn("part", F.lit("tail"))
    return head.unionByName(tail).select("part", ACCT, "adjustment_delta")


@register("representative_account", q("""
SELECT segment_name, MIN(current_account_nbr) AS current_account_nbr, MIN(adjustment_delta) AS adjustment_delta
FROM (SELECT f.segment_name, f.current_account_nbr, f.adjustment_delta FROM final_recs f
      JOIN (SELECT segment_name, MAX(CASE WHEN rn = GREATEST(CAST(CEIL(0.5 * n) AS BIGINT), 1) THEN adjustment_delta END) AS med
            FROM (SELECT segment_name, adjustment_delta,
                    ROW_NUMBER() OVER (PARTITION BY segment_name ORDER BY adjustment_delta) AS rn,
                    COUNT(adjustment_delta) OVER (PARTITION BY segment_name) AS n FROM final_recs)
            GROUP BY segment_name) m ON f.segment_name = m.segment_name AND f.adjustment_delta = m.med)
GROUP BY segment_name""", "final_recs", **QP))
def q_representative_account(spark, sf_dir):
    return R.median_representative(context(spark, sf_dir).final_recs, "segment_name", "adjustment_delta")


@register("sample_rows", q("""
SELECT current_account_nbr, cu_crd_line, adjustment_delta FROM final_recs
ORDER BY md5('42|' || current_account_nbr), current_account_nbr LIMIT 2000""", "final_recs", **QP))
def q_sample_rows(spark, sf_dir):
    f = context(spark, sf_dir).final_recs.select(ACCT, "cu_crd_line", "adjustment_delta")
    return R.hash_sample(f, 2000)


@register("distinct_accounts", q("SELECT DISTINCT current_account_nbr FROM customer_monthly", "customer_monthly"))
def q_distinct_accounts(spark, sf_dir):
    return context(spark, sf_dir).cm.select(ACCT).distinct()


# ---------------------------------------------------------------------------------------
# 2.2 profiling, pruning, dates
# ---------------------------------------------------------------------------------------

ANOMALY_COLS = ["total_spend", "txn_count", "avg_txn_amt", "max_txn_amt", "total_foreign_amt", "total_markup_fees",
                "first_purchase_count"]


# numeric columns of the account base, in its order
BASE_NUMERIC = [c for c in _base_columns() if c not in (
    "current_account_nbr", "payment_hist_1_12_mths", "card_activation_date", "external_status_reason_code", "market_segment",
    "cu_line_incr_excl_flag", "rb_crd_gr_new_crd_gr", "cu_processing_date")]


def _corr_sql(table: str, cols, digits: int | None = 4) -> str:
    """Every pair's |r| by DuckDB's own correlation over long-form cells, null where a column does
    not vary over the pair's rows."""
    cells = ", ".join(f"{{'i': {i}, 'x': CAST({c} AS DOUBLE)}}" for i, c in enumerate(cols))
    names = "[" + ", ".join(f"'{c}'" for c in cols) + "]"
    r = "CASE WHEN MIN(a.x) < MAX(a.x) AND MIN(b.x) < MAX(b.x) THEN ABS(CORR(a.x, b.x)) END"
    return f"""
SELECT {names}[g.i + 1] AS col_a, {names}[g.j + 1] AS col_b, {_r('m.r', digits) if digits is not None else 'm.r'} AS abs_corr
FROM (SELECT x.i AS i, y.i AS j FROM range({len(cols)}) x(i) JOIN range({len(cols)}) y(i) ON x.i < y.i) g
LEFT JOIN (
  WITH cell AS (SELECT rid, p.i AS i, p.x AS x FROM (
    SELECT rid, unnest([{cells}]) AS p FROM (SELECT *, ROW_NUMBER() OVER () AS rid FROM {table})) WHERE p.x IS NOT NULL)
  SELECT a.i AS i, b.i AS j, {r} AS r FROM cell a JOIN cell b ON a.rid = b.rid AND a.i < b.i GROUP BY a.i, b.i) m
ON g.i = m.i AND g.j = m.j"""


@register("correlation_matrix", q(_corr_sql("customer_base", BASE_NUMERIC), "customer_base"))
def q_correlation_matrix(spark, sf_dir):
    return R.correlation_pairs(finish(context(spark, sf_dir).base), BASE_NUMERIC)


@register("drop_correlated", q(f"""
SELECT c.column_name, COALESCE(bool_or(p.abs_corr > 0.85), FALSE) AS dropped, c.position
FROM (SELECT * FROM (VALUES {', '.join(f"('{c}', {i})" for i, c in enumerate(BASE_NUMERIC))}) v(column_name, position)) c
LEFT JOIN ({_corr_sql('customer_base', BASE_NUMERIC, None)}) p ON p.col_a = c.column_name
GROUP BY c.column_name, c.position""", "customer_base"))
def q_drop_correlated(spark, sf_dir):
    _, verdicts = R.drop_correlated(finish(context(spark, sf_dir).base).select(*BASE_NUMERIC), 0.85)
    return verdicts


@register("pruned_base", q("SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null FROM customer_base" for c in BASE_NUMERIC) + f""") k
WHERE column_name NOT IN (SELECT p.col_a FROM ({_corr_sql('customer_base', BASE_NUMERIC, None)}) p WHERE p.abs_corr > 0.85)
  AND non_null >= 0.3 * (SELECT COUNT(*) FROM customer_base)""", "customer_base"))
def q_pruned_base(spark, sf_dir):
    """The base's numeric columns that both prunings leave, counted in the pruned frame."""
    base = finish(context(spark, sf_dir).base).select(*BASE_NUMERIC)
    few, _ = R.drop_correlated(base, 0.85)
    left, _ = R.drop_high_missing(few, 0.70)
    return R.non_null_counts(left, left.columns).select("column_name", "non_null")


@register("drop_high_missing", q("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_share, "
    f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.7 AS dropped FROM customer_base" for c in _base_columns()),
                                 "customer_base"))
def q_drop_high_missing(spark, sf_dir):
    _, verdicts = R.drop_high_missing(finish(context(spark, sf_dir).base), 0.70)
    return verdicts


@register("parse_dates", q("""
SELECT current_account_nbr, CAST(CAST(card_activation_date AS VARCHAR) AS TIMESTAMP) AS card_activation_date FROM account_dim""",
                           "account_dim"))
def q_parse_dates(spark, sf_dir):
    a = context(spark, sf_dir).t["account_dim"].select(ACCT, F.col("card_activation_date").cast("string"))
    return parse_dates(a, ["card_activation_date", "not_a_column"])


@register("extract_month", q("""
SELECT current_account_nbr, transaction_id, strftime(transaction_date, '%Y-%m') AS year_month FROM transaction_base""",
                             "transaction_base"))
def q_extract_month(spark, sf_dir):
    t = context(spark, sf_dir).t["transaction_base"].select(ACCT, "transaction_id", "transaction_date")
    return extract_month(t, "transaction_date").drop("transaction_date")


@register("month_in_filter", q(f"""
SELECT current_account_nbr, month, CAST(total_spend AS DOUBLE) AS total_spend FROM customer_monthly
WHERE strftime(month, '%Y-%m') IN ({', '.join(repr(m) for m in QUARTER_MONTHS)})""", "customer_monthly"))
def q_month_in_filter(spark, sf_dir):
    cm = context(spark, sf_dir).cm
    return finish(matrix.month_in(cm, QUARTER_MONTHS).select(ACCT, "month", "total_spend"))


# ---------------------------------------------------------------------------------------
# 2.3 / 2.2 / 2.5 model matrices and splits
# ---------------------------------------------------------------------------------------

def _q4_oracle_body(select: str) -> str:
    static = ", ".join(f"b.{c}" for c in matrix.STATIC_FEATURES)
    return f"""
SELECT {select} FROM (
  SELECT m.*, {static}, CASE WHEN m.month < DATE '{CUTOFF_MONTH}' THEN 'train' ELSE 'test' END AS split FROM (
    SELECT l.*, b2.cu_crd_line,
      CASE WHEN COALESCE(b2.cu_crd_line, 0.0) > 0 THEN CAST(l.total_spend AS DOUBLE) / GREATEST(COALESCE(b2.cu_crd_line, 0.0), 1.0)
           ELSE 0.0 END AS spend_to_limit_ratio
    FROM cm_lags l LEFT JOIN customer_base b2 ON l.current_account_nbr = b2.current_account_nbr) m
  LEFT JOIN customer_base b ON m.current_account_nbr = b.current_account_nbr)
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in matrix.Q4_FEATURES + ['total_spend'])}"""


_Q4_SELECT = ("current_account_nbr, month, split, CAST(total_spend AS DOUBLE) AS total_spend, "
              + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in matrix.Q4_FEATURES))


def _q4_frame(spark, sf_dir):
    """The quarter matrix, written once per session to the checkpoint folder: model fits,
    early-stopping evaluation and the report queries all read the same materialised rows
    instead of re-running the windows and joins."""
    ctx = context(spark, sf_dir)
    store = ctx.__dict__.setdefault("_models", {})
    if "q4_frame" not in store:
        df, feats, target = matrix.q4_feature_matrix(ctx.cm_lags, ctx.base, CUTOFF_MONTH)
        store["q4_frame"] = (materialise(df, "q4-matrix"), feats, target)
    return store["q4_frame"]


@register("q4_feature_matrix", q(_q4_oracle_body(_Q4_SELECT), "cm_lags", "customer_base"))
def q_q4_feature_matrix(spark, sf_dir):
    df, feats, target = _q4_frame(spark, sf_dir)
    return df.select(ACCT, "month", "split", F.col(target).cast("double").alias(target),
                     *[F.col(c).cast("double").alias(c) for c in feats])


@register("temporal_split", q(
    "SELECT split, COUNT(*) AS rows, CAST(SUM(total_spend) AS DOUBLE) AS total_target FROM ("
    + _q4_oracle_body("split, total_spend") + ") GROUP BY split", "cm_lags", "customer_base"))
def q_temporal_split(spark, sf_dir):
    df, _, target = _q4_frame(spark, sf_dir)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum(target).cast("double").alias("total_target"))


@register("null_feature_policy", q(f"""
SELECT 'drop' AS policy, COUNT(*) AS rows, {_r('SUM(COALESCE(CAST(cu_bhv_scr AS DOUBLE), 0.0))', 2)} AS bhv_sum
FROM segments WHERE {' AND '.join(f'{c} IS NOT NULL' for c in segments.CLASSIFICATION_FEATURES)}
UNION ALL
SELECT 'zero_fill' AS policy, COUNT(*) AS rows, {_r('SUM(COALESCE(CAST(cu_bhv_scr AS DOUBLE), 0.0))', 2)} AS bhv_sum
FROM segments""", "segments"))
def q_null_feature_policy(spark, sf_dir):
    s = context(spark, sf_dir).segments
    cols = segments.CLASSIFICATION_FEATURES
    dropped = matrix.drop_null_features(s, cols)
    filled = matrix.zero_fill_features(s, cols)
    agg = lambda d, name: d.agg(F.lit(name).alias("policy"), F.count(F.lit(1)).alias("rows"),
                                R.round_dp(F.sum(F.col("cu_bhv_scr").cast("double")), 2).alias("bhv_sum"))
    return agg(dropped, "drop").unionByName(agg(filled, "zero_fill"))


@register("sequence_windows", q("""
SELECT current_account_nbr, month, step, total_spend, prev_balance, CAST(target AS DOUBLE) AS target FROM (
  SELECT *, SUM(CASE WHEN step > 9 AND step <= 12 THEN CAST(total_spend AS DECIMAL(28,2)) END) OVER (PARTITION BY current_account_nbr) AS target
  FROM (SELECT current_account_nbr, month, COALESCE(CAST(total_spend AS DOUBLE), 0.0) AS total_spend,
          COALESCE(CAST(prev_balance AS DOUBLE), 0.0) AS prev_balance,
          ROW_NUMBER() OVER (PARTITION BY current_account_nbr ORDER BY month) AS step,
          COUNT(*) OVER (PARTITION BY current_account_nbr) AS n
        FROM customer_monthly) WHERE n >= 12)
WHERE step <= 9""", "customer_monthly"))
def q_sequence_windows(spark, sf_dir):
    return matrix.sequence_windows(context(spark, sf_dir).cm)


def _hash(salt: str = "") -> str:
    return f"CAST(('0x' || substr(md5('{salt}' || CAST(current_account_nbr AS VARCHAR)), 1, 8)) AS BIGINT)"


@register("validation_tail", q(f"""
SELECT current_account_nbr, month,
  ROW_NUMBER() OVER (ORDER BY current_account_nbr DESC, month DESC) <= FLOOR(COUNT(*) OVER () * CAST('0.2' AS DOUBLE)) AS is_validation
FROM ({_q4_oracle_body('current_account_nbr, month, split')}) WHERE split = 'train'""", "cm_lags", "customer_base"))
def q_validation_tail(spark, sf_dir):
    df, _, _ = _q4_frame(spark, sf_dir)
    return matrix.positional_tail(df.where(F.col("split") == "train").select(ACCT, "month"), 0.20, [ACCT, "month"])


@register("random_split", q(f"""
SELECT current_account_nbr, ROW_NUMBER() OVER (ORDER BY {_hash()}, current_account_nbr)
  <= FLOOR(COUNT(*) OVER () * 0.25 + 0.5) AS is_test FROM rule_adj""", "rule_adj"))
def q_random_split(spark, sf_dir):
    return matrix.exact_split(context(spark, sf_dir).rule_adj.select(ACCT), 0.25, "is_test")


@register("stratified_split", q(f"""
SELECT current_account_nbr, segment_label, ROW_NUMBER() OVER (PARTITION BY segment_label ORDER BY {_hash()}, current_account_nbr)
  <= FLOOR(COUNT(*) OVER (PARTITION BY segment_label) * 0.25 + 0.5) AS is_test FROM segments""", "segments"))
def q_stratified_split(spark, sf_dir):
    return matrix.stratified_split(context(spark, sf_dir).segments.select(ACCT, "segment_label"), "segment_label", 0.25)


@register("class_weights", q("""
SELECT segment_label, CAST(SUM(n_c) OVER () AS DOUBLE) / (COUNT(*) OVER () * n_c) AS class_weight
FROM (SELECT segment_label, COUNT(*) AS n_c FROM segments GROUP BY segment_label)""", "segments"))
def q_class_weights(spark, sf_dir):
    s = context(spark, sf_dir).segments
    return segments.class_weights(s.select("segment_label")).select("segment_label", "class_weight").distinct()


@register("zscore_features", q("SELECT current_account_nbr, " + ", ".join(
    f"{_r(f'(COALESCE(CAST({c} AS DOUBLE), 0.0) - AVG(COALESCE(CAST({c} AS DOUBLE), 0.0)) OVER ()) / '
          f'COALESCE(NULLIF(STDDEV_POP(COALESCE(CAST({c} AS DOUBLE), 0.0)) OVER (), 0), 1.0)', 4)} AS {c}"
    for c in ANOMALY_COLS) + " FROM anomaly_features", "anomaly_features"))
def q_zscore_features(spark, sf_dir):
    z = matrix.zscore(context(spark, sf_dir).anomaly_features, ANOMALY_COLS)
    return z.select(ACCT, *[R.round_dp(c, 4).alias(c) for c in ANOMALY_COLS])


# ---------------------------------------------------------------------------------------
# 2.1 sources and sinks
# ---------------------------------------------------------------------------------------

ACCOUNT_DIM_SCHEMA = ("current_account_nbr string, payment_hist_1_12_mths string, card_activation_date date, "
                      "external_status_reason_code string, market_segment string")


@register("csv_ingest", q("SELECT * FROM account_dim", "account_dim"))
def q_csv_ingest(spark, sf_dir):
    from pyspark.sql.types import _parse_datatype_string
    src = context(spark, sf_dir).t["account_dim"]
    path = ingest.write_csv(src, scratch_path(spark, "csv-ingest"))
    good, _bad = ingest.read_csv_table(spark, path, _parse_datatype_string(ACCOUNT_DIM_SCHEMA))
    store = scratch_path(spark, "store")
    for rows in (good.limit(1), good):  # the second load drops and recreates the table
        tables.replace_table(rows, store, "account_dim")
    return tables.read_table(spark, store, "account_dim")


@register("row_count_audit", q("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST({v} AS BIGINT) AS expected, "
    f"(SELECT COUNT(*) FROM {n}) AS actual, (SELECT COUNT(*) FROM {n}) - {v} AS diff, "
    f"ABS((SELECT COUNT(*) FROM {n}) - {v}) <= {ingest.AUDIT_TOLERANCE} AS ok"
    for n, v in ingest.EXPECTED_COUNTS.items()), *ingest.EXPECTED_COUNTS.keys()))
def q_row_count_audit(spark, sf_dir):
    t = context(spark, sf_dir).t
    return ingest.row_count_audit(spark, {n: t[n] for n in ingest.EXPECTED_COUNTS})


@register("parquet_sink", q(f"SELECT current_account_nbr, month, CAST(total_spend AS DOUBLE) AS total_spend, txn_count "
                            f"FROM customer_monthly", "customer_monthly"))
def q_parquet_sink(spark, sf_dir):
    cm = finish(context(spark, sf_dir).cm.select(ACCT, "month", "total_spend", "txn_count"))
    store = scratch_path(spark, "store")
    tables.replace_table(cm, store, "customer_monthly")
    return tables.read_table(spark, store, "customer_monthly")


@register("csv_sink", q("""
SELECT current_account_nbr, cu_crd_line AS current_credit_line, q4_forecast, segment_name, risk_score, anomaly_flag,
  recommended_credit_line, adjustment_delta FROM final_recs""", "final_recs", **QP))
def q_csv_sink(spark, sf_dir):
    from ..operators import credit
    out = credit.final_projection(context(spark, sf_dir).final_recs)
    path = ingest.write_csv(out, scratch_path(spark, "final-output"))
    schema = ("current_account_nbr string, current_credit_line double, q4_forecast double, segment_name string, "
              "risk_score double, anomaly_flag double, recommended_credit_line double, adjustment_delta double")
    return spark.read.schema(schema).option("header", "true").csv(path)


@register("exclude_column", q("SELECT * FROM latest_rams", "latest_rams"))
def q_exclude_column(spark, sf_dir):
    """The newest snapshot rows with the helper rank column dropped (``SELECT * EXCLUDE``)."""
    from ..operators import accounts
    return accounts.latest_snapshot(context(spark, sf_dir).t["rams_batch_cur"])


@register("not_null_filter", q("""
SELECT 'transaction_base' AS table_name, current_account_nbr, transaction_date AS event_date FROM transaction_base
WHERE transaction_date IS NOT NULL
UNION ALL
SELECT 'statement_fact', current_account_nbr, billing_cycle_date FROM statement_fact WHERE billing_cycle_date IS NOT NULL""",
                               "transaction_base", "statement_fact"))
def q_not_null_filter(spark, sf_dir):
    t = context(spark, sf_dir).t
    a = (t["transaction_base"].where(F.col("transaction_date").isNotNull())
         .select(F.lit("transaction_base").alias("table_name"), ACCT, F.col("transaction_date").alias("event_date")))
    b = (t["statement_fact"].where(F.col("billing_cycle_date").isNotNull())
         .select(F.lit("statement_fact").alias("table_name"), ACCT, F.col("billing_cycle_date").alias("event_date")))
    return a.unionByName(b)


_LOADED = ("current_account_nbr", "transaction_id", "transaction_date", "transaction_amt", "transaction_code", "frgn_curr_code",
           "first_purchase_ind", "source_table")


@register("load_pipeline", q("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST({v} AS BIGINT) AS expected, "
    f"(SELECT COUNT(*) FROM {n}) AS actual, (SELECT COUNT(*) FROM {n}) - {v} AS diff, "
    f"ABS((SELECT COUNT(*) FROM {n}) - {v}) <= {ingest.AUDIT_TOLERANCE} AS ok"
    for n, v in ingest.EXPECTED_COUNTS.items()), *ingest.EXPECTED_COUNTS.keys()))
def q_load_pipeline(spark, sf_dir):
    """Full load path: every source table is exported as headered CSV, loaded back with
    its fixed schema (corrupt-row split), unioned, and audited against expected counts."""
    return ingest.row_count_audit(spark, _csv_round_trip(spark, sf_dir))


def _csv_round_trip(spark, sf_dir):
    t = context(spark, sf_dir).t
    base = scratch_path(spark, "csv-extracts")
    schemas = {}
    for name in ingest.SOURCE_TABLES:
        ingest.write_csv(t[name], f"{base}/{name}.csv")
        schemas[name] = t[name].schema
    return ingest.load_tables(spark, base, schemas, store=f"{base}/store")


@register("load_pipeline_values", q(f"""
SELECT {', '.join('CAST(transaction_amt AS DOUBLE) AS transaction_amt' if c == 'transaction_amt' else c for c in _LOADED)}
FROM transaction_base""", "transaction_base"))
def q_load_pipeline_values(spark, sf_dir):
    """The transactions' values after the CSV round trip, empty text told from null."""
    return finish(_csv_round_trip(spark, sf_dir)["transaction_base"].select(*_LOADED))
