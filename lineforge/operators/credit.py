"""Credit-line decisions: rule adjustment, model-driven recommendation, output, audits."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip_columns, excluded_flag, numeric_or_zero, to_numeric_zero

ACCT = "current_account_nbr"

# ---------------------------------------------------------------------------------------
# Adjustment by segment, balance floor and line cap.
#   segment 3 +20 %, 2 +10 %, 1 0 %, 0 -5 %; floor 1.10 x balance; cap 1.50 x line.
# ---------------------------------------------------------------------------------------
ADJUSTMENT_RULES = {3: 0.20, 2: 0.10, 1: 0.00, 0: -0.05}
BALANCE_FLOOR = 1.10
LINE_CAP = 1.50

# Features of the credit model.
CREDIT_FEATURES = [
    "cu_crd_line", "cu_cur_balance", "cu_otb",
    "ca_current_utilz", "ca_avg_utilz_lst_3_mnths", "ca_avg_utilz_lst_6_mnths",
    "cu_bhv_scr", "cu_crd_bureau_scr",
    "cu_nbr_days_dlq", "ca_nsf_count_lst_12_months",
    "ca_mob", "ca_mnths_since_active", "ca_mnths_since_cl_chng",
    "avg_monthly_sales_6m", "sales_trend_slope",
    "delinquent_cycle_count", "max_delinquency_level",
    "utilization_ratio", "otb_ratio",
    "risk_score", "segment_label",
]

OUTPUT_COLUMNS = [
    "current_account_nbr", "current_credit_line", "q4_forecast", "segment_name", "risk_score",
    "anomaly_flag", "recommended_credit_line", "adjustment_delta",
]


def _pct_map():
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(
        (k, float(v)) for k, v in ADJUSTMENT_RULES.items())])


def apply_rule_based_adjustment(df: DataFrame) -> DataFrame:
    """pct by segment -> exclusion caps pct at 0 -> line x (1 + pct) -> clip to
    [1.1 x balance, max(1.5 x line, line)] -> zero line stays 0 -> excluded: min(rec, line)."""
    line, bal = F.col("cu_crd_line"), F.col("cu_cur_balance")
    out = df.withColumns({"cu_crd_line": numeric_or_zero("cu_crd_line"),
                          "cu_cur_balance": numeric_or_zero("cu_cur_balance")})
    excl = excluded_flag("cu_line_incr_excl_flag")
    pct = F.coalesce(F.try_element_at(_pct_map(), F.col("segment_label").cast("int")), F.lit(0.0))
    out = out.withColumn("adjustment_pct", F.when(excl, F.least(pct, F.lit(0.0))).otherwise(pct))
    rec = line * (F.lit(1.0) + F.col("adjustment_pct"))
    lo = bal * F.lit(BALANCE_FLOOR)
    hi = F.greatest(line * F.lit(LINE_CAP), line)
    rec = clip_columns(rec, lo, hi)
    rec = F.when(line == 0, F.lit(0.0)).otherwise(rec)
    rec = F.when(excl, F.least(rec, line)).otherwise(rec)
    out = out.withColumn("rule_recommended_line", rec)
    return out.withColumn("rule_adjustment_delta", F.col("rule_recommended_line") - line)


def final_recommendations(df: DataFrame, predicted_delta: str = "predicted_adjustment_delta") -> DataFrame:
    """Apply a predicted delta: excluded & positive -> no change; clip to
    [1.1 x balance, 1.5 x line]; zero line -> 0; excluded -> min(rec, line); delta recomputed."""
    line, bal = F.col("cu_crd_line"), F.col("cu_cur_balance")
    out = df.withColumns({"cu_crd_line": numeric_or_zero("cu_crd_line"),
                          "cu_cur_balance": numeric_or_zero("cu_cur_balance")})
    excl = excluded_flag("cu_line_incr_excl_flag")
    d = F.col(predicted_delta).cast("double")
    blocked = excl & (d > 0)
    rec = F.when(blocked, line).otherwise(line + d)
    out = out.withColumn(predicted_delta, F.when(blocked, F.lit(0.0)).otherwise(d))
    rec = clip_columns(rec, bal * F.lit(BALANCE_FLOOR), line * F.lit(LINE_CAP))
    rec = F.when(line == 0, F.lit(0.0)).otherwise(rec)
    rec = F.when(excl, F.least(rec, line)).otherwise(rec)
    out = out.withColumn("recommended_credit_line", rec)
    delta = F.when(line == 0, F.lit(0.0)).otherwise(F.col("recommended_credit_line") - line)
    return out.withColumn("adjustment_delta", delta)


def final_projection(df: DataFrame, sort: bool = True) -> DataFrame:
    """The 8-column deliverable; missing columns are added as null; sorted by delta desc."""
    out = df.withColumnRenamed("cu_crd_line", "current_credit_line") if "cu_crd_line" in df.columns else df
    cols = []
    for c in OUTPUT_COLUMNS:
        cols.append(F.col(c) if c in out.columns else F.lit(None).cast("double").alias(c))
    res = out.select(*cols)
    return res.orderBy(F.col("adjustment_delta").desc_nulls_last(), F.col(ACCT)) if sort else res


def exclusion_audit(df: DataFrame, delta: str = "rule_adjustment_delta") -> DataFrame:
    """Accounts flagged for no increase, and how many of them were increased (must be 0)."""
    excl = excluded_flag("cu_line_incr_excl_flag")
    return df.agg(F.count_if(excl).alias("excluded_accounts"),
                  F.count_if(excl & (F.col(delta) > 0)).alias("excluded_increased"))


def portfolio_impact(df: DataFrame, line: str = "cu_crd_line",
                     rec: str = "recommended_credit_line", delta: str = "adjustment_delta") -> DataFrame:
    """Exposure before/after and the sums and counts of positive, negative, flat changes."""
    d = F.col(delta)
    return df.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.round(F.sum(to_numeric_zero(line).cast("decimal(20,4)")), 2).cast("double").alias("current_exposure"),
        F.round(F.sum(F.col(rec).cast("decimal(20,4)")), 2).cast("double").alias("recommended_exposure"),
        F.round(F.sum(F.when(d > 0, d.cast("decimal(20,4)"))), 2).cast("double").alias("positive_total"),
        F.count_if(d > 0).alias("positive_accounts"),
        F.round(F.sum(F.when(d < 0, d.cast("decimal(20,4)"))), 2).cast("double").alias("negative_total"),
        F.count_if(d < 0).alias("negative_accounts"),
        F.count_if(d == 0).alias("flat_accounts"))


def adjustment_waterfall(df: DataFrame) -> DataFrame:
    """Per segment: sum of current line, recommended line and delta, and account count."""
    return (df.groupBy("segment_name")
            .agg(F.round(F.sum(to_numeric_zero("cu_crd_line").cast("decimal(20,4)")), 2).cast("double").alias("current_total"),
                 F.round(F.sum(F.col("recommended_credit_line").cast("decimal(20,4)")), 2).cast("double").alias("recommended_total"),
                 F.round(F.sum(F.col("adjustment_delta").cast("decimal(20,4)")), 2).cast("double").alias("delta_total"),
                 F.count(ACCT).alias("account_count")))
