"""Registry of named queries (Spark callables) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payment as pay
from ..functions.numeric import to_numeric_zero
from ..functions.status import EXT_STATUS, external_status_desc
from ..operators import accounts, credit, fraud, monthly, risk, segments
from .context import CUTOFF_MONTH, QUARTER_END, context, finish
from .oracle import q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


ACCT = "current_account_nbr"
QP = {"cutoff": CUTOFF_MONTH, "end": QUARTER_END}

# ---------------------------------------------------------------------------------------
# 2.7 / 2.1  union and the monthly slice
# ---------------------------------------------------------------------------------------


@register("transaction_union", q("""
SELECT current_account_nbr, transaction_id, transaction_date, CAST(transaction_amt AS DOUBLE) AS transaction_amt,
  transaction_code, CAST(curr_markup_fee AS DOUBLE) AS curr_markup_fee, frgn_curr_code, first_purchase_ind, source_table
FROM transaction_base""", "transaction_base"))
def q_transaction_union(spark, sf_dir):
    from ..sources.ingest import union_transactions
    t = context(spark, sf_dir).t
    return finish(union_transactions(t["transaction_fact"], t["wrld_stor_tran_fact"]))


_TXN_MONTHLY_OUT = """
SELECT current_account_nbr, txn_month, CAST(total_spend AS DOUBLE) AS total_spend, txn_count, avg_txn_amt,
  CAST(max_txn_amt AS DOUBLE) AS max_txn_amt, CAST(total_cash_advance AS DOUBLE) AS total_cash_advance,
  CAST(total_returns AS DOUBLE) AS total_returns, CAST(total_markup_fees AS DOUBLE) AS total_markup_fees,
  CAST(total_foreign_txn_amt AS DOUBLE) AS total_foreign_txn_amt, first_purchase_count FROM txn_monthly"""


@register("txn_monthly", q(_TXN_MONTHLY_OUT, "txn_monthly"))
def q_txn_monthly(spark, sf_dir):
    return finish(monthly.txn_monthly(context(spark, sf_dir).t["transaction_base"]))


@register("stmt_monthly", q("""
SELECT current_account_nbr, stmt_month, CAST(prev_balance AS DOUBLE) AS prev_balance, return_check_cnt_total,
  return_check_cnt_ytd, return_check_cnt_last_mth FROM stmt_monthly""", "stmt_monthly"))
def q_stmt_monthly(spark, sf_dir):
    return finish(monthly.stmt_monthly(context(spark, sf_dir).t["statement_fact"]))


_CM_COLS = """current_account_nbr, month, CAST(total_spend AS DOUBLE) AS total_spend, txn_count, avg_txn_amt,
  CAST(max_txn_amt AS DOUBLE) AS max_txn_amt, CAST(total_cash_advance AS DOUBLE) AS total_cash_advance,
  CAST(total_returns AS DOUBLE) AS total_returns, CAST(total_markup_fees AS DOUBLE) AS total_markup_fees,
  CAST(total_foreign_txn_amt AS DOUBLE) AS total_foreign_txn_amt, first_purchase_count,
  CAST(prev_balance AS DOUBLE) AS prev_balance, return_check_cnt_total, return_check_cnt_ytd, return_check_cnt_last_mth"""


@register("customer_monthly", q(f"SELECT {_CM_COLS} FROM customer_monthly", "customer_monthly"))
def q_customer_monthly(spark, sf_dir):
    return finish(context(spark, sf_dir).cm)


_LAG_COLS = """CAST(spend_lag_1 AS DOUBLE) AS spend_lag_1, CAST(spend_lag_2 AS DOUBLE) AS spend_lag_2,
  CAST(spend_lag_3 AS DOUBLE) AS spend_lag_3, spend_rolling_mean_3, spend_rolling_std_3"""


@register("spend_lags", q(f"SELECT current_account_nbr, month, CAST(total_spend AS DOUBLE) AS total_spend, {_LAG_COLS} FROM cm_lags",
                          "cm_lags"))
def q_spend_lags(spark, sf_dir):
    df = context(spark, sf_dir).cm_lags
    return finish(df.select(ACCT, "month", "total_spend", "spend_lag_1", "spend_lag_2", "spend_lag_3",
                            "spend_rolling_mean_3", "spend_rolling_std_3"))


@register("rolling_spend", q("""
SELECT current_account_nbr, month, spend_rolling_mean_3, spend_rolling_std_3 FROM cm_lags""", "cm_lags"))
def q_rolling_spend(spark, sf_dir):
    return context(spark, sf_dir).cm_lags.select(ACCT, "month", "spend_rolling_mean_3", "spend_rolling_std_3")


# ---------------------------------------------------------------------------------------
# 2.5 / 2.4 / 2.3  account table
# ---------------------------------------------------------------------------------------

_RAMS_OUT = ", ".join(
    ["cu_account_nbr", "cu_processing_date", "cu_crd_line", "cu_cur_balance", "cu_otb", "ca_current_utilz",
     "cu_nbr_days_dlq", "ca_nsf_count_lst_12_months", "cu_line_incr_excl_flag", "ca_mob"])


@register("latest_snapshot", q(f"SELECT {_RAMS_OUT} FROM latest_rams", "latest_rams"))
def q_latest_snapshot(spark, sf_dir):
    df = accounts.latest_snapshot(context(spark, sf_dir).t["rams_batch_cur"])
    return df.select(*[c.strip() for c in _RAMS_OUT.split(",")])


@register("fraud_accounts", q("""
SELECT current_account_nbr, has_fraud_case, CAST(max_fraud_amt AS DOUBLE) AS max_fraud_amt FROM fraud_accounts""",
                              "fraud_accounts"))
def q_fraud_accounts(spark, sf_dir):
    return finish(accounts.fraud_accounts(context(spark, sf_dir).t["fraud_claim_case"]))


@register("customer_base", q("SELECT * REPLACE (CAST(max_fraud_amt AS DOUBLE) AS max_fraud_amt) FROM customer_base",
                             "customer_base"))
def q_customer_base(spark, sf_dir):
    return finish(context(spark, sf_dir).base)


@register("payment_history", q("""
SELECT current_account_nbr, payment_hist_1_12_mths, delinquent_cycle_count, max_delinquency_level, risk_flag_count
FROM customer_base""", "customer_base"))
def q_payment_history(spark, sf_dir):
    a = context(spark, sf_dir).t["account_dim"]
    return a.select(ACCT, "payment_hist_1_12_mths",
                    pay.delinquent_cycle_count("payment_hist_1_12_mths").alias("delinquent_cycle_count"),
                    pay.max_delinquency_level("payment_hist_1_12_mths").alias("max_delinquency_level"),
                    pay.risk_flag_count("payment_hist_1_12_mths").alias("risk_flag_count"))


_NUM_RE = r"^(\s*[+-]?((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?\s*|[+-]?(?i:inf|infinity))$"


def _sql_to_num(col: str) -> str:
    return (f"COALESCE(CASE WHEN regexp_full_match(CAST({col} AS VARCHAR), '{_NUM_RE}') "
            f"THEN TRY_CAST(trim(CAST({col} AS VARCHAR)) AS DOUBLE) END, 0.0)")


@register("to_numeric_zero", q(f"""
SELECT cu_account_nbr, cu_processing_date, rb_crd_gr_new_crd_gr, cu_line_incr_excl_flag,
  {_sql_to_num('rb_crd_gr_new_crd_gr')} AS crd_grade_num, {_sql_to_num('cu_line_incr_excl_flag')} AS excl_flag_num
FROM rams_batch_cur""", "rams_batch_cur"))
def q_to_numeric_zero(spark, sf_dir):
    r = context(spark, sf_dir).t["rams_batch_cur"]
    return r.select("cu_account_nbr", "cu_processing_date", "rb_crd_gr_new_crd_gr", "cu_line_incr_excl_flag",
                    to_numeric_zero("rb_crd_gr_new_crd_gr").alias("crd_grade_num"),
                    to_numeric_zero("cu_line_incr_excl_flag").alias("excl_flag_num"))


@register("sales_trend", q("""
SELECT current_account_nbr, avg_monthly_sales_6m, sales_trend_slope FROM customer_base""", "customer_base"))
def q_sales_trend(spark, sf_dir):
    return context(spark, sf_dir).base.select(ACCT, "avg_monthly_sales_6m", "sales_trend_slope")


@register("safe_ratios", q("""
SELECT current_account_nbr, cu_crd_line, cu_cur_balance, cu_otb, utilization_ratio, otb_ratio FROM customer_base""",
                           "customer_base"))
def q_safe_ratios(spark, sf_dir):
    return context(spark, sf_dir).base.select(ACCT, "cu_crd_line", "cu_cur_balance", "cu_otb",
                                              "utilization_ratio", "otb_ratio")


@register("impute_sentinel", q("SELECT current_account_nbr, card_activation_date FROM customer_base", "customer_base"))
def q_impute_sentinel(spark, sf_dir):
    return context(spark, sf_dir).base.select(ACCT, "card_activation_date")


_STATUS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EXT_STATUS.items())


@register("map_external_status", q(f"""
SELECT current_account_nbr, external_status_reason_code,
  COALESCE(CASE CAST(external_status_reason_code AS VARCHAR) {_STATUS} END, 'Unknown') AS ext_status_desc
FROM account_dim""", "account_dim"))
def q_map_external_status(spark, sf_dir):
    a = context(spark, sf_dir).t["account_dim"]
    return a.select(ACCT, "external_status_reason_code",
                    external_status_desc("external_status_reason_code").alias("ext_status_desc"))


@register("spend_to_limit", q("""
SELECT m.current_account_nbr, m.month, CAST(m.total_spend AS DOUBLE) AS total_spend, b.cu_crd_line,
  CASE WHEN COALESCE(b.cu_crd_line, 0.0) > 0 THEN CAST(m.total_spend AS DOUBLE) / GREATEST(COALESCE(b.cu_crd_line, 0.0), 1.0)
       ELSE 0.0 END AS spend_to_limit_ratio
FROM customer_monthly m LEFT JOIN customer_base b ON m.current_account_nbr = b.current_account_nbr""",
                              "customer_monthly", "customer_base"))
def q_spend_to_limit(spark, sf_dir):
    ctx = context(spark, sf_dir)
    df = monthly.add_spend_to_limit_ratio(ctx.cm, ctx.base)
    return finish(df.select(ACCT, "month", "total_spend", "cu_crd_line", "spend_to_limit_ratio"))


# ---------------------------------------------------------------------------------------
# 2.9  decisions with exact oracles
# ---------------------------------------------------------------------------------------

@register("segment_rules", q("""
SELECT current_account_nbr, ca_current_utilz, cu_nbr_days_dlq, ca_nsf_count_lst_12_months, has_fraud_case,
  delinquent_cycle_count, max_delinquency_level, sales_trend_slope, avg_monthly_sales_6m, cu_cur_balance, ca_mob,
  segment_label, segment_name FROM segments""", "segments"))
def q_segment_rules(spark, sf_dir):
    return context(spark, sf_dir).segments.select(
        ACCT, "ca_current_utilz", "cu_nbr_days_dlq", "ca_nsf_count_lst_12_months", "has_fraud_case",
        "delinquent_cycle_count", "max_delinquency_level", "sales_trend_slope", "avg_monthly_sales_6m",
        "cu_cur_balance", "ca_mob", "segment_label", "segment_name")


@register("risk_score", q("""
SELECT current_account_nbr, anomaly_flag, risk_delinquency, risk_nsf, risk_utilization, risk_anomaly, risk_payment_hist,
  risk_score FROM risk""", "risk"))
def q_risk_score(spark, sf_dir):
    return context(spark, sf_dir).risk.select(ACCT, "anomaly_flag", "risk_delinquency", "risk_nsf", "risk_utilization",
                                              "risk_anomaly", "risk_payment_hist", "risk_score")


@register("rule_adjustment", q("""
SELECT current_account_nbr, segment_label, cu_line_incr_excl_flag, cu_crd_line, cu_cur_balance, adjustment_pct,
  rule_recommended_line, rule_adjustment_delta FROM rule_adj""", "rule_adj"))
def q_rule_adjustment(spark, sf_dir):
    return context(spark, sf_dir).rule_adj.select(
        ACCT, "segment_label", "cu_line_incr_excl_flag", "cu_crd_line", "cu_cur_balance", "adjustment_pct",
        "rule_recommended_line", "rule_adjustment_delta")


@register("final_recommendations", q("""
SELECT current_account_nbr, cu_crd_line, predicted_adjustment_delta, recommended_credit_line, adjustment_delta
FROM final_recs""", "final_recs", **QP))
def q_final_recommendations(spark, sf_dir):
    return context(spark, sf_dir).final_recs.select(
        ACCT, "cu_crd_line", "predicted_adjustment_delta", "recommended_credit_line", "adjustment_delta")


@register("final_projection", q("""
SELECT current_account_nbr, cu_crd_line AS current_credit_line, q4_forecast, segment_name, risk_score, anomaly_flag,
  recommended_credit_line, adjustment_delta FROM final_recs ORDER BY adjustment_delta DESC, current_account_nbr""",
                                "final_recs", **QP))
def q_final_projection(spark, sf_dir):
    return credit.final_projection(context(spark, sf_dir).final_recs)


@register("exclusion_audit", q("""
SELECT COUNT(*) FILTER (WHERE excl) AS excluded_accounts,
  COUNT(*) FILTER (WHERE excl AND rule_adjustment_delta > 0) AS excluded_increased FROM rule_adj""", "rule_adj"))
def q_exclusion_audit(spark, sf_dir):
    return credit.exclusion_audit(context(spark, sf_dir).rule_adj)


def _dec_sum(expr: str) -> str:
    return f"CAST(ROUND(SUM(CAST({expr} AS DECIMAL(20,4))), 2) AS DOUBLE)"


@register("portfolio_impact", q(f"""
SELECT COUNT(*) AS accounts, {_dec_sum('cu_crd_line')} AS current_exposure,
  {_dec_sum('recommended_credit_line')} AS recommended_exposure,
  {_dec_sum('CASE WHEN adjustment_delta > 0 THEN adjustment_delta END')} AS positive_total,
  COUNT(*) FILTER (WHERE adjustment_delta > 0) AS positive_accounts,
  {_dec_sum('CASE WHEN adjustment_delta < 0 THEN adjustment_delta END')} AS negative_total,
  COUNT(*) FILTER (WHERE adjustment_delta < 0) AS negative_accounts,
  COUNT(*) FILTER (WHERE adjustment_delta = 0) AS flat_accounts
FROM final_recs""", "final_recs", **QP))
def q_portfolio_impact(spark, sf_dir):
    return credit.portfolio_impact(context(spark, sf_dir).final_recs)


@register("adjustment_waterfall", q(f"""
SELECT segment_name, {_dec_sum('cu_crd_line')} AS current_total, {_dec_sum('recommended_credit_line')} AS recommended_total,
  {_dec_sum('adjustment_delta')} AS delta_total, COUNT(current_account_nbr) AS account_count
FROM final_recs GROUP BY segment_name""", "final_recs", **QP))
def q_adjustment_waterfall(spark, sf_dir):
    return credit.adjustment_waterfall(context(spark, sf_dir).final_recs)


# ---------------------------------------------------------------------------------------
# 2.3 / 2.4  fraud and anomaly tables
# ---------------------------------------------------------------------------------------

@register("anomaly_features", q("""
SELECT current_account_nbr, CAST(total_spend AS DOUBLE) AS total_spend, txn_count, avg_txn_amt,
  CAST(max_txn_amt AS DOUBLE) AS max_txn_amt, CAST(total_foreign_amt AS DOUBLE) AS total_foreign_amt,
  CAST(total_markup_fees AS DOUBLE) AS total_markup_fees, first_purchase_count FROM anomaly_features""",
                                "anomaly_features"))
def q_anomaly_features(spark, sf_dir):
    return finish(context(spark, sf_dir).anomaly_features)


_TXN_OUT = """t.current_account_nbr, t.transaction_id, t.transaction_date, CAST(t.transaction_amt AS DOUBLE) AS transaction_amt,
  t.transaction_code, t.source_table"""
_CLAIM_ON = """t.current_account_nbr = f.current_account_nbr AND CAST(t.transaction_date AS DATE) = CAST(f.transaction_dt AS DATE)
  AND ABS(t.transaction_amt - f.transaction_am) < 0.01"""


@register("txn_fraud_flag", q(f"""
SELECT {_TXN_OUT}, CASE WHEN f.current_account_nbr IS NOT NULL THEN 1 ELSE 0 END AS is_fraud_txn
FROM transaction_base t LEFT JOIN fraud_claim_tran f ON {_CLAIM_ON}""", "transaction_base", "fraud_claim_tran"))
def q_txn_fraud_flag(spark, sf_dir):
    t = context(spark, sf_dir).t
    df = fraud.txn_fraud_flag(t["transaction_base"], t["fraud_claim_tran"])
    return finish(df.select(ACCT, "transaction_id", "transaction_date", "transaction_amt", "transaction_code",
                            "source_table", "is_fraud_txn"))


@register("txn_fraud_flag_once", q(f"""
SELECT {_TXN_OUT}, CASE WHEN EXISTS (SELECT 1 FROM fraud_claim_tran f WHERE {_CLAIM_ON}) THEN 1 ELSE 0 END AS is_fraud_txn
FROM transaction_base t""", "transaction_base", "fraud_claim_tran"))
def q_txn_fraud_flag_once(spark, sf_dir):
    t = context(spark, sf_dir).t
    df = fraud.txn_fraud_flag_once(t["transaction_base"], t["fraud_claim_tran"])
    return finish(df.select(ACCT, "transaction_id", "transaction_date", "transaction_amt", "transaction_code",
                            "source_table", "is_fraud_txn"))


@register("contamination_rate", q("""
SELECT CAST(SUM(COALESCE(CAST(has_fraud_case AS DOUBLE), 0.0)) AS BIGINT) AS fraud_count, COUNT(*) AS total,
  COALESCE(CASE WHEN COUNT(*) > 0 THEN GREATEST(0.005, LEAST(0.1, SUM(COALESCE(CAST(has_fraud_case AS DOUBLE), 0.0)) / COUNT(*) * 2.0)) END,
    0.02) AS contamination
FROM customer_base""", "customer_base"))
def q_contamination_rate(spark, sf_dir):
    return risk.contamination_rate(context(spark, sf_dir).base)


@register("fraud_confusion", q("""
SELECT tp, fp, fn, tn, ROUND(p, 4) AS precision, ROUND(r, 4) AS recall,
  ROUND(CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END, 4) AS f1
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r
      FROM (SELECT COUNT(*) FILTER (WHERE fl = 1 AND fr = 1) AS tp, COUNT(*) FILTER (WHERE fl = 1 AND fr = 0) AS fp,
                   COUNT(*) FILTER (WHERE fl = 0 AND fr = 1) AS fn, COUNT(*) FILTER (WHERE fl = 0 AND fr = 0) AS tn
            FROM (SELECT s.anomaly_flag AS fl, COALESCE(CAST(b.has_fraud_case AS INTEGER), 0) AS fr
                  FROM standin_flags s LEFT JOIN customer_base b ON s.current_account_nbr = b.current_account_nbr)))
""", "standin_flags", "customer_base"))
def q_fraud_confusion(spark, sf_dir):
    ctx = context(spark, sf_dir)
    return risk.fraud_confusion(ctx.standin_flags, ctx.base)
