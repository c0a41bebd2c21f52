"""One row per account: latest risk snapshot, fraud accounts and the joined account base.

All four inputs are keyed by account, so the three left joins share one hash
partitioning of the account key; small sides (fraud accounts) are broadcast by AQE only
when their measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import coerce_numeric, safe_ratio
from ..functions.payment import payment_history_columns
from ..functions.status import impute_sentinel
from ..session import dealt

ACCT = "current_account_nbr"

# Snapshot columns carried into the account base, in output order.
SNAPSHOT_COLUMNS = [
    "cu_bhv_scr", "ca_cash_bal_pct_crd_line", "ca_cash_bal_pct_cash_line", "cu_nbr_days_dlq",
    "cu_nbr_of_plastics", "ca_avg_utilz_lst_6_mnths", "cu_cash_line_am", "cu_crd_bureau_scr",
    "cu_crd_line", "cu_cur_balance", "cu_cur_nbr_due", "ca_current_utilz", "cu_line_incr_excl_flag",
    "ca_max_dlq_lst_6_mnths", "ca_mnths_since_active", "ca_mnths_since_cl_chng", "ca_mob",
    "ca_nsf_count_lst_12_months", "cu_otb", "rb_new_bhv_scr", "rb_crd_gr_new_crd_gr",
    "cu_processing_date", "mo_tot_sales_array_1", "mo_tot_sales_array_2", "mo_tot_sales_array_3",
    "mo_tot_sales_array_4", "mo_tot_sales_array_5", "mo_tot_sales_array_6", "ca_avg_utilz_lst_3_mnths",
]
SALES_COLUMNS = [f"mo_tot_sales_array_{i}" for i in range(1, 7)]

SNAPSHOT_ROWS = 1 << 18  # of a task: some 100 MB with all columns

# Deterministic order among snapshots of the same date.
SNAPSHOT_TIE_BREAK = ["cu_crd_line", "cu_cur_balance", "cu_otb"]


def latest_snapshot(rams: DataFrame, key: str = "cu_account_nbr",
                    date_col: str = "cu_processing_date") -> DataFrame:
    """Newest snapshot row per account (row_number = 1; planned as a WindowGroupLimit).

    The limit sorts each task's rows before they are dealt by account, so the tasks are made of a
    bounded number of rows first, whatever a file holds; by account and date, which also spreads
    an account with many snapshots."""
    rams = dealt(rams, SNAPSHOT_ROWS, key, date_col)
    order = [F.col(date_col).desc()] + [F.col(c).desc() for c in SNAPSHOT_TIE_BREAK if c in rams.columns]
    w = Window.partitionBy(key).orderBy(*order)
    return rams.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).drop("rn")


def fraud_accounts(fraud_claim_case: DataFrame) -> DataFrame:
    """Accounts with a fraud case: flag 1 and the largest gross fraud amount."""
    return (fraud_claim_case.groupBy(ACCT)
            .agg(F.max("gross_fraud_amt").alias("max_fraud_amt"))
            .select(ACCT, F.lit(1).alias("has_fraud_case"), "max_fraud_amt"))


def customer_base(account_dim: DataFrame, syf_id: DataFrame, rams: DataFrame,
                  fraud_claim_case: DataFrame) -> DataFrame:
    """Account dimension left-joined with id score, latest snapshot and fraud accounts,
    plus payment-history, sales-trend and ratio features and the activation sentinel."""
    a = account_dim.alias("a")
    s = syf_id.select(F.col("account_nbr_pty"), F.col("confidence_level")).alias("s")
    r = latest_snapshot(rams).select("cu_account_nbr", *SNAPSHOT_COLUMNS).alias("r")
    f = fraud_accounts(fraud_claim_case).alias("f")
    j = (a.join(s, F.col(f"a.{ACCT}") == F.col("s.account_nbr_pty"), "left")
          .join(r, F.col(f"a.{ACCT}") == F.col("r.cu_account_nbr"), "left")
          .join(f, F.col(f"a.{ACCT}") == F.col(f"f.{ACCT}"), "left"))
    base = j.select("a.*", "s.confidence_level", *[F.col(f"r.{c}") for c in SNAPSHOT_COLUMNS],
                    F.coalesce(F.col("f.has_fraud_case"), F.lit(0)).alias("has_fraud_case"),
                    F.col("f.max_fraud_amt"))
    base = base.withColumns(payment_history_columns("payment_hist_1_12_mths"))
    base = base.withColumns(coerce_numeric(base, SALES_COLUMNS))
    s_ = [F.col(c) for c in SALES_COLUMNS]
    base = base.withColumns({
        "avg_monthly_sales_6m": (s_[0] + s_[1] + s_[2] + s_[3] + s_[4] + s_[5]) / F.lit(6.0),
        "sales_trend_slope": (s_[0] - s_[5]) / F.lit(6.0),
    })
    base = base.withColumns(coerce_numeric(base, ["cu_crd_line", "cu_cur_balance", "cu_otb"]))
    base = base.withColumns({
        "utilization_ratio": safe_ratio("cu_cur_balance", "cu_crd_line"),
        "otb_ratio": safe_ratio("cu_otb", "cu_crd_line"),
    })
    return impute_sentinel(base, "card_activation_date", "NEVER_ACTIVATED")


def assert_one_row_per_account(df: DataFrame, key: str = ACCT) -> DataFrame:
    """Rows whose key occurs more than once (empty when the grain holds)."""
    return df.groupBy(key).count().where(F.col("count") > 1)
