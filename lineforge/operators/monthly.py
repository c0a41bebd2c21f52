"""Account x month feature table: monthly aggregates, full join, lags and rolling stats.

Plan shape at scale: transactions beyond a task's size are dealt by account and month, so
a hot account is spread over its months; below that, as for statements, partial (map-side)
aggregation collapses it to one row per (account, month, map task) before any exchange.  The full
outer join reuses the (account, month) partitioning of the two aggregates, and the lag/rolling window partitions by account only, over at most
one row per month of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_ratio, numeric_or_zero
from ..session import dealt, dealt_into, parts_of

ACCT = "current_account_nbr"

# ---------------------------------------------------------------------------------------
# Transaction codes.
# ---------------------------------------------------------------------------------------
PURCHASE_CODES = ("253", "259")
CASH_ADVANCE_CODE = "254"
RETURN_CODE = "255"
DOMESTIC_CURRENCY = "840"

TXN_ROWS = 1 << 20  # transactions of a task
LAG_ROWS = 1 << 20  # account-months of a task that sorts them by account


def _month(col: str):
    return F.trunc(F.col(col).cast("date"), "month")


def txn_monthly_aggs() -> list:
    """Aggregate expressions of the account-month transaction summary (shared by the
    batch operator and the streaming form)."""
    amt = F.col("transaction_amt")
    code = F.col("transaction_code").cast("string")
    cur = F.col("frgn_curr_code").cast("string")
    zero = F.lit(0).cast("decimal(18,2)")
    return [F.sum(F.when(code.isin(*PURCHASE_CODES), amt).otherwise(zero)).alias("total_spend"),
            F.count(F.lit(1)).alias("txn_count"),
            F.sum(amt).alias("_sum_amt"),
            F.count(amt).alias("_n_amt"),
            F.max(amt).alias("max_txn_amt"),
            F.sum(F.when(code == CASH_ADVANCE_CODE, amt).otherwise(zero)).alias("total_cash_advance"),
            F.sum(F.when(code == RETURN_CODE, amt).otherwise(zero)).alias("total_returns"),
            F.sum("curr_markup_fee").alias("total_markup_fees"),
            F.sum(F.when((cur != DOMESTIC_CURRENCY) & (cur != ""), amt).otherwise(zero)).alias("total_foreign_txn_amt"),
            F.sum(F.when(F.col("first_purchase_ind") == "Y", 1).otherwise(0)).cast("long").alias("first_purchase_count")]


def finish_txn_monthly(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_txn_amt", F.col("_sum_amt").cast("double") / F.col("_n_amt")).drop("_sum_amt", "_n_amt")


def txn_monthly(transaction_base: DataFrame, parts: int | None = None) -> DataFrame:
    """Per account and month: spend, counts, cash advances, returns, fees, foreign amount.

    A scan task's rows have almost as many accounts and months as rows, so a table over ``TXN_ROWS`` is
    dealt by both first: a task's groups are bounded, are not spilled, and travel once."""
    if parts is None:
        parts = parts_of(transaction_base, TXN_ROWS)
    g = (dealt_into(transaction_base.withColumn("txn_month", _month("transaction_date")), parts, ACCT, "txn_month")
         .where(F.col("transaction_date").isNotNull())
         .groupBy(ACCT, "txn_month")
         .agg(*txn_monthly_aggs()))
    return finish_txn_monthly(g)


def stmt_monthly(statement_fact: DataFrame, parts: int = 1) -> DataFrame:
    """Per account and month: max of balance and the three return-check counts."""
    return (dealt_into(statement_fact.withColumn("stmt_month", _month("billing_cycle_date")), parts, ACCT, "stmt_month")
            .where(F.col("billing_cycle_date").isNotNull())
            .groupBy(ACCT, "stmt_month")
            .agg(F.max("prev_balance").alias("prev_balance"),
                 F.max("return_check_cnt_total").alias("return_check_cnt_total"),
                 F.max("return_check_cnt_ytd").alias("return_check_cnt_ytd"),
                 F.max("return_check_cnt_last_mth").alias("return_check_cnt_last_mth")))


MONTHLY_COLUMNS = [
    ACCT, "month", "total_spend", "txn_count", "avg_txn_amt", "max_txn_amt",
    "total_cash_advance", "total_returns", "total_markup_fees", "total_foreign_txn_amt",
    "first_purchase_count", "prev_balance", "return_check_cnt_total", "return_check_cnt_ytd",
    "return_check_cnt_last_mth",
]


def customer_monthly(transaction_base: DataFrame, statement_fact: DataFrame) -> DataFrame:
    """Transactions by month full-outer-joined with statements by month.

    Beyond a task's size both are dealt alike before they are grouped, and joined as they lie: a task's
    groups and sorts are bounded however few parts shuffles have."""
    parts = max(parts_of(df, TXN_ROWS) for df in (transaction_base, statement_fact))
    t = txn_monthly(transaction_base, parts).alias("t")
    s = stmt_monthly(statement_fact, parts).alias("s")
    j = t.join(s, (F.col(f"t.{ACCT}") == F.col(f"s.{ACCT}"))
               & (F.col("t.txn_month") == F.col("s.stmt_month")), "full")
    zero = F.lit(0)
    return j.select(
        F.coalesce(F.col(f"t.{ACCT}"), F.col(f"s.{ACCT}")).alias(ACCT),
        F.coalesce(F.col("t.txn_month"), F.col("s.stmt_month")).alias("month"),
        F.coalesce(F.col("t.total_spend"), zero.cast("decimal(28,2)")).alias("total_spend"),
        F.coalesce(F.col("t.txn_count"), zero.cast("long")).alias("txn_count"),
        F.col("t.avg_txn_amt").alias("avg_txn_amt"),
        F.col("t.max_txn_amt").alias("max_txn_amt"),
        F.coalesce(F.col("t.total_cash_advance"), zero.cast("decimal(28,2)")).alias("total_cash_advance"),
        F.coalesce(F.col("t.total_returns"), zero.cast("decimal(28,2)")).alias("total_returns"),
        F.coalesce(F.col("t.total_markup_fees"), zero.cast("decimal(28,2)")).alias("total_markup_fees"),
        F.coalesce(F.col("t.total_foreign_txn_amt"), zero.cast("decimal(28,2)")).alias("total_foreign_txn_amt"),
        F.coalesce(F.col("t.first_purchase_count"), zero.cast("long")).alias("first_purchase_count"),
        F.col("s.prev_balance"), F.col("s.return_check_cnt_total"),
        F.col("s.return_check_cnt_ytd"), F.col("s.return_check_cnt_last_mth"))


def add_lag_features(cm: DataFrame, value: str = "total_spend") -> DataFrame:
    """Lags 1-3 (by row, not calendar) and mean/sample-std of the previous <= 3 rows.

    Tasks are made of a bounded number of rows before they sort them by account."""
    cm = dealt(cm, LAG_ROWS, ACCT)
    w = Window.partitionBy(ACCT).orderBy("month")
    prev3 = w.rowsBetween(-3, -1)
    v = F.col(value)
    vd = v.cast("double")
    n = F.count(v).over(prev3)
    return cm.withColumns({
        "spend_lag_1": F.lag(v, 1).over(w),
        "spend_lag_2": F.lag(v, 2).over(w),
        "spend_lag_3": F.lag(v, 3).over(w),
        "spend_rolling_mean_3": F.sum(v).over(prev3).cast("double") / n,
        "spend_rolling_std_3": F.coalesce(F.round(F.stddev_samp(vd).over(prev3), 4), F.lit(0.0)),
    })


def add_spend_to_limit_ratio(cm: DataFrame, customer_base: DataFrame) -> DataFrame:
    """Left join of the account credit line and ``spend / max(line, 1)`` (0 when no line)."""
    lines = customer_base.select(ACCT, "cu_crd_line")
    j = cm.join(lines, ACCT, "left")
    line = numeric_or_zero("cu_crd_line")
    return j.withColumn("spend_to_limit_ratio", safe_ratio(F.col("total_spend").cast("double"), line))
