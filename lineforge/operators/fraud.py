"""Transaction fraud flags and the per-account behaviour table of the anomaly detector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCT = "current_account_nbr"
AMOUNT_TOLERANCE = 0.01  # fixed value: claim amount matches within one cent (strict <)



def cent_bin(amount):
    """Number of the tolerance-wide bin that a (decimal) amount lies in."""
    return F.floor(amount.cast("decimal(28,6)") / F.lit(AMOUNT_TOLERANCE).cast("decimal(3,2)")).cast("long")


def _claims(fraud_claim_tran: DataFrame) -> DataFrame:
    """The claims, each sent to its own bin of amounts and to the two beside it."""
    own = fraud_claim_tran.select(F.col(ACCT).alias("_f_acct"), F.col("transaction_dt").cast("date").alias("_f_dt"),
                                  F.col("transaction_am").alias("_f_am"), cent_bin(F.col("transaction_am")).alias("_own"))
    return own.withColumn("_f_bin", F.explode(F.sequence(F.col("_own") - 1, F.col("_own") + 1)))


def _keys(t: DataFrame, f: DataFrame):
    return ((t[ACCT] == f["_f_acct"]) & (t["transaction_date"].cast("date") == f["_f_dt"])
            & (cent_bin(t["transaction_amt"]) == f["_f_bin"]))


def txn_fraud_flag(transaction_base: DataFrame, fraud_claim_tran: DataFrame) -> DataFrame:
    """Left join with the claims; as coded, a transaction matching two claims appears twice.

    Account, day and bin of the amount are the join's keys, so a day with many transactions is not
    held against all its claims; the exact band is left for the three bins.  One plan at every size:
    AQE broadcasts the claims if they measure small, and splits a hot key of the sorted sides."""
    t, f = transaction_base, _claims(fraud_claim_tran)
    j = t.join(f, _keys(t, f) & (F.abs(t["transaction_amt"] - f["_f_am"]) < F.lit(AMOUNT_TOLERANCE)), "left")
    return j.select(*[t[c] for c in t.columns], F.when(f["_f_acct"].isNotNull(), 1).otherwise(0).alias("is_fraud_txn"))


def txn_fraud_flag_once(transaction_base: DataFrame, fraud_claim_tran: DataFrame) -> DataFrame:
    """Same flag with exactly one row per transaction.

    A bin is as wide as the tolerance, so all that a transaction must know of the claims is one row
    for its (account, day, bin): whether there is a claim in the bin itself, the highest amount in
    the bin below, the lowest in the bin above.  The join has that row or none: no fan-out, and as a
    left join with plain keys AQE splits a hot one."""
    t = transaction_base
    claims = _claims(fraud_claim_tran)
    f = claims.groupBy("_f_acct", "_f_dt", "_f_bin").agg(
        F.count_if(F.col("_own") == F.col("_f_bin")).alias("_same"),
        F.max(F.when(F.col("_own") < F.col("_f_bin"), F.col("_f_am"))).alias("_below"),
        F.min(F.when(F.col("_own") > F.col("_f_bin"), F.col("_f_am"))).alias("_above"))
    j = t.join(f, _keys(t, f), "left")
    near = ((F.col("_same") > 0) | (t["transaction_amt"] - F.col("_below") < F.lit(AMOUNT_TOLERANCE))
            | (F.col("_above") - t["transaction_amt"] < F.lit(AMOUNT_TOLERANCE)))
    return j.select(*[t[c] for c in t.columns], F.when(near, 1).otherwise(0).alias("is_fraud_txn"))


def anomaly_features(transaction_base: DataFrame) -> DataFrame:
    """Per account over all transactions (all codes, null dates included)."""
    amt = F.col("transaction_amt")
    cur = F.col("frgn_curr_code").cast("string")
    zero = F.lit(0).cast("decimal(18,2)")
    return (transaction_base.groupBy(ACCT)
            .agg(F.sum(amt).alias("total_spend"),
                 F.count(F.lit(1)).alias("txn_count"),
                 F.count(amt).alias("_n_amt"),
                 F.max(amt).alias("max_txn_amt"),
                 F.sum(F.when((cur != "840") & (cur != ""), amt).otherwise(zero)).alias("total_foreign_amt"),
                 F.sum("curr_markup_fee").alias("total_markup_fees"),
                 F.sum(F.when(F.col("first_purchase_ind") == "Y", 1).otherwise(0)).cast("long").alias("first_purchase_count"))
            .withColumn("avg_txn_amt", F.col("total_spend").cast("double") / F.col("_n_amt"))
            .select(ACCT, "total_spend", "txn_count", "avg_txn_amt", "max_txn_amt",
                    "total_foreign_amt", "total_markup_fees", "first_purchase_count"))
