"""Composite 0-100 risk score, contamination calibration and detector evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip_scalar, coerce_numeric

ACCT = "current_account_nbr"

# ---------------------------------------------------------------------------------------
# Component weights and normalisers of the risk score.
#   delinquency depth 0.30 (days / 90 * 100), NSF frequency 0.15 (count / 5 * 100),
#   utilisation 0.25 (percent), anomaly flag 0.20 (0 or 100),
#   payment history 0.10 (max level / 7 * 100); every component clipped to 0-100.
# Contamination: 2 x fraud rate, clipped to [0.005, 0.1]; 0.02 without labels.
# ---------------------------------------------------------------------------------------
RISK_WEIGHTS = {
    "delinquency_depth": 0.30,
    "nsf_frequency": 0.15,
    "utilization_level": 0.25,
    "anomaly_flag": 0.20,
    "payment_history": 0.10,
}
CONTAMINATION_MIN, CONTAMINATION_MAX, CONTAMINATION_DEFAULT = 0.005, 0.1, 0.02


def attach_anomaly(df: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Left join of the detector output; a missing flag counts as 0 (score stays null)."""
    if "anomaly_flag" in df.columns:
        return df.withColumn("anomaly_flag", F.coalesce(F.col("anomaly_flag").cast("double"), F.lit(0.0)))
    cols = [c for c in ("anomaly_flag", "anomaly_score") if c in anomaly.columns]
    j = df.join(anomaly.select(ACCT, *cols), ACCT, "left")
    return j.withColumn("anomaly_flag", F.coalesce(F.col("anomaly_flag").cast("double"), F.lit(0.0)))


def risk_components(df: DataFrame) -> DataFrame:
    n = coerce_numeric(df, ["cu_nbr_days_dlq", "ca_nsf_count_lst_12_months", "ca_current_utilz",
                            "max_delinquency_level"])
    zero = F.lit(0.0)
    return df.withColumns({
        "risk_delinquency": clip_scalar(n.get("cu_nbr_days_dlq", zero) / F.lit(90.0) * F.lit(100.0), 0.0, 100.0),
        "risk_nsf": clip_scalar(n.get("ca_nsf_count_lst_12_months", zero) / F.lit(5.0) * F.lit(100.0), 0.0, 100.0),
        "risk_utilization": clip_scalar(n.get("ca_current_utilz", zero), 0.0, 100.0),
        "risk_anomaly": F.col("anomaly_flag").cast("double") * F.lit(100.0),
        "risk_payment_hist": clip_scalar(n.get("max_delinquency_level", zero) / F.lit(7.0) * F.lit(100.0), 0.0, 100.0),
    })


def compute_risk_score(customer: DataFrame, anomaly: DataFrame) -> DataFrame:
    """Weighted sum of the five components, rounded to 2 dp (via DECIMAL), clipped 0-100."""
    df = risk_components(attach_anomaly(customer, anomaly))
    w = RISK_WEIGHTS
    raw = (F.lit(w["delinquency_depth"]) * F.col("risk_delinquency")
           + F.lit(w["nsf_frequency"]) * F.col("risk_nsf")
           + F.lit(w["utilization_level"]) * F.col("risk_utilization")
           + F.lit(w["anomaly_flag"]) * F.col("risk_anomaly")
           + F.lit(w["payment_history"]) * F.col("risk_payment_hist"))
    score = F.round(raw.cast("decimal(18,6)"), 2).cast("double")
    return df.withColumn("risk_score", clip_scalar(score, 0.0, 100.0))


def contamination_rate(customer: DataFrame) -> DataFrame:
    """One row: ``max(.005, min(.1, 2 * fraud / total))`` (0.02 when the table is empty)."""
    agg = customer.agg(F.sum(F.coalesce(F.col("has_fraud_case").cast("double"), F.lit(0.0))).alias("fraud_count"),
                       F.count(F.lit(1)).alias("total"))
    rate = F.when(F.col("total") > 0,
                  F.greatest(F.lit(CONTAMINATION_MIN),
                             F.least(F.lit(CONTAMINATION_MAX), F.col("fraud_count") / F.col("total") * F.lit(2.0))))
    return agg.select(F.col("fraud_count").cast("long").alias("fraud_count"), "total",
                      F.coalesce(rate, F.lit(CONTAMINATION_DEFAULT)).alias("contamination"))


def fraud_confusion(predictions: DataFrame, customer: DataFrame,
                    flag: str = "anomaly_flag") -> DataFrame:
    """TP/FP/FN/TN of a 0/1 flag against ``has_fraud_case``, with precision/recall/F1."""
    j = (predictions.select(ACCT, F.col(flag).cast("int").alias("_flag"))
         .join(customer.select(ACCT, "has_fraud_case"), ACCT, "left")
         .withColumn("_fraud", F.coalesce(F.col("has_fraud_case").cast("int"), F.lit(0))))
    m = j.agg(F.count_if((F.col("_flag") == 1) & (F.col("_fraud") == 1)).alias("tp"),
              F.count_if((F.col("_flag") == 1) & (F.col("_fraud") == 0)).alias("fp"),
              F.count_if((F.col("_flag") == 0) & (F.col("_fraud") == 1)).alias("fn"),
              F.count_if((F.col("_flag") == 0) & (F.col("_fraud") == 0)).alias("tn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    m = m.withColumns({"_p": precision, "_r": recall})
    f1 = F.when(F.col("_p") + F.col("_r") > 0,
                F.lit(2.0) * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))).otherwise(F.lit(0.0))
    return m.select("tp", "fp", "fn", "tn",
                    F.round(F.col("_p"), 4).alias("precision"),
                    F.round(F.col("_r"), 4).alias("recall"),
                    F.round(f1, 4).alias("f1"))


def standin_anomaly_flags(anomaly_features: DataFrame) -> DataFrame:
    """Deterministic 0/1 flag used where an exact oracle is needed instead of the forest:
    accounts whose foreign-currency amount is more than half of their total amount."""
    return anomaly_features.select(
        ACCT,
        F.when(F.col("total_foreign_amt") * 2 > F.col("total_spend"), 1).otherwise(0).alias("anomaly_flag"))
