"""Rule-based account segments, class weights and z-scored features."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import coerce_numeric

# ---------------------------------------------------------------------------------------
# Segment labels and the rule thresholds.
# ---------------------------------------------------------------------------------------
SEGMENTS = {
    0: "Non-Performing",
    1: "No Increase Needed",
    2: "Eligible - With Risk",
    3: "Eligible - No Risk",
}
# Inputs of the rules and features of the classifier.
RULE_INPUTS = [
    "ca_current_utilz", "cu_nbr_days_dlq", "ca_nsf_count_lst_12_months", "has_fraud_case",
    "delinquent_cycle_count", "max_delinquency_level", "sales_trend_slope", "avg_monthly_sales_6m",
    "utilization_ratio", "cu_cur_balance", "ca_mob",
]

CLASSIFICATION_FEATURES = [
    "cu_bhv_scr", "cu_crd_bureau_scr", "ca_current_utilz",
    "ca_avg_utilz_lst_3_mnths", "ca_avg_utilz_lst_6_mnths",
    "cu_nbr_days_dlq", "ca_nsf_count_lst_12_months",
    "ca_mob", "ca_mnths_since_active",
    "avg_monthly_sales_6m", "sales_trend_slope",
    "delinquent_cycle_count", "max_delinquency_level",
    "utilization_ratio", "otb_ratio",
    "cu_crd_line", "cu_cur_balance",
]


def segment_name(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(SEGMENTS.items())])
    return F.try_element_at(mapping, c.cast("int"))


def segment_label_expr() -> F.Column:
    """First matching rule wins (inputs already coerced to numbers, nulls as 0)."""
    c = F.col
    dlq_days, max_lvl, fraud = c("cu_nbr_days_dlq"), c("max_delinquency_level"), c("has_fraud_case")
    cycles, avg_sales, bal, mob = c("delinquent_cycle_count"), c("avg_monthly_sales_6m"), c("cu_cur_balance"), c("ca_mob")
    util, nsf, slope = c("ca_current_utilz"), c("ca_nsf_count_lst_12_months"), c("sales_trend_slope")

    non_performing = ((dlq_days > 60) | (max_lvl >= 4) | (fraud == 1) | (cycles >= 6)
                      | ((avg_sales == 0) & (bal <= 0) & (mob > 6)))
    has_risk = (util > 75) | (nsf >= 2) | (cycles >= 2) | (dlq_days > 15) | (max_lvl >= 2)
    active = (avg_sales > 0) | (slope > 0)
    return (F.when(non_performing, 0)
            .when(has_risk & active, 2)
            .when((slope <= 0) & (util < 50) & (avg_sales > 0), 1)
            .when(~active, 1)
            .when((util <= 75) & (dlq_days == 0) & (nsf == 0) & (cycles <= 1) & active, 3)
            .otherwise(1))


def assign_rule_based_segments(df: DataFrame) -> DataFrame:
    """Coerce the rule inputs (the zero-filled values flow downstream), then label."""
    out = df.withColumns(coerce_numeric(df, RULE_INPUTS))
    missing = [x for x in RULE_INPUTS if x not in out.columns]
    if missing:
        out = out.withColumns({x: F.lit(0.0) for x in missing})
    out = out.withColumn("segment_label", segment_label_expr().cast("int"))
    return out.withColumn("segment_name", segment_name("segment_label"))


def class_weights(df: DataFrame, label: str = "segment_label", weight: str = "class_weight") -> DataFrame:
    """``n / (k * n_c)`` per row (balanced class weights) from two small aggregates."""
    # one row per class: the global window is over the labels
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n_c"))
    everything = Window.partitionBy()
    per = counts.withColumns({"_n": F.sum("_n_c").over(everything),
                              "_k": F.count(F.lit(1)).over(everything)})
    per = per.select(label, (F.col("_n") / (F.col("_k") * F.col("_n_c"))).alias(weight))
    return df.join(per, label, "left")
