"""Model matrices: the quarter-forecast matrix, splits, sequences, z-scores, null policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .monthly import add_lag_features

ACCT = "current_account_nbr"

# The models' feature lists.
STATIC_FEATURES = [
    "cu_bhv_scr", "cu_crd_bureau_scr",
    "ca_current_utilz", "ca_avg_utilz_lst_3_mnths",
    "ca_avg_utilz_lst_6_mnths", "ca_mob", "ca_nsf_count_lst_12_months",
    "ca_mnths_since_active", "cu_nbr_days_dlq",
    "avg_monthly_sales_6m", "sales_trend_slope",
    "delinquent_cycle_count", "max_delinquency_level",
    "utilization_ratio", "otb_ratio", "has_fraud_case",
]

Q4_FEATURES = [
    "spend_lag_1", "spend_lag_2", "spend_lag_3",
    "spend_rolling_mean_3", "spend_rolling_std_3",
    "txn_count", "avg_txn_amt", "max_txn_amt",
    "total_cash_advance", "total_returns",
    "prev_balance", "spend_to_limit_ratio",
    "cu_bhv_scr", "cu_crd_bureau_scr", "cu_crd_line",
    "ca_current_utilz", "ca_avg_utilz_lst_3_mnths",
    "ca_avg_utilz_lst_6_mnths", "ca_mob",
    "ca_nsf_count_lst_12_months", "ca_mnths_since_active",
    "avg_monthly_sales_6m", "sales_trend_slope",
    "delinquent_cycle_count", "max_delinquency_level",
    "utilization_ratio", "otb_ratio", "has_fraud_case",
]
# Features known before the month starts (no same-month transaction columns, no target/line ratio).
CAUSAL_FEATURES = [c for c in Q4_FEATURES if c not in (
    "txn_count", "avg_txn_amt", "max_txn_amt", "total_cash_advance", "total_returns",
    "spend_to_limit_ratio")]

TARGET = "total_spend"


def q4_feature_matrix(cm: DataFrame, customer_base: DataFrame, cutoff_month: str,
                      end_month: str | None = None, feature_set: str = "as_coded", drop_nulls: bool = True):
    """Adds lags/ratio if absent, left-joins the static account features, and returns
    ``(frame_with_split_column, feature_cols, target)``.  ``split`` is 'train' before the
    cutoff and 'test' from it (open-ended unless ``end_month`` is given); rows with a
    null feature or target are dropped on both sides, unless ``drop_nulls`` is off (scoring of
    every account: the fitted pipeline fills nulls with its training means)."""
    if "spend_lag_1" not in cm.columns:
        cm = add_lag_features(cm)
    static = [c for c in STATIC_FEATURES if c in customer_base.columns and c not in cm.columns]
    need_line = "cu_crd_line" not in cm.columns and "cu_crd_line" in customer_base.columns
    # one left join brings the credit line and every static feature: the account base is
    # shuffled once, and the account-month side keeps the partitioning of its lag window
    joined_cols = (["cu_crd_line"] if need_line else []) + static
    if joined_cols:
        cm = cm.join(customer_base.select(ACCT, *joined_cols), ACCT, "left")
    if "spend_to_limit_ratio" not in cm.columns:
        from ..functions.numeric import numeric_or_zero, safe_ratio
        cm = cm.withColumn("spend_to_limit_ratio",
                           safe_ratio(F.col("total_spend").cast("double"), numeric_or_zero("cu_crd_line")))
    wanted = Q4_FEATURES if feature_set == "as_coded" else CAUSAL_FEATURES
    features = [c for c in wanted if c in cm.columns]
    cutoff = F.to_date(F.lit(cutoff_month))
    split = F.when(F.col("month") < cutoff, "train").otherwise("test")
    out = cm.withColumn("split", split)
    if end_month is not None:
        out = out.where(F.col("month") < F.to_date(F.lit(end_month)))
    if drop_nulls:
        out = out.dropna(subset=features + [TARGET])
    return out, features, TARGET


def temporal_split(df: DataFrame, cutoff_month: str, subset, end_month: str | None = None):
    """``(train, test)``: month < cutoff / month >= cutoff (optionally < end), nulls dropped."""
    cutoff = F.to_date(F.lit(cutoff_month))
    clean = df.dropna(subset=list(subset))
    train = clean.where(F.col("month") < cutoff)
    test = clean.where(F.col("month") >= cutoff)
    if end_month is not None:
        test = test.where(F.col("month") < F.to_date(F.lit(end_month)))
    return train, test


def month_in(df: DataFrame, months, col: str = "month") -> DataFrame:
    """Keep rows whose ``yyyy-MM`` is in the list."""
    return df.where(F.date_format(F.col(col), "yyyy-MM").isin(list(months)))


def key_hash(col: str = ACCT, salt: str = ""):
    """The first 32 bits of md5(salt, key)."""
    key = F.col(col).cast("string")
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), key) if salt else key), 1, 8), 16, 10).cast("long")


def positional_tail(df: DataFrame, share: float, order: list[str], name: str = "is_validation") -> DataFrame:
    """Marks the last floor(``share`` x n) rows in the order of ``order``, which identifies a row.

    The rows are dealt into ranges of the order and written; the ranges' counts (a number for each)
    tell which range the cut falls into, and only that range is ranked.  Nulls come first.  An empty
    table stays empty; a tail without rows of a table that has some is refused."""
    ranged = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    counts = {r._range: r.n for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = int(sum(counts.values()) * share)
    if counts and not rest:
        raise ValueError(f"a share of {share} of {sum(counts.values())} rows is no row")
    cut = None
    for cut in sorted(counts, reverse=True):
        if counts[cut] >= rest:
            break
        rest -= counts[cut]
    if cut is None:
        return ranged.withColumn(name, F.lit(False)).drop("_range")
    back = Window.partitionBy("_range").orderBy(*[F.col(c).desc() for c in order])
    inside = (ranged.where(F.col("_range") == cut).withColumn(name, F.row_number().over(back) <= rest))
    outside = ranged.where(F.col("_range") != cut).withColumn(name, F.col("_range") > cut)
    return inside.unionByName(outside).drop("_range")


def exact_split(df: DataFrame, share: float, name: str = "is_test", key: str = ACCT) -> DataFrame:
    """Marks ``share`` of the rows, to the nearest row, in the order of the key's hash.

    Rows are counted by hash prefix (4,096 numbers); only the prefix with the cut is ranked.  Rows
    with a null key are not marked."""
    rows = df.withColumn("_h", key_hash(key)).withColumn("_p", F.floor(F.col("_h") / F.lit(1 << 20)))
    counts = {r._p: r.n for r in rows.where(F.col("_p").isNotNull()).groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest, cut = int(sum(counts.values()) * share + 0.5), -1
    for cut in sorted(counts):
        if counts[cut] >= rest:
            break
        rest -= counts[cut]
    at = F.coalesce(F.col("_p") == F.lit(cut), F.lit(False))
    inside = rows.where(at).withColumn(name, F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)) <= rest)
    outside = rows.where(~at).withColumn(name, F.coalesce(F.col("_p") < F.lit(cut), F.lit(False)))
    return inside.unionByName(outside).drop("_h", "_p")


def stratified_split(df: DataFrame, label: str, share: float, name: str = "is_test", key: str = ACCT) -> DataFrame:
    """Marks ``share`` of each label's rows (to the nearest row), in the order of the key's hash.

    No label is sorted whole: rows are counted by label and hash prefix, the prefix with the cut is
    found from the counts, and only that prefix's rows are ranked.  Keys are unique; rows with a
    null label are not marked."""
    step = 1 << 20  # 4,096 prefixes of the 32 bits
    rows = df.withColumn("_h", key_hash(key)).withColumn("_p", F.floor(F.col("_h") / F.lit(step)))
    counts = rows.groupBy(label, "_p").agg(F.count(F.lit(1)).alias("_c"))
    one = Window.partitionBy(label)
    cut = (counts.withColumns({"_n": F.sum("_c").over(one),
                               "_b": F.coalesce(F.sum("_c").over(one.orderBy("_p").rowsBetween(
                                   Window.unboundedPreceding, -1)), F.lit(0))})
           .withColumn("_want", F.floor(F.col("_n") * F.lit(float(share)) + F.lit(0.5)))
           .where("_b < _want and _want <= _b + _c")
           .select(F.col(label).alias("_l"), F.col("_p").alias("_cut"), (F.col("_want") - F.col("_b")).alias("_rest")))
    rows = rows.join(cut, F.col(label) == F.col("_l"), "left")
    edge = (rows.where("_p = _cut").withColumn("_k", F.row_number().over(Window.partitionBy(label).orderBy("_h", key)))
            .where("_k <= _rest").select(F.col(key).alias("_e")))
    out = rows.join(edge, F.col(key) == F.col("_e"), "left")
    marked = F.coalesce((F.col("_p") < F.col("_cut")) | F.col("_e").isNotNull(), F.lit(False))
    return out.select(*df.columns, marked.alias(name))


def sequence_windows(cm: DataFrame, seq_length: int = 9, horizon: int = 3, min_history: int = 12) -> DataFrame:
    """Long form of the sequence data: the first ``seq_length`` rows of each account with
    at least ``min_history`` rows (spend, prev_balance; nulls -> 0) and the target, the sum
    of spend over the following ``horizon`` rows."""
    w = Window.partitionBy(ACCT).orderBy("month")
    whole = Window.partitionBy(ACCT)
    spend = F.coalesce(F.col("total_spend").cast("double"), F.lit(0.0))
    staged = cm.select(ACCT, "month",
                       spend.alias("total_spend"),
                       F.coalesce(F.col("prev_balance").cast("double"), F.lit(0.0)).alias("prev_balance"),
                       F.row_number().over(w).alias("step"),
                       F.count(F.lit(1)).over(whole).alias("_n"))
    need = max(min_history, seq_length + horizon)
    tgt = F.sum(F.when((F.col("step") > seq_length) & (F.col("step") <= seq_length + horizon),
                       F.col("total_spend").cast("decimal(28,2)"))).over(whole)
    staged = staged.where(F.col("_n") >= need).withColumn("target", tgt.cast("double"))
    return staged.where(F.col("step") <= seq_length).drop("_n")


def sequence_vectors(seq_long: DataFrame, seq_length: int = 9) -> DataFrame:
    """One row per account: ``features`` = [spend_1..spend_9, balance_1..balance_9]."""
    from pyspark.ml.functions import array_to_vector
    rows = (seq_long.groupBy(ACCT, "target")
            .agg(F.array_sort(F.collect_list(F.struct("step", "total_spend", "prev_balance"))).alias("s")))
    feats = F.concat(F.transform("s", lambda x: x["total_spend"]), F.transform("s", lambda x: x["prev_balance"]))
    return rows.select(ACCT, "target", array_to_vector(feats).alias("features"))


def zscore(df: DataFrame, cols, keep=(ACCT,)) -> DataFrame:
    """Standardise with population std (constant column -> scale 1), nulls as 0 first.

    The per-column mean/std is a fixed-size summary (two numbers per column), computed in
    one aggregate and applied as literals, as a fitted scaler would."""
    cols = list(cols)
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    stats = filled.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                       *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    out = []
    for i, c in enumerate(cols):
        m = stats[f"m_{i}"] or 0.0
        s = stats[f"s_{i}"] or 0.0
        scale = s if s > 0 else 1.0
        out.append(((F.col(c) - F.lit(m)) / F.lit(scale)).alias(c))
    return filled.select(*keep, *out)


def present(cols, df: DataFrame):
    return [c for c in cols if c in df.columns]


def drop_null_features(df: DataFrame, cols) -> DataFrame:
    """Training policy: keep listed features that exist, drop rows with a null among them."""
    return df.dropna(subset=present(cols, df))


def zero_fill_features(df: DataFrame, cols) -> DataFrame:
    """Scoring policy: keep listed features that exist, nulls become 0."""
    return df.fillna(0, subset=present(cols, df))
