"""Hand-made edge frames: each checks one semantic corner of an operator."""
import math

import pytest
from pyspark.sql import functions as F

from lineforge.functions import payment
from lineforge.functions.numeric import clip_columns, excluded_flag, safe_ratio, to_numeric_zero
from lineforge.operators import accounts, credit, monthly, segments
from lineforge.plans import reports as R
from lineforge.sources import ingest

TXN_SCHEMA = ("current_account_nbr string, transaction_id long, transaction_date date, transaction_amt decimal(18,2), "
              "transaction_code string, curr_markup_fee decimal(18,2), frgn_curr_code string, first_purchase_ind string")
STMT_SCHEMA = ("current_account_nbr string, billing_cycle_date date, prev_balance decimal(18,2), "
               "return_check_cnt_total long, return_check_cnt_ytd long, return_check_cnt_last_mth int")


def test_snapshot_tie_break_is_deterministic(spark):
    rams = spark.createDataFrame(
        [("A1", "2000-12-31", 500.0, 10.0, 490.0), ("A1", "2000-12-31", 800.0, 10.0, 790.0),
         ("A1", "2000-11-30", 900.0, 10.0, 890.0), ("A2", "2000-10-01", 100.0, 0.0, 100.0)],
        "cu_account_nbr string, cu_processing_date string, cu_crd_line double, cu_cur_balance double, cu_otb double",
    ).withColumn("cu_processing_date", F.to_date("cu_processing_date"))
    got = {r.cu_account_nbr: r.cu_crd_line for r in accounts.latest_snapshot(rams).collect()}
    assert got == {"A1": 800.0, "A2": 100.0}


def test_snapshots_are_dealt_before_they_are_sorted(spark, monkeypatch):
    rows = [(f"A{i % 40}" if i % 7 else None, i // 40, float(i % 9)) for i in range(400)]
    rams = spark.createDataFrame(rows, "cu_account_nbr string, cu_processing_date int, cu_crd_line double").coalesce(1)
    want = sorted(map(str, accounts.latest_snapshot(rams).collect()))
    monkeypatch.setattr(accounts, "SNAPSHOT_ROWS", 50)
    few = accounts.latest_snapshot(rams)
    assert sorted(map(str, few.collect())) == want and len(want) == 41
    # a file read by one task: its rows are not sorted there, but in eight parts
    text = few._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in text and "hashpartitioning(cu_account_nbr" in text and ", 8)" in text


def test_full_join_null_account_and_month_gap(spark):
    txn = spark.createDataFrame(
        [("A1", 1, "2000-01-05", "10.00", "253", None, "840", "Y"),
         ("A1", 2, "2000-03-07", "20.00", "259", "1.00", "", "N"),
         (None, 3, "2000-01-09", "5.00", "253", None, None, "N"),
         ("A1", 4, None, "99.00", "253", None, None, "N")],
        "current_account_nbr string, transaction_id long, transaction_date string, transaction_amt string, "
        "transaction_code string, curr_markup_fee string, frgn_curr_code string, first_purchase_ind string")
    txn = txn.select("current_account_nbr", "transaction_id", F.to_date("transaction_date").alias("transaction_date"),
                     F.col("transaction_amt").cast("decimal(18,2)").alias("transaction_amt"), "transaction_code",
                     F.col("curr_markup_fee").cast("decimal(18,2)").alias("curr_markup_fee"), "frgn_curr_code",
                     "first_purchase_ind")
    stmt = spark.createDataFrame(
        [("A1", "2000-02-28", "50.00", 1, 0, 0), (None, "2000-01-31", "7.00", 0, 0, 0)],
        "current_account_nbr string, billing_cycle_date string, prev_balance string, return_check_cnt_total long, "
        "return_check_cnt_ytd long, return_check_cnt_last_mth int")
    stmt = stmt.select("current_account_nbr", F.to_date("billing_cycle_date").alias("billing_cycle_date"),
                       F.col("prev_balance").cast("decimal(18,2)").alias("prev_balance"), "return_check_cnt_total",
                       "return_check_cnt_ytd", "return_check_cnt_last_mth")
    cm = monthly.add_lag_features(monthly.customer_monthly(txn, stmt))
    rows = cm.orderBy(F.col("current_account_nbr").asc_nulls_first(), "month").collect()
    # null accounts never match in the full join: one row from each side
    assert sum(1 for r in rows if r.current_account_nbr is None) == 2
    a1 = [r for r in rows if r.current_account_nbr == "A1"]
    assert [str(r.month) for r in a1] == ["2000-01-01", "2000-02-01", "2000-03-01"]
    # the null-dated transaction is excluded; statement-only month has zero spend
    assert [float(r.total_spend) for r in a1] == [10.0, 0.0, 20.0]
    # lags go by row: March's lag_2 is January even though February had no transactions
    assert float(a1[2].spend_lag_2) == 10.0
    assert a1[0].spend_lag_1 is None and a1[0].spend_rolling_std_3 == 0.0
    assert a1[1].spend_rolling_std_3 == 0.0  # a single previous value has no sample std
    assert math.isclose(a1[2].spend_rolling_mean_3, 5.0)
    # foreign amount: '' and '840' are domestic
    assert float(a1[1].total_foreign_txn_amt) == 0.0


@pytest.mark.parametrize("hist,expected", [
    ("", (0, 0, 0)), (None, (0, 0, 0)), ("aibjck", (4, 2, 2)), ("ABCDEFGHIJ", (8, 7, 4)),
    ("#%+-ZQ0000AI", (0, 0, 0)), ("LU", (2, 4, 2)), ("p7H", (3, 7, 0)), ("1234567", (7, 7, 0)),
])
def test_payment_history(spark, hist, expected):
    df = spark.createDataFrame([(hist,)], "h string")
    r = df.select(payment.delinquent_cycle_count("h").alias("a"), payment.max_delinquency_level("h").alias("b"),
                  payment.risk_flag_count("h").alias("c")).first()
    assert (r.a, r.b, r.c) == expected


@pytest.mark.parametrize("text,expected", [
    ("1d", 0.0), (" 12 ", 12.0), ("1_000", 0.0), ("inf", math.inf), ("-Infinity", -math.inf), ("INF", math.inf),
    (" inf ", 0.0), ("infin", 0.0), ("0x10", 0.0), ("", 0.0), (None, 0.0), ("-3.5", -3.5), ("1e3", 1000.0),
    ("5.", 5.0), (".5", 0.5), ("NaN", 0.0),
])
def test_to_numeric_zero(spark, text, expected):
    r = spark.createDataFrame([(text,)], "x string").select(to_numeric_zero("x").alias("v")).first()
    assert r.v == expected


def test_clip_with_crossed_bounds(spark):
    df = spark.createDataFrame([(5.0, 10.0, 7.0), (8.0, 10.0, 7.0), (12.0, 1.0, 7.0), (3.0, None, 2.0)],
                               "x double, lo double, hi double")
    got = [r.c for r in df.select(clip_columns("x", "lo", "hi").alias("c")).collect()]
    assert got == [10.0, 7.0, 7.0, 2.0]


def test_safe_ratio_and_exclusion_flag(spark):
    df = spark.createDataFrame([(5.0, 0.0, "Y"), (5.0, 0.5, "y"), (5.0, 10.0, " Y"), (5.0, -1.0, None)],
                               "x double, d double, f string")
    got = df.select(safe_ratio("x", "d").alias("r"), excluded_flag("f").alias("e")).collect()
    assert [r.r for r in got] == [0.0, 5.0, 0.5, 0.0]
    assert [r.e for r in got] == [True, True, False, False]


def _adj_frame(spark, rows):
    return spark.createDataFrame(rows, "current_account_nbr string, segment_label int, cu_crd_line double, "
                                       "cu_cur_balance double, cu_line_incr_excl_flag string")


def test_rule_adjustment_corners(spark):
    rows = [("zero", 3, 0.0, 50.0, "N"),          # zero line stays 0
            ("floor", 3, 1000.0, 2000.0, "N"),    # floor 2200 above cap 1500 -> 2200
            ("excl", 3, 1000.0, 100.0, "Y"),      # excluded: no increase
            ("excl_floor", 0, 1000.0, 2000.0, "y"),  # floor lifts, exclusion caps at line
            ("neg", 0, 1000.0, -50.0, None),       # -5 %
            ("half", 2, 0.5, 0.0, "N")]
    out = {r.current_account_nbr: r for r in credit.apply_rule_based_adjustment(_adj_frame(spark, rows)).collect()}
    assert out["zero"].rule_recommended_line == 0.0
    assert math.isclose(out["floor"].rule_recommended_line, 2200.0)
    assert out["excl"].rule_recommended_line == 1000.0 and out["excl"].rule_adjustment_delta == 0.0
    assert out["excl_floor"].rule_recommended_line == 1000.0
    assert math.isclose(out["neg"].rule_recommended_line, 950.0)
    assert math.isclose(out["half"].rule_recommended_line, 0.55)
    audit = credit.exclusion_audit(credit.apply_rule_based_adjustment(_adj_frame(spark, rows))).first()
    assert audit.excluded_accounts == 2 and audit.excluded_increased == 0


def test_final_recommendations_blocks_excluded_increase(spark):
    df = _adj_frame(spark, [("e", 3, 1000.0, 0.0, "Y"), ("n", 3, 1000.0, 0.0, "N"), ("z", 3, 0.0, 0.0, "N")]) \
        .withColumn("predicted_adjustment_delta", F.lit(900.0))
    out = {r.current_account_nbr: r for r in credit.final_recommendations(df).collect()}
    assert out["e"].recommended_credit_line == 1000.0 and out["e"].predicted_adjustment_delta == 0.0
    assert out["n"].recommended_credit_line == 1500.0  # capped at 1.5 x line
    assert out["z"].adjustment_delta == 0.0


def test_segment_rules_order(spark):
    base = {c: 0.0 for c in segments.RULE_INPUTS}
    cases = {
        "fraud": dict(base, has_fraud_case=1.0, avg_monthly_sales_6m=10.0),
        "inactive": dict(base, ca_mob=12.0),
        "risky_active": dict(base, ca_current_utilz=80.0, avg_monthly_sales_6m=5.0),
        "stable": dict(base, ca_current_utilz=30.0, avg_monthly_sales_6m=5.0, sales_trend_slope=-1.0),
        "dormant": dict(base, cu_cur_balance=10.0),
        "growing": dict(base, ca_current_utilz=60.0, avg_monthly_sales_6m=5.0, sales_trend_slope=1.0),
    }
    cols = ["current_account_nbr"] + segments.RULE_INPUTS
    df = spark.createDataFrame([tuple([k] + [v[c] for c in segments.RULE_INPUTS]) for k, v in cases.items()],
                               ", ".join(f"{c} {'string' if c == 'current_account_nbr' else 'double'}" for c in cols))
    got = {r.current_account_nbr: r.segment_label for r in segments.assign_rule_based_segments(df).collect()}
    assert got == {"fraud": 0, "inactive": 0, "risky_active": 2, "stable": 1, "dormant": 1, "growing": 3}


def test_correlation_constant_column_and_missing_share(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, 5.0, None if i < 7 else 1.0, None if i < 8 else 1.0)
                                for i in range(10)], "a double, b double, c double, m70 double, m80 double")
    pairs = {(r.col_a, r.col_b): r.abs_corr for r in R.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert pairs[("a", "b")] == 1.0 and pairs[("a", "c")] is None
    drops = {r.column_name: r.dropped for r in R.correlated_drops(df, ["a", "b", "c"]).collect()}
    assert drops == {"a": True, "b": False, "c": False}
    kept, verdicts = R.drop_high_missing(df, 0.70)
    v = {r.column_name: r.dropped for r in verdicts.collect()}
    assert v["m70"] is False and v["m80"] is True
    assert "m80" not in kept.columns and "m70" in kept.columns


def test_csv_ingest_splits_corrupt_rows(spark, tmp_path):
    p = tmp_path / "acct.csv"
    p.write_text("id,amount,day\nA1,10.5,2000-01-01\nA2,notanumber,2000-01-02\nA3,3.0\nA4,4.0,2000-01-04,extra\n"
                 "A5,5.0,2000-01-05\n")
    from pyspark.sql.types import _parse_datatype_string
    good, bad = ingest.read_csv_table(spark, str(p), _parse_datatype_string("id string, amount double, day date"))
    assert sorted(r.id for r in good.collect()) == ["A1", "A5"]
    assert good.select("id").count() == 2  # stable under column pruning
    assert bad.count() == 3


def test_union_refuses_mismatched_types(spark):
    a = spark.createDataFrame([("x", 1)], "a string, b int")
    b = spark.createDataFrame([("x", "1")], "a string, b string")
    with pytest.raises(ValueError):
        ingest.union_transactions(a, b)
    u = ingest.union_transactions(a, a)
    assert sorted(r.source_table for r in u.collect()) == ["transaction_fact", "wrld_stor_tran_fact"]


def test_round_dp_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.125,)], "x double")
    got = [r.v for r in df.select(R.round_dp("x", 2).alias("v")).collect()]
    assert got == [1.0, 2.5, -2.5, 0.13]  # 1.005 is 1.00499.. in binary


def test_duplicate_claims_fan_out_and_once(spark):
    from lineforge.operators import fraud
    txn = spark.createDataFrame(
        [("A1", 1, "2000-01-05", "10.00"), ("A1", 2, "2000-01-05", "20.00"), ("A2", 3, "2000-01-06", "10.00")],
        "current_account_nbr string, transaction_id long, d string, a string")
    txn = txn.select("current_account_nbr", "transaction_id", F.to_date("d").alias("transaction_date"),
                     F.col("a").cast("decimal(18,2)").alias("transaction_amt"))
    claims = spark.createDataFrame(
        [("A1", "2000-01-05", 10.004), ("A1", "2000-01-05", 10.0), ("A1", "2000-01-05", 20.02), ("A2", "2000-01-07", 10.0)],
        "current_account_nbr string, d string, transaction_am double"
    ).select("current_account_nbr", F.to_date("d").alias("transaction_dt"), "transaction_am")
    fanned = fraud.txn_fraud_flag(txn, claims).collect()
    # transaction 1 matches two claims (0.004 off and exact) and appears twice, as coded
    assert sorted((r.transaction_id, r.is_fraud_txn) for r in fanned) == [(1, 1), (1, 1), (2, 0), (3, 0)]
    once = fraud.txn_fraud_flag_once(txn, claims).collect()
    assert sorted((r.transaction_id, r.is_fraud_txn) for r in once) == [(1, 1), (2, 0), (3, 0)]


def test_single_month_account_has_null_lags_and_zero_std(spark):
    cm = spark.createDataFrame([("A9", "2000-05-01", "12.50")], "current_account_nbr string, m string, s string") \
        .select("current_account_nbr", F.to_date("m").alias("month"), F.col("s").cast("decimal(28,2)").alias("total_spend"))
    r = monthly.add_lag_features(cm).first()
    assert r.spend_lag_1 is None and r.spend_lag_3 is None
    assert r.spend_rolling_mean_3 is None and r.spend_rolling_std_3 == 0.0


def test_claim_flags_agree_with_each_other_and_with_a_hot_account(spark):
    from lineforge.operators import fraud
    from lineforge.sources.fixtures import input_tables
    t = input_tables(spark, "/root/testdata/sf0.001")
    hot = lambda df: df.withColumn("current_account_nbr", F.lit("HOT"))
    for tb, claims in ((t["transaction_base"], t["fraud_claim_tran"]), (hot(t["transaction_base"]), hot(t["fraud_claim_tran"]))):
        many = fraud.txn_fraud_flag(tb, claims)
        once = fraud.txn_fraud_flag_once(tb, claims).select(*many.columns).collect()
        key = lambda r: tuple(str(x) for x in r)
        assert len(once) == tb.count() and set(map(key, many.collect())) == set(map(key, once))
        assert sum(r.is_fraud_txn for r in once) > 0


def test_summary_quantiles_follow_the_rank_rule(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    vals = [float(v) for v in rng.integers(0, 1000, size=137)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = R.summary_stats(df, ["x"], interpolate=False).first()
    xs = np.sort(np.array([v for v in vals if v is not None]))
    n = len(xs)
    pick = lambda q: xs[max(int(np.ceil(q * n)) - 1, 0)]
    assert r["count"] == n and (r["min"], r["max"]) == (xs[0], xs[-1])
    assert (r.p25, r.p50, r.p75) == (pick(0.25), pick(0.5), pick(0.75))
    assert r.mean == round(float(np.floor(xs.mean() * 1e4 + 0.5) / 1e4), 4)


def test_histogram_puts_the_top_edge_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.99,), (2.0,), (99.99,), (100.0,), (None,)], "s double")
    got = {r.bin_start: r["count"] for r in R.histogram(df, "s", 2.0, 0.0, 100.0).collect()}
    assert got == {0.0: 2, 2.0: 1, 98.0: 2}


def test_heatmap_wide_matches_long_form(spark):
    import __spark_entry__ as entry
    sf = "/root/testdata/sf0.001"
    wide = entry.queries()["spend_heatmap_wide"](spark, sf).toPandas().set_index("current_account_nbr")
    long = entry.queries()["spend_heatmap"](spark, sf).toPandas()
    assert len(wide) == long.current_account_nbr.nunique() <= 200
    for r in long.itertuples(index=False):
        assert abs(wide.loc[r.current_account_nbr, r.month_str] - r.avg_spend) < 1e-9
    assert (wide.fillna(-1) >= 0).all().all()  # absent cells are 0, never null


def test_heatmap_wide_has_months_outside_the_list(spark):
    cm = spark.sql("""SELECT current_account_nbr, date(m) AS month, total_spend FROM VALUES
        ('a', '2003-05-01', 7.0), ('a', '2000-01-01', 1.0), ('b', '2000-01-01', 2.0) t(current_account_nbr, m, total_spend)""")
    out = {r.current_account_nbr: r.asDict() for r in R.spend_heatmap_wide(cm, 5, ["1999-12", "2000-01"]).collect()}
    assert list(out["a"]) == ["current_account_nbr", "1999-12", "2000-01", "2003-05"]
    assert out["a"]["2003-05"] == 7.0 and out["b"]["2003-05"] == 0.0 and out["b"]["2000-01"] == 2.0


def test_summary_quantiles_interpolate_like_pandas(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    for n in (1, 2, 5, 98):
        vals = [float(v) for v in rng.normal(100, 30, size=n)]
        df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
        r = R.summary_stats(df, ["x"]).first()
        for name, q in (("p25", 25), ("p50", 50), ("p75", 75)):
            want = float(np.percentile(np.array(vals), q))
            assert abs(r[name] - want) <= 0.00005 + 1e-9, (n, name, r[name], want)


def test_quantiles_are_exact_on_millions_of_rows_ties_and_extremes(spark):
    import numpy as np
    from lineforge.operators.quantiles import exact_quantiles
    n = 2_200_000
    x = F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 7.0 - 50_000)
    df = spark.range(n).select(x.alias("x"), F.when(F.col("id") % 2 == 0, F.exp(F.col("id") % 600)).alias("y"),
                               (F.col("id") % 4).alias("g"))
    i = np.arange(n)
    want = np.where(i % 3 == 0, 7.5, (i * 7919 % 1_000_003) / 7.0 - 50_000)
    other = np.exp((i % 600).astype(float))[i % 2 == 0]
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9999, 1.0]
    got = {(r.column_name, r.q): r.value for r in exact_quantiles(df, ["x", "y"], qs).collect()}
    for q in qs:
        assert got["x", q] == pytest.approx(np.quantile(want, q), rel=1e-12)
        assert got["y", q] == pytest.approx(np.quantile(other, q), rel=1e-9)
    grouped = {(r.g, r.q): (r.value, r.n) for r in exact_quantiles(df, ["x"], [0.5], "g", discrete=True).collect()}
    for g in range(4):
        part = np.sort(want[i % 4 == g])
        assert grouped[g, 0.5] == (part[int(np.ceil(0.5 * len(part))) - 1], len(part))


def test_quantiles_of_nulls_nan_one_value_and_no_rows(spark):
    from lineforge.operators.quantiles import exact_quantiles
    df = spark.createDataFrame([(None, "a"), (float("nan"), "a"), (3.0, "a"), (1.7e308, None), (-1.7e308, None)], "x double, g string")
    got = {r.g: (r.value, r.n) for r in exact_quantiles(df, ["x"], [0.25], "g").collect()}
    assert got["a"] == (3.0, 1) and got[None][1] == 2
    assert exact_quantiles(df.where("x = 3"), ["x"], [0.9]).first().value == 3.0
    assert exact_quantiles(df.limit(0), ["x"], [0.9]).count() == 0


def test_stratified_split_is_within_a_row_of_the_share(spark):
    from lineforge.operators.matrix import stratified_split
    df = spark.range(20_000).select(F.col("id").cast("string").alias("current_account_nbr"),
                                    F.when(F.col("id") % 10 < 7, 0).when(F.col("id") < 40, 1).when(F.col("id") % 2 == 0, 2).alias("label"))
    out = stratified_split(df, "label", 0.25)
    for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == (int(r.n * 0.25 + 0.5) if r.label is not None else 0), r
    assert out.count() == 20_000 and out.columns == [*df.columns, "is_test"]


def test_metrics_skip_rows_without_a_prediction(spark):
    from lineforge.operators.forecast import regression_metrics
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (9.0, None), (None, 3.0), (4.0, 4.0)], "y double, p double")
    r = regression_metrics(df, "y", "p").first()
    assert r.n == 3 and r.r2 == round(1 - 0.25 / (14 / 3), 4)


def test_stand_in_recommendations_take_every_branch(spark):
    from lineforge.plans.context import context
    rows = context(spark, "/root/testdata/sf0.01").final_recs.select(
        "cu_crd_line", "cu_cur_balance", "cu_line_incr_excl_flag", "recommended_credit_line", "predicted_adjustment_delta").collect()
    excl = lambda r: (r.cu_line_incr_excl_flag or "").upper() == "Y"
    blocked = [r for r in rows if excl(r) and r.predicted_adjustment_delta == 0.0]
    floor = [r for r in rows if r.cu_crd_line and r.recommended_credit_line == r.cu_cur_balance * 1.1]
    cap = [r for r in rows if r.cu_crd_line and r.recommended_credit_line == r.cu_crd_line * 1.5]
    crossed = [r for r in rows if r.cu_crd_line and r.cu_cur_balance * 1.1 > r.cu_crd_line * 1.5]
    zero = [r for r in rows if r.cu_crd_line == 0]
    assert all(len(x) > 0 for x in (blocked, floor, cap, crossed, zero))


def _parts(df):
    """Numbers of the parts that the plan deals rows into by number, not by the session's shuffle width."""
    import re
    return [int(n) for n in re.findall(r"hashpartitioning\([^()]*(?:\([^()]*\)[^()]*)*, (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())]


def test_transactions_are_dealt_by_account_and_month_before_they_are_grouped(spark, monkeypatch):
    txn = spark.range(600).select(
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("A"), F.col("id") % 7)).alias("current_account_nbr"), F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 13 > 0, F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 90).cast("int"))).alias("transaction_date"),
        F.col("id").cast("decimal(18,2)").alias("transaction_amt"), F.lit("253").alias("transaction_code"),
        F.lit(None).cast("decimal(18,2)").alias("curr_markup_fee"), F.lit("840").alias("frgn_curr_code"), F.lit("Y").alias("first_purchase_ind"))
    whole = monthly.txn_monthly(txn)
    want = sorted(map(str, whole.collect()))
    assert _parts(whole) == []
    monkeypatch.setattr(monthly, "TXN_ROWS", 100)
    dealt = monthly.txn_monthly(txn)
    assert _parts(dealt) == [6] and sorted(map(str, dealt.collect())) == want and len(want) == 24


def test_passes_over_accounts_are_dealt_out(spark, monkeypatch):
    from lineforge.operators import forecast, models
    x = spark.range(400).select(F.concat(F.lit("A"), F.col("id")).alias("current_account_nbr"),
                                ((F.col("id") % 2) * 10 + F.rand(1)).alias("a"), F.rand(2).alias("b")).coalesce(1)
    one, centres, cost = models.kmeans_clusters(x, ["a", "b"], 2, seeds=(1,))
    seen = []
    keep = models.materialise
    monkeypatch.setattr(models, "materialise", lambda df, name: seen.append(_parts(df)) or keep(df, name))
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    many, centres2, cost2 = models.kmeans_clusters(x, ["a", "b"], 2, seeds=(1,))
    assert seen == [[], [4]] and abs(centres - centres2).max() < 1e-9 and math.isclose(cost, cost2)
    assert sorted(map(str, one.select("current_account_nbr", "cluster_id").collect())) == sorted(
        map(str, many.select("current_account_nbr", "cluster_id").collect()))
    series = x.select("current_account_nbr", F.array("a", "b", "a", "b").alias("ys"))
    for df in (forecast.holt_forecast(series), forecast.holt_estimated(series)):
        assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and df.count() == 400
