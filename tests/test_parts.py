"""Joins and windows over large tables: parts are made by their rows, whatever width shuffles have."""
import re
from datetime import date

from lineforge.operators import monthly
from lineforge.sources import fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_transactions_join_in_parts_by_rows(spark, tmp_path):
    orders = [(k, k % 7) for k in range(200)] + [(None, 1), (5, 3)]
    lines = [(k % 200, n, "F" if n % 2 else "O") for k in range(400) for n in (1, 2)] + [(None, 1, "F")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))

    def joined(rows):
        s = fixtures.lines_and_orders(spark, str(tmp_path), rows)
        return s["lineitem"].join(s["orders"].hint("merge"), s["lineitem"].l_orderkey == s["orders"].o_orderkey)

    one, many = joined(1 << 20), joined(100)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect())) and many.count() == 804
    assert set(re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\), (\w+)", _plan(many))) == {("9", "REPARTITION_BY_NUM")}


def test_account_months_join_and_lag_in_parts_by_rows(spark, monkeypatch):
    t = spark.createDataFrame(
        [(f"A{k % 11}" if k % 13 else None, date(2000, 1 + k % 5, 1 + k % 28) if k % 9 else None, float(k), "253", None, "840", "Y") for k in range(300)],
        "current_account_nbr string, transaction_date date, transaction_amt double, transaction_code string, curr_markup_fee double, "
        "frgn_curr_code string, first_purchase_ind string")
    t = t.withColumns({c: t[c].cast("decimal(18,2)") for c in ("transaction_amt", "curr_markup_fee")})
    s = spark.createDataFrame([(f"A{k % 12}", date(2000, 1 + k % 6, 3) if k % 9 else None, float(k), k % 3, 0, 1) for k in range(100)],
                              "current_account_nbr string, billing_cycle_date date, prev_balance double, return_check_cnt_total int, "
                              "return_check_cnt_ytd int, return_check_cnt_last_mth int")
    whole = lambda: monthly.add_lag_features(monthly.customer_monthly(t, s).hint("merge"))
    before = sorted(map(repr, whole().collect()))
    monkeypatch.setattr(monthly, "TXN_ROWS", 40)
    monkeypatch.setattr(monthly, "LAG_ROWS", 20)
    assert sorted(map(repr, whole().collect())) == before
    # each side travels once, dealt by its rows, and no shuffle has the session's width
    for df in (monthly.customer_monthly(t, s), whole()):
        kinds = re.findall(r"Exchange .*?, (REPARTITION_BY_NUM|ENSURE_REQUIREMENTS)", _plan(df))
        assert kinds and set(kinds) == {"REPARTITION_BY_NUM"}
