"""One account holding a third of all transactions: results stay exact and the plan
pre-aggregates before the shuffle (the hot account becomes one row per month and map
task before any exchange)."""
import pandas as pd
from pyspark.sql import functions as F

from paths import SF_SMALL
from lineforge.operators import monthly
from lineforge.sources.fixtures import input_tables
from test_plans import plan


def test_hot_account_monthly_matches_brute_force(spark):
    t = input_tables(spark, SF_SMALL)
    hot = t["transaction_base"].withColumn(
        "current_account_nbr",
        F.when(F.pmod(F.col("transaction_id"), F.lit(3)) == 0, F.lit("HOT")).otherwise(F.col("current_account_nbr")))
    cm = monthly.txn_monthly(hot)
    text = plan(cm)
    assert text.index("partial_sum") < text.rindex("Exchange")
    got = cm.where(F.col("current_account_nbr") == "HOT").toPandas().set_index("txn_month").sort_index()
    pdf = hot.where("current_account_nbr = 'HOT' AND transaction_date IS NOT NULL").toPandas()
    assert len(pdf) > len(hot.toPandas()) / 4
    pdf["m"] = pd.to_datetime(pdf.transaction_date).dt.to_period("M").dt.to_timestamp().dt.date
    pdf["amt"] = pdf.transaction_amt.astype(float)
    spend = pdf[pdf.transaction_code.isin(["253", "259"])].groupby("m").amt.sum()
    counts = pdf.groupby("m").size()
    assert (got.txn_count.astype(int) == counts.reindex(got.index)).all()
    assert ((got.total_spend.astype(float) - spend.reindex(got.index).fillna(0.0)).abs() < 1e-6).all()
