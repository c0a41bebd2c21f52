"""Physical-plan properties that matter at scale, checked on the registered queries."""
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL


def plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_or_nested_loop_join(spark, name):
    text = plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_monthly_aggregates_partially_before_shuffle(spark):
    text = plan(entry.queries()["txn_monthly"](spark, SF_SMALL))
    first_exchange = text.index("Exchange")
    assert "partial_sum" in text and text.index("partial_sum") < text.rindex("Exchange")
    assert first_exchange > 0
    # pruned scan: the transaction id and source columns are never read
    scan = text[text.index("ReadSchema"):].split("\n")[0]
    assert "transaction_id" not in scan and "source_table" not in scan
    assert "PushedFilters: [IsNotNull(transaction_date)]" in text


def test_latest_snapshot_limits_before_the_exchange(spark):
    text = plan(entry.queries()["latest_snapshot"](spark, SF_SMALL))
    assert "WindowGroupLimit" in text
    assert "Partial" in text and "Final" in text


def test_once_flag_is_a_single_left_join_on_the_claims_bins(spark):
    text = plan(entry.queries()["txn_fraud_flag_once"](spark, SF_SMALL))
    assert text.split("(1)")[0].count("Join") == 1 and "LeftOuter" in text.split("(1)")[0] and "Left keys [3]" in text
    import re
    scans = re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)
    assert len(scans) == 2  # transactions once, claims once
