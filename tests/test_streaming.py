"""The streamed account-month table equals the batch operator's, whatever the order and number of
the micro-batches."""
from paths import SF_SMALL
from lineforge.operators.monthly import txn_monthly
from lineforge.session import scratch_path
from lineforge.sources.fixtures import input_path, input_tables
from lineforge.streaming.monthly import merged_months, start_txn_monthly_stream


def test_stream_equals_batch(spark):
    tb = input_tables(spark, SF_SMALL)["transaction_base"]
    source = input_path(spark, SF_SMALL, "transaction_base")
    sink, state = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    start_txn_monthly_stream(spark, source, tb.schema, sink, state, files_per_batch=1).awaitTermination()
    got = merged_months(spark.read.parquet(sink))
    batch = txn_monthly(tb)
    cols = sorted(batch.columns)
    assert got.count() == batch.count() > 0
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    # nothing new: the query picks up where it was, and the table stays
    start_txn_monthly_stream(spark, source, tb.schema, sink, state).awaitTermination()
    assert merged_months(spark.read.parquet(sink)).select(cols).exceptAll(batch.select(cols)).count() == 0
