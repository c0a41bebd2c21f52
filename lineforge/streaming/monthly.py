"""Incremental account-month transaction aggregates with Structured Streaming.

Every micro-batch of new transaction files is pre-aggregated by account and month and written as
partial sums under its batch number (written again after a failure, it replaces itself).  Reading
merges the partials with the batch operator's own arithmetic, so at any time the result covers all
input so far, late months included: there is no state store to size and nothing to flush.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.monthly import ACCT, finish_txn_monthly, txn_monthly_aggs

KEYS = [ACCT, "txn_month"]


def partial_months(events: DataFrame) -> DataFrame:
    """Partial sums of a set of transactions, by account and month."""
    month = F.trunc(F.col("transaction_date").cast("date"), "month").alias("txn_month")
    return events.where(F.col("transaction_date").isNotNull()).groupBy(F.col(ACCT), month).agg(*txn_monthly_aggs())


def merged_months(partials: DataFrame) -> DataFrame:
    """The batch operator's table from all partials (sums and counts add up, maxima compare)."""
    merge = lambda c: (F.max(c) if c == "max_txn_amt" else F.sum(c)).alias(c)
    cols = [c for c in partials.columns if c not in (*KEYS, "batch")]
    return finish_txn_monthly(partials.groupBy(*KEYS).agg(*[merge(c) for c in cols]))


def start_txn_monthly_stream(spark: SparkSession, source_path: str, schema: StructType, sink_path: str,
                             checkpoint_location: str, available_now: bool = True, files_per_batch: int = 1000):
    """Run the stream from a folder of transaction Parquet files into a folder of partials.

    ``checkpoint_location`` must be on shared storage, so the query goes on where it was after a
    restart or executor loss; ``files_per_batch`` bounds a micro-batch."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_path)

    def save(batch: DataFrame, number: int) -> None:
        partial_months(batch).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/batch={number}")

    writer = events.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
