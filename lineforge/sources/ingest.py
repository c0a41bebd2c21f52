"""CSV ingest with a corrupt-row split, the positional transaction union, the row-count
audit and the Parquet/CSV sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
NULL_TEXT = "\\N"  # beside an empty field without quotes; "" in quotes is an empty text

# ---------------------------------------------------------------------------------------
# Expected row counts of the production extracts, and the audit tolerance.
# ---------------------------------------------------------------------------------------
EXPECTED_COUNTS = {
    "account_dim": 18_070,
    "statement_fact": 658_228,
    "transaction_fact": 493_336,
    "wrld_stor_tran_fact": 1_053_854,
    "transaction_base": 1_547_190,
    "syf_id": 18_070,
    "rams_batch_cur": 96_799,
    "fraud_claim_case": 77,
    "fraud_claim_tran": 202,
}
AUDIT_TOLERANCE = 5

SOURCE_TABLES = ("account_dim", "statement_fact", "transaction_fact", "wrld_stor_tran_fact", "syf_id",
                 "rams_batch_cur", "fraud_claim_case", "fraud_claim_tran")


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   materialise: bool = True) -> tuple[DataFrame, DataFrame]:
    """Headered CSV with a fixed schema: ``(good_rows, bad_rows)``.

    PERMISSIVE mode keeps malformed lines (wrong type, too few or too many fields) in a
    corrupt-record column.  The CSV parser only checks the columns a query needs, so the
    full parse is written once as Parquet under the shared checkpoint folder and the
    good/bad split is taken from that copy: the row set no longer depends on which
    columns a later query prunes, and later scans are columnar."""
    from ..session import scratch_path
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.schema(full).option("header", "true").option("mode", "PERMISSIVE")
           .option("emptyValue", "").option("nullValue", NULL_TEXT)
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    if materialise:
        target = scratch_path(spark, "csv-parsed")
        raw.write.mode("overwrite").parquet(target)
        raw = spark.read.parquet(target)
    good = raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = raw.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def load_tables(spark: SparkSession, base_path: str, schemas: dict[str, T.StructType],
                file_names: dict[str, str] | None = None, store: str | None = None) -> dict[str, DataFrame]:
    """All source CSVs (good rows) plus the transaction union; nothing is collected.

    With ``store`` each of them replaces the table of its name there (:mod:`.tables`); a table that
    cannot be loaded keeps its old rows, and the error ends the load."""
    from .tables import read_table, replace_table
    out = {}
    for name, schema in schemas.items():
        fname = (file_names or {}).get(name, f"{name}.csv")
        out[name], _ = read_csv_table(spark, f"{base_path.rstrip('/')}/{fname}", schema)
    if "transaction_fact" in out and "wrld_stor_tran_fact" in out:
        out["transaction_base"] = union_transactions(out["transaction_fact"], out["wrld_stor_tran_fact"])
    if store is None:
        return out
    for name, df in out.items():
        replace_table(df, store, name)
    return {name: read_table(spark, store, name) for name in out}


def union_transactions(transaction_fact: DataFrame, wrld_stor_tran_fact: DataFrame) -> DataFrame:
    """Positional UNION ALL of the two transaction sources with a literal source column."""
    a_types = [f.dataType for f in transaction_fact.schema.fields]
    b_types = [f.dataType for f in wrld_stor_tran_fact.schema.fields]
    if a_types != b_types:
        raise ValueError("transaction sources differ in column types; positional union refused")
    a = transaction_fact.withColumn("source_table", F.lit("transaction_fact"))
    b = wrld_stor_tran_fact.withColumn("source_table", F.lit("wrld_stor_tran_fact"))
    return a.union(b)


def row_count_audit(spark: SparkSession, tables: dict[str, DataFrame],
                    expected: dict[str, int] | None = None, tolerance: int = AUDIT_TOLERANCE) -> DataFrame:
    """table, expected, actual, diff, ok (|diff| <= tolerance); an absent table counts 0."""
    expected = dict(EXPECTED_COUNTS if expected is None else expected)
    counts = None
    for name, df in tables.items():
        c = df.select(F.lit(name).alias("table_name")).groupBy("table_name").agg(F.count(F.lit(1)).alias("actual"))
        counts = c if counts is None else counts.unionByName(c)
    exp = spark.createDataFrame([(k, int(v)) for k, v in expected.items()], "table_name string, expected long")
    j = exp.join(counts, "table_name", "left") if counts is not None else exp.withColumn("actual", F.lit(None))
    j = j.withColumn("actual", F.coalesce(F.col("actual"), F.lit(0)).cast("long"))
    return j.select("table_name", "expected", "actual", (F.col("actual") - F.col("expected")).alias("diff"),
                    (F.abs(F.col("actual") - F.col("expected")) <= tolerance).alias("ok"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Headered CSV: an empty text is written as a pair of quotes, a null as nothing."""
    df.write.mode("overwrite").option("header", "true").option("emptyValue", '""').csv(path)
    return path
