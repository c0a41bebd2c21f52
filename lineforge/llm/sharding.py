"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows are put in a seeded random order within their source; a row's fractional rank is its place
there, divided by the rows of the source.  In the order of fractional ranks every stretch holds
each source in proportion, so cutting that order into equal runs gives shards of the same mixture.

Both orders are made of many small runs, not of one window a source or one for all: a row's place
is its rank in a small bucket plus the rows in the buckets before.  A source with a third of all
rows is spread like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

RUNS = 4096  # buckets of each source's random order, and of the interleaved order
PHASES = 1 << 20


def interleaved_shards(docs: DataFrame, shards: int = 40, seed: int = 7, id_col: str = "doc_id",
                       text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, text_crc32, source, law, shard, slot, grown_shard) of every row of ``docs``.

    The law is ``rows``: the counts of the shards are at most one apart, slots are gapless from 0
    in each shard, and each shard has its share of each source within about two rows (tiny sources,
    of fewer rows than shards, fall where their phase puts them).  size: bytes of
    the UTF-8 text, and 16; text_crc32: unsigned.

    Nulls and odd input: a null text counts as an empty one (size 16, checksum 0); null sources are
    one source; null and repeated ids are placed like others; rows that are equal in id, text and
    source are interchangeable.  An empty table gives no rows; with fewer rows than shards some
    shards stay empty.  Other columns are not read, whatever their names.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("_source"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 16).cast("long").alias("_size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("_crc"))
    rows = (rows.withColumn("_s", F.coalesce(F.concat(F.lit("="), "_source"), F.lit("")))
            .withColumn("_h", F.xxhash64("_id", "_crc", "_size", F.lit(seed)))
            .withColumn("_b", F.pmod(F.col("_h"), F.lit(RUNS))))
    rows = materialise(rows, "sizes")

    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    runs = (rows.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
            .select("_s", "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
                    F.sum("_c").over(Window.partitionBy("_s")).alias("_n")))
    rank = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", "_id", "_size", "_crc")) - 1
    # a phase for each source, else all sources of one row would fall on one place
    phase = (F.pmod(F.xxhash64("_s", F.lit(seed)), F.lit(PHASES)) + 0.5) / PHASES
    placed = (rows.withColumn("_r", rank).join(runs, ["_s", "_b"])
              .withColumn("_place", F.col("_before") + F.col("_r"))
              .withColumn("_frac", (F.col("_place") + phase) / F.col("_n"))
              .select("_id", "_size", "_crc", "_source", "_s", "_place", "_frac",
                      F.least(F.floor(F.col("_frac") * RUNS), F.lit(RUNS - 1)).alias("_f")))
    placed = materialise(placed, "placed")

    whole = Window.orderBy("_f")  # over RUNS rows at most
    runs = (placed.groupBy("_f").agg(F.count(F.lit(1)).alias("_c"))
            .select("_f", F.coalesce(F.sum("_c").over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                    .alias("_start"),
                    F.sum("_c").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all")))
    rank = F.row_number().over(Window.partitionBy("_f").orderBy("_frac", "_s", "_place")) - 1
    at = placed.withColumn("_q", rank).join(runs, "_f").withColumn("_at", F.col("_start") + F.col("_q"))
    at = at.withColumn("_shard", F.expr(f"(_at * {shards}) div _all"))
    first = F.expr(f"(_shard * _all + {shards - 1}) div {shards}")
    return at.select(F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
                     F.col("_source").alias("source"), F.lit("rows").alias("law"), F.col("_shard").cast("int").alias("shard"),
                     (F.col("_at") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` (unique ids) as Parquet, one folder a shard, rows in the order of their slots."""
    place = placed.select(F.col(id_col).alias("_lf_id"), F.col("shard").alias("_lf_shard"), F.col("slot").alias("_lf_slot"))
    out = docs.join(place, docs[id_col].eqNullSafe(place["_lf_id"])).drop("_lf_id")
    (out.repartition("_lf_shard", F.floor(F.col("_lf_slot") / 100_000)).sortWithinPartitions("_lf_shard", "_lf_slot")
     .write.partitionBy("_lf_shard").parquet(path))


def shard_query(spark, sf_dir: str) -> DataFrame:
    return interleaved_shards(table(spark, sf_dir, "documents"))
