"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, prepare

__all__ = ["components", "materialise", "prepare", "table", "text_buffer", "chunks", "release_state", "worker_state"]

_held: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark alone (the folder may be in a remote store)."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_state(key, build):
    """What ``build`` gives, kept by a worker over its tasks while they ask for the same ``key``: one
    state at a time, so that the workers of a long job do not pile up what its earlier stages used."""
    if key not in _held:
        release_state()
        _held[key] = build()
    return _held[key]


def release_state() -> None:
    """Lets go of what the worker has kept from earlier tasks."""
    _held.clear()
    pa.default_memory_pool().release_unused()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (n + 1) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = 2 << 20, most: int = 2000):
    """Row ranges (i, j) of at most ``limit`` bytes and ``most`` rows, one row at least: what the
    numpy code holds at a time does not follow the size of an Arrow batch."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), i + most, n)
        yield i, j
        i = j


def _fingerprint(df: DataFrame):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of the undirected ``edges`` (u, v); label is the smallest node
    that can be reached.

    Alternating large-star and small-star steps: every round is two aggregates and two joins on
    plain pairs, so a hub with millions of neighbours is never gathered.  The rounds are written
    tables, which bounds the lineage and survives lost executors."""
    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    seen = _fingerprint(e)
    for _ in range(most_rounds if seen[0] else 0):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = materialise(small, "edges")
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError("components: no fixed point; raise most_rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
