"""Named tables that a load replaces as a whole.

A load writes the rows into a version folder of its own; only then the table's pointer, a small file
with the version's name, is swapped by one rename.  Readers follow the pointer: they see the old
rows or the new ones, never half a table, and a load that fails leaves the old rows as they were.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _pointer(spark: SparkSession, root: str, name: str) -> str | None:
    """The version that a table's pointer names."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/{name}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_table(df: DataFrame, root: str, name: str) -> str:
    """Drops and recreates the table ``name`` under ``root`` with the rows of ``df``; returns the new
    version.  The version before stays for readers that have begun, older ones are deleted.  Of two
    loads at a time the one that ends last is the table."""
    spark = df.sparkSession
    home, version = f"{root.rstrip('/')}/{name}", f"v-{uuid.uuid4().hex}"
    before = _pointer(spark, root, name)
    df.write.parquet(f"{home}/{version}")
    written, fs = _fs(spark, f"{home}/{POINTER}-{version}")
    stream = fs.create(written, False)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    target = jvm.org.apache.hadoop.fs.Path(f"{home}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(written.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(written), fs.makeQualified(target), options)
    for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(home)):
        old = status.getPath().getName()
        if old.startswith("v-") and old not in (version, before):
            fs.delete(status.getPath(), True)
    return version


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table's rows as of now."""
    version = _pointer(spark, root, name)
    if version is None:
        raise ValueError(f"no table {name} under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/{version}")
