"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI arithmetic, UTC dates, AQE with skew handling.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "lineforge") -> SparkSession:
    """A local[N] session for tests and the bench (no UI, small shuffle width)."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LINEFORGE_DRIVER_MEM", "8g")))
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used as is.
    Only when it is unset (local tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at shared storage (e.g. an HDFS/S3 "
                               "folder) so materialised stages survive executor loss")
        conf_dir = tempfile.mkdtemp(prefix="lineforge-ckpt-")  # local mode only (tests)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def shared_folder(spark: SparkSession) -> str | None:
    """The shared checkpoint folder as a path that Python can open; none if it is in another store."""
    base = ensure_checkpoint_dir(spark)
    if "://" in base and not base.startswith("file://"):
        return None
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    return base.rstrip("/") if base.startswith("/") else None


def task_slots(spark: SparkSession) -> int:
    """How many tasks the executors run at once, as far as the settings tell; 0 if their number may change."""
    sc, conf = spark.sparkContext, spark.sparkContext.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    local = re.fullmatch(r"local(?:\[(\d+|\*)(?:, *\d+)?\])?", sc.master)
    if local:
        cores = sc._jvm.java.lang.Runtime.getRuntime().availableProcessors() if local[1] == "*" else int(local[1] or 1)
    else:
        executors = max(sc._jsc.sc().getExecutorMemoryStatus().size() - 1, 0)  # the driver is among them
        if conf.get("spark.executor.cores", None):
            cores = executors * int(conf.get("spark.executor.cores"))
        else:
            cores = executors if conf.get("spark.default.parallelism", None) else min(sc.defaultParallelism, 1024)
    return cores // int(conf.get("spark.task.cpus", "1"))


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under the checkpoint folder (call it at the session's end:
    frames that read from there are gone with it).  The folder is the application's own, made by
    Spark under the shared one, so nobody else's files are touched."""
    base = spark.sparkContext.getCheckpointDir()
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lineforge`` importable in executor Python workers (once per SparkContext).

    The Arrow-batched functions (grid search, isolation forest, contributions) run in
    executor Python workers, which must import this package.  The package is zipped into
    the shared checkpoint folder and registered with ``addPyFile``, as ``--py-files``
    would do at submit time."""
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _shipped:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    base = ensure_checkpoint_dir(spark)
    target = f"{base.rstrip('/')}/pyfiles-{uuid.uuid4().hex[:8]}/lineforge.zip"
    local = target[len("file:"):] if target.startswith("file:") else target
    if "://" in local:  # remote shared storage: build locally, then let Spark distribute it
        local = os.path.join(tempfile.mkdtemp(prefix="lineforge-zip-"), "lineforge.zip")
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with zipfile.ZipFile(local, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(local)
    _shipped.add(key)


def prepare(spark: SparkSession) -> str:
    """Checkpoint folder + package on executors; returns the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    ship_package(spark)
    return base


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of Parquet input.

    * scan splits of ~256 MB (``maxPartitionBytes``) keep every task's input bounded;
    * initial shuffle width = max(3 x cores, input / 256 MB) so the widest exchange (the
      transaction-side partial aggregates) spills little; AQE then coalesces small
      partitions to the advisory size and splits skewed ones (a hot account);
    * broadcast only sides measured under 64 MB at runtime (AQE statistics)."""
    cores = max(1, executors * cores_per_executor)
    width = max(3 * cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 4),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def materialise(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint (the data survives executor loss), runs
    the plan exactly once, and later queries read it columnar, with column pruning and
    filter pushdown."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def parts_of(df, rows: int) -> int:
    """Parts of some ``rows`` rows that ``df`` makes.  Counting reads no columns of a Parquet table."""
    return -(-df.count() // rows)


def dealt(df, rows: int, *keys):
    """``df`` dealt by the hash of ``keys`` into as many parts as give each some ``rows`` rows; left
    as it is if there are no more."""
    return dealt_into(df, parts_of(df, rows), *keys)


def dealt_into(df, parts: int, *keys):
    """``df`` dealt by the hash of ``keys`` into ``parts`` parts, left as it is if that is one.  Both sides
    of a join, dealt alike by its keys, meet without another exchange, whatever width shuffles have."""
    return df.repartition(parts, *keys) if parts > 1 else df
