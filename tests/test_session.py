"""Session helpers: cluster sizing and the package shipped to executors."""
from lineforge import session


def test_cluster_conf_scales_shuffle_width_with_input():
    small = session.cluster_conf(10 << 30, executors=10, cores_per_executor=4)
    big = session.cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 120  # 3 x cores dominates
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_materialise_round_trips_through_the_checkpoint_folder(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    back = session.materialise(df, "unit")
    assert sorted(r.x for r in back.collect()) == list(range(10))
    assert session.ensure_checkpoint_dir(spark) in back.inputFiles()[0] or back.inputFiles()


def test_executor_workers_import_the_package(spark):
    import pandas as pd
    session.ship_package(spark)  # idempotent per application

    def probe(batches):
        import lineforge
        from lineforge.operators import iforest
        for _ in batches:
            yield pd.DataFrame({"version": [lineforge.__version__], "gamma": [iforest.EULER_GAMMA]})

    rows = spark.range(4).repartition(2).mapInPandas(probe, "version string, gamma double").collect()
    assert rows and all(r.version == __import__("lineforge").__version__ for r in rows)


def test_clear_scratch_deletes_only_the_applications_folder(spark):
    import subprocess
    import sys
    import tempfile
    shared = tempfile.mkdtemp()
    code = f"""
import os
from lineforge import session
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{shared}")
     .getOrCreate())
open("{shared}/other", "w").close()
session.materialise(s.range(3), "x")
assert len(os.listdir("{shared}")) == 2
session.clear_scratch(s)
assert os.listdir("{shared}") == ["other"]
"""
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env=os.environ | {"PYTHONPATH": root})
