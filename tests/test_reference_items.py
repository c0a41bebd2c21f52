"""Band join, forest samples, k-means, trained smoothing and replaced tables, against brute force."""
import datetime
import random
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from lineforge.operators import forecast, fraud, iforest, models
from lineforge.operators.segments import CLASSIFICATION_FEATURES
from lineforge.plans.catalog_models import _series
from lineforge.plans.context import context
from lineforge.sources import tables
from test_plans import plan

DAY = datetime.date(2000, 1, 2)


def _hot_day(spark, n=3000):
    """One account's day holds nearly all transactions, in fractions of a cent, and many claims."""
    rnd = random.Random(5)
    amount = lambda: Decimal(rnd.randint(0, 40_000)) / 1000
    t = [("HOT" if rnd.random() < 0.9 else f"a{rnd.randint(0, 5)}", DAY, amount(), i) for i in range(n)]
    t += [("HOT", DAY, None, n), (None, DAY, Decimal(1), n + 1), ("HOT", None, Decimal(1), n + 2), ("HOT", DAY, Decimal("-0.005"), n + 3)]
    f = [(rnd.choice(["HOT", "a1", "a2"]), DAY, amount()) for _ in range(300)] + [("HOT", DAY, None), ("HOT", DAY, Decimal("0.002"))]
    tx = spark.createDataFrame(t, "current_account_nbr string, transaction_date date, transaction_amt decimal(18,3), transaction_id long")
    cl = spark.createDataFrame(f, "current_account_nbr string, transaction_dt date, transaction_am decimal(18,3)")
    hits = Counter()
    for a, d, m, i in t:
        hits[i] = sum(1 for x, y, z in f if (x, y) == (a, d) and None not in (a, d, m, z) and abs(m - z) < Decimal("0.01"))
    return tx, cl, hits


def test_band_join_on_a_hot_day(spark):
    tx, cl, hits = _hot_day(spark)
    many = Counter((r.transaction_id, r.is_fraud_txn) for r in fraud.txn_fraud_flag(tx, cl).collect())
    assert many == Counter({(i, 1 if n else 0): max(n, 1) for i, n in hits.items()})
    once = {r.transaction_id: r.is_fraud_txn for r in fraud.txn_fraud_flag_once(tx, cl).collect()}
    assert once == {i: int(n > 0) for i, n in hits.items()} and max(hits.values()) > 1
    assert fraud.txn_fraud_flag_once(tx, cl).count() == tx.count()
    empty = fraud.txn_fraud_flag_once(tx, cl.limit(0))
    assert empty.agg(F.sum("is_fraud_txn")).first()[0] == 0 and fraud.txn_fraud_flag_once(tx.limit(0), cl).count() == 0


def test_band_join_has_the_bin_among_its_keys(spark):
    tx, cl, _ = _hot_day(spark, 50)
    for df in (fraud.txn_fraud_flag(tx, cl), fraud.txn_fraud_flag_once(tx, cl)):
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text and "Left keys [3]" in text


@pytest.mark.parametrize("n", [10, 256, 3000])
def test_every_tree_has_its_exact_sample(spark, n):
    df = spark.range(n).selectExpr("cast(id as string) as current_account_nbr", "id as x").repartition(5)
    got = iforest.bottom_samples(df, n, 20, 64, seed=3).toPandas()
    again = iforest.bottom_samples(df.repartition(3), n, 20, 64, seed=3).toPandas()
    for t, rows in got.groupby("tree"):
        assert len(rows) == min(64, n) == rows.current_account_nbr.nunique()
        assert set(rows.current_account_nbr) == set(again[again.tree == t].current_account_nbr)
    assert got.tree.nunique() == 20
    hashes = df.selectExpr("current_account_nbr", "xxhash64(3, 7, current_account_nbr) as h").orderBy("h").limit(min(64, n)).toPandas()
    assert set(hashes.current_account_nbr) == set(got[got.tree == 7].current_account_nbr)


def test_kmeans_starts_in_one_pass_equal_plain_lloyd(spark):
    seg = context(spark, SF_SMALL).segments
    from lineforge.operators.matrix import zscore
    data = zscore(seg, CLASSIFICATION_FEATURES, keep=("current_account_nbr",))
    found = models.kmeans_all_starts(data, CLASSIFICATION_FEATURES, 4, (1, 2, 3))
    x = data.orderBy(F.xxhash64("current_account_nbr"), "current_account_nbr").select(*CLASSIFICATION_FEATURES).toPandas().to_numpy(float)
    for (centres, cost), seed in zip(found, (1, 2, 3)):
        c = models._start_centres(x, 4, seed)
        for _ in range(100):
            at = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            new = np.array([x[at == k].mean(0) if (at == k).any() else c[k] for k in range(4)])
            if np.abs(new - c).max() < 1e-9:
                break
            c = new
        assert np.isclose(cost, ((x[:, None] - c[None]) ** 2).sum(2).min(1).sum(), rtol=1e-9)
    _, _, best = models.kmeans_clusters(seg, CLASSIFICATION_FEATURES, 4, seeds=(1, 2, 3))
    assert np.isclose(best, min(c for _, c in found))
    frame, centres, _ = models.kmeans_clusters(seg.limit(0), CLASSIFICATION_FEATURES, 4)
    assert frame.count() == 0 and len(centres) == 0


def test_kmeans_is_no_worse_than_ten_fits(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    from lineforge.operators.matrix import zscore
    seg = context(spark, SF_SMALL).segments
    _, _, cost = models.kmeans_clusters(seg, CLASSIFICATION_FEATURES, 6)
    data = VectorAssembler(inputCols=CLASSIFICATION_FEATURES, outputCol="features").transform(zscore(seg, CLASSIFICATION_FEATURES))
    spark_best = min(KMeans(k=6, seed=s, maxIter=20).fit(data).summary.trainingCost for s in (42, 43, 44))
    assert cost <= 1.02 * spark_best


def test_trained_holt_is_never_above_grid_or_refined(spark):
    series = _series(context(spark, SF_SMALL))
    fits = {k: {r.current_account_nbr: r for r in forecast.holt_estimated(series, **a).collect()}
            for k, a in {"grid": {}, "fine": {"refine": 6}, "newton": {"refine": 6, "newton": True}, "rough": {"newton": True}}.items()}
    for acct, r in fits["newton"].items():
        assert r.sse <= min(fits[k][acct].sse for k in ("grid", "fine")) * (1 + 1e-9) + 1e-6
        assert 0 < r.alpha < 1 and 0 < r.beta < 1
    lower = sum(r.sse < fits["grid"][a].sse * 0.9999 for a, r in fits["rough"].items())
    assert lower > len(fits["rough"]) / 2
    # at a minimum: no neighbour is lower
    rows = {r.current_account_nbr: np.array(r.ys, float) for r in series.limit(40).collect()}
    for acct, ys in rows.items():
        r = fits["newton"][acct]
        around = np.array([[min(max(r.alpha + d, 1e-4), 0.9999), min(max(r.beta + e, 1e-4), 0.9999)] for d in (-1e-3, 0, 1e-3) for e in (-1e-3, 0, 1e-3)])
        sse, *_ = forecast._holt_states(ys[None], np.array([len(ys)]), around[None, :, 0], around[None, :, 1], 3)
        assert (sse >= r.sse * (1 - 1e-6) - 1e-6).all()


def test_a_failed_load_leaves_the_old_rows(spark, tmp_path):
    root = str(tmp_path)
    tables.replace_table(spark.range(5), root, "t")
    reader = tables.read_table(spark, root, "t")

    @F.udf("long")
    def fail(x):
        raise RuntimeError("injected")

    with pytest.raises(Exception, match="injected"):
        tables.replace_table(spark.range(9).select(fail("id").alias("id")), root, "t")
    assert tables.read_table(spark, root, "t").count() == 5
    tables.replace_table(spark.range(7), root, "t")
    assert tables.read_table(spark, root, "t").count() == 7 and reader.count() == 5  # who has begun reads on
    tables.replace_table(spark.range(2), root, "t")
    assert tables.read_table(spark, root, "t").count() == 2
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 2
    with pytest.raises(ValueError):
        tables.read_table(spark, root, "other")
