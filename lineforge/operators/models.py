"""Models: boosted spend and credit regressors that stop by the tail of their training rows, the
segment classifier and its report, and k-means clusters.

Training inputs stay distributed; only fixed-size artefacts reach the driver (validation errors,
cluster centres, feature importances).  What a long fit has reached is written to the shared
checkpoint folder, so a lost executor does not restart it from the source scan.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dealt_into, ensure_checkpoint_dir, materialise, parts_of, task_slots
from .boosting import BoostedTrees, BoostSettings, fit_boosted
from .matrix import positional_tail, stratified_split, zscore
from .segments import SEGMENTS

ACCT = "current_account_nbr"
TASK_ROWS = 1 << 16  # accounts of a task of a fit that passes over them many times


def _kept_dealt(df: DataFrame, name: str, least: int = 1) -> DataFrame:
    """``df`` written, a second time if it has more rows than ``TASK_ROWS``: in parts of that many, and in
    no fewer than ``least``."""
    kept = materialise(df, name)
    parts = parts_of(kept, TASK_ROWS)
    return kept if parts <= 1 else materialise(dealt_into(kept, max(parts, least), ACCT), name)


def _assembler(features: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")


def with_double_features(df: DataFrame, features: list[str], zero_fill: bool = False) -> DataFrame:
    cols = {c: F.col(c).cast("double") for c in features}
    if zero_fill:
        cols = {c: F.coalesce(v, F.lit(0.0)) for c, v in cols.items()}
    return df.withColumns(cols)


def fit_with_tail(train: DataFrame, features: list[str], label: str, keys: list[str], val_share: float = 0.2,
                  settings: BoostSettings | None = None) -> BoostedTrees:
    """Boosted trees that stop by the positional tail of the training rows (the last ``val_share`` of
    them in the order of ``keys``).  A table too small for a tail of a row is refused."""
    ensure_checkpoint_dir(train.sparkSession)
    y = F.col(label).cast("double")
    rows = positional_tail(train.where(y.isNotNull() & ~F.isnan(y)), val_share, keys, "_is_val")
    return fit_boosted(rows, features, label, F.col("_is_val"), keys, settings, together=True)


def predict_floor(model, df: DataFrame, features: list[str], out: str = "prediction",
                  floor: float | None = 0.0, zero_fill: bool = False) -> DataFrame:
    """Score with a fitted model; predictions floored (negative spend is 0)."""
    rows = with_double_features(df, features, zero_fill=zero_fill)
    if isinstance(model, BoostedTrees):
        scored = model.predict(rows, "_raw")
    else:
        scored = model.transform(rows).withColumn("_raw", F.col("prediction")).drop("features", "rawPrediction", "probability", "prediction")
    pred = F.col("_raw") if floor is None else F.greatest(F.col("_raw"), F.lit(floor))
    return scored.withColumn(out, pred).drop("_raw")


def feature_importances(model, features: list[str], top: int = 15) -> list[tuple[str, float]]:
    """(feature, importance) pairs, largest first (a vector of length #features)."""
    if isinstance(model, BoostedTrees):
        return model.importances(top)
    imp = model.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(features, [float(x) for x in imp]), key=lambda p: (-p[1], p[0]))
    return pairs[:top]


# ---------------------------------------------------------------------------------------
# segment classifier, report and clusters
# ---------------------------------------------------------------------------------------

def fit_segment_classifier(df: DataFrame, features: list[str], label: str = "segment_label",
                           test_share: float = 0.25, num_trees: int = 300, max_depth: int = 15,
                           min_instances: int = 5, seed: int = 42):
    """Random forest on the rule labels; 75/25 split stratified by label, class weights balanced
    over the training rows.  Returns ``(model, predictions_on_test)`` with y_true, y_pred."""
    from .segments import class_weights
    ensure_checkpoint_dir(df.sparkSession)
    data = with_double_features(df.dropna(subset=features + [label]), features)
    data = _kept_dealt(stratified_split(data, label, test_share, "_is_test"), "classifier-input", task_slots(df.sparkSession))
    train = class_weights(data.where(~F.col("_is_test")), label, "class_weight")
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="class_weight", numTrees=num_trees,
                                maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed,
                                checkpointInterval=10, cacheNodeIds=True)  # a pass need not walk every tree from its root
    pipe = Pipeline(stages=[_assembler(features), rf]).fit(train.withColumn(label, F.col(label).cast("double")))
    pred = pipe.transform(data.where(F.col("_is_test")))
    out = pred.select(ACCT, F.col(label).cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))
    return pipe, out


def confusion_matrix(pred: DataFrame, labels=tuple(sorted(SEGMENTS))) -> DataFrame:
    """y_true x predicted-label counts (pivot over the fixed label list, missing = 0)."""
    return (pred.groupBy("y_true").pivot("y_pred", list(labels)).agg(F.count(F.lit(1)))
            .fillna(0).select("y_true", *[F.col(str(k)).cast("long").alias(f"pred_{k}") for k in labels]))


def classification_report(pred: DataFrame, labels=tuple(sorted(SEGMENTS))) -> DataFrame:
    """Per class precision/recall/F1/support, then accuracy, macro and weighted averages
    (an absent class reports zeros instead of failing)."""
    from ..plans.reports import round_dp
    per = pred.agg(*[F.count_if((F.col("y_true") == k) & (F.col("y_pred") == k)).alias(f"tp_{k}") for k in labels],
                   *[F.count_if(F.col("y_pred") == k).alias(f"pp_{k}") for k in labels],
                   *[F.count_if(F.col("y_true") == k).alias(f"sp_{k}") for k in labels],
                   F.count(F.lit(1)).alias("n"))
    stack = "stack({}, {}) as (label, tp, pp, support)".format(
        len(labels), ", ".join(f"{k}, tp_{k}, pp_{k}, sp_{k}" for k in labels))
    rows = per.selectExpr("n", stack)
    p = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    rows = rows.withColumns({"precision": p, "recall": r})
    rows = rows.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                        F.lit(2.0) * F.col("precision") * F.col("recall")
                                        / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    names = F.create_map(*[x for k in labels for x in (F.lit(k), F.lit(SEGMENTS.get(k, str(k))))])
    cls = rows.select(F.element_at(names, F.col("label")).alias("class_name"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"), "tp", "n")
    # the class table has one row per label, so these summaries are over a few rows
    macro = cls.agg(F.lit("macro avg").alias("class_name"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = cls.agg(F.lit("weighted avg").alias("class_name"),
                       (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                       F.sum("support").alias("support"))
    acc = cls.agg(F.lit("accuracy").alias("class_name"), F.lit(None).cast("double").alias("precision"),
                  F.lit(None).cast("double").alias("recall"),
                  (F.sum("tp") / F.sum("support")).alias("f1"), F.sum("support").alias("support"))
    out = cls.select("class_name", "precision", "recall", "f1", "support").unionByName(acc).unionByName(macro) \
        .unionByName(weighted)
    return out.select("class_name", *[round_dp(c, 4).alias(c) for c in ("precision", "recall", "f1")],
                      F.col("support").cast("long").alias("support"))


START_ROWS = 4096  # rows (by the hash of their key) that the starts are drawn from


def _start_centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over the rows ``x``: each next centre by the squared distance to those there are."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    while len(centres) < k:
        d = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0)
        centres.append(x[rng.choice(len(x), p=d / d.sum())] if d.sum() > 0 else x[rng.integers(len(x))])
    return np.array(centres)


def kmeans_all_starts(data: DataFrame, features: list[str], k: int, seeds, max_iter: int = 100, key: str = ACCT):
    """(centres, cost) of each start: all of them move in the same pass.

    An iteration is one job: each task gives, for every start and cluster, the number, sum and
    squared distance of its rows; these are added up in Spark, and the driver gets starts x clusters
    rows.  It ends when no centre of any start moves."""
    sample = data.orderBy(F.xxhash64(key), key).limit(START_ROWS).select(*features).toPandas().to_numpy(dtype=float)
    if not len(sample):
        return []
    centres = np.array([_start_centres(sample, k, s) for s in seeds])
    names = [f"s{j}" for j in range(len(features))]

    def sums(centres):
        def run(batches):
            total = np.zeros((len(centres) * k, len(features) + 2))
            for pdf in batches:
                x = pdf[features].to_numpy(dtype=float)
                ones = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                for i, c in enumerate(centres):
                    d = (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)
                    at = d.argmin(1)
                    hot = np.zeros((k, len(x)))
                    hot[at, np.arange(len(x))] = 1.0
                    total[i * k:(i + 1) * k, :-1] += hot @ ones
                    total[i * k:(i + 1) * k, -1] += hot @ np.maximum(d[np.arange(len(x)), at], 0.0)
            out = pd.DataFrame(total, columns=["n", *names, "cost"])
            out.insert(0, "slot", np.arange(len(total)))
            yield out

        each = data.select(*features).mapInPandas(run, "slot int, n double, " + ", ".join(f"{c} double" for c in names) + ", cost double")
        got = each.groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("n", *names, "cost")]).toPandas().sort_values("slot")
        n, s = got.n.to_numpy(), got[names].to_numpy()
        moved = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], centres.reshape(-1, len(features)))
        return moved.reshape(centres.shape), got.cost.to_numpy().reshape(len(centres), k).sum(1)

    costs = None
    for _ in range(max_iter):
        moved, costs = sums(centres)
        if np.abs(moved - centres).max() < 1e-9:
            break
        centres = moved
    return list(zip(centres, costs.tolist()))


def kmeans_clusters(df: DataFrame, features: list[str], k: int = 6, seeds=tuple(range(42, 52)), max_iter: int = 100):
    """k-means on zero-filled z-scored features; the start with the lowest cost wins, its clusters
    numbered from the one with the smallest first feature on.  Returns
    ``(frame with cluster_id, centres, cost)``."""
    # every pass reads the same rows, dealt out: much work for few bytes
    data = _kept_dealt(zscore(df, features, keep=(ACCT,)), "kmeans-input")
    found = kmeans_all_starts(data, features, k, seeds, max_iter)
    if not found:
        return df.withColumn("cluster_id", F.lit(None).cast("int")), np.zeros((0, len(features))), 0.0
    centres, cost = min(found, key=lambda f: f[1])
    centres = centres[np.lexsort(centres.T[::-1])]
    far = F.array(*[sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(features, centre)), F.lit(0.0))
                    for centre in centres])
    clusters = data.select(ACCT, (F.array_position(far, F.array_min(far)) - 1).cast("int").alias("cluster_id"))
    return df.join(clusters, ACCT, "left"), centres, cost
