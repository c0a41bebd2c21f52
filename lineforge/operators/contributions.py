"""Additive per-row feature contributions for tree ensembles (path-dependent Shapley values).

What a leaf adds to a feature's contribution depends only on which of the conditions on the leaf's
path a row meets, one bit for each feature on the path.  So every leaf gets a small table, worked out
for all leaves with equally many features at once; the tables of up to four leaves side by side are
added up to one, and a row only looks its bits up.  The tables are of the model's size, which is
broadcast; rows are explained in a ``mapInPandas`` pass, batch by batch.
Per row: ``base_value + sum(contributions) == raw prediction``.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .boosting import BoostedTrees

ACCT = "current_account_nbr"


def tree_tables(model, spark) -> tuple[list[dict], list[float], float]:
    """(node arrays of each tree, tree weights, constant) of a boosted model or of a Spark ML
    ensemble, which is saved to the shared folder and its node table read back."""
    if isinstance(model, BoostedTrees):
        return model.trees, [1.0] * len(model.trees), model.base
    path = scratch_path(spark, "tree-model")
    model.write().overwrite().save(path)
    data = spark.read.parquet(path + "/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.impurityStats",
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        "nodeData.split.leftCategoriesOrThreshold")
    # bounded by (trees x nodes per tree): a model-sized table
    pdf = data.toPandas()
    weights = [float(w) for w in model.treeWeights] if hasattr(model, "treeWeights") else [1.0] * pdf.treeID.nunique()
    trees = []
    for tid in sorted(pdf.treeID.unique()):
        t = pdf[pdf.treeID == tid].sort_values("id")
        n = int(t.id.max()) + 1
        feat = np.full(n, -1, dtype=int)
        thr = np.zeros(n)
        left = np.full(n, -1, dtype=int)
        right = np.full(n, -1, dtype=int)
        value = np.zeros(n)
        cover = np.zeros(n)
        for r in t.itertuples(index=False):
            i = int(r.id)
            value[i] = r.prediction
            stats = r.impurityStats
            cover[i] = float(stats[0]) if stats is not None and len(stats) > 0 and stats[0] > 0 else float(r.rawCount)
            if r.leftChild is not None and r.leftChild >= 0:
                left[i], right[i] = int(r.leftChild), int(r.rightChild)
                feat[i] = int(r.featureIndex)
                thr[i] = float(r.leftCategoriesOrThreshold[0])
        trees.append({"feature": feat, "threshold": thr, "left": left, "right": right, "value": value,
                      "cover": cover, "missing_left": np.zeros(n, bool)})
    return trees, weights, 0.0


def expected_value(tree: dict, node: int = 0) -> float:
    if tree["left"][node] < 0:
        return float(tree["value"][node])
    l, r = tree["left"][node], tree["right"][node]
    c = tree["cover"][node] or 1.0
    return (tree["cover"][l] * expected_value(tree, l) + tree["cover"][r] * expected_value(tree, r)) / c


def leaf_paths(tree: dict) -> list[tuple]:
    """(leaf, {feature: (share of the cover that meets its conditions, [(node, goes left)])}) of each
    leaf that some of the cover reaches."""
    out, stack = [], [(0, {})]
    while stack:
        node, path = stack.pop()
        if tree["left"][node] < 0:
            out.append((node, path))
            continue
        f, c = int(tree["feature"][node]), tree["cover"][node] or 1.0
        for child, left in ((tree["left"][node], True), (tree["right"][node], False)):
            share, conditions = path.get(f, (1.0, []))
            stack.append((child, path | {f: (share * tree["cover"][child] / c, [*conditions, (node, left)])}))
    return out


def shapley_tables(shares: np.ndarray) -> np.ndarray:
    """(leaves, 2^m, m): for leaves with ``m`` features on their path, whose conditions the cover
    meets in ``shares``, each feature's Shapley value of the indicator "all conditions met", for
    every pattern of conditions that a row meets (bit k: feature k)."""
    n, m = shares.shape
    met = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)
    size = np.array([factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)])
    out = np.empty((n, 1 << m, m))
    for i in range(m):
        # sum over the sets S of the other features of t^|S| * product(met in S) * product(share outside)
        poly = np.zeros((n, 1 << m, m))
        poly[:, :, 0] = 1.0
        for j in (j for j in range(m) if j != i):
            grown = poly * shares[:, j, None, None]
            grown[:, :, 1:] += poly[:, :, :-1] * met[None, :, j, None]
            poly = grown
        out[:, :, i] = (poly @ size) * (met[None, :, i] - shares[:, i, None])
    return out


GROUP_NODES = 3  # inner nodes of a group of leaves: up to four leaves share a look-up


def leaf_groups(tree: dict) -> list[int]:
    """Nodes whose subtrees have up to ``GROUP_NODES`` inner nodes, and together all leaves."""
    inner = np.zeros(len(tree["left"]), np.int64)  # of each node's subtree

    out, order, stack = [], [], [0]
    while stack:
        node = stack.pop()
        order.append(node)
        if tree["left"][node] >= 0:
            stack += [int(tree["left"][node]), int(tree["right"][node])]
    for node in reversed(order):
        if tree["left"][node] >= 0:
            inner[node] = 1 + inner[tree["left"][node]] + inner[tree["right"][node]]
    stack = [0]
    while stack:
        node = stack.pop()
        if inner[node] <= GROUP_NODES:
            out.append(node)
        else:
            stack += [int(tree["left"][node]), int(tree["right"][node])]
    return out


def group_table(tree: dict, root: int, leaves: dict) -> tuple[list, list[int], np.ndarray]:
    """(what a row's bits stand for, features, table of features x patterns of bits) of the leaves
    under ``root``; ``leaves``: the path and table of each.  A bit is a list of conditions (node, goes
    left) that a row meets all of: those on the way to ``root`` feature by feature, then a bit for each
    inner node of the group."""
    below, stack = [], [root]
    while stack:
        node = stack.pop()
        below.append(node)
        if tree["left"][node] >= 0:
            stack += [int(tree["left"][node]), int(tree["right"][node])]
    inner = sorted(n for n in below if tree["left"][n] >= 0)
    some = [leaves[n] for n in below if n in leaves]
    above: dict[int, list] = {}
    for f, (_, conditions) in some[0][0].items() if some else ():
        if outer := [c for c in conditions if c[0] not in inner]:
            above[f] = outer
    bits = [*above.values(), *[[(n, True)] for n in inner]]
    patterns = np.arange(1 << len(bits))
    met = [(patterns >> k & 1).astype(bool) for k in range(len(bits))]
    features = sorted({f for path, _ in some for f in path})
    out = np.zeros((len(features), len(patterns)))
    for path, table in some:
        code = np.zeros(len(patterns), np.int64)
        for k, (f, (_, conditions)) in enumerate(path.items()):
            ok = met[list(above).index(f)].copy() if f in above else np.ones(len(patterns), bool)
            for node, left in conditions:
                if node in inner:
                    side = met[len(above) + inner.index(node)]
                    ok &= side if left else ~side
            code |= ok.astype(np.int64) << k
        for k, f in enumerate(path):
            out[features.index(f)] += table[code, k]
    return bits, features, out


class Explainer:
    """The ensemble's leaves with their tables."""

    def __init__(self, trees: list[dict], weights: list[float], n_features: int):
        self.trees, self.weights, self.n_features = trees, weights, n_features
        paths = [[(leaf, path) for leaf, path in leaf_paths(t)] for t in trees]
        by_size: dict[int, list] = {}
        for k, some in enumerate(paths):
            for leaf, path in some:
                by_size.setdefault(len(path), []).append((k, leaf, path))
        leaves: list[dict] = [{} for _ in trees]  # of each tree: leaf -> (path, table)
        for m, some in by_size.items():
            if m == 0:
                continue
            for a in range(0, len(some), 512):
                part = some[a:a + 512]
                tables = shapley_tables(np.array([[s for s, _ in path.values()] for _, _, path in part]))
                for (k, leaf, path), table in zip(part, tables):
                    leaves[k][leaf] = (path, table * (trees[k]["value"][leaf] * weights[k]))
        self.groups = []  # of each tree: (bits, features, table)
        for t, some in zip(trees, leaves):
            self.groups.append([g for g in (group_table(t, root, some) for root in leaf_groups(t)) if g[1]])
            some.clear()

    def contributions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x features) contributions and the raw prediction without the constant."""
        phi, pred, one = np.zeros((self.n_features, len(x))), np.zeros(len(x)), np.empty(len(x))
        x = np.ascontiguousarray(x.T)
        missing = np.isnan(x)
        for t, w, groups in zip(self.trees, self.weights, self.groups):
            side, other = {}, {}
            node = np.zeros(len(pred), np.uint16 if len(t["value"]) <= 1 << 16 else np.uint32)
            for k in np.flatnonzero(t["left"] >= 0).tolist():  # children come after their parents
                f = t["feature"][k]
                s = x[f] <= t["threshold"][k]
                if t["missing_left"][k]:
                    s |= missing[f]
                side[k], other[k] = s, ~s
                here = node == k
                for rows, child in ((here & s, int(t["left"][k])), (here & other[k], int(t["right"][k]))):
                    node ^= np.negative(rows.astype(node.dtype)) & node.dtype.type(k ^ child)
            pred += w * t["value"][node]
            for bits, features, table in groups:
                code = np.zeros(len(pred), np.uint8 if len(bits) <= 8 else np.uint32)
                for bit, conditions in enumerate(bits):
                    node_k, left = conditions[0]
                    ok = side[node_k] if left else other[node_k]
                    for k, goes_left in conditions[1:]:
                        ok = ok & (side[k] if goes_left else other[k])
                    code |= (ok.view(np.uint8) if code.itemsize == 1 else ok.astype(np.uint32)) << code.dtype.type(bit)
                code = code.astype(np.intp)
                for f, values in zip(features, table):
                    phi[f] += values.take(code, out=one, mode="clip")
        return phi.T, pred


def explain(df: DataFrame, model, features: list[str], key: str = ACCT, zero_fill: bool = True) -> DataFrame:
    """key, base_value, raw_prediction, one ``contrib_<feature>`` column per feature.

    A null or NaN feature takes the side that its split has learnt (the right one in Spark ML's
    trees), or counts as 0 with ``zero_fill``."""
    spark = df.sparkSession
    trees, weights, constant = tree_tables(model, spark)
    base = constant + float(sum(w * expected_value(t) for t, w in zip(trees, weights)))
    bc = spark.sparkContext.broadcast((trees, weights))
    cols = [F.col(c).cast("double") for c in features]
    if zero_fill:
        cols = [F.coalesce(c, F.lit(0.0)) for c in cols]
    # a row costs its way through every leaf: few bytes, much work, so the rows are dealt out anew
    x_df = df.select(F.col(key), *[c.alias(f) for c, f in zip(cols, features)]).repartition(spark.sparkContext.defaultParallelism)
    out_schema = f"{key} string, base_value double, raw_prediction double, " + ", ".join(
        f"contrib_{f} double" for f in features)

    def run(batches):
        explainer = None
        for pdf in batches:
            explainer = explainer or Explainer(*bc.value, len(features))
            phi, pred = explainer.contributions(pdf[features].to_numpy(dtype=float))
            out = pd.DataFrame(phi, columns=[f"contrib_{f}" for f in features])
            out.insert(0, "raw_prediction", pred + constant)
            out.insert(0, "base_value", base)
            out.insert(0, key, pdf[key].to_numpy())
            yield out

    return x_df.mapInPandas(run, out_schema)


def mean_abs_contributions(contrib: DataFrame, features: list[str]) -> DataFrame:
    """Global importance: mean |contribution| per feature (one aggregate, then unpivot)."""
    one = contrib.agg(*[F.avg(F.abs(F.col(f"contrib_{f}"))).alias(f"m{i}") for i, f in enumerate(features)])
    stack = "stack({}, {}) as (feature, mean_abs_contribution)".format(
        len(features), ", ".join(f"'{f}', m{i}" for i, f in enumerate(features)))
    return one.selectExpr(stack)


def account_breakdown(contrib: DataFrame, features: list[str], key: str = ACCT) -> DataFrame:
    """Long form per account (waterfall data): key, feature, contribution."""
    stack = "stack({}, {}) as (feature, contribution)".format(
        len(features), ", ".join(f"'{f}', `contrib_{f}`" for f in features))
    return contrib.selectExpr(key, "base_value", "raw_prediction", stack)
