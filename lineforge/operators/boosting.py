"""Second-order gradient boosting, with learnt sides for missing values and patience.

The training rows are binned once and packed in blocks (bytes of bins, labels, scores), a written
table of as many parts as its rows need (``PART_ROWS`` each).  A tree grows level by level, one Spark
job a level: every task adds up, for its blocks, the gradients and Hessians of the open nodes by
feature and bin; the tasks' sums meet per feature and group of nodes, where the best split of each
node is looked up, with the missing values tried on either side.  The driver gets one candidate per
feature and node; the sums of up to ``FEW_PARTS`` tasks meet there instead, without an exchange.  Where all rows fit one part, its sums are the totals already:
the task then goes on with the next level, up to ``STORE`` trees, instead of a job for each.  All
ways run the same rounds on the same sums and give the same model.

A job for each level costs far more than its sums.  So where the cluster runs all parts at once, they
are the tasks of a barrier stage, which holds the blocks for up to ``TOGETHER`` trees: the tasks'
sums meet through files in the shared checkpoint folder, feature by feature, and every task grows the
same tree from the same candidates (:class:`_Meeting`).

The validation rows' error after each tree comes with the next tree's first level.  Fitting ends
when it has not fallen for ``patience`` trees, and the model is cut to the best one: there is no
second fit.  Executors keep the blocks with the scores after the last tree, so a level evaluates the
tree that is being grown and no other; they are written every ``STORE`` trees, which bounds what a
lost executor costs.
"""

from __future__ import annotations

import json
import os
import pickle
import shutil
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, shared_folder, task_slots

BINS = 64          # of a feature; the last one is for missing values
MISSING = BINS - 1
BLOCK = 16_384     # rows of a block
SLICE = 16         # nodes whose histograms travel together
PART_ROWS = 1 << 18  # rows of a part of the block table: 7 MB of bins for 28 features
FEW_PARTS = 16     # parts whose sums (at most 0.7 MB each for 22 features) the driver adds up itself
STORE = 25         # trees after which the blocks' scores are written anew
TOGETHER = 100     # the same for tasks that grow trees together
TOGETHER_ROWS = 1 << 22  # rows that such a task holds at most: some 90 bytes each
TOGETHER_LEAST = 1 << 14  # rows that such a task is worth; there are at least four, or one task does it all
JOINED = 1 << 16   # rows of a block that such a task holds
WAIT = 600.0       # seconds after which a task no longer waits for the others


@dataclass
class BoostSettings:
    max_trees: int = 1000
    patience: int = 50
    max_depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.8        # of each tree's rows
    column_share: float = 0.8     # of each tree's features
    l1: float = 0.1
    l2: float = 1.0
    min_weight: float = 5.0       # sum of Hessians of a child
    seed: int = 42


def empty_tree(value: float, cover: float) -> dict:
    return {"feature": np.array([-1], np.int32), "bin": np.array([0], np.int32), "threshold": np.zeros(1),
            "missing_left": np.zeros(1, bool), "left": np.array([-1], np.int32), "right": np.array([-1], np.int32),
            "value": np.array([value]), "cover": np.array([cover]), "gain": np.zeros(1)}


@dataclass
class BoostedTrees:
    """A fitted model: prediction = base + the trees' leaf values."""
    features: list[str]
    base: float
    trees: list[dict] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)  # validation error after each tree tried

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Predictions for rows of feature values; NaN is missing."""
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += t["value"][leaves(t, lambda f, r: x[r, f], lambda v, node: v <= t["threshold"][node], np.isnan, len(x))]
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the predictions; a null feature takes the side its split has learnt."""
        if not self.trees:
            return df.withColumn(out, F.lit(float(self.base)))
        shared = df.sparkSession.sparkContext.broadcast(self)  # bounded by trees x nodes

        @F.pandas_udf("double")
        def scored(x: pd.DataFrame) -> pd.Series:
            return pd.Series(shared.value.raw(x.to_numpy(dtype=float)))

        return df.withColumn(out, scored(F.struct(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(self.features)])))

    def importances(self, top: int = 15) -> list[tuple[str, float]]:
        """(feature, mean gain of its splits as a share of all features'), largest first."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for t in self.trees:
            inner = t["left"] >= 0
            np.add.at(total, t["feature"][inner], t["gain"][inner])
            np.add.at(count, t["feature"][inner], 1)
        mean = total / np.maximum(count, 1)
        share = mean / mean.sum() if mean.sum() > 0 else mean
        return sorted(zip(self.features, share.tolist()), key=lambda p: (-p[1], p[0]))[:top]

    def save(self, spark: SparkSession, path: str) -> str:
        """Node table and header, as Parquet."""
        rows = [(i, k, *[t[c][k].item() for c in _NODE]) for i, t in enumerate(self.trees) for k in range(len(t["value"]))]
        spark.createDataFrame(rows, "tree int, node int, " + ", ".join(f"`{c}` {k}" for c, k in _NODE.items())) \
            .coalesce(1).write.mode("overwrite").parquet(path + "/nodes")
        head = json.dumps({"features": self.features, "base": self.base, "errors": self.errors})
        spark.createDataFrame([(head,)], "header string").write.mode("overwrite").parquet(path + "/header")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        head = json.loads(spark.read.parquet(path + "/header").first().header)
        nodes = spark.read.parquet(path + "/nodes").toPandas().sort_values(["tree", "node"])  # of the model's size
        kinds = {c: empty_tree(0.0, 0.0)[c].dtype for c in _NODE}
        trees = [{c: t[c].to_numpy().astype(kinds[c]) for c in _NODE} for _, t in nodes.groupby("tree")]
        return cls(head["features"], head["base"], trees, head["errors"])


# The columns of a saved node.
_NODE = {"feature": "int", "bin": "int", "threshold": "double", "missing_left": "boolean", "left": "int", "right": "int",
         "value": "double", "cover": "double", "gain": "double"}


def leaves(tree: dict, values, goes_left, is_missing, n: int, start: np.ndarray | None = None) -> np.ndarray:
    """The node that each of ``n`` rows ends in, from the root or the nodes ``start`` on.
    values(features, rows): what the rows have in these features; goes_left(values, nodes) and
    is_missing(values) tell the side."""
    node = np.zeros(n, np.int64) if start is None else start.copy()
    rows = np.flatnonzero(tree["left"][node] >= 0)
    while len(rows):
        at = node[rows]
        v = values(tree["feature"][at], rows)
        left = np.where(is_missing(v), tree["missing_left"][at], goes_left(v, at))
        node[rows] = np.where(left, tree["left"][at], tree["right"][at])
        rows = rows[tree["left"][node[rows]] >= 0]
    return node


def binned_leaves(tree: dict, bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """As :func:`leaves`, for rows of bins (features x rows): node by node over bytes, each for all rows
    at once, which takes a tenth of the time of looking every row's own node up."""
    kind = np.uint8 if len(tree["value"]) <= 256 else np.uint32
    node = np.zeros(bins.shape[1], kind) if start is None else start.astype(kind)
    reached = np.bincount(node, minlength=len(tree["value"])) > 0  # nodes that rows are in, now or on their way
    for k in np.flatnonzero(tree["left"] >= 0).tolist():  # children come after their parents
        if not reached[k]:
            continue
        to_left, to_right = int(tree["left"][k]), int(tree["right"][k])
        reached[[to_left, to_right]] = True
        x = bins[tree["feature"][k]]
        right = x > np.uint8(tree["bin"][k])
        if tree["missing_left"][k]:
            right &= x != MISSING
        # all in bits: the rows in this node turn into one child or the other
        here = node == kind(k)
        right &= here
        here ^= right
        for rows, child in ((here, to_left), (right, to_right)):
            turned = np.negative(rows.view(np.uint8) if kind is np.uint8 else rows.astype(kind))
            turned &= kind(k ^ child)
            node ^= turned
    return node


def threshold(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def rounded(gain: np.ndarray) -> np.ndarray:
    """To nine digits: equal splits must not be told apart by the order that their sums were made in."""
    unit = 10.0 ** np.floor(np.log10(np.maximum(gain, 1e-300)))
    return np.round(gain / unit, 9) * unit


def best_splits(grad: np.ndarray, hess: np.ndarray, s: BoostSettings):
    """For histograms (nodes x bins), each of one feature: each node's best split.

    (gain, bin, missing left, gradient and Hessian of the left child), a gain of 0 if no split is
    allowed.  Splits lie behind each bin of values, the last of them between values and missing;
    each is tried with the missing rows on the right and on the left."""
    g_all, h_all = grad.sum(1, keepdims=True), hess.sum(1, keepdims=True)
    weight = lambda g, h: threshold(g, s.l1) ** 2 / (h + s.l2)
    g = np.cumsum(grad[:, :MISSING], axis=1)
    h = np.cumsum(hess[:, :MISSING], axis=1)
    sides = []
    for left in (False, True):
        gl, hl = (g + grad[:, MISSING:], h + hess[:, MISSING:]) if left else (g, h)
        gain = weight(gl, hl) + weight(g_all - gl, h_all - hl) - weight(g_all, h_all)
        ok = (hl >= s.min_weight) & (h_all - hl >= s.min_weight)
        sides.append((rounded(np.where(ok, np.maximum(gain, 0.0), 0.0)), gl, hl))
    rows = np.arange(len(grad))
    at = [x[0].argmax(1) for x in sides]
    gains = [x[0][rows, k] for x, k in zip(sides, at)]
    # without missing rows both sides are the same split: they would go with the heavier child
    none = hess[:, MISSING] <= 0
    heavier = sides[0][2][rows, at[0]] * 2 >= h_all[:, 0]
    left = np.where(none, heavier, gains[1] > gains[0])
    k = np.where(left & ~none, at[1], at[0])
    pick = lambda j: np.where(left, sides[1][j][rows, k], sides[0][j][rows, k])
    return pick(0), k, left, pick(1), pick(2)


def _mix(seeds: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in [0, 1) that follow from the rows' seeds and a salt."""
    z = seeds + np.uint64((salt * 0x9E3779B97F4A7C15) % 2 ** 64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    return (z ^ (z >> np.uint64(31))).astype(np.float64) / 2.0 ** 64


class _Block:
    """The rows of a block, with the scores and leaves that change while trees are grown."""

    def __init__(self, row: dict, n_features: int):
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, -1)
        self.y = np.frombuffer(row["y"], np.float64)
        self.score = np.frombuffer(row["score"], np.float64).copy()
        self.val = np.frombuffer(row["val"], np.uint8).astype(bool)
        self.seed = np.frombuffer(row["seed"], np.uint64)
        self.node: np.ndarray | None = None

    def add(self, tree: dict) -> None:
        self.score += tree["value"][binned_leaves(tree, self.bins, self.node)]
        self.node = None

    def drawn(self, level: Level, share: float) -> None:
        """For a new tree: the rows it is grown on, the cells of their bins, their gradients."""
        self.rows = np.flatnonzero(~self.val & (_mix(self.seed, level.salt) < share))
        self.cells = [self.bins[f].take(self.rows) for f in level.use]
        # of half the squared error: the Hessian is 1
        self.grad = (self.score - self.y)[self.rows]


@dataclass
class Level:
    """What the sums of a level are asked for."""
    tree: dict
    open_nodes: list[int]
    use: list[int]       # features
    salt: int            # of the tree's share of rows
    with_error: bool


def add_sums(blocks: Iterable[_Block], level: Level, s: BoostSettings):
    """Over ``blocks``: gradients and Hessians (open nodes x features x bins), and the validation
    rows' sum of absolute errors and number."""
    width, n_use = len(level.open_nodes), len(level.use)
    place = np.full(len(level.tree["value"]), width)  # rows in finished leaves go to a node that is not kept
    place[level.open_nodes] = np.arange(width)
    shape = (width + 1, n_use, BINS)
    grad, hess, error, at_most = np.zeros(shape), np.zeros(shape), np.zeros(2), (width + 1) * BINS
    for b in blocks:
        if level.with_error and b.val.any():
            error += np.abs(b.y - b.score)[b.val].sum(), b.val.sum()
        if b.node is None:
            b.drawn(level, s.row_share)
        b.node = binned_leaves(level.tree, b.bins, b.node)
        at, cells, g = place[b.node[b.rows]], b.cells, b.grad
        inside = np.flatnonzero(at < width)
        if 4 * len(inside) < 3 * len(at):  # most levels ask for a part of the rows
            at, cells, g = at[inside], [c[inside] for c in cells], g[inside]
        at = at * BINS
        for k in range(n_use):
            cell = at + cells[k]
            grad[:, k] += np.bincount(cell, weights=g, minlength=at_most).reshape(-1, BINS)
            hess[:, k] += np.bincount(cell, minlength=at_most).reshape(-1, BINS)
    return grad[:width], hess[:width], error


def _batch_rows(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in b.schema.names}


def bin_edges(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Cut points of each feature, from a quantile sketch of its values in one pass: at most
    ``bins`` - 2, fewer where values repeat."""
    shares = [k / (bins - 1) for k in range(1, bins - 1)]
    found = df.agg(*[F.percentile_approx(F.nanvl(F.col(c), F.lit(None)), shares, 20_000).alias(f"e{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(e, np.float64)) if e else np.zeros(0) for e in found]


def pack_blocks(df: DataFrame, features: list[str], edges: list[np.ndarray], base: float) -> DataFrame:
    """Block table of rows (features as doubles, _y, _val, _seed)."""
    def pack(batches):
        for b in batches:
            for a in range(0, b.num_rows, BLOCK):
                part = b.slice(a, BLOCK)
                n = part.num_rows
                bins = np.empty((len(features), n), np.uint8)
                for i, e in enumerate(edges):
                    x = part.column(f"f{i}").to_numpy(zero_copy_only=False).astype(np.float64)
                    bins[i] = np.where(np.isnan(x), MISSING, np.searchsorted(e, x, side="left"))
                raw = {"bins": bins, "y": part.column("_y").to_numpy(zero_copy_only=False).astype(np.float64), "score": np.full(n, base),
                       "val": part.column("_val").to_numpy(zero_copy_only=False).astype(np.uint8),
                       "seed": part.column("_seed").to_numpy(zero_copy_only=False).astype(np.int64)}
                yield pa.RecordBatch.from_pydict({k: pa.array([v.tobytes()], pa.binary()) for k, v in raw.items()})

    rows = df.select(*[F.col(c).alias(f"f{i}") for i, c in enumerate(features)], "_y", "_val", "_seed")
    return materialise(rows.mapInArrow(pack, "bins binary, y binary, score binary, val binary, seed binary"), "boost-blocks")


def _block_batch(row: dict, score: np.ndarray) -> pa.RecordBatch:
    row = row | {"score": score.tobytes()}
    return pa.RecordBatch.from_pydict({k: pa.array([row[k]], pa.binary()) for k in ("bins", "y", "score", "val", "seed")})


def _rescored(blocks: DataFrame, tree: dict, n_features: int) -> DataFrame:
    """The blocks with the tree's values added to their scores."""
    def run(batches):
        for r in _batch_rows(batches):
            b = _Block(r, n_features)
            b.add(tree)
            yield _block_batch(r, b.score)
    return blocks.mapInArrow(run, blocks.schema)


_KINDS = {"feature": (pa.int32(), "int"), "node": (pa.int32(), "int"), "gain": (pa.float64(), "double"), "bin": (pa.int32(), "int"),
          "missing_left": (pa.bool_(), "boolean"), "gl": (pa.float64(), "double"), "hl": (pa.float64(), "double"),
          "g": (pa.float64(), "double"), "h": (pa.float64(), "double")}


def _candidates(feature: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, s: BoostSettings) -> dict[str, np.ndarray]:
    gain, at, left, gl, hl = best_splits(g, h, s)
    return dict(zip(_KINDS, (feature, node, gain, at, left, gl, hl, g.sum(1), h.sum(1))))


def _level_job(blocks: DataFrame, n_features: int, level: Level, s: BoostSettings, parts: int):
    """(candidates, error) of a level, summed over all blocks by Spark."""
    width = len(level.open_nodes)

    def sums(batches):
        grad, hess, error = add_sums((_Block(r, n_features) for r in _batch_rows(batches)), level, s)
        keys, body = [], []
        for k, f in enumerate(level.use):
            for a in range(0, width, SLICE):
                keys.append(f * 1000 + a // SLICE)
                body.append(np.stack([grad[a:a + SLICE, k], hess[a:a + SLICE, k]]).tobytes())
        if level.with_error:
            keys.append(-1)
            body.append(error.tobytes())
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int32()), "body": pa.array(body, pa.binary())})

    def found(key, t):
        total = sum(np.frombuffer(x, np.float64) for x in t.column("body").to_pylist())
        key = key[0].as_py()
        if key < 0:
            got = dict(zip(_KINDS, [np.array([v]) for v in (-1, 0, 0.0, 0, False, *total, 0.0, 0.0)]))
        else:
            g, h = total.reshape(2, -1, BINS)
            got = _candidates(np.full(len(g), key // 1000), key % 1000 * SLICE + np.arange(len(g)), g, h, s)
        return pa.table([pa.array(got[c], k) for c, (k, _) in _KINDS.items()], names=list(_KINDS))

    rows = blocks.mapInArrow(sums, "key int, body binary")
    if parts <= FEW_PARTS:  # not worth an exchange: a few tasks' sums, of the model's size, meet here
        rows, by_key = rows.toArrow(), {}
        for i, key in enumerate(rows.column("key").to_pylist()):
            by_key.setdefault(key, []).append(i)
        rows = pa.concat_tables([found([pa.scalar(key)], rows.take(at)) for key, at in sorted(by_key.items())])
    else:
        rows = rows.groupBy("key").applyInArrow(found, ", ".join(f"{c} {k}" for c, (_, k) in _KINDS.items())).toArrow()
    cols = {c: rows.column(c).to_numpy() for c in _KINDS}
    at = np.flatnonzero(cols["feature"] < 0)
    error = np.array([cols["gl"][at[0]], cols["hl"][at[0]]]) if len(at) else np.zeros(2)
    return {c: v[cols["feature"] >= 0] for c, v in cols.items()}, error


def _level_here(blocks: list[_Block], level: Level, s: BoostSettings):
    """(candidates, error) of a level whose blocks are all at hand."""
    grad, hess, error = add_sums(blocks, level, s)
    width = len(level.open_nodes)
    return _candidates(np.tile(level.use, width), np.repeat(np.arange(width), len(level.use)),
                       grad.reshape(-1, BINS), hess.reshape(-1, BINS), s), error


def _grow(tree: dict, open_nodes: list[int], found: dict[str, np.ndarray], edges: list[np.ndarray], s: BoostSettings) -> list[int]:
    """Splits the open nodes by their best candidates; returns the new nodes."""
    leaf = lambda g, h: float(-s.learning_rate * threshold(g, s.l1) / (h + s.l2))
    new, add, n = [], {k: [] for k in tree}, len(tree["value"])
    # per node the highest gain, of equals the first feature
    order = np.lexsort((found["feature"], -found["gain"], found["node"]))
    first = order[np.flatnonzero(np.diff(found["node"][order], prepend=-1))]
    for i in first:
        c = {k: v[i] for k, v in found.items()}
        if not c["gain"] > 1e-12:
            continue
        node, e = open_nodes[c["node"]], edges[c["feature"]]
        tree["feature"][node], tree["bin"][node], tree["gain"][node] = c["feature"], c["bin"], c["gain"]
        # a split behind the last edge is between values and missing
        tree["threshold"][node] = e[c["bin"]] if c["bin"] < len(e) else np.inf
        tree["missing_left"][node] = c["missing_left"]
        tree["left"][node], tree["right"][node] = n, n + 1
        for g, h in ((c["gl"], c["hl"]), (c["g"] - c["gl"], c["h"] - c["hl"])):
            for k, v in empty_tree(leaf(g, h), h).items():
                add[k].append(v)
        new += [n, n + 1]
        n += 2
    for k in tree:
        tree[k] = np.concatenate([tree[k], *add[k]]) if add[k] else tree[k]
    return new


@dataclass
class Rounds:
    """The course of a fit: trees so far, the validation error before each, and when it ends."""
    n_features: int
    edges: list[np.ndarray]
    settings: BoostSettings
    trees: list[dict] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    ended: bool = False

    def best(self) -> int:
        return int(np.argmin(self.errors)) if self.errors else len(self.trees)

    def next_tree(self, sums: Callable[[Level], tuple]) -> dict | None:
        """Grows a tree from the sums of its levels; none if the fit has come to its end."""
        s, number = self.settings, len(self.trees)
        n_use = max(1, int(round(s.column_share * self.n_features)))
        use = sorted(np.random.default_rng([s.seed, number]).choice(self.n_features, n_use, replace=False).tolist())
        tree, open_nodes = empty_tree(0.0, 0.0), [0]
        for depth in range(s.max_depth):
            found, error = sums(Level(tree, open_nodes, use, s.seed * 1_000_003 + number, depth == 0))
            if depth == 0:
                if error[1] and len(self.errors) == number:
                    self.errors.append(float(error[0] / error[1]))
                if number >= s.max_trees or self.errors and number - self.best() >= s.patience:
                    self.ended = True
                    return None
                tree["cover"][0] = found["h"].max(initial=0.0)
            open_nodes = _grow(tree, open_nodes, found, self.edges, s)
            if not open_nodes:
                break
        if len(tree["value"]) == 1:
            self.ended = True
            return None
        self.trees.append(tree)
        return tree


def _rounds_here(blocks: DataFrame, rounds: Rounds) -> tuple[DataFrame, Rounds]:
    """Up to ``STORE`` trees over a table of one part, grown by the task that holds it."""
    n = rounds.n_features

    def run(batches):
        rows = list(_batch_rows(batches))
        held = [_Block(r, n) for r in rows]
        for _ in range(STORE):
            tree = rounds.next_tree(lambda level: _level_here(held, level, rounds.settings))
            if tree is None:
                break
            for b in held:
                b.add(tree)
        for r, b in zip(rows, held):
            yield _with_state(_block_batch(r, b.score), None)
        yield _with_state(None, pickle.dumps((rounds.trees, rounds.errors, rounds.ended)))

    done = materialise(blocks.coalesce(1).mapInArrow(run, _STATE), "boost-blocks")
    return _blocks_and_rounds(done, rounds)


_STATE = "bins binary, y binary, score binary, val binary, seed binary, state binary"


def _with_state(batch: pa.RecordBatch | None, state: bytes | None) -> pa.RecordBatch:
    names = ["bins", "y", "score", "val", "seed"]
    cols = [batch.column(c) for c in names] if batch is not None else [pa.array([None], pa.binary())] * len(names)
    return pa.RecordBatch.from_arrays([*cols, pa.array([state], pa.binary())], names=[*names, "state"])


def _blocks_and_rounds(done: DataFrame, rounds: Rounds) -> tuple[DataFrame, Rounds]:
    trees, errors, ended = pickle.loads(done.where("state is not null").first().state)  # of the model's size
    return done.where("state is null").drop("state"), Rounds(rounds.n_features, rounds.edges, rounds.settings, trees, errors, ended)


class _Meeting:
    """Where the tasks of a barrier stage add their sums up: a folder that all of them see.

    A level takes two rounds.  Every task leaves the sums of its blocks; the task that a feature falls
    to adds these up, in the order of the tasks, and leaves the feature's best splits.  Then every task
    reads all candidates.  Of two siblings only the lighter one is added up: the other's sums are their
    parent's less these.  A file is complete when it has its name, and goes when all have read it."""

    def __init__(self, folder: str, task: int, tasks: int, blocks: list[_Block], s: BoostSettings):
        self.folder, self.task, self.tasks, self.blocks, self.s = folder, task, tasks, blocks, s
        self.levels, self.mine, self.totals = 0, [], {}  # totals: of this task's features, by node

    def _path(self, kind: str, task: int, level: int) -> str:
        return f"{self.folder}/{kind}-{level}-{task}"

    def _leave(self, kind: str, body: bytes) -> None:
        path = self._path(kind, self.task, self.levels)
        with open(path + ".part", "wb") as f:
            f.write(body)
        os.rename(path + ".part", path)
        self.mine.append((kind, path))

    def _read(self, kind: str, task: int, start: int = 0, length: int = -1) -> bytes:
        path, until = self._path(kind, task, self.levels), time.monotonic() + WAIT
        while not os.path.exists(path):
            if time.monotonic() > until:
                raise TimeoutError(f"task {task} left no {path} for {WAIT} s")
            time.sleep(0.0005)
        with open(path, "rb") as f:
            f.seek(start)
            return f.read(length)

    def _forget(self, kind: str, keep: str) -> None:
        for k, path in self.mine:
            if k == kind and path != keep:
                os.unlink(path)
        self.mine = [(k, path) for k, path in self.mine if k != kind or path == keep]

    def sums(self, level: Level):
        """(candidates, error) of a level, summed over the blocks of all tasks."""
        tree, use, share = level.tree, level.use, min(self.tasks, len(level.use))
        pairs = list(zip(level.open_nodes[::2], level.open_nodes[1::2]))  # siblings; the root has none
        lighter = {n: o for a, b in pairs for n, o in [(a, b) if tree["cover"][a] <= tree["cover"][b] else (b, a)]} or {0: None}
        counted = list(lighter)
        grad, hess, error = add_sums(self.blocks, Level(tree, counted, use, level.salt, level.with_error), self.s)
        owned = [list(range(d, len(use), share)) for d in range(share)]
        self._leave("sums", b"".join([error.tobytes(), *[np.stack([grad[:, o], hess[:, o]]).tobytes() for o in owned]]))
        if self.task < share:
            o = owned[self.task]
            size = lambda d: 16 * len(counted) * len(owned[d]) * BINS
            start = sum(size(d) for d in range(self.task))
            total = sum(np.frombuffer(self._read("sums", d, 16 + start, size(self.task)), np.float64) for d in range(self.tasks))
            total = total.reshape(2, len(counted), len(o), BINS)
            before, self.totals = self.totals, {}
            parent = {int(tree["left"][k]): k for k in np.flatnonzero(tree["left"] >= 0).tolist()}
            for i, (n, other) in enumerate(lighter.items()):
                self.totals[n] = total[:, i]
                if other is not None:
                    rest = before[parent[min(n, other)]] - total[:, i]
                    rest[0][rest[1] <= 0] = 0.0  # no rows: what is left there is rounding
                    self.totals[other] = rest
            g, h = np.stack([self.totals[n] for n in level.open_nodes], axis=1)
            found = _candidates(np.tile(np.array(use)[o], len(g)), np.repeat(np.arange(len(g)), len(o)),
                                g.reshape(-1, BINS), h.reshape(-1, BINS), self.s)
            if self.task == 0 and level.with_error:
                error = sum(np.frombuffer(self._read("sums", d, 0, 16), np.float64) for d in range(self.tasks))
            self._leave("found", pickle.dumps((found, error)))
        each = [pickle.loads(self._read("found", d)) for d in range(share)]
        # whoever left candidates of this level has read all of the last one; all have read this level's sums
        self._forget("sums", "")
        self._forget("found", self._path("found", self.task, self.levels))
        self.levels += 1
        return {c: np.concatenate([f[c] for f, _ in each]) for c in _KINDS}, each[0][1]


def _joined(rows: Iterable[dict], n_features: int):
    """Rows of the block table put together to some ``JOINED`` rows each."""
    some, n = [], 0

    def one():
        joined = {c: b"".join(r[c] for r in some) for c in ("y", "score", "val", "seed")}
        return joined | {"bins": np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(n_features, -1) for r in some], axis=1).tobytes()}

    for r in rows:
        some.append(r)
        n += len(r["val"])
        if n >= JOINED:
            yield one()
            some, n = [], 0
    if some:
        yield one()


def _rounds_together(blocks: DataFrame, rounds: Rounds, tasks: int, folder: str) -> tuple[DataFrame, Rounds]:
    """Up to ``TOGETHER`` trees, grown by ``tasks`` tasks of a barrier stage that meet in ``folder``."""
    n = rounds.n_features

    def run(batches):
        context = BarrierTaskContext.get()
        rows = list(_joined(_batch_rows(batches), n))
        held = [_Block(r, n) for r in rows]
        # a folder for this run of the stage: another one after a failure starts anew
        at = f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}"
        os.makedirs(at, exist_ok=True)
        meeting = _Meeting(at, context.partitionId(), tasks, held, rounds.settings)
        for _ in range(TOGETHER):
            tree = rounds.next_tree(meeting.sums)
            if tree is None:
                break
            for b in held:
                b.add(tree)
        for r, b in zip(rows, held):
            yield _with_state(_block_batch(r, b.score), None)
        if context.partitionId() == 0:
            yield _with_state(None, pickle.dumps((rounds.trees, rounds.errors, rounds.ended)))

    done = materialise(blocks.repartition(tasks).mapInArrow(run, _STATE, barrier=True), "boost-blocks")
    shutil.rmtree(folder, ignore_errors=True)
    return _blocks_and_rounds(done, rounds)


def fit_boosted(rows: DataFrame, features: list[str], label: str, is_validation: Column, keys: list[str],
                settings: BoostSettings | None = None, part_rows: int = PART_ROWS, together: bool = False) -> BoostedTrees:
    """Fits on the rows that are not validation rows, stops by the mean absolute error of those.

    ``keys`` identify a row: the shares of rows that the trees are grown on follow from their hash,
    so they are the same under task retries.  Rows with a null or NaN label are left out; missing
    features are used as such.  Without fit rows the model predicts 0, without validation rows all
    ``max_trees`` are grown; a tree that finds no split ends the fit.

    ``together``: where rows are worth several tasks, these run side by side and meet in the shared
    folder, if the cluster has room for at least two, they hold all rows, and the folder is a path of
    the file system; otherwise each level of more than one part is a job."""
    s = settings or BoostSettings()
    y = F.col(label).cast("double")
    data = rows.where(y.isNotNull() & ~F.isnan(y)).select(
        *[F.col(c).cast("double").alias(c) for c in features], y.alias("_y"), F.coalesce(is_validation, F.lit(False)).alias("_val"),
        F.xxhash64(*keys).alias("_seed"))
    data = materialise(data, "boost-input")
    size = data.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(~F.col("_val"), F.col("_y"))).alias("base")).first()
    model = BoostedTrees(list(features), float(size.base or 0.0))
    if size.base is None:
        return model
    edges = bin_edges(data.where(~F.col("_val")), features)
    parts, spark = -(-size.n // part_rows), rows.sparkSession
    tasks = 0
    if together and size.n > min(part_rows, 4 * TOGETHER_LEAST) and shared_folder(spark):
        tasks = min(task_slots(spark), -(-size.n // min(part_rows, TOGETHER_LEAST)))
    if tasks < 2 or tasks * TOGETHER_ROWS < size.n:
        tasks = 0
    if tasks:
        data = data.repartition(tasks, "_seed", "_y")
    elif parts > 1:  # where every core has a part, parts grow up to four times as long
        parts = min(parts, max(spark.sparkContext.defaultParallelism, -(-size.n // (4 * part_rows))))
        data = data.repartition(parts, "_seed", "_y")
    blocks, rounds, held = pack_blocks(data, features, edges, model.base), Rounds(len(features), edges, s), []
    while not rounds.ended:
        if parts == 1 and not tasks:
            blocks, rounds = _rounds_here(blocks, rounds)
            continue
        if tasks:
            blocks, rounds = _rounds_together(blocks, rounds, tasks, f"{shared_folder(spark)}/boost-meeting-{uuid.uuid4().hex[:12]}")
            continue
        tree = rounds.next_tree(lambda level: _level_job(blocks, len(features), level, s, parts))
        for old in held[:-1]:  # the trees' levels have read the last one, so what it was made from can go
            old.unpersist()
        held = held[-1:]
        if tree is None:
            continue
        # the scores after each tree are kept by the executors, made by the next tree's first level as it
        # reads them, and written every STORE trees, which cuts the lineage
        blocks = _rescored(blocks, tree, len(features))
        if len(rounds.trees) % STORE == 0:
            blocks = materialise(blocks, "boost-blocks")
        else:
            blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(blocks)
    for old in held:
        old.unpersist()
    model.errors, model.trees = rounds.errors, rounds.trees[:rounds.best()]
    return model
