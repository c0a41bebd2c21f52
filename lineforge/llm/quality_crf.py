"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is labelled good or bad.  A line's evidence are counts of what is in it and in
the lines next to it; a transition score couples neighbouring labels.  The forward-backward pass
gives each line's probability to be good; weighted by the lines' lengths these make the document's
quality, which a logistic curve, fitted on the same training rows, turns into the score.

The field is trained on a bounded sample of the labelled documents (``TRAIN_DOCS`` of them, by a
hash of their ids, of at most ``TRAIN_BYTES`` each), every line with its document's label.
Features, training rows and scores are made by Spark tasks; the fit itself is a few thousand
documents' lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, release_state, table, text_buffer
from .textvec import word_hashes

TRAIN_DOCS, TRAIN_BYTES = 4000, 100_000
ROUNDS, RATE, RIDGE = 250, 0.15, 1e-3
THRESHOLD = 0.7

# Kinds of bytes.
_KIND = np.zeros(256, np.int8)
_KIND[[9, 11, 12, 13, 32]] = 1                       # space
_KIND[ord("A"):ord("Z") + 1] = 2                     # upper case
_KIND[ord("a"):ord("z") + 1] = 3                     # lower case
_KIND[ord("0"):ord("9") + 1] = 4                     # digit
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 5           # marks of prose
_KIND[ord("!")] = 6
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{}~"]] = 7  # symbols
_KIND[ord("|")] = 8
_KIND[0xC0:] = 9                                     # first byte of another letter
_KIND[0x80:0xC0] = 10                                # its further bytes
FEATURES = 14


def line_features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, bytes of each line, first line of each text and their number).

    An empty text is one empty line."""
    n, rows = len(buf), len(off) - 1
    cut = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate([off[:-1], cut + 1]), kind="stable")
    ends = np.sort(np.concatenate([off[1:], cut]), kind="stable")
    # line k runs from the kth start to the kth end: both are in order of text, then place
    first = np.searchsorted(cut, off) + np.arange(rows + 1)
    kind = _KIND[buf]
    total = np.zeros((11, n + 1), np.int32)
    for k in range(1, 11):
        np.cumsum(kind == k, out=total[k, 1:])
    c = (total[:, ends] - total[:, starts]).astype(np.float64)
    space = (kind == 1) | (buf == 10)
    begins = ~space
    begins[1:] &= space[:-1]
    inner = off[1:-1][off[1:-1] < n]
    begins[inner] = ~space[inner]
    word = np.concatenate([[0], np.cumsum(begins)])
    words = (word[ends] - word[starts]).astype(np.float64)
    w = np.maximum(words, 1)
    letters = c[2] + c[3] + c[9]
    chars = np.maximum(c[1:10].sum(0), 1)
    ended = np.zeros(len(ends), bool)
    some = ends > starts
    ended[some] = np.isin(buf[ends[some] - 1], [ord("."), ord("?")])
    lead = np.zeros(len(ends), bool)
    lead[some] = np.isin(kind[starts[some]], [2, 9])
    # words that only repeat the one before
    h, _, at = word_hashes(buf, off)
    same = np.zeros(n + 1, np.int32)
    same[at[1:][h[1:] == h[:-1]] + 1] = 1
    same = np.cumsum(same)
    again = (same[ends] - same[starts]).astype(np.float64)
    out = np.stack([
        np.ones(len(ends)), np.log1p(words) / 4, np.minimum(c[7] / w, 4), np.minimum(c[8] / w, 2), np.minimum(c[6] / w, 3),
        c[2] / np.maximum(c[2] + c[3], 1), c[4] / chars, np.minimum(letters / w / 8, 3), np.minimum(c[5] / w, 2),
        ended, lead, np.minimum(c[5] / chars * 4, 2), words == 0, again / w], axis=1)
    return out, ends - starts, first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after (zero beyond the text's ends)."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x):
        before[1:], after[:-1] = x[:-1], x[1:]
        before[first[:-1]] = 0
        after[first[1:] - 1] = 0
    return np.concatenate([x, before, after], axis=1)


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def forward_backward(u: np.ndarray, first: np.ndarray, t: np.ndarray, pairs: bool = False):
    """Log odds of each line's label good, from the lines' evidence ``u`` (of good) and the
    transition scores ``t`` (2 x 2); with ``pairs`` also the expected transitions, summed, and the
    texts' log partition sums.  Texts of like length are worked off side by side."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    m = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(m), side="left")  # texts with more than k lines
    a0, a1 = np.zeros(len(u)), u.copy()
    for k in range(1, m):
        i = start[:active[k]] + k
        p0, p1 = a0[i - 1], a1[i - 1]
        a0[i] = _log_add(p0 + t[0, 0], p1 + t[1, 0])
        a1[i] += _log_add(p0 + t[0, 1], p1 + t[1, 1])
    b0, b1 = np.zeros(len(u)), np.zeros(len(u))
    for k in range(m - 1, 0, -1):
        i = start[:active[k]] + k
        n0, n1 = b0[i], b1[i] + u[i]
        b0[i - 1] = _log_add(n0 + t[0, 0], n1 + t[0, 1])
        b1[i - 1] = _log_add(n0 + t[1, 0], n1 + t[1, 1])
    odds = a1 + b1 - a0 - b0
    if not pairs:
        return odds
    last = first[1:] - 1
    z = _log_add(a0[last], a1[last])
    inner = np.ones(len(u), bool)
    inner[first[:-1]] = False
    i = np.flatnonzero(inner)
    zz = np.repeat(z, np.diff(first))[i]
    expected = np.zeros((2, 2))
    for x, a in enumerate((a0, a1)):
        for y, (b, e) in enumerate(((b0, 0.0), (b1, u))):
            expected[x, y] = np.exp(a[i - 1] + t[x, y] + b[i] + (e[i] if y else 0.0) - zz).sum()
    return odds, expected, z


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -700, 700)))


def document_quality(odds: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities to be good, weighted by their lengths, as log odds."""
    w = np.maximum(size, 1).astype(np.float64)
    good = np.add.reduceat(_sigmoid(odds) * w, first[:-1]) / np.add.reduceat(w, first[:-1])
    bad = np.add.reduceat(_sigmoid(-odds) * w, first[:-1]) / np.add.reduceat(w, first[:-1])
    return np.log(np.maximum(good, 1e-300)) - np.log(np.maximum(bad, 1e-300))


def fit(x: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict:
    """Weights, transitions and the final curve, from lines with their texts' labels."""
    feats = with_neighbours(x, first)
    y = np.repeat(label, np.diff(first)).astype(np.float64)
    # all lines of a text have its label, so the observed transitions stay within a label
    steps = np.diff(first) - 1
    seen = np.array([[steps[label == 0].sum(), 0.0], [0.0, steps[label == 1].sum()]])
    w, t = np.zeros(feats.shape[1]), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    n = len(y)
    for r in range(1, ROUNDS + 1):
        odds, expected, _ = forward_backward(feats @ w, first, t, pairs=True)
        gw = feats.T @ (y - _sigmoid(odds)) / n - RIDGE * w
        gt = (seen - expected) / n - RIDGE * t
        for p, g, a, b in ((w, gw, 0, 1), (t, gt, 2, 3)):  # Adam
            state[a] = 0.9 * state[a] + 0.1 * g
            state[b] = 0.999 * state[b] + 0.001 * g * g
            p += RATE * (1 - 0.5 * r / ROUNDS) * (state[a] / (1 - 0.9 ** r)) / (np.sqrt(state[b] / (1 - 0.999 ** r)) + 1e-8)
    q = np.clip(document_quality(forward_backward(feats @ w, first, t), size, first), -30, 30)
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's steps of a logistic fit with a light ridge
        p = _sigmoid(slope * q + shift)
        v = p * (1 - p) + 1e-6
        g = np.array([((label - p) * q).sum() - 1e-2 * (slope - 1), (label - p).sum() - 1e-2 * shift])
        h = np.array([[(v * q * q).sum() + 1e-2, (v * q).sum()], [(v * q).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        slope, shift = slope + np.clip(step[0], -0.5, 0.5), shift + np.clip(step[1], -0.5, 0.5)
    return {"w": w, "t": t, "slope": max(float(slope), 1e-3), "shift": float(shift)}


def score_texts(buf: np.ndarray, off: np.ndarray, model: dict) -> np.ndarray:
    out = []
    for i, j in chunks(off):
        x, size, first = line_features(buf[off[i]:off[j]], off[i:j + 1] - off[i])
        odds = forward_backward(with_neighbours(x, first) @ model["w"], first, model["t"])
        out.append(_sigmoid(model["slope"] * np.clip(document_quality(odds, size, first), -30, 30) + model["shift"]))
    return np.concatenate(out) if out else np.zeros(0)


def held_out(id_col: Column) -> Column:
    """Rows that are never trained on: crc32 of the id as text leaves 2, divided by 4."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """Fits the model; labels: doc_id, quality (0 or 1; others are not used).

    Ids with both labels, null ids and held-out ids are left out.  Without rows of both labels
    every text gets the score of the commoner label's side, 0.5 without any."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("_q"), F.max("quality").alias("_q2")).where("_q = _q2")
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs).select(F.col("doc_id").alias("_i"), "_q"))

    def lines(batches):
        for b in batches:
            buf, off = text_buffer(b.column("_t"))
            label = b.column("_q").to_pylist()
            for i, j in chunks(off):
                x, size, first = line_features(buf[off[i]:off[j]], off[i:j + 1] - off[i])
                yield pa.RecordBatch.from_pydict({
                    "q": pa.array(label[i:j], pa.int32()),
                    "x": pa.array([x[first[k]:first[k + 1]].astype(np.float32).tobytes() for k in range(j - i)], pa.binary()),
                    "size": pa.array([size[first[k]:first[k + 1]].astype(np.int64).tobytes() for k in range(j - i)], pa.binary())})

    # the sample is bounded by its parameter, so it may be sent to all executors
    rows = (docs.select(F.col("doc_id").alias("_d"), F.col("text").cast("string").alias("_t"))
            .where(F.coalesce(F.octet_length("_t"), F.lit(0)) <= TRAIN_BYTES)
            .join(F.broadcast(known), F.col("_d") == F.col("_i")).select("_t", "_q")
            .mapInArrow(lines, "q int, x binary, size binary").collect())
    label = np.array([r.q for r in rows], np.int64)
    if len(set(label.tolist())) < 2:
        return {"w": np.zeros(3 * FEATURES), "t": np.zeros((2, 2)), "slope": 1.0,
                "shift": 0.0 if not len(label) else 3.0 * (2 * int(label[0]) - 1)}
    order = sorted(range(len(rows)), key=lambda k: (rows[k].size, rows[k].x))  # whatever order the tasks ended in
    x = [np.frombuffer(rows[k].x, np.float32).reshape(-1, FEATURES).astype(np.float64) for k in order]
    first = np.concatenate([[0], np.cumsum([len(v) for v in x])])
    return fit(np.concatenate(x), np.concatenate([np.frombuffer(rows[k].size, np.int64) for k in order]), first, label[order])


def score_documents(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row of ``docs``: the whole text counts.

    Nulls and odd input: a null text counts as an empty one, which is one empty line and has a score
    too; null and repeated ids are kept row by row.  An empty table gives no rows.  Other columns
    (language, source, labels) are not read, whatever their names."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(score_texts(*text_buffer(b.column("_t")), model))],
                                             names=["_id", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def quality_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Stage of the pipeline: the rows of ``docs``, as they are, with a score of at least
    ``threshold``."""
    model = train(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        release_state()
        for b in batches:
            yield b.filter(pa.array(score_texts(*text_buffer(b.column(at)), model) >= threshold))

    return docs.mapInArrow(run, docs.schema)
