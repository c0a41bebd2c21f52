"""Exact top-k search by distributed histogram selection.

All candidates are scored against a block of queries at a time, in every cell (a block of queries
and a block of candidates, both bounded).  The scores are not moved: every cell gives, for each of
its queries, the upper end of its histogram over the range that can still hold the kth score, down
to the bin with which its own counts reach k.  Summed over the cells, these tell the bin of the
global kth score; the next round refines that bin, until it is one score wide.  The last pass
filters what is over that score, and of the ties on it what has the smallest ids.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, table

BLOCK = 2048     # vectors of a block
TILE = 256       # queries scored at a time
BINS = 512       # of a round
SPREAD = 16      # ways in which the candidate blocks are dealt for each block of queries
EXACT = 2 ** 53  # up to here doubles hold all integers
MOST = 2 ** 62 - 1  # scores beyond it are held to it, so that a range of scores fits a long
HELD = 2 ** 58


def quantised(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component, as doubles; rows with a null id or vector,
    an empty vector, or a component that is null or not finite are left out.  Components beyond
    2^58 in size, after scaling, are held to it."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(float(HELD))),
                                                                F.lit(float(-HELD)))).cast("double"))
    fine = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(F.col(vec_col)) > 0) & fine
    return rows.where(good).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def _digest(ids: np.ndarray, mat: np.ndarray) -> int:
    return int.from_bytes(blake2b(ids.tobytes() + mat.tobytes(), digest_size=8).digest(), "little", signed=True)


def _blocks(vectors: DataFrame, name: str) -> DataFrame:
    """(dim, block, ids, vecs): vectors of one length packed in binary columns."""
    def pack(batches):
        held: dict[int, list] = {}

        def out(dim, some):
            ids, mat = np.array([x for x, _ in some], np.int64), np.concatenate([y for _, y in some])
            small = np.abs(mat).max() < 2 ** 15
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "block": pa.array([_digest(ids, mat)], pa.int64()),
                "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()),
                "vecs": pa.array([(mat.astype(np.int16) if small else mat).tobytes()], pa.binary())})

        for b in batches:
            v = b.column("v")
            flat, off = v.flatten().to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            off = off - off[0]
            for i, vid in enumerate(b.column("vec_id").to_pylist()):
                dim = int(off[i + 1] - off[i])
                some = held.setdefault(dim, [])
                some.append((vid, flat[off[i]:off[i + 1]].copy()))
                if len(some) == BLOCK:
                    yield out(dim, held.pop(dim))
        for dim, some in held.items():
            yield out(dim, some)

    return materialise(vectors.mapInArrow(pack, "dim int, block long, n int, ids binary, vecs binary"), name)


def _unpacked(ids: bytes, vecs: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    kind = np.int16 if len(vecs) == 2 * len(i) * dim else np.float64
    return i, np.frombuffer(vecs, kind).reshape(len(i), dim).astype(np.float64)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products; exact: doubles while the sums fit them, else Python's integers, held within
    the range of a long."""
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < EXACT:
        return (q @ c.T).astype(np.int64)
    exact = q.astype(np.int64).astype(object) @ c.astype(np.int64).astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for each of ``queries`` its ``k`` highest inner products with
    ``vectors`` (both: vec_id, v), all if there are fewer; ties go to the smaller vec_id.

    A query is not held against rows with its own id, nor against vectors of another length.  A
    query id that is repeated is asked once, with the smallest of its vectors; candidates that
    repeat an id are all held.  Empty tables give no rows.  Scores beyond 2^62 in
    size are held to it, and so tie."""
    cand = _blocks(vectors, "candidates")
    asked = _blocks(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    parts = F.pmod(F.xxhash64("block"), F.lit(SPREAD)).alias("part")
    # each block of queries meets each block of candidates of its length
    left = asked.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("part"),
                        F.col("block").alias("qb"), F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"))
    right = cand.select("dim", parts, F.col("block").alias("cb"), "ids", "vecs")
    cells = materialise(left.join(right, ["dim", "part"]).select("dim", "qb", "qids", "qvecs", "ids", "vecs"), "cells")

    def cell_rows(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(n)[i].as_py() for n in b.schema.names}
                qi, q = _unpacked(r["qids"], r["qvecs"], r["dim"])
                ci, c = _unpacked(r["ids"], r["vecs"], r["dim"])
                yield r, qi, q, ci, c

    def bounds(batches):
        """Each cell's highest and lowest score of each query, and its number of candidates."""
        for r, qi, q, ci, c in cell_rows(batches):
            own = np.array([(ci == x).sum() for x in qi])
            low, high = [], []
            for a in range(0, len(qi), TILE):
                s = _scores(q[a:a + TILE], c)
                low.append(s.min(1)), high.append(s.max(1))
            yield pa.RecordBatch.from_pydict({"qid": qi, "low": np.concatenate(low), "high": np.concatenate(high),
                                              "n": (len(ci) - own).astype(np.int64)})

    spans = (cells.mapInArrow(bounds, "qid long, low long, high long, n long").groupBy("qid")
             .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
             .where("n > 0").select("qid", "low", F.col("high"), F.least(F.col("n"), F.lit(k)).alias("need")))

    def state_of(cells: DataFrame, state: DataFrame) -> DataFrame:
        """The cells with what is known of each of their queries, packed in one column."""
        ids = asked.select(F.col("block").alias("qb"), "ids", "dim")

        def listed(batches):
            for b in batches:
                for i in range(b.num_rows):
                    x = np.frombuffer(b.column("ids")[i].as_py(), np.int64)
                    yield pa.RecordBatch.from_pydict({"qb": np.full(len(x), b.column("qb")[i].as_py()), "qid": x})

        known = (ids.mapInArrow(listed, "qb long, qid long").join(state, "qid")
                 .groupBy("qb").agg(F.collect_list(F.struct("qid", "low", "high", "need")).alias("known")))
        return cells.join(known, "qb")

    def known_of(r, qi):
        got = {x["qid"]: (x["low"], x["high"], x["need"]) for x in r["known"]}
        has = np.array([x in got for x in qi], bool)
        full = np.array([got.get(x, (0, 0, 0)) for x in qi], np.int64).reshape(-1, 3)
        return has, full[:, 0], full[:, 1], full[:, 2]

    def histogram(batches):
        """(qid, bin, count): of the scores within [low, high], the bins from the top on with which
        a cell's count reaches what is needed."""
        for r, qi, q, ci, c in cell_rows(batches):
            has, low, high, need = known_of(r, qi)
            width = _width(low, high)
            rows = []
            for a in range(0, len(qi), TILE):
                s = _scores(q[a:a + TILE], c)
                for j in range(s.shape[0]):
                    x = a + j
                    if not has[x]:
                        continue
                    t = s[j][(s[j] >= low[x]) & (s[j] <= high[x]) & (ci != qi[x])]
                    if len(t) > need[x]:
                        kth = np.partition(t, len(t) - need[x])[len(t) - need[x]]
                        t = t[t >= low[x] + (kth - low[x]) // width[x] * width[x]]
                    if len(t):
                        bins, n = np.unique((t - low[x]) // width[x], return_counts=True)
                        rows.append((np.full(len(bins), qi[x]), bins, n))
            if rows:
                yield pa.RecordBatch.from_pydict({m: np.concatenate([y[z] for y in rows]).astype(np.int64)
                                                  for z, m in enumerate(("qid", "bin", "n"))})

    state = materialise(spans, "range")
    while True:
        open_ = state.where("high > low")
        if open_.isEmpty():
            break
        counts = (state_of(cells, open_).mapInArrow(histogram, "qid long, bin long, n long")
                  .groupBy("qid", "bin").agg(F.sum("n").alias("n")))
        # at most need bins of each cell in a query's list: its bins from the top, summed up
        summed = counts.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct((-F.col("bin")).alias("b"), "n"))).alias("bins"))
        stop = F.aggregate("bins", F.struct(F.lit(0).cast("long").alias("above"), F.lit(None).cast("long").alias("at")),
                           lambda a, x: F.when(a["at"].isNotNull(), a).when(
                               a["above"] + x["n"] >= F.col("need"), F.struct(a["above"].alias("above"), (-x["b"]).alias("at")))
                           .otherwise(F.struct((a["above"] + x["n"]).alias("above"), a["at"].alias("at"))))
        w = F.expr(f"(high - low) div {BINS} + 1")
        refined = (open_.join(summed, "qid").withColumn("s", stop).withColumn("w", w)
                   .select("qid", (F.col("low") + F.col("s.at") * F.col("w")).alias("low"),
                           F.least(F.col("high"), F.col("low") + (F.col("s.at") + 1) * F.col("w") - 1).alias("high"),
                           (F.col("need") - F.col("s.above")).alias("need")))
        state = materialise(refined.unionByName(state.where("high <= low")), "range")

    def chosen(batches):
        """All that is over the kth score; of its ties the smallest ids, as many as are needed."""
        for r, qi, q, ci, c in cell_rows(batches):
            has, kth, _, need = known_of(r, qi)
            rows = []
            for a in range(0, len(qi), TILE):
                s = _scores(q[a:a + TILE], c)
                for j in range(s.shape[0]):
                    x = a + j
                    if not has[x]:
                        continue
                    other = ci != qi[x]
                    over = np.flatnonzero((s[j] > kth[x]) & other)
                    tied = np.flatnonzero((s[j] == kth[x]) & other)
                    tied = tied[np.argsort(ci[tied], kind="stable")[:need[x]]]
                    at = np.concatenate([over, tied])
                    rows.append((np.full(len(at), qi[x]), ci[at], s[j][at]))
            if rows:
                yield pa.RecordBatch.from_pydict({m: np.concatenate([y[z] for y in rows]).astype(np.int64)
                                                  for z, m in enumerate(("query_id", "vec_id", "score"))})

    kept = state_of(cells, state).mapInArrow(chosen, "query_id long, vec_id long, score long")
    best = kept.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def _width(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (high - low) // BINS + 1


def topk_query(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


TOPK_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id::bigint as query_id, rank::int as rank, vec_id::bigint as vec_id, score from r where rank <= 5
"""
