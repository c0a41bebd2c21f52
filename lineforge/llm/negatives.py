"""Hard negatives by Four-Russians scoring.

The candidates' integer components are cut into bit planes, and the planes of eight dimensions
packed in bytes.  For each anchor and group of eight dimensions a table holds the sums of all 256
subsets of the anchor's eight components; a candidate's byte is the index of the sum that its plane
adds to the score.  The planes' sums, shifted by their place and added up (the top one is taken off:
two's complement), give the full inner product, exactly.

Anchors and candidates are packed in blocks, which a grid of cells deals out: a cell is a few blocks
of either side, so its memory is bounded; a block is sent to each cell of its row or column.  The
first pass gives each cell's best rows of the anchors' own labels, from which the positives come;
the second each cell's best rows of other labels within the bounds that each positive sets.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

ANCHORS, ROWS = 256, 1024    # of a block
ANCHOR_BLOCKS = 16           # of a cell
CELL_BLOCKS = (8, 1024)      # candidate blocks of a cell: at least, at most
COLUMNS = 64                 # cells that a row of the grid has before the cells grow
MOST_PARTS = 20_000          # of the shuffles that deal out cells
CELL = ("dim", "row", "col")
TILE = 128                   # anchors whose tables are held at a time
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95           # bounds of a negative's score, in hundredths of the positive's
HELD = 2 ** 58               # components beyond it are held to it
PLACE = 24                   # bits of a candidate's place within a cell
SMALL = 2 ** 36              # scores under it are sorted together with their places


def usable(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding",
           label_col: str = "label") -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of each component as a long, one row for each id.

    Rows with a null id, label or vector, an empty vector or one with a component that is null or
    not finite are left out.  Of several rows with one id the one with the smallest label, then
    vector, is taken.  Components beyond 2^58 in size, after scaling, are held to it."""
    c = F.col(vec_col)
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    v = F.transform(c, lambda e: F.floor(F.greatest(F.least(F.lit(float(scale)) * e.cast("double"), F.lit(float(HELD))),
                                                    F.lit(float(-HELD)))).cast("long"))
    kept = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & c.isNotNull() & (F.size(c) > 0) & fine)
    one = (kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
           .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")))
    return one.select("vec_id", "r.label", "r.v")


def bit_planes(mat: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of the two's complement of ``mat`` (rows x dimensions): as many
    planes as its largest component needs, eight dimensions a byte, the first in the lowest bit."""
    rows, dim = mat.shape
    most = max(int(mat.max()), -int(mat.min()) - 1, 0)
    planes = most.bit_length() + 1
    wide = np.zeros((rows, -(-dim // 8) * 8), np.int64)
    wide[:, :dim] = mat
    out = np.empty((planes, wide.shape[1] // 8, rows), np.uint8)
    for p in range(planes):
        out[p] = np.packbits(((wide >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each eight dimensions the sums of all subsets of each anchor's
    components; each table is doubled eight times, by one component after the other."""
    n, dim = anchors.shape
    wide = np.zeros((n, -(-dim // 8) * 8), anchors.dtype)
    wide[:, :dim] = anchors
    out = np.zeros((wide.shape[1] // 8, 256, n), anchors.dtype)
    for g in range(len(out)):
        for k in range(8):
            out[g, 1 << k:2 << k] = out[g, :1 << k] + wide[:, 8 * g + k]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates x anchors) inner products, from the anchors' tables and the candidates' bytes."""
    total = None
    for p in range(len(planes) - 1, -1, -1):
        part = tables[0][planes[p, 0]]
        for g in range(1, len(tables)):
            part += tables[g][planes[p, g]]
        # the top plane counts negative; each next one shifts what is there by one place
        total = -part if total is None else (total << 1) + part if total.dtype != object else total * 2 + part
    return total


def _kind(anchors: np.ndarray, most: int) -> type:
    """The smallest type that holds every sum on the way, for candidates of up to ``most`` in size."""
    bound = int(np.abs(anchors.astype(np.float64)).max(initial=0.0)) * 2 * max(2 * most, 1) * anchors.shape[1]
    return np.int32 if bound < 2 ** 30 else np.int64 if bound < 2 ** 62 else object


def _blocks(rows: DataFrame, size: int, packed: bool, name: str) -> DataFrame:
    """(dim, block, n, ids, labels, most, body): rows of one length in binary columns; body: the bit
    planes of candidates, the components of anchors."""
    def pack(batches):
        held: dict[int, list] = {}

        def out(dim, some):
            ids = np.array([x for x, _, _ in some], np.int64)
            labels = np.array([x for _, x, _ in some], np.int64)
            mat = np.stack([x for _, _, x in some])
            body = (bit_planes(mat) if packed else mat).tobytes()
            mark = int.from_bytes(blake2b(ids.tobytes() + body, digest_size=8).digest(), "little", signed=True)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "block": pa.array([mark], pa.int64()), "n": pa.array([len(ids)], pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()), "labels": pa.array([labels.tobytes()], pa.binary()),
                "most": pa.array([int(np.abs(mat).max())], pa.int64()), "body": pa.array([body], pa.binary())})

        for b in batches:
            v = b.column("v")
            flat, off = v.flatten().to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            off = off - off[0]
            for i, (vid, label) in enumerate(zip(b.column("vec_id").to_pylist(), b.column("label").to_pylist())):
                dim = int(off[i + 1] - off[i])
                some = held.setdefault(dim, [])
                some.append((vid, label, flat[off[i]:off[i + 1]].copy()))
                if len(some) == size:
                    yield out(dim, held.pop(dim))
        for dim, some in held.items():
            yield out(dim, some)

    return materialise(rows.mapInArrow(pack, "dim int, block long, n int, ids binary, labels binary, most long, body binary"), name)


class _Cell:
    """The blocks of a cell, laid out for scoring: candidates in the order of their ids."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table):
        self.anchors = anchors.to_pylist()
        held = candidates.to_pylist()
        self.dim = held[0]["dim"]
        groups = -(-self.dim // 8)
        planes = [np.frombuffer(r["body"], np.uint8).reshape(-1, groups, r["n"]) for r in held]
        most = max(len(p) for p in planes)
        # a shorter block's top plane is its sign: repeated, it means the same numbers
        planes = [p if len(p) == most else np.concatenate([p, np.repeat(p[-1:], most - len(p), axis=0)]) for p in planes]
        ids = np.concatenate([np.frombuffer(r["ids"], np.int64) for r in held])
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.labels = np.concatenate([np.frombuffer(r["labels"], np.int64) for r in held])[order]
        self.planes = np.ascontiguousarray(np.concatenate(planes, axis=2)[:, :, order])
        self.most = max(r["most"] for r in held)

    def tiles(self):
        """(block, first anchor, ids, labels, tables) of a few anchors at a time."""
        for r in self.anchors:
            ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
            mat = np.frombuffer(r["body"], np.int64).reshape(r["n"], self.dim)
            kind = _kind(mat, self.most)
            for a in range(0, r["n"], TILE):
                yield r, a, ids[a:a + TILE], labels[a:a + TILE], subset_sums(mat[a:a + TILE].astype(kind))

    def columns(self, tables: np.ndarray):
        """(places, scores) of a few thousand candidates at a time: anchors x candidates."""
        for c in range(0, len(self.ids), ROWS * 4):
            yield np.arange(c, min(c + ROWS * 4, len(self.ids))), scores(tables, self.planes[:, :, c:c + ROWS * 4]).T


def _best(score: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores and their places; ties to the smaller place."""
    if score.dtype == object or not len(score) or np.abs(score).max() >= SMALL:
        order = sorted(range(len(score)), key=lambda i: (-int(score[i]), place[i]))[:k]
        return score[order], place[order]
    key = (score.astype(np.int64) << PLACE) + ((1 << PLACE) - 1 - place)
    if len(key) > k:
        key = np.partition(key, len(key) - k)[len(key) - k:]
    key = np.sort(key)[::-1]
    return key >> PLACE, (1 << PLACE) - 1 - (key & ((1 << PLACE) - 1))


def _merged(found: list, k: int):
    if len(found) == 1:
        return found[0]
    return _best(np.concatenate([s for s, _ in found]), np.concatenate([p for _, p in found]), k)


def _grid(anchors: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Both sides' blocks with the cells (dim, row, col) that they go to, and the number of cells: as
    a cell's work does not follow its bytes, the number of parts is set and not left to be coalesced."""
    sizes = {r.dim: r.c for r in candidates.groupBy("dim").agg(F.count(F.lit(1)).alias("c")).collect()}
    rows = {r.dim: -(-r.c // ANCHOR_BLOCKS) for r in anchors.groupBy("dim").agg(F.count(F.lit(1)).alias("c")).collect()}
    low, high = CELL_BLOCKS
    grid = [(d, rows[d], -(-c // min(max(low, -(-c // COLUMNS)), high))) for d, c in sizes.items() if d in rows]
    parts = min(max(sum(n * m for _, n, m in grid), 1), MOST_PARTS)
    # three numbers for each length of vectors
    grid = F.broadcast(anchors.sparkSession.createDataFrame(grid, "dim int, n_rows int, n_cols int"))
    own = lambda n: F.pmod(F.col("block"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = anchors.join(grid, "dim").withColumn("row", own("n_rows")).withColumn("col", upto("n_cols"))
    right = candidates.join(grid, "dim").withColumn("col", own("n_cols")).withColumn("row", upto("n_rows"))
    return left.drop("n_rows", "n_cols"), right.drop("n_rows", "n_cols"), parts


def _cells(left: DataFrame, right: DataFrame, parts: int, work, schema: str) -> DataFrame:
    one, two = left.repartition(parts, *CELL), right.repartition(parts, *CELL)
    return one.groupBy(*CELL).cogroup(two.groupBy(*CELL)).applyInArrow(work, schema)


def _rows(schema: pa.Schema, found: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*found), schema)] if found
                                else [pa.array([], f.type) for f in schema], schema=schema)


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` are (vec_id, label, v) of :func:`usable`, with an id at most once each.
    An anchor's positives are the ``positives`` other rows of its label with the highest inner
    products; for each of them, the ``negatives`` highest rows of other labels with
    low * positive <= 100 * negative <= high * positive.  Ties go to the smaller vec_id.  Scores are
    exact at any size, as decimals; vectors of different lengths are not held against each other.
    Empty tables, single rows and labels without other rows give no rows."""
    number = pa.decimal128(38, 0)
    cand = _blocks(rows, ROWS, True, "candidates")
    asked = _blocks(anchors, ANCHORS, False, "anchors")
    left, right, parts = _grid(asked, cand)
    best_schema = pa.schema([("anchor_id", pa.int64()), ("block", pa.int64()), ("dim", pa.int32()), ("vec_id", pa.int64()), ("score", number)])

    def own_label(a: pa.Table, c: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and c.num_rows:
            cell = _Cell(a, c)
            for r, _, ids, labels, tables in cell.tiles():
                found = [[] for _ in ids]
                for place, s in cell.columns(tables):
                    for k in range(len(ids)):
                        ok = np.flatnonzero((cell.labels[place] == labels[k]) & (cell.ids[place] != ids[k]))
                        found[k].append(_best(s[k][ok], place[ok], positives))
                for k, one in enumerate(found):
                    for s, p in zip(*_merged(one, positives)):
                        out.append((int(ids[k]), r["block"], cell.dim, int(cell.ids[p]), int(s)))
        return _rows(best_schema, out)

    best = _cells(left, right, parts, own_label, "anchor_id long, block long, dim int, vec_id long, score decimal(38,0)")
    order = lambda *by: Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id"))
    found = materialise(best.withColumn("rank", F.row_number().over(order("anchor_id"))).where(F.col("rank") <= positives)
                        .select("block", "dim", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                        "positives")
    # the few positives of each of a block's anchors travel with the block
    known = found.groupBy("block", "dim").agg(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score")).alias("known"))
    left = left.join(known, ["block", "dim"])
    mined_schema = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", number), ("vec_id", pa.int64()), ("score", number)])

    def other_label(a: pa.Table, c: pa.Table) -> pa.Table:
        out = []
        if a.num_rows and c.num_rows:
            cell = _Cell(a, c)
            block = None
            for r, _, ids, labels, tables in cell.tiles():
                if r["block"] != block:
                    block, bounds = r["block"], {}
                    for x in r["known"]:
                        p = int(x["positive_score"])
                        bounds.setdefault(x["anchor_id"], []).append((x["positive_id"], p, -(-low * p // 100), high * p // 100))
                found = {}
                for place, s in cell.columns(tables):
                    for k, anchor in enumerate(ids.tolist()):
                        mine = bounds.get(anchor)
                        if not mine:
                            continue
                        least, most = min(x[2] for x in mine), max(x[3] for x in mine)
                        # all bounds of the anchor first: few rows are between them
                        ok = np.flatnonzero((s[k] >= least) & (s[k] <= most) & (cell.labels[place] != labels[k]) & (cell.ids[place] != anchor))
                        if len(ok):
                            t, at = s[k][ok], place[ok]
                            for n, (_, _, lo, hi) in enumerate(mine):
                                within = (t >= lo) & (t <= hi)
                                if within.any():
                                    found.setdefault((anchor, n), []).append(_best(t[within], at[within], negatives))
                for (anchor, n), one in found.items():
                    pid, p = bounds[anchor][n][:2]
                    for s, at in zip(*_merged(one, negatives)):
                        out.append((anchor, pid, p, int(cell.ids[at]), int(s)))
        return _rows(mined_schema, out)

    mined = _cells(left, right, parts, other_label, "anchor_id long, positive_id long, positive_score decimal(38,0), vec_id long, score decimal(38,0)")
    return (mined.withColumn("rank", F.row_number().over(order("anchor_id", "positive_id"))).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def negatives_query(spark, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = materialise(rows.withColumn("label", moved), "labelled")
    out = hard_negatives(rows, rows.where("vec_id % 50 = 0"))
    return out.withColumns({c: F.col(c).cast("long") for c in ("positive_score", "negative_score")})


NEGATIVES_SQL = """
with v as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (
  select a.vec_id as anchor_id, c.vec_id as vec_id, a.label = c.label as same,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v a join v c on a.vec_id % 50 = 0 and c.vec_id <> a.vec_id),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as k from s where same) where k <= 5),
n as (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same
    and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score)
select anchor_id::bigint as anchor_id, positive_id::bigint as positive_id, rank::int as rank, negative_id::bigint as negative_id,
  positive_score, negative_score
from n where rank <= 3
"""
