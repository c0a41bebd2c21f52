"""MinHash near-duplicates with odd sketches.

Texts with the same shingle set are one class.  128 MinHash values a class, in 32 bands of 4, put
classes into buckets; a pair above a similarity of 0.8 misses all bands with a probability under
1e-7.  Another MinHash sample (the smallest hash in each of 1,024 bins) is folded into an odd
sketch: each sampled value flips one of 2,048 parity bits, so the population count of the XOR of two
sketches estimates how many samples differ, and with it a high similarity precisely (standard
error under 0.015).  Pairs whose estimate is not clearly below the threshold are confirmed on their
full shingle sets.

No bucket is expanded into its pairs.  Every member is first held against its bucket's smallest
member; confirmed links give components; then only pairs across components are left, which blocks
of members find by sketch, the likeliest of each member first, then all of them.  So a group of
thousands of copies costs its members, not their square, and no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, components, materialise, table, text_buffer
from .textvec import mix, shingles, word_hashes

BANDS, ROWS = 32, 4
SKETCH_BITS, BINS = 2048, 1024
MARGIN = 0.06        # of the estimate below the threshold: over 4 standard errors
BLOCK = 256          # members held against each other at a time
FIRST_TRIES = 4      # of a member with each other component of a block, in the first round

_rng = np.random.default_rng(20240917)
_A = _rng.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


def _sets(column: pa.Array, words: int):
    """Chunks of rows: (first row, shingle hashes, bounds)."""
    buf, off = text_buffer(column)
    for i, j in chunks(off):
        o = off[i:j + 1] - off[i]
        h, row, _ = word_hashes(buf[off[i]:off[j]], o)
        yield i, *shingles(h, row, words, j - i)


def _signature(u: np.ndarray, bounds: np.ndarray):
    """Of each row: set size, set hash (two longs), band keys, odd sketch with bin occupancy."""
    n = np.diff(bounds)
    rows, full = len(n), np.flatnonzero(n)
    at, of = bounds[:-1][full], np.repeat(np.arange(rows), n)
    hi, lo = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    keys = np.zeros((rows, BANDS), np.uint64)
    if len(full):
        hi[full] = np.add.reduceat(mix(u ^ np.uint64(0x243F6A8885A308D3)), at)
        lo[full] = np.add.reduceat(mix(u + np.uint64(0x13198A2E03707344)), at)
        h = (u >> np.uint64(16)).astype(np.uint32)
        for band in range(BANDS):
            k = np.full(len(full), band + 1, np.uint64)
            for r in range(band * ROWS, (band + 1) * ROWS):
                k = mix(k * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * _A[r] + _B[r], at))
            keys[full, band] = k
    slot = (u >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64) + of * BINS
    sampled = np.empty(len(u), bool)  # hashes are sorted: the first of a bin is its smallest
    if len(u):
        sampled[0] = True
        sampled[1:] = slot[1:] != slot[:-1]
    bit = (mix(u[sampled]) % np.uint64(SKETCH_BITS)).astype(np.int64) + of[sampled] * SKETCH_BITS
    odd = (np.bincount(bit, minlength=rows * SKETCH_BITS) & 1).astype(np.uint8).reshape(rows, -1)
    taken = np.zeros(rows * BINS, np.uint8)
    taken[slot] = 1
    sketch = np.concatenate([np.packbits(odd, axis=1), np.packbits(taken.reshape(rows, -1), axis=1)], axis=1)
    return n, hi.view(np.int64), lo.view(np.int64), keys.view(np.int64), sketch


def _estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity by the sketches (…, bytes) of two arrays that broadcast."""
    cut = SKETCH_BITS // 8
    ones = lambda t: np.bitwise_count(t).sum(-1, dtype=np.int64)
    z = ones(x[..., :cut] ^ y[..., :cut])
    differ = -SKETCH_BITS / 2 * np.log(np.maximum(1 - 2 * z / SKETCH_BITS, 1e-9))
    same = (ones(x[..., cut:]) + ones(y[..., cut:]) - differ) / 2
    return same / np.maximum(ones(x[..., cut:] | y[..., cut:]), 1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


WIDTH = (SKETCH_BITS + BINS) // 8


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the similarity."""
    def check(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("_x").to_pylist(), b.column("_y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield b.filter(pa.array(keep, pa.bool_())).select(["u", "v"])

    one = sets.select(F.col("_id").alias("u"), F.col("_set").alias("_x"))
    two = sets.select(F.col("_id").alias("v"), F.col("_set").alias("_y"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "_x", "_y").mapInArrow(check, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Documents are linked where ``den * |A and B| >= num * |A or B|`` for their sets of distinct
    ``words``-word shingles; component_id is the smallest id that links reach.

    Nulls and odd input: a null or blank text has an empty set (n_shingles 0) and no links; a null
    id takes no part in links and gets a null component_id; rows that share an id are one document
    with several texts, linked where any of them is.  An empty table gives an empty result.  Other
    columns are not read, whatever their names.
    """
    threshold = num / den
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))

    def sign(batches):
        for b in batches:
            for i, u, bounds in _sets(b.column("_t"), words):
                n, hi, lo, keys, sketch = _signature(u, bounds)
                yield pa.RecordBatch.from_arrays([
                    b.column("_id").slice(i, len(n)), pa.array(n, pa.int64()), pa.array(hi), pa.array(lo),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()),
                                             pa.array(keys.ravel())),
                    pa.array([x.tobytes() for x in sketch], pa.binary())],
                    names=["_id", "n", "hi", "lo", "keys", "sketch"])

    signed = materialise(docs.mapInArrow(sign, "_id long, n long, hi long, lo long, keys array<long>, sketch binary"),
                         "signatures")
    # one row a class: texts with the same set are not held against each other
    classes = materialise(signed.where("n > 0 and _id is not null").groupBy("n", "hi", "lo").agg(
        F.min("_id").alias("rep"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")), "classes")
    rows = classes.select("rep", F.explode("keys").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("size")).where("size > 1")
    member = materialise(rows.join(buckets, "key"), "members")  # members of buckets with company

    sketches = classes.select("rep", "sketch")

    def close(batches):
        for b in batches:
            if b.num_rows:
                est = _estimate(_matrix(b.column("s1"), WIDTH), _matrix(b.column("s2"), WIDTH))
                b = b.filter(pa.array(est >= threshold - MARGIN))
            yield b.select(["u", "v"])

    stars = member.where("rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()
    stars = (stars.join(sketches.select(F.col("rep").alias("u"), F.col("sketch").alias("s1")), "u")
             .join(sketches.select(F.col("rep").alias("v"), F.col("sketch").alias("s2")), "v")
             .select("u", "v", "s1", "s2").mapInArrow(close, "u long, v long"))
    stars = materialise(stars.distinct(), "stars")

    def full(batches):
        for b in batches:
            for i, u, bounds in _sets(b.column("_t"), words):
                got = [u[bounds[k]:bounds[k + 1]].tobytes() for k in range(len(bounds) - 1)]
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(i, len(got)), pa.array(got, pa.binary())],
                                                 names=["_id", "_set"])

    def links_of(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("u", "v")).alias("_id")).distinct()
        sets = docs.join(wanted, "_id", "left_semi").mapInArrow(full, "_id long, _set binary").where("length(_set) > 0")
        if pairs.isEmpty():
            return pairs
        sets = materialise(sets, "sets")
        return materialise(_confirmed(pairs, sets, num, den).distinct(), "links")

    links = links_of(stars)
    labels = materialise(components(links), "labels")

    for tries in (FIRST_TRIES, None):
        pairs = materialise(_across(member, classes, labels, threshold, tries), "pairs")
        more = links_of(pairs)
        if more.isEmpty():
            if tries is None or pairs.isEmpty():
                break
            continue
        # links between components: components of the labels, then each node's label's label
        known = labels.withColumnRenamed("node", "n1")
        edge = (more.join(known.select(F.col("n1").alias("u"), F.col("label").alias("lu")), "u", "left")
                .join(known.select(F.col("n1").alias("v"), F.col("label").alias("lv")), "v", "left")
                .select(F.coalesce("lu", "u").alias("u"), F.coalesce("lv", "v").alias("v")))
        up = materialise(components(edge), "uplabels")
        labels = materialise(labels.join(up.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
                             .select("node", F.coalesce("to", "label").alias("label"))
                             .union(up.join(labels.select("node"), "node", "left_anti").select("node", "label")), "labels")

    # rows that share an id are one document: their classes' representatives are linked too
    by_class = (classes.select("n", "hi", "lo", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
                .select("n", "hi", "lo", F.coalesce("label", "rep").alias("component_id")))
    out = signed.select("_id", "n", "hi", "lo").join(by_class, ["n", "hi", "lo"], "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("_id").isNotNull(), F.coalesce("component_id", "_id")).alias("component_id"))


def _across(member: DataFrame, classes: DataFrame, labels: DataFrame, threshold: float, tries: int | None) -> DataFrame:
    """Pairs of a bucket's members in different components whose sketches are close.

    The members outside the bucket's main component, in blocks, meet all members, in blocks; a
    pair is given by the first band that it shares.  ``tries``: of each member with each other
    component of a block only so many, the likeliest; None: all."""
    m = (member.where("size > 2").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
         .select("key", "rep", F.coalesce("label", "rep").alias("label")))
    per = m.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    main = (per.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("size"),
                                   F.max("c").alias("c")).where("c < size"))
    m = (m.join(main, "key")
         .join(classes.select("rep", "keys", "sketch").groupBy("rep").agg(F.first("keys").alias("keys"),
                                                                          F.first("sketch").alias("sketch")), "rep"))
    item = F.struct("rep", "label", "keys", "sketch")
    block = lambda n: F.pmod(F.xxhash64("rep"), F.ceil(n / BLOCK)).alias("block")
    every = m.groupBy("key", block(F.col("size"))).agg(F.collect_list(item).alias("many"))
    minor = (m.where("label <> main").groupBy("key", block(F.col("size") - F.col("c")))
             .agg(F.collect_list(item).alias("few")))
    met = minor.select("key", "few").join(every.select("key", "many"), "key")

    def unpack(x):
        v = x.flatten() if isinstance(x, pa.ChunkedArray) else x.values
        keys = v.field("keys")
        return (v.field("rep").to_numpy(), v.field("label").to_numpy(),
                keys.flatten().to_numpy().reshape(len(v), BANDS), _matrix(v.field("sketch"), WIDTH))

    def meet(batches):
        for b in batches:
            for i in range(b.num_rows):
                key = b.column("key")[i].as_py()
                r1, l1, k1, s1 = unpack(b.column("few").slice(i, 1)[0])
                r2, l2, k2, s2 = unpack(b.column("many").slice(i, 1)[0])
                us, vs = [], []
                for a in range(len(r1)):
                    est = _estimate(s1[a][None, :], s2)
                    near = np.flatnonzero((est >= threshold - MARGIN) & (l2 != l1[a]))
                    if not len(near):
                        continue
                    shared = np.argmax(k2[near] == k1[a][None, :], axis=1)
                    near = near[k2[near, shared] == key]
                    if tries is not None and len(near) > tries:
                        near = near[np.argsort(-est[near], kind="stable")]
                        seen: dict[int, int] = {}
                        held = []
                        for x in near:
                            seen[l2[x]] = seen.get(l2[x], 0) + 1
                            if seen[l2[x]] <= tries:
                                held.append(x)
                        near = np.array(held, np.int64)
                    us.append(np.full(len(near), r1[a]))
                    vs.append(r2[near])
                u = np.concatenate(us) if us else np.zeros(0, np.int64)
                v = np.concatenate(vs) if vs else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v), pa.int64()),
                                                  pa.array(np.minimum(u, v), pa.int64())], names=["u", "v"])

    return met.mapInArrow(meet, "u long, v long").distinct()


def near_dup_query(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document, the one of the smallest id, of each group of near-duplicates.

    All columns are kept as they are.  Rows with a null id or a blank text stay; so do rows that
    repeat the id of a document that stays."""
    found = near_duplicates(docs, words=words, num=num, den=den)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_lf_gone")).distinct()
    gone = materialise(gone, "gone")
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["_lf_gone"], "left_anti")
