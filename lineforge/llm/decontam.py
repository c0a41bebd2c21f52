"""Benchmark decontamination by latent semantic retrieval.

Words, in lower case, are hashed to ``FEATURES`` features; passages of 48 words of all documents give the inverse
passage frequencies.  Benchmark items, cut into passages, are dealt into blocks; the TF-IDF matrix
of each block gets a randomised SVD (range finder with power steps), the blocks in parallel in
Spark tasks.  A block is small enough for its latent space to keep nearly all of its passages, so
retrieval does not depend on how many items there are.

Documents are read in windows of 32 words, 16 apart, folded into the latent space and held against
the block's passages by cosine, over the window's full norm.  A candidate is checked word by word:
the longest common subsequence with the words around the window, as a share of the passage.  A high
share is a copy; a middling one is a paraphrase only if the answer, the end of the item, is there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialise, table, text_buffer, worker_state
from .textvec import SPACE, word_hashes

FEATURES = 1 << 17
PASSAGE = 48                    # words of a passage, at most
WINDOW, STRIDE = 32, 16         # words of a window, and of the blocks that windows are made of
MIN_WORDS = 8                   # items with fewer words cannot be told from chance
IN_BLOCK = 192                  # passages of a block, about
ENERGY = 0.999                  # of a block's matrix that its latent space keeps
COSINE = 0.15                   # measured, not a bound: paraphrases at the least share, with new words, lie above it
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
MODELS_AT_ONCE = 8              # blocks that one pass over the documents holds

# words end at white space and at ASCII marks: punctuation does not count
BREAKS = SPACE.copy()
BREAKS[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def features_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - FEATURES.bit_length() + 1)).astype(np.int64)


def _texts(batches, column: str):
    """(batch, first row, word hashes, their rows from that row on, number of rows) of each chunk."""
    for b in batches:
        buf, off = text_buffer(b.column(column))
        for i, j in chunks(off, 1 << 20):
            h, row, _ = word_hashes(buf[off[i]:off[j]], off[i:j + 1] - off[i], BREAKS)
            yield b, i, h, row, j - i


def _place(row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each word's place in its row, and the first word of each row (rows + 1)."""
    first = np.searchsorted(row, np.arange(rows + 1))
    return np.arange(len(row)) - first[row], first


def passage_frequencies(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log(passages / passages with the feature), smoothed, for each feature, over all documents."""
    def count(batches):
        seen, n = np.zeros(FEATURES, np.int64), 0
        for _, _, h, row, rows in _texts(batches, "_t"):
            place, _ = _place(row, rows)
            part = np.cumsum(np.concatenate([[0], ((np.diff(row) != 0) | (place[1:] % PASSAGE == 0)).astype(np.int64)]))[:len(row)]
            if len(part):
                n += int(part[-1]) + 1
                # a chunk has a few thousand passages, so passage and feature fit 32 bits
                kind = np.int32 if (int(part[-1]) + 1) * FEATURES < 2 ** 31 else np.int64
                pair = np.sort((part * FEATURES + features_of(h)).astype(kind))
                once = np.append(True, pair[1:] != pair[:-1])
                seen += np.bincount(pair[once] % FEATURES, minlength=FEATURES)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"f": np.append(some, -1), "n": np.append(seen[some], n)})

    rows = (docs.select(F.lower(F.col(text_col).cast("string")).alias("_t")).mapInArrow(count, "f long, n long")
            .groupBy("f").agg(F.sum("n").alias("n")).collect())  # FEATURES rows at most, whatever the input
    out, total = np.zeros(FEATURES), 0
    for r in rows:
        if r.f < 0:
            total = r.n
        else:
            out[r.f] = r.n
    return np.log((total + 1.0) / (out + 1.0)).astype(np.float32) + np.float32(0.05)


def _cut(words: int) -> list[tuple[int, int]]:
    """An item's passages: equal parts of at most PASSAGE words."""
    parts = -(-words // PASSAGE)
    return [(words * k // parts, words * (k + 1) // parts) for k in range(parts)]


def randomised_svd(a: np.ndarray, rank: int, rng, over: int = 8, steps: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors) of a matrix: a random range, sharpened by power
    steps, then the exact SVD of the matrix projected on it."""
    q = a.T @ rng.standard_normal((a.shape[0], min(rank + over, a.shape[0])))
    for _ in range(steps):
        q, _ = np.linalg.qr(q)
        q = a.T @ (a @ q)
    q, _ = np.linalg.qr(q)
    _, s, vt = np.linalg.svd(a @ q, full_matrices=False)
    return s[:rank], (vt @ q.T)[:rank]


def latent_blocks(benchmark: DataFrame, idf: np.ndarray, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row a block of benchmark passages: its model, packed (bounded by IN_BLOCK, whatever the
    number of items).

    Items with fewer than MIN_WORDS words, null and empty ones among them, are left out."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item"), F.lower(F.col(text_col).cast("string")).alias("_t"))

    def passages(batches):
        for b, i, h, row, rows in _texts(batches, "_t"):
            _, first = _place(row, rows)
            out = []
            for k in range(rows):
                words = h[first[k]:first[k + 1]]
                if len(words) < MIN_WORDS:
                    continue
                end = words[-max(3, len(words) // 4):]
                for x, y in _cut(len(words)):
                    out.append((b.column("item")[i + k].as_py(), words[x:y].tobytes(), end.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()),
                                                  *[pa.array([o[z] for o in out], pa.binary()) for z in (1, 2)]],
                                                 names=["item", "words", "answer"])

    cut = materialise(items.mapInArrow(passages, "item long, words binary, answer binary"), "passages")
    blocks = max(1, -(-cut.count() // IN_BLOCK))

    def model(key, t):
        import pickle

        t = t.sort_by([("words", "ascending"), ("item", "ascending")])
        words = [np.frombuffer(x, np.uint64) for x in t.column("words").to_pylist()]
        feats = [features_of(x) for x in words]
        vocab = np.unique(np.concatenate(feats))
        a = np.zeros((len(words), len(vocab)))
        for k, f in enumerate(feats):
            np.add.at(a[k], np.searchsorted(vocab, f), 1.0)
        a *= idf[vocab]
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        s, vt = randomised_svd(a, min(a.shape), np.random.default_rng(key[0].as_py() + 1))
        energy = np.cumsum(s ** 2) / (a ** 2).sum()
        keep = min(len(s), int(np.searchsorted(energy, ENERGY)) + 1)
        vt = vt[:keep]
        z = a @ vt.T
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
        packed = pickle.dumps({"vocab": vocab, "v": np.ascontiguousarray(vt.T * idf[vocab][:, None], np.float32),
                               "z": z.astype(np.float32), "words": words, "item": t.column("item").to_pylist(),
                               "answer": [np.frombuffer(x, np.uint64) for x in t.column("answer").to_pylist()]})
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "model": pa.array([packed], pa.binary())})

    keyed = cut.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    return materialise(keyed.groupBy("block").applyInArrow(model, "block long, model binary"), "latent")


def common_subsequence(masks: dict[int, int], n: int, words) -> int:
    """Length of the longest common subsequence of ``words`` and a passage of n words, whose places
    ``masks`` has as bits, word by word (bit-parallel)."""
    full = (1 << n) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


class Matcher:
    """Finds a block's passages in the words of many texts."""

    def __init__(self, packed: bytes, idf: np.ndarray):
        import pickle

        m = pickle.loads(packed)
        self.idf = idf
        self.v, self.z, self.words, self.item, self.answer = m["v"], m["z"], m["words"], m["item"], m["answer"]
        self.at = np.full(FEATURES, -1, np.int32)
        self.at[m["vocab"]] = np.arange(len(m["vocab"]))
        self.masks = [_masks(w) for w in self.words]
        self.ends = [_masks(w) for w in self.answer]

    def candidates(self, h: np.ndarray, row: np.ndarray, rows: int, cosine: float = COSINE):
        """(row, first word, word after the last, passage) of windows and passages that are close."""
        if not len(h):
            return
        f = features_of(h)
        place, first = _place(row, rows)
        w = self.idf[f].astype(np.float64)
        at = self.at[f]
        block = np.cumsum(np.concatenate([[0], ((np.diff(row) != 0) | (place[1:] % STRIDE == 0)).astype(np.int64)]))
        starts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
        of = row[starts]
        n = len(starts)
        span = WINDOW // STRIDE
        # a window: blocks from k on, as many as the text has, up to span
        wide = np.minimum(np.searchsorted(of, of, side="right"), np.arange(n) + span)
        lead = np.searchsorted(of, of, side="left")
        use = (wide - np.arange(n) == span) | (np.arange(n) == lead)  # none that is only the rest of another
        power = np.concatenate([[0], np.cumsum(np.add.reduceat(w * w, starts))])
        mine = np.concatenate([[0], np.cumsum(np.add.reduceat(np.where(at >= 0, w * w, 0), starts))])
        k = np.flatnonzero(use)
        total, own = power[wide[k]] - power[k], mine[wide[k]] - mine[k]
        k = k[own >= cosine * cosine * total]  # else no passage can be that close
        if not len(k):
            return
        need = np.zeros(n, bool)
        for d in range(span):
            b = k + d
            need[b[b < wide[k]]] = True
        word = np.flatnonzero((at >= 0) & need[block])
        z = np.zeros((n, self.v.shape[1]), np.float32)
        if len(word):
            b = block[word]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1])
            nth = np.arange(len(b)) - np.repeat(cut, np.diff(np.append(cut, len(b))))
            for j in range(STRIDE):  # the jth such word of every block: no block twice
                x = np.flatnonzero(nth == j)
                z[b[x]] += self.v[at[word[x]]]
        last = np.append(starts, len(h))
        for a in range(0, len(k), 4096):
            kk = k[a:a + 4096]
            x = np.zeros((len(kk), z.shape[1]), np.float32)
            for d in range(span):
                b = np.minimum(kk + d, n - 1)
                x += np.where((kk + d < wide[kk])[:, None], z[b], 0)
            # full norm: repeats of a word in the window count once each, which can only raise the cosine
            cos = x @ self.z.T / np.sqrt(power[wide[kk]] - power[kk] + 1e-12)[:, None].astype(np.float32)
            for i, p in zip(*np.nonzero(cos >= cosine)):
                yield int(of[kk[i]]), int(last[kk[i]]), int(last[wide[kk[i]]]), int(p)

    def matches(self, h: np.ndarray, row: np.ndarray, rows: int) -> dict[int, dict[int, float]]:
        """row -> {item: highest share of a passage of it} of what holds."""
        first = np.searchsorted(row, np.arange(rows + 1))
        found: dict[int, dict[int, float]] = {}
        for r, a, b, p in self.candidates(h, row, rows):
            n = len(self.words[p])
            words = h[max(first[r], a - n):min(first[r + 1], b + n)].tolist()
            masks = self.masks[p]
            if len(masks.keys() & set(words)) < len(masks) - (1 - PARAPHRASE) * n:
                continue  # too many words are missing, in whatever order
            share = common_subsequence(masks, n, words) / n
            if share >= PARAPHRASE and share < COPY:
                end = len(self.answer[p])
                if common_subsequence(self.ends[p], end, words) < ANSWER * end:
                    continue
            elif share < PARAPHRASE:
                continue
            held = found.setdefault(r, {})
            held[self.item[p]] = max(held.get(self.item[p], 0.0), share)
        return found


def _matchers_of(shared) -> list[Matcher]:
    def build():
        models, idf = shared[1].value
        return [Matcher(m, idf) for m in models]
    return worker_state(shared[0], build)


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "item_id") -> DataFrame:
    """``docs`` with _lf_matches: the benchmark items (item, share) that are found in each text.

    Nulls and odd input: null and empty texts have no matches; so has every text if the benchmark
    is empty or has short items only; equal items are all reported; null item ids are reported as
    null; rows are kept as they are, whatever their ids and columns.  An empty table gives no rows."""
    from uuid import uuid4

    sc = docs.sparkSession.sparkContext
    idf = passage_frequencies(docs, text_col)
    blocks = latent_blocks(benchmark, idf, id_col)
    keys = sorted(r.block for r in blocks.select("block").collect())  # one number a block of items
    lower = F.lower(F.col(text_col).cast("string"))
    out = docs.withColumn("_lf_lower", lower).withColumn("_lf_matches", F.array().cast("array<struct<item:bigint,share:double>>"))
    for g in range(0, len(keys), MODELS_AT_ONCE):
        some = keys[g:g + MODELS_AT_ONCE]
        models = [r.model for r in blocks.where(F.col("block").isin(some)).orderBy("block").collect()]
        shared = (uuid4().hex, sc.broadcast((models, idf)))  # bounded: MODELS_AT_ONCE blocks, FEATURES numbers

        def run(batches, shared=shared):
            matchers = _matchers_of(shared)
            for b in batches:
                buf, off = text_buffer(b.column(b.num_columns - 2))
                old = b.column(b.num_columns - 1).to_pylist()
                for i, j in chunks(off, 1 << 20):
                    h, row, _ = word_hashes(buf[off[i]:off[j]], off[i:j + 1] - off[i], BREAKS)
                    for m in matchers:
                        for r, held in m.matches(h, row, j - i).items():
                            for x in old[i + r]:
                                held[x["item"]] = max(x["share"], held.get(x["item"], 0.0))
                            old[i + r] = [{"item": x, "share": s} for x, s in sorted(
                                held.items(), key=lambda y: (y[0] is None, y[0] or 0))]
                new = pa.array(old, pa.list_(pa.struct([("item", pa.int64()), ("share", pa.float64())])))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], new], names=b.schema.names)

        out = out.mapInArrow(run, out.schema)
        if g and (g // MODELS_AT_ONCE) % 4 == 0:
            out = materialise(out, "matched")
    return out.drop("_lf_lower")


def _best(matches):
    return F.sort_array(F.array_distinct(F.transform(matches, lambda m: m["item"])))


def decontam_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_matches(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("_lf_matches") > 0).alias("contaminated"), _best("_lf_matches").alias("items"),
                      F.array_max(F.transform("_lf_matches", lambda m: m["share"])).alias("highest_share"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Stage of the pipeline: the rows of ``docs``, as they are, that hold no benchmark item."""
    return with_matches(docs, benchmark).where(F.size("_lf_matches") == 0).drop("_lf_matches")
