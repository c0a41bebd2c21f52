import itertools
import zlib

import numpy as np
import pyarrow as pa

from lineforge.llm import quality_crf as crf
from lineforge.llm.common import text_buffer


def buffers(texts):
    return text_buffer(pa.array(texts, pa.string()))


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    first = np.array([0, 1, 5, 7])
    u, t = rng.normal(size=7), rng.normal(size=(2, 2))
    odds, expected, z = crf.forward_backward(u, first, t, pairs=True)
    want = np.zeros((2, 2))
    for d in range(3):
        v = u[first[d]:first[d + 1]]
        total, good, steps = 0.0, np.zeros(len(v)), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=len(v)):
            s = np.exp(sum(a for a, b in zip(v, y) if b) + sum(t[a, b] for a, b in zip(y, y[1:])))
            total += s
            good += s * np.array(y)
            for a, b in zip(y, y[1:]):
                steps[a, b] += s
        p = good / total
        assert np.allclose(odds[first[d]:first[d + 1]], np.log(p / (1 - p)))
        assert np.isclose(z[d], np.log(total))
        want += steps / total
    assert np.allclose(expected, want)


def test_lines_of_texts():
    texts = ["a b\n\nC c|", "", "\n", "x", "", "é ü"]
    x, size, first = crf.line_features(*buffers(texts))
    assert first.tolist() == [0, 3, 4, 6, 7, 8, 9]
    lines = [ln for t in texts for ln in t.split("\n")]
    assert size.tolist() == [len(ln.encode()) for ln in lines]
    assert np.allclose(np.expm1(x[:, 1] * 4), [len(ln.split()) for ln in lines])


def test_held_out_quality(spark, sf):
    big = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in crf.quality_query(spark, big).collect()}
    assert len(out) == spark.read.parquet(f"{big}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .7) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in out.items())
    rows = [(r.quality, out[r.doc_id]) for r in spark.read.parquet(f"{big}/labels.parquet").collect() if out[r.doc_id].held_out]
    good, bad = [r.score for q, r in rows if q], [r.score for q, r in rows if not q]
    auc = np.mean([(g > b) + .5 * (g == b) for g in good for b in bad])
    assert auc > .99 and np.mean([s >= .7 for s in good]) > .99 and np.mean([s >= .7 for s in bad]) < .1


def test_scores_do_not_depend_on_other_columns_or_neighbours(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = crf.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [(1, None), (1, ""), (None, "Some text here, it is fine.\nAnd more of it."), (2, "x " * 500_000), (3, "\n" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'fr' as lang", "1 as score", "0 as quality")
    one = crf.score_documents(df, model).collect()
    assert len(one) == 5 and all(0 <= r.score <= 1 for r in one)
    assert crf.score_documents(df.limit(0), model).count() == 0
    kept = crf.good_documents(docs.withColumnRenamed("source", "score"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert kept.columns == ["doc_id", "text", "lang", "score", "n_chars"]
    want = {r.doc_id for r in crf.quality_query(spark, sf).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == want


def test_labels_of_one_kind_or_none(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b")], "doc_id long, text string")
    lab = spark.createDataFrame([(1, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > .9 for r in crf.score_documents(df, crf.train(df, lab)).collect())
    assert all(r.score == .5 for r in crf.score_documents(df, crf.train(df, lab.limit(0))).collect())
