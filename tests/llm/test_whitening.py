import math
import random
from collections import defaultdict

import numpy as np
import pytest

from lineforge.llm import whitening


def brute(vectors):
    """Exact whole numbers, then numpy's eigenvectors."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    far = x * n - s
    deviation = (far * far).sum(1)
    v = ((far.T @ far) / (n * n * n)).astype(np.float64)
    values, vectors = np.linalg.eigh(v)
    return n, deviation, far.astype(np.float64) / n, values[::-1], vectors[:, ::-1], np.trace(v)


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 as dim", "'a' as x", "2 as _id", "3 as n")


def test_query_against_brute_force(spark, sf):
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = sorted(given)
    n, deviation, centred, values, vectors, trace = brute([given[i] for i in ids])
    rows = whitening.whitening_query(spark, sf).collect()
    assert len(rows) == 32 * len(ids) and {r.n for r in rows} == {n}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-10
    got = np.zeros((len(ids), 32))
    place = {i: k for k, i in enumerate(ids)}
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviation[place[r.vec_id]]
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-12 * r.explained + 1e-15
    want = centred @ vectors[:, :32] / np.sqrt(values[:32])
    signs = np.sign((got * want).sum(0))
    assert np.abs(got * signs - want).max() < 1e-7


def test_factor_and_rotations():
    rnd = np.random.default_rng(1)
    for d, r in ((1, 1), (5, 5), (12, 4), (33, 33)):
        a = rnd.normal(size=(d, r)) * np.logspace(0, -6, r)
        v = a @ a.T
        low = whitening.pivoted_cholesky(v)
        assert np.abs(low @ low.T - v).max() < 1e-14 * np.abs(v).max() * d
        turned = whitening.one_sided_jacobi(low)
        gram = turned.T @ turned
        size = np.sqrt(np.diag(gram))
        assert np.abs(gram - np.diag(np.diag(gram)))[size > 0][:, size > 0].max(initial=0.0) <= 1e-13 * gram.max()
        values, vectors = whitening.principal(v, d)
        assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:len(values)], rtol=1e-9, atol=1e-14 * np.abs(v).max())
        assert np.allclose(v @ vectors, vectors * values, atol=1e-13 * np.abs(v).max() * d)
    assert whitening.principal(np.zeros((4, 4)))[0].size == 0


def test_offset_and_small_spread_lose_nothing(spark):
    """Entries of a spread of one unit on the shift of a million."""
    rnd = random.Random(8)
    rows = [(i, [rnd.choice([0.0, 1 / 64]) + 1000.0 * k for k in range(4)]) for i in range(500)]
    out, models = whitening.whiten(frame(spark, rows).repartition(7))
    _, _, _, values, _, trace = brute([v for _, v in rows])
    assert np.allclose(models[4]["values"], values, rtol=1e-13) and abs(models[4]["trace"] - trace) < 1e-13 * trace


def test_lengths_nulls_equal_rows_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (None, [3.0, 5.0]),
            (7, [9.0]), (8, [9.0]), (9, [1.0, 0.0, 0.0])]
    out, models = whitening.whiten(frame(spark, rows))
    got = {(r.vec_id, r.dim): r for r in out.collect()}
    assert sorted(got, key=str) == sorted([(6, 2), (None, 2), (7, 1), (8, 1), (9, 3)], key=str) and out.count() == 6
    assert got[7, 1].whitened == [] and got[9, 3].whitened == []          # nothing varies
    assert len(got[6, 2].whitened) == 1 and models[2]["n"] == 3           # two entries that vary together
    assert [r.dim for r in whitening.identity_errors(out).collect()] == [2]
    empty, none = whitening.whiten(frame(spark, rows).limit(0))
    assert empty.count() == 0 and none == {}


@pytest.mark.parametrize("top", [1e6, 1e12, 1e17, 1e300])
def test_large_numbers(spark, top):
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(-top, top), rnd.uniform(-1, 1), float(rnd.randint(-5, 5))]) for i in range(60)]
    out, models = whitening.whiten(frame(spark, rows))
    got = out.collect()
    assert len(got) == 60
    held = [[max(min(64 * c, 2.0 ** 61), -2.0 ** 61) / 64 for c in v] for _, v in rows]
    _, deviation, _, values, _, _ = brute(held)
    assert np.allclose(models[3]["values"][0], values[0], rtol=1e-9)
    for r in got:
        want = deviation[r.vec_id]
        assert r.deviation == (want if want < 2 ** 63 else None)


def test_query_on_the_shape_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = whitening.whitening_query(spark, str(tmp_path))
    assert rows.count() == 0 and defaultdict(str, rows.dtypes)["deviation"] == "bigint"
