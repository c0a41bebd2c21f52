import math
import random

import numpy as np
import pytest

from lineforge.llm import negatives as N


def brute(rows, is_anchor, positives=5, most=3):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [max(min(math.floor(256 * x), N.HELD), -N.HELD) for x in v])
        kept[i] = min(kept.get(i, row), row)
    out = []
    for a, (label, v) in kept.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, (k, w) in kept.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            ok = [(t, n) for t, n, k in scored if k != label and 50 * -s <= 100 * -t <= 95 * -s][:most]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n) in enumerate(ok)]
    return sorted(out)


def got(spark, rows, step=50, parts=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as v", "2 as score", "3 as block")
    v = N.usable(df.repartition(parts))
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, int(r.positive_score), int(r.negative_score))
                  for r in N.hard_negatives(v, v.where(f"vec_id % {step} = 0")).collect())


def test_scores_are_inner_products():
    rnd = np.random.default_rng(2)
    for dim in (1, 7, 8, 9, 64):
        for size in (1, 200, 10 ** 6, 2 ** 57):
            c, a = rnd.integers(-size, size + 1, (50, dim)), rnd.integers(-size, size + 1, (9, dim))
            want = c.astype(object) @ a.astype(object).T
            kind = N._kind(a, int(np.abs(c).max()))
            assert (N.scores(N.subset_sums(a.astype(kind)), N.bit_planes(c)) == want).all()
    for edge in (-1, 0, 1, -128, 127, -129, 128):
        c, a = np.full((2, 8), edge), np.full((3, 8), 5)
        assert (N.scores(N.subset_sums(a), N.bit_planes(c)) == 40 * edge).all()


def test_tables_hold_all_subsets():
    a = np.random.default_rng(5).integers(-9, 9, (4, 11))
    t = N.subset_sums(a)
    for g, b in ((0, 0), (0, 255), (0, 0b1010), (1, 0b101), (1, 255)):
        bits = [8 * g + k for k in range(8) if b >> k & 1 and 8 * g + k < 11]
        assert (t[g, b] == a[:, bits].sum(1)).all()


@pytest.mark.parametrize("cell", [(8, 1024), (1, 2)])
def test_against_brute_force_with_ties(spark, monkeypatch, cell):
    monkeypatch.setattr(N, "CELL_BLOCKS", cell)
    monkeypatch.setattr(N, "ROWS", 40)
    monkeypatch.setattr(N, "ANCHORS", 3)
    monkeypatch.setattr(N, "ANCHOR_BLOCKS", 2)
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-.5, 0.0, .25, .5, 1.0]) for _ in range(5)], rnd.randint(0, 3)) for i in range(700)]
    rows += [(1000 + i, [.5, .5, .5, .5, .5], 1) for i in range(300)]  # a third of the rows are one vector
    want = brute(rows, lambda i: i % 50 == 0)
    assert want and got(spark, rows) == want


def test_nulls_lengths_large_numbers_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [0.5, 3.0], 1), (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 2), (2, None, 1), (3, [1.0, None], 1),
            (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (6, [], 1), (7, [1.0, 2.0, 3.0], 1), (8, [1.0, 1.0], 2),
            (9, [.6, 1.1], 3), (10, [1e14, 1.0], 3), (11, [9e13, 2e13], 3), (12, [8e13, 1e13], 4), (13, [1e300, 1.0], 4),
            (14, [1.0, 2.0], None), (15, [9e200, 1.0], -5), (16, [6e200, 1.0], 4)]
    want = brute(rows, lambda i: True)
    assert any(w[4] > 2 ** 63 for w in want) and got(spark, rows, 1) == want


def test_query_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = sorted(map(tuple, N.negatives_query(spark, sf).collect()))
    assert out == brute(rows, lambda i: i % 50 == 0) and len(out) > 50


def test_empty_and_lonely(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1), (2, [.6], 2)]) == [(0, 1, 1, 2, 65536, 256 * 153)]
