import math
import random

from lineforge.llm import topk


def brute(rows, k, is_query):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if is_query(i)}):
        qv = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q and len(v) == len(qv))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def got(spark, rows, k=5, step=50):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as score")
    v = topk.quantised(df.repartition(5))
    return sorted(map(tuple, topk.top_k(v, v.where(f"vec_id % {step} = 0"), k).collect()))


def test_ties_copies_and_few_candidates(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-.5, 0.0, .25, .5]) for _ in range(3)]) for i in range(400)]
    rows += [(1000 + i, [.5, .5, .5]) for i in range(300)]
    assert got(spark, rows) == brute(rows, 5, lambda i: i % 50 == 0)
    assert got(spark, rows[:3], step=1) == brute(rows[:3], 5, lambda i: True)


def test_nulls_lengths_large_numbers_and_repeated_ids(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [0.5, 3.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 1.0]), (9, [1e-9, -1e-9]),
            (50, [1e6, 1e6]), (51, [3e6, -1e6])]
    assert got(spark, rows, 3, 1) == brute(rows, 3, lambda i: True)


def test_large_vectors_take_part(spark):
    rows = [(0, [1e14, 1.0]), (1, [3e13, -2.0]), (2, [1.0, 1.0]), (3, [-1e14, 5.0]), (4, [.25, .125]), (5, [1e300, 0.0])]
    held = lambda x: max(min(math.floor(256 * x), topk.HELD), -topk.HELD)
    whole = {i: [held(x) for x in v] for i, v in rows}
    want = []
    for q, a in whole.items():
        score = lambda i: max(min(sum(x * y for x, y in zip(a, whole[i])), topk.MOST), -topk.MOST)
        best = sorted((-score(i), i) for i in whole if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got(spark, rows, 5, 1) == sorted(want) and len(want) == 30


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0])]) == []
