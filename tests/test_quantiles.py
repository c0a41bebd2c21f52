"""Exact quantiles on values that spread over all doubles."""
import math
import random

import duckdb
import pytest

from lineforge.operators import quantiles

INF = float("inf")


CASES = [
    [1.0, 2.0, 5.0, INF], [-INF, INF, 0.0], [-INF, -INF, INF, INF, 3.0],
    [5e-324, 1e308, -1e308, 1.7976931348623157e308, 0.0, -0.0, -5e-324, 1e-300], [7.0], [2.0] * 9 + [INF] * 9]


def one(spark, values, qs):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    return {r.q: r for r in quantiles.exact_quantiles(df, ["x"], qs).collect()}


def test_any_double(spark):
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame([(g, v) for g, values in enumerate(CASES) for v in values], "g int, x double").repartition(3)
    got = {(r.g, r.q): r for r in quantiles.exact_quantiles(df, ["x"], qs, "g").collect()}
    low = {(r.g, r.q): r.value for r in quantiles.exact_quantiles(df, ["x"], qs, "g", discrete=True).collect()}
    for g, values in enumerate(CASES):
        s = sorted(values)
        for q in qs:
            at = q * (len(s) - 1)
            a, b = s[math.floor(at)], s[min(math.floor(at) + 1, len(s) - 1)]
            want = a if a == b or at == math.floor(at) else a + (b - a) * (at - math.floor(at))
            r = got[g, q]
            assert r.n == len(s) and (r.value == want or math.isnan(want) and math.isnan(r.value))
            assert low[g, q] == s[max(math.ceil(q * len(s)), 1) - 1]


def test_equals_duckdb_over_all_sizes_of_numbers(spark):
    rnd = random.Random(6)
    values = [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(4000)] + [rnd.gauss(0, 1) for _ in range(4000)]
    qs = [0.01, 0.1, 0.5, 0.9, 0.999]
    got = one(spark, values, qs)
    db = duckdb.connect()
    db.execute("create table t (x double)")
    db.executemany("insert into t values (?)", [(v,) for v in values])
    want = db.execute(f"select quantile_cont(x, {qs}) from t").fetchone()[0]
    assert [got[q].value for q in qs] == pytest.approx(want, rel=1e-12)


def test_rounds_are_bounded(spark, monkeypatch):
    wrote = []
    keep = quantiles.materialise
    monkeypatch.setattr(quantiles, "materialise", lambda df, name: wrote.append(name) or keep(df, name))
    one(spark, [1.0 + k * 2.0 ** -52 for k in range(300)] + [-INF, INF], [0.3])
    assert 2 <= wrote.count("quantile-state") <= 7
