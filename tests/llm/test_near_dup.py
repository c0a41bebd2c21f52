"""Near-duplicates against all pairs by brute force."""
import random
import re
from collections import Counter, defaultdict

from lineforge.llm import near_dup


def brute(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    post = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in post[s])
        for j, both in shared.items():
            if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
        for s in sets[i]:
            post[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = near_dup.near_dup_query(spark, sf)
    assert got(out) == brute(rows, 3, 85, 100)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())


def test_large_group_of_near_copies_around_the_threshold(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    base = [rnd.choice(words) for _ in range(160)]
    rows = [(0, " ".join(base))]
    for i in range(1, 700):
        w = list(base)
        for _ in range(rnd.choice([1, 3, 5, 8, 12])):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60)))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = brute(rows, 3, 85, 100)
    assert len({v[1] for k, v in want.items() if k < 1000}) > 20
    assert got(near_dup.near_duplicates(df)) == want


def test_nulls_short_texts_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "One", "x"), (5, "one", "x"), (6, "one two", "x"),
            (7, "a b c d e f", "x"), (7, "a b c d e f", "x"), (None, "a b c d e f", "x"), (8, "A B\nC\x0bD E  F", "x"),
            (9, "É b c", "x"), (10, "é b c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id)
                 for r in near_dup.near_duplicates(df).collect() if r.doc_id is not None)
    assert out == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 4, 7), (7, 4, 7), (8, 4, 7),
                   (9, 1, 9), (10, 1, 10)]
    lone = [r for r in near_dup.near_duplicates(df).collect() if r.doc_id is None]
    assert [(r.n_shingles, r.component_id) for r in lone] == [(4, None)]
    kept = near_dup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 7, 9, 10]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(df).count() == 0


def test_very_long_text(spark):
    t = " ".join(str(i * 7919 % 1000003) for i in range(300_000))
    df = spark.createDataFrame([(1, t), (2, t + " end"), (3, "x" * 3_000_000)], "doc_id long, text string")
    assert got(near_dup.near_duplicates(df)) == {1: (299_998, 1), 2: (299_999, 1), 3: (1, 3)}
