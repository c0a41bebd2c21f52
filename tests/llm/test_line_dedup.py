"""Repeated runs against a definition by brute force: a line goes if it lies in a run of at least
min_words words, in a row, that stands earlier too; blank lines between lines that go, go."""
import random

from lineforge.llm import line_dedup


def brute(rows, most):
    docs = []
    for i, t in sorted(rows):
        lines = [(p, x.strip(" \t\r\f")) for p, x in enumerate((t or "").split("\n"))]
        docs.append((i, t, [(p, x, len(x.split())) for p, x in lines if x.split()]))
    places = {}
    for d, (_, _, ls) in enumerate(docs):
        for a in range(len(ls)):
            n = 0
            for b in range(a, len(ls)):
                n += ls[b][2]
                if n >= most:
                    places.setdefault(tuple(x for _, x, _ in ls[a:b + 1]), (d, a))
    out = {}
    for d, (i, t, ls) in enumerate(docs):
        gone = set()
        for a in range(len(ls)):
            n = 0
            for b in range(a, len(ls)):
                n += ls[b][2]
                if n >= most and places[tuple(x for _, x, _ in ls[a:b + 1])] < (d, a):
                    gone |= {p for p, _, _ in ls[a:b + 1]}
        for (p, _, _), (q, _, _) in zip(ls, ls[1:]):
            if p in gone and q in gone:
                gone |= set(range(p, q))
        out[i] = t if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone)
    return out


def got(spark, rows, most):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r.doc_id: r.text for r in line_dedup.dedup_lines(df, min_words=most).collect()}


def test_random_texts_against_the_definition(spark):
    rnd = random.Random(11)
    pool = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(14)]
    rows = []
    for i in range(150):
        lines = [rnd.choice(pool + ["", "  "]) for _ in range(rnd.randint(0, 12))]
        rows.append((i, "\n".join(lines)))
    assert got(spark, rows, 9) == brute(rows, 9)
    assert got(spark, rows, 4) == brute(rows, 4)


def test_passage_in_many_documents_and_copies(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    passage = " ".join(word() for _ in range(55))
    rows = [(i, f"{word()} {word()}.\n{passage}\n{word()}.") for i in range(60)]
    rows += [(100, "short line\nshort line"), (101, "short line"), (102, rows[3][1]), (103, rows[3][1])]
    out = got(spark, rows, 50)
    assert passage in out[0] and not any(passage in out[i] for i in range(1, 60))
    assert out[100] == rows[60][1] and out[101] == "short line"
    assert [len(out[i].split("\n")) for i in range(1, 60)] == [2] * 59


def test_nulls_repeats_long_texts_and_columns(spark):
    long = "\n".join(f"line {i} " + "w " * 30 for i in range(3000))
    rows = [(1, None, 1), (2, "", 1), (3, long, 1), (3, long, 2), (None, long, 3), (4, long, 4), (5, "\n\n", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int").selectExpr("*", "'k' as h", "'l' as first")
    out = line_dedup.without_repeated_lines(df)
    assert out.columns == df.columns
    left = sorted((r.doc_id or 0, len(r.text or ""), r.n_chars) for r in out.collect())
    # the null id comes first, so it keeps the run; of the others nothing is left
    assert left == [(0, len(long), 3), (1, 0, 1), (2, 0, 1), (5, 2, 5)]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = line_dedup.line_dedup_query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
