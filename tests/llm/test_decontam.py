import random

import numpy as np
import pyarrow as pa

from lineforge.llm import decontam as d
from lineforge.llm.common import text_buffer
from lineforge.llm.textvec import word_hashes


def test_common_subsequence_against_the_table():
    rnd = random.Random(4)
    for _ in range(200):
        a = [rnd.randint(0, 6) for _ in range(rnd.randint(1, 70))]
        b = [rnd.randint(0, 6) for _ in range(rnd.randint(0, 90))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert d.common_subsequence(d._masks(np.array(a)), len(a), b) == t[-1][-1]


def test_randomised_svd_against_the_full_one():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((40, 12)) @ rng.standard_normal((12, 300))
    s, vt = d.randomised_svd(a, 12, np.random.default_rng(1))
    assert np.allclose(s, np.linalg.svd(a, compute_uv=False)[:12])
    assert np.allclose(a @ vt.T @ vt, a)


def test_planted_items_copies_and_paraphrases(spark, sf):
    """Each benchmark item, whole, in other case, with words changed, or its words shuffled, in the
    midst of other text: found, found, found, and not found."""
    rnd = random.Random(8)
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").collect()]
    host = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(400).collect()]
    clean = d.with_matches(spark.createDataFrame(list(enumerate(host)), "doc_id long, text string"),
                           spark.read.parquet(f"{sf}/benchmark.parquet"))
    host = [r.text for r in clean.collect() if not len(r._lf_matches)]
    rows, want = [], {}
    for i, item in enumerate(items):
        w = item.split()
        loose = [x if rnd.random() > .12 else "other" + str(rnd.random()) for x in w]
        mixed = rnd.sample(w, len(w))
        for k, t in enumerate((item, item.upper(), " ".join(loose), " ".join(mixed))):
            around = rnd.choice(host).split(" ")
            at = rnd.randrange(len(around) + 1)
            n = len(rows)
            rows.append((n, " ".join(around[:at]) + "\n" + t + "\n" + " ".join(around[at:])))
            want[n] = i if k < 3 else None
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r.doc_id: [m.item for m in r._lf_matches] for r in d.with_matches(df, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    found = {n: want[n] in out[n] for n in want if want[n] is not None}
    assert all(hit for n, hit in found.items() if n % 4 < 2)
    assert np.mean([hit for n, hit in found.items() if n % 4 == 2]) >= .85  # of short ones too many words may be changed
    assert np.mean([bool(out[n]) for n in want if want[n] is None]) <= .05


def test_paraphrases_with_new_words_and_the_answer_kept(spark, sf):
    """Items of which 60 to 80 % of the words are left, the answer whole, within other text."""
    rnd = random.Random(3)
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    idf = d.passage_frequencies(docs)
    matchers = [d.Matcher(r.model, idf) for r in d.latent_blocks(bench, idf).collect()]
    host = [r.text for r in docs.orderBy("doc_id").collect()]
    texts, want = [], []
    for share in (.6, .6, .6, .65, .7, .8):
        for r in bench.orderBy("item_id").collect():
            w = r.text.split()
            if len(w) > d.PASSAGE:
                continue  # the share would be each passage's own
            keep = max(3, len(w) // 4)
            for i in rnd.sample(range(len(w) - keep), int((1 - share) * len(w))):
                w[i] = f"x{rnd.randrange(10 ** 9)}"
            around = rnd.choice(host).split()
            around = around[-120:]
            at = rnd.randrange(len(around) + 1)
            texts.append(" ".join(around[:at] + w + around[at:]).lower())
            want.append(r.item_id)
    h, row, _ = word_hashes(*text_buffer(pa.array(texts)), d.BREAKS)

    def found(cosine):
        out = [set() for _ in texts]
        for m in matchers:
            m.candidates = lambda *a, m=m: d.Matcher.candidates(m, *a, cosine)
            for r, held in m.matches(h, row, len(texts)).items():
                out[r] |= held.keys()
        return [x in y for x, y in zip(want, out)]

    accepted = found(1e-6)  # every window and passage is checked word by word
    hit = [x for x, y in zip(found(d.COSINE), accepted) if y]
    assert sum(accepted) > 100 and np.mean(hit) >= .995, (sum(hit), sum(accepted))


def test_candidates_recall_against_exact_cosine(spark, sf):
    """The latent space finds what the full TF-IDF cosine finds."""
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    idf = d.passage_frequencies(docs)
    m = d.Matcher(d.latent_blocks(bench, idf).first().model, idf)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    hit = total = 0
    vocab = np.unique(np.concatenate([d.features_of(w) for w in m.words]))
    column = np.full(d.FEATURES, len(vocab))  # the last one: features that no item has
    column[vocab] = np.arange(len(vocab))

    def weights(words):
        f, n = np.unique(d.features_of(words), return_counts=True)
        x = np.zeros(len(vocab) + 1)
        np.add.at(x, column[f], n * idf[f])
        x[-1] = 0.0
        return x, np.sqrt(((n * idf[f]) ** 2).sum())

    exact = np.stack([np.divide(*weights(w)) for w in m.words])
    for a in range(0, len(texts), 50):
        buf, off = text_buffer(pa.array([t.lower() for t in texts[a:a + 50]]))
        h, row, _ = word_hashes(buf, off, d.BREAKS)
        got = {(x, y, p) for x, y, _, p in m.candidates(h, row, len(off) - 1)}
        first = np.searchsorted(row, np.arange(len(off)))
        for r in range(len(off) - 1):
            for y in range(first[r], first[r + 1], d.STRIDE):
                if y + d.STRIDE >= first[r + 1] and y > first[r]:
                    continue  # the rest of the window before
                x, norm = weights(h[y:min(y + d.WINDOW, first[r + 1])])
                for p in np.flatnonzero(exact @ x / norm >= min(.3, d.COSINE + .03)):
                    total += 1
                    hit += (r, y, int(p)) in got
    assert total > 20 and hit / total >= .99, (hit, total)


def test_frequencies_against_counting(spark):
    rows = [("a b c " * 40,), (None,), ("",), ("a-d",)]
    idf = d.passage_frequencies(spark.createDataFrame(rows, "text string"))
    f = d.features_of(word_hashes(*text_buffer(pa.array(["a d z"])), d.BREAKS)[0])
    # 120 words are 3 passages; with the short one 4
    assert np.allclose(idf[f], np.log([5 / 5, 5 / 2, 5 / 1]) + .05, atol=1e-5)


def test_nulls_short_items_long_texts_and_columns(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "the of"), (None, item), (5, item)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (4, "word " * 300_000 + item), (5, "the of " * 50),
            (6, item.replace(" ", ", ").title())]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item", "2 as share")
    out = sorted((r.doc_id or 0, [m.item for m in r._lf_matches]) for r in d.with_matches(df, bench).collect())
    hit = [1, 5, None]
    assert out == [(0, hit), (1, []), (2, []), (3, hit), (3, hit), (4, hit), (5, []), (6, hit)]
    kept = d.clean_documents(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 5]
    assert d.clean_documents(df, bench.limit(0)).count() == 8
    assert d.clean_documents(df.limit(0), bench).count() == 0


def test_more_items_than_a_block_holds(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(5))
    texts = [" ".join(word() for _ in range(rnd.randint(8, 120))) for _ in range(2500)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").repartition(3)
    docs = spark.createDataFrame([(i, f"{word()} {word()} {texts[i]} {word()}") for i in range(0, 2500, 5)], "doc_id long, text string")
    out = d.with_matches(docs, bench).collect()
    assert np.mean([r.doc_id in [m.item for m in r._lf_matches] for r in out]) >= .99
    assert sum(len(r._lf_matches) for r in out) <= 1.02 * len(out)
