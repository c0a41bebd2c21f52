import itertools
import random

import sentencepiece

from lineforge.llm import pieces

RAW = ["", " ", "  ", "a", "Hello  world\nfoo\tbar <s> ñ  ﬁ  ", "\n\n", "日本語 test", "🙂🙂x", "    four", "a b", "<0x0A>", "aaaaaaaaaaaa",
       "x" * 3000, "the the the", " leading", "trailing ", "\x00\x01", "é", "</s> <unk>"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def test_equals_the_library_on_odd_and_random_texts():
    sp, enc = library(), pieces.Encoder(pieces.load_vocabulary())
    rnd = random.Random(1)
    texts = RAW + ["".join(rnd.choice("abcdeéñ 'THIng.\n1") for _ in range(rnd.randint(1, 80))) for _ in range(2000)]
    for t, ids in zip(texts, enc.encode(texts)):
        assert ids.tolist() == sp.encode(t), t
        assert enc.decode(ids.tolist()) == t


def test_query_equals_the_library(spark, sf):
    sp = library()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = pieces.encode_query(spark, sf).collect()
    assert len(out) == len(text) and all(r.round_trip for r in out)
    for r in out:
        assert r.n_tokens == len(r.token_ids) and list(r.token_ids) == sp.encode(text[r.doc_id])


def test_unigram_forward_pass_against_all_segmentations():
    rnd = random.Random(9)
    names = sorted({"".join(rnd.choice("ab▁") for _ in range(rnd.randint(1, 4))) for _ in range(40)} | set("ab▁"))
    names = [n for n in names if "▁" not in n.lstrip("▁")]
    score = {n: -rnd.random() * 10 for n in names}
    enc = pieces.Encoder({"pieces": ["<unk>", *names], "scores": [0.0, *[score[n] for n in names]],
                          "special": [True] + [False] * len(names), "bytes": [], "unknown": 0, "kind": "unigram"})
    words = ["▁" + "".join(w) for n in range(7) for w in itertools.product("ab", repeat=n)]

    def best(w):
        return max((score[w[:k]] + (best(w[k:]) if w[k:] else 0.0) for k in range(1, len(w) + 1) if w[:k] in score))

    for w, got in enc.segmented(words).items():
        assert "".join(got) == w and abs(sum(score[p] for p in got) - best(w)) < 1e-9


def test_nulls_repeats_long_texts_and_columns(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "word " * 400_000), (3, "x▁y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    out = sorted(pieces.encode_texts(df, pieces.load_vocabulary()).collect(), key=lambda r: (r.doc_id or 0, r.round_trip is None))
    assert [(r.doc_id, r.round_trip) for r in out] == [(None, True), (1, True), (1, None), (2, True), (3, False)]
    assert [r.n_tokens for r in out[1:3]] == [0, 0] and out[3].n_tokens >= 400_000
    assert pieces.encode_texts(df.limit(0), pieces.load_vocabulary()).count() == 0
