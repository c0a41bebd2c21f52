"""Each stage of the pipeline against a brute-force version, on what the stage before it kept."""
import os
import re
import shutil
import subprocess
import sys

import pytest
import sentencepiece

import corpus_pipeline
from lineforge.llm import pieces, quality_crf
from test_line_dedup import brute as without_runs
from test_near_dup import brute as groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf):
    """Documents, and what every stage leaves, as {doc_id: row}."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        out.append(docs)
    assert all(df.columns == COLUMNS for df in out[:-1])
    return [{r.doc_id: r for r in df.collect()} for df in out]


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup",
                                                      "benchmark_decontamination", "sentencepiece"]


def test_quality(spark, sf, kept):
    want = {r.doc_id for r in quality_crf.quality_query(spark, sf).collect() if r.score >= .7}
    assert set(kept[1]) == want and all(kept[1][i] == kept[0][i] for i in want)
    good = [r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1]
    assert sum(i in kept[1] for i in good) >= .99 * len(good)


def test_lines(kept):
    want = {i: t for i, t in without_runs([(i, r.text) for i, r in kept[1].items()], 50).items() if t is None or t.split()}
    assert {i: r.text for i, r in kept[2].items()} == want
    assert all(r.n_chars == len(r.text) for i, r in kept[2].items() if r.text != kept[1][i].text)


def test_near_duplicates(kept):
    want = groups([(i, r.text) for i, r in kept[2].items()], 5, 80, 100)
    assert set(kept[3]) == {i for i, (_, c) in want.items() if c == i}
    assert all(kept[3][i] == kept[2][i] for i in kept[3])


def test_benchmark(spark, sf, kept):
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {i for i, r in kept[3].items() if any(x in plain(r.text) for x in items)}
    assert set(kept[3]) - set(kept[4]) == whole
    assert all(kept[4][i] == kept[3][i] for i in kept[4])


def test_pieces(kept):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert set(kept[5]) == set(kept[4])
    assert all(list(r.token_ids) == sp.encode(kept[4][i].text) and r.round_trip for i, r in kept[5].items())


def test_run_gives_the_last_stage(spark, sf, kept):
    assert {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()} == kept[5]


def test_entry_works_without_this_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(root, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'spend_lags' in q and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", check=True, env=os.environ | {"PYTHONPATH": ""})


def test_stages_on_an_empty_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0, name
        if name != "sentencepiece":
            assert out.columns == COLUMNS, name


def test_stages_on_null_and_repeated_rows(spark, sf, kept):
    good = [r for i, r in sorted(kept[4].items()) if len(r.text) > 2000][:2]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(7, None, None, None, None), (7, None, None, None, None), (8, "", "en", None, 0), (None, good[0].text, None, "a", 1),
            (None, None, None, None, None), (9, good[1].text, "en", "b", None), (9, good[1].text, "en", "b", None)]
    docs = spark.createDataFrame(rows, docs.schema)
    known = {(r[0], bool(r[1])) for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf).collect()
        if name == "sentencepiece":
            assert sorted((r.doc_id or 0, r.n_tokens > 0, r.round_trip is None) for r in out) == [
                (0, False, True), (0, True, False), (7, False, True), (7, False, True), (8, False, False), (9, True, False), (9, True, False)]
        else:
            assert {(r.doc_id, bool(r.text)) for r in out} <= known and len(out) <= 7, name
            assert sum(r.doc_id == 9 for r in out) == 2, name
            assert sum(r.doc_id is None and bool(r.text) for r in out) == 1, name
