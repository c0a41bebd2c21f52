"""The corpus pipeline: filter, de-duplicate, decontaminate and encode ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; the first
four return the columns of ``documents``, the last the token ids of the documents that are left."""

from __future__ import annotations

from lineforge.llm import decontam, line_dedup, near_dup, pieces, quality_crf
from lineforge.llm.common import materialise, prepare, table


def quality_classifier(spark, docs, sf_dir):
    """Documents that the line field rejects go.  A null text is judged as an empty one; null and
    repeated ids are judged row by row; an empty table stays empty."""
    return quality_crf.good_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark, docs, sf_dir):
    """Repeated runs of lines go, and documents of which nothing else is left.  Null and empty texts
    stay as they are; rows that repeat id and text are one text; an empty table stays empty."""
    prepare(spark)
    return line_dedup.without_repeated_lines(docs)


def minhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays (five-word shingles, similarity 0.8): that
    of the smallest id, with all rows of that id.  Rows with a null id or a blank text stay; an empty
    table stays empty."""
    prepare(spark)
    return near_dup.drop_near_duplicates(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go.  Null and empty texts hold none; ids do not matter;
    an empty table stays empty."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark, docs, sf_dir):
    """Token ids of each document, and whether decoding gives its text again.  A null text has no ids
    and a null round trip; null and repeated ids are encoded row by row; an empty table gives no rows."""
    prepare(spark)
    return pieces.encode_texts(docs, pieces.load_vocabulary())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_encoding),
]

#: SQL cannot express the classifier, the retrieval and the encoding; tests hold each stage against
#: a brute-force version instead.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """The rows that the stages leave of ``documents``, each stage written before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
