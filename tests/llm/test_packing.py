import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import tokenizers

from lineforge.llm import packing
from lineforge.llm.packing import OpenWindows, Piece, merge_windows


@pytest.fixture(scope="module")
def tokenizer_text():
    return packing.tokenizer_file()


def covered(rows, size=packing.SIZE):
    """Checks what every packing must have; gives the padding of each sequence."""
    docs, seqs = defaultdict(list), defaultdict(list)
    for doc, start, length, total, seq, offset in rows:
        assert length > 0
        docs[doc].append((start, length, total))
        seqs[seq].append((offset, length))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    return docs, sorted(size - sum(n for _, n in s) for s in seqs.values())


def test_open_windows_keep_their_bound_and_best_fit():
    rnd = random.Random(4)
    packer, closed = OpenWindows(100, 5, 10), []
    for d in range(2000):
        n = rnd.randint(1, 250)
        before = dict((w, r) for r, w in packer.rooms)
        got = list(packer.place(Piece(d, 0, np.arange(n, dtype=np.uint32), n)))
        closed += got
        assert len(packer.rooms) <= 5
        rest = n % 100
        fits = [r for r in before.values() if r >= rest]
        if rest and fits:  # it went where it leaves the least room, nothing was closed early
            assert len(got) == n // 100 + (min(fits) == rest)
    for w in closed:
        used = sum(len(p.ids) for p in w)
        assert 90 <= used <= 100
    seen = defaultdict(int)
    for w in closed + list(packer.windows.values()):
        for p in w:
            assert p.ids[0] == p.start and p.ids[-1] == p.start + len(p.ids) - 1
            seen[p.doc] += len(p.ids)
    assert len(seen) == 2000


def test_merge_closes_within_the_gap_and_carries_the_emptiest():
    rnd = random.Random(5)
    pieces = [Piece(d, 0, np.arange(n, dtype=np.uint32), n) for d in range(400) for n in [rnd.choice([51, 52, 60, 70])]]
    for carry in (0, 7):
        closed, kept = merge_windows(list(pieces), 100, carry, 3)
        used = sorted(sum(len(p.ids) for p in w) for w in closed)
        assert len(kept) <= carry + bool(carry) and used[0 if carry else 1] >= 97 and used[-1] <= 100
        assert sum(used) + sum(len(p.ids) for w in kept for p in w) == sum(len(p.ids) for p in pieces)


def test_ids_are_the_library_s(tokenizer_text):
    lib, own = tokenizers.Tokenizer.from_str(tokenizer_text), packing.Tokenizer(tokenizer_text)
    rnd = random.Random(2)
    texts = ["", "<|endoftext|>", "x <|endoftext|>y", "  \n\t a", "é漢字🙂", "\x00 ", " " * 1_000_000, "ab" * 300_000]
    texts += ["".join(chr(rnd.choice([rnd.randint(1, 127), rnd.randint(0xA0, 0x2FF), rnd.randint(0x3000, 0x9FFF)]))
                      for _ in range(200)) for _ in range(300)]
    for t in texts:
        assert own.ids(t).tolist() == lib.encode(t, add_special_tokens=False).ids


def test_query_returns_every_id_once(spark, sf, tokenizer_text):
    lib = tokenizers.Tokenizer.from_str(tokenizer_text)
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = packing.packing_query(spark, sf).collect()
    docs, gaps = covered([(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in out])
    assert docs.keys() == text.keys() and len(out) == len({(r.doc_id, r.start) for r in out})
    for r in out:
        ids = lib.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [1]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[r.start:r.start + r.length]))
    for spans in docs.values():
        at = 0
        for start, length, _ in sorted(spans):
            assert start == at
            at += length
        assert at == spans[0][2]
    assert gaps[-2] <= packing.MAX_GAP and sum(gaps) < 0.02 * packing.SIZE * len(gaps)


def test_many_partitions_merge_in_rounds(spark, tokenizer_text):
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('ab ', cast(id % 97 as int)) as text").repartition(300)
    out = packing.pack(df, tokenizer_text, size=128, open_windows=3, max_gap=8)
    rows = out.selectExpr("doc_id", "start", "octet_length(ids) div 4", "doc_tokens", "sequence_id", "offset").collect()
    docs, gaps = covered(rows, 128)
    assert len(docs) == 3000 and gaps[-2] <= 8
    assert sum(r[2] for r in rows) == sum(s[0][2] for s in docs.values())


def test_sequences_hold_the_pieces(spark, tokenizer_text):
    df = spark.createDataFrame([(i, "word " * (i % 40)) for i in range(200)], "doc_id long, text string")
    pieces = packing.pack(df, tokenizer_text, size=64).cache()
    rows = packing.sequences(pieces, 64, pad=7).collect()
    by = defaultdict(dict)
    for p in pieces.collect():
        by[p.sequence_id][p.offset] = bytes(p.ids)
    assert len(rows) == len(by)
    for r in rows:
        ids = b"".join(by[r.sequence_id][k] for k in sorted(by[r.sequence_id]))
        assert bytes(r.ids) == ids + struct.pack("<I", 7) * (64 - r.n_tokens) and len(ids) == 4 * r.n_tokens
        assert [d.offset for d in r.documents] == sorted(by[r.sequence_id])


def test_nulls_repeats_long_texts_names_and_empty(spark, tokenizer_text):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "word " * 200_000), (3, " " * 500_000), (4, "x"), (4, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as start", "'q' as ids", "2 as part", "0 as _id")
    out = packing.pack(df, tokenizer_text).collect()
    total = defaultdict(int)
    for r in out:
        total[r.doc_id] += len(r.ids) // 4
    assert total[1] == 2 and total[None] == 3 and total[2] == 200_001 + 1 and total[4] == 4
    assert packing.pack(df.limit(0), tokenizer_text).count() == 0
    assert packing.pack(df.where("false"), tokenizer_text).count() == 0
