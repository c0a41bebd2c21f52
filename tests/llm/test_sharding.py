"""Shards against the law, and against the interleaving done by hand."""
import zlib
from collections import Counter, defaultdict

from lineforge.llm import sharding


def checked(rows, out, shards=40):
    """Law, slots, sizes and checksums; the number of each source in each shard."""
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert want == Counter((r.doc_id, r.size, r.text_crc32) for r in out)
    return Counter((r.source, r.shard) for r in out)


def test_query_over_the_whole_table(spark, sf):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = sharding.shard_query(spark, sf).collect()
    mixed = checked(rows, out)
    of = Counter(s for _, _, s in rows)
    for (source, shard), n in mixed.items():
        assert abs(n - of[source] / 40) < 2
    assert sorted(out) == sorted(sharding.shard_query(spark, sf).repartition(3).collect())


def test_order_is_that_of_fractional_ranks(spark, sf):
    """The places within a source are evenly spaced over the whole order."""
    out = sharding.shard_query(spark, sf).collect()
    at = {(r.shard, r.slot): k for k, r in enumerate(sorted(out, key=lambda r: (r.shard, r.slot)))}
    places = defaultdict(list)
    for r in out:
        places[r.source].append(at[r.shard, r.slot])
    for source, p in places.items():
        p.sort()
        step = len(out) / len(p)
        assert all(abs((p[k] - p[0]) - k * step) < len(places) + 1 for k in range(len(p)))


def test_nulls_repeats_hot_source_and_other_columns(spark):
    rows = [(i, f"text {i % 50}", "hot") for i in range(700)] + [(1000 + i, "é" * (i % 7), f"s{i % 4}") for i in range(200)]
    rows += [(None, None, None)] * 3 + [(5, None, "hot"), (5, "", None), (5, "", None), (1, "x" * 500_000, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "'a' as shard", "1 as slot", "2 as size", "3 as law")
    out = sharding.interleaved_shards(df, shards=7).collect()
    mixed = checked(rows, out, 7)
    hot = [mixed["hot", s] for s in range(7)]
    assert max(hot) - min(hot) <= 2


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id long, text string, source string")
    out = sharding.interleaved_shards(df).collect()
    assert sorted(r.slot for r in out) == [0, 0] and len({r.shard for r in out}) == 2
    assert sharding.interleaved_shards(df.limit(0)).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    placed = sharding.interleaved_shards(df, shards=4)
    sharding.write_shards(df, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.doc_id, r._lf_shard, r._lf_slot, r.text) for r in back.collect()) == sorted(
        (r.doc_id, r.shard, r.slot, f"t{r.doc_id}") for r in placed.collect())
