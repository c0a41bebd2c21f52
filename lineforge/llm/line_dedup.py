"""Removal of repeated runs of lines, by winnowing.

A run counts as repeated if it has at least ``min_words`` words and the same lines, in a row, were
there before (in an earlier document, or further up).  Every line starts a window, the shortest run
from it with that many words, and ends one.  A window's fingerprint is its smallest line hash; so
two equal windows have the same fingerprint, and a repeated run is guaranteed to show one.

Only fingerprints at two places or more are followed up: their positions are joined with the
windows that they stand for, forward and backward, and a window whose lines were seen before is a
match.  Overlapping and adjoining matches are one run: each line of a repeated run lies in a window
inside of it, so the matches together reach as far, both ways, as the run does.  Matches are held
against the first place of their lines only, never against each other, so lines that a third of
all documents share cost no more than their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, table

MIN_WORDS = 50


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_words: int = MIN_WORDS) -> DataFrame:
    """(_k1, _k2, runs): the runs (first, last line from 0) to delete in each text that has some.

    _k1, _k2: 128 bits that stand for id and text (``_keyed``)."""
    rows = _keyed(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t")), "_id", "_t")
    lines = (rows.where("length(_t) > 0").select("_id", "_k1", "_k2", F.posexplode(F.split("_t", "\n")).alias("_p", "_l"))
             .withColumn("_l", F.btrim(F.col("_l"), F.lit(" \t\r\f")))
             .select("_id", "_k1", "_k2", "_p", F.regexp_count("_l", F.lit("[^ \t\r\f]+")).cast("long").alias("_w"),
                     F.xxhash64("_l").alias("_h"), F.hash("_l").cast("long").alias("_g"))
             .where("_w > 0"))
    # rows that repeat id and text are one text
    lines = (lines.repartition("_k1", "_k2").groupBy("_k1", "_k2", "_p")
             .agg(*[F.first(c).alias(c) for c in ("_id", "_w", "_h", "_g")]))
    text = Window.partitionBy("_k1", "_k2")
    lines = lines.withColumn("_e", F.sum("_w").over(text.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumn("_s", F.col("_e") - F.col("_w")).withColumn("_o", F.row_number().over(text.orderBy("_p")))

    def window(w, first, last):
        return F.struct(F.min("_h").over(w).alias("fp"), F.xxhash64(F.collect_list("_h").over(w)).alias("h"),
                        F.sum("_g").over(w).alias("g"), F.sum("_w").over(w).alias("n"), first(w).alias("first"), last(w).alias("last"))

    at = F.struct("_p", "_o")  # a line's place among all lines, and among those that count
    here = lambda w: at
    ahead = window(text.orderBy("_s").rangeBetween(0, min_words - 1), here, lambda w: F.max(at).over(w))
    back = window(text.orderBy("_e").rangeBetween(1 - min_words, 0), lambda w: F.min(at).over(w), here)
    windows = (lines.select("_id", "_k1", "_k2", ahead.alias("a"), back.alias("b"))
               .select("_id", "_k1", "_k2", F.explode(F.array_distinct(F.array("a", "b"))).alias("x"))
               .select("_id", "_k1", "_k2", "x.*").where(F.col("n") >= min_words))
    windows = materialise(windows, "windows")

    spot = F.struct("_id", "_k1", "_k2", "first")
    # fingerprints at one place only: nothing is repeated there
    shared = (windows.groupBy("fp").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi"))
              .where("lo <> hi or lo is null").select("fp"))
    likely = materialise(windows.join(shared, "fp"), "likely")
    earliest = (likely.groupBy("fp", "h", "g").agg(F.min(spot).alias("origin"), F.count(F.lit(1)).alias("c"))
                .where("c > 1").drop("c"))
    later = likely.join(earliest, ["fp", "h", "g"]).where(spot > F.col("origin")).select("_k1", "_k2", "first", "last")

    spans = later.distinct().groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))
    end = lambda a: F.try_element_at(a, F.lit(-1))
    grow = lambda a, x: F.when(  # noqa: E731  overlapping, or with blank lines only between: one run
        (F.size(a) > 0) & (F.coalesce(end(a)["last"]["_o"], F.lit(-2)) + 1 >= x["first"]["_o"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(
            end(a)["first"].alias("first"), F.greatest(end(a)["last"], x["last"]).alias("last")))),
    ).otherwise(F.concat(a, F.array(x)))
    none = F.array().cast("array<struct<first:struct<_p:int,_o:int>,last:struct<_p:int,_o:int>>>")
    runs = F.transform(F.aggregate("runs", none, grow), lambda r: F.struct(r["first"]["_p"].alias("first"), r["last"]["_p"].alias("last")))
    return spans.select("_k1", "_k2", runs.alias("runs"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumns({"_k1": F.xxhash64(id_col, text_col), "_k2": F.xxhash64(text_col, id_col, F.lit(1))})


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the text less its repeated runs, and ``_lf_runs``, the runs deleted (null: none).

    Documents come in the order of id, then of a hash of id and text; the first place of a run
    stays.  Lines are compared without the white space around them; a word is what stands between
    white space; blank lines do not count, but go if the lines that count on both sides go.

    Nulls and odd input: null and empty texts stay as they are; null ids come first; rows that
    repeat id and text are one text and lose the same lines; a text of which all is repeated
    becomes empty.  An empty table gives no rows.  All columns are kept; a column named like the
    internal ones (_k1, _k2, _lf_runs) is not allowed for."""
    runs = materialise(repeated_runs(docs, id_col, text_col, min_words).select(
        F.col("_k1").alias("_lf_1"), F.col("_k2").alias("_lf_2"), F.col("runs").alias("_lf_runs")), "runs")
    keyed = docs.withColumns({"_lf_k1": F.xxhash64(id_col, F.col(text_col).cast("string")),
                              "_lf_k2": F.xxhash64(F.col(text_col).cast("string"), id_col, F.lit(1))})
    # always merged: which way texts go should not depend on how many runs there are
    out = keyed.join(runs.hint("merge"), (F.col("_lf_k1") == F.col("_lf_1")) & (F.col("_lf_k2") == F.col("_lf_2")), "left")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n"), lambda x, i: ~F.exists(
        "_lf_runs", lambda r: (r["first"] <= i) & (i <= r["last"]))), "\n")
    out = out.withColumn(text_col, F.when(F.col("_lf_runs").isNull(), F.col(text_col)).otherwise(kept))
    return out.drop("_lf_k1", "_lf_k2", "_lf_1", "_lf_2")


def line_dedup_query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    gone = F.aggregate("_lf_runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    return out.select("doc_id", "text", F.coalesce(gone, F.lit(0)).cast("long").alias("lines_removed"),
                      F.coalesce(F.size("_lf_runs"), F.lit(0)).cast("long").alias("runs_removed"))


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Stage of the pipeline: ``docs`` with its columns; n_chars follows the new text; documents of
    which nothing is left go."""
    out = dedup_lines(docs, min_words=min_words)
    out = out.where(F.col("_lf_runs").isNull() | F.col("text").rlike("[^ \t\r\f\n]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_lf_runs").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


LINE_SQL = r"""
with d as (select row_number() over (order by doc_id) as rid, doc_id, text from documents),
s as (select rid, string_split(text, chr(10)) as parts from d where length(text) > 0),
raw as (select rid, unnest(parts) as line, generate_subscripts(parts, 1) - 1 as p from s),
l as (select rid, p, trim(line, ' ' || chr(9) || chr(13) || chr(12)) as line from raw),
w as (select *, len(regexp_extract_all(line, '[^ \t\r\f]+'))::bigint as n from l),
c as (select *, sum(n) over (partition by rid order by p) as e from w where n > 0),
f as (select rid, p as a, max(p) over r as b, string_agg(line, chr(10)) over r as content, sum(n) over r as total
      from c window r as (partition by rid order by e - n range between current row and 49 following)),
g as (select rid, min(p) over r as a, p as b, string_agg(line, chr(10)) over r as content, sum(n) over r as total
      from c window r as (partition by rid order by e range between 49 preceding and current row)),
u as (select distinct * from (select * from f union all select * from g) where total >= 50),
o as (select *, min((rid, a)) over (partition by content) as origin from u),
gone as (select distinct w.rid, w.p from w join o on w.rid = o.rid and w.p between o.a and o.b
         where (o.rid, o.a) > o.origin),
q as (select raw.rid, raw.p, raw.line, case when w.n > 0 then gone.p is not null end as dead
      from raw join w using (rid, p) left join gone using (rid, p)),
m as (select rid, p, line, coalesce(dead, coalesce(last_value(dead ignore nulls) over (partition by rid order by p
        rows between unbounded preceding and current row), false) and coalesce(first_value(dead ignore nulls) over (
        partition by rid order by p rows between current row and unbounded following), false)) as dead from q),
k as (select rid, coalesce(string_agg(line, chr(10) order by p) filter (where not dead), '') as text,
        sum(dead::int)::bigint as lines_removed,
        sum((dead and not before)::int)::bigint as runs_removed
      from (select *, coalesce(lag(dead) over (partition by rid order by p), false) as before from m) group by rid)
select d.doc_id, case when k.rid is null then d.text else k.text end as text,
  coalesce(lines_removed, 0) as lines_removed, coalesce(runs_removed, 0) as runs_removed
from d left join k using (rid)
"""
