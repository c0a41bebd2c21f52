"""Exact quantiles of any number of rows, by refining histograms.

A quantile needs the order statistics at one or two ranks.  A double's bits, with the sign put in
order, are a whole number that sorts as the double does; its digits of ``DIGIT`` bits are the bins.
Each round counts one digit, with map-side pre-aggregation, within the prefixes that hold a rank, and
keeps the digit that does; only rows with such a prefix go on to the next round.  It ends where a
bin's smallest and largest values agree, after six rounds at most whatever the values are, infinite
ones included.  State and shuffles are bounded by ranks x bins, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

DIGIT = 12  # bits: 4,096 bins


def ordered_bits(x: Column) -> Column:
    """A long that sorts, bit by bit from the highest, as the double ``x`` (neither null nor NaN)."""
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), x + F.lit(0.0)).cast("long")  # -0.0 + 0.0 is 0.0
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(bits.bitwiseXOR(F.lit(-(1 << 63))))


def exact_quantiles(df: DataFrame, cols: list[str], qs: list[float], group: str | None = None,
                    discrete: bool = False) -> DataFrame:
    """(group value if any, column_name, q, n, value) for each column and share in ``qs``.

    value: linear between the neighbouring ranks, as pandas and numpy do; with ``discrete`` the
    order statistic at rank ceil(q * n).  Nulls and NaN are left out; columns without values give
    no rows."""
    marked = F.col(group) if group else F.lit(None)
    names = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.lit(c))])
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x"))
                                for i, c in enumerate(cols)])).alias("e")
    rows = df.select(F.coalesce(F.concat(F.lit("="), marked.cast("string")), F.lit("")).alias("k"),
                     marked.alias("g"), cells).select("k", "g", "e.c", "e.x")
    rows = materialise(rows.where(F.col("x").isNotNull() & ~F.isnan("x")), "quantile-input").select("k", "g", "c", "x")
    whole = rows.groupBy("k", "c").agg(F.first("g").alias("g"), F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"),
                                       F.max("x").alias("hi"))
    if discrete:
        first = F.greatest(F.ceil(F.col("q") * F.col("n")), F.lit(1)) - 1
        last, part = first, F.lit(0.0)
    else:
        place = F.col("q") * (F.col("n") - 1)
        first = F.floor(place)
        last, part = F.least(first + 1, F.col("n") - 1), place - first
    asked = materialise(whole.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
                        .select("k", "c", "g", "n", "q", first.cast("long").alias("r1"), last.cast("long").alias("r2"),
                                part.alias("part"), "lo", "hi"), "quantile-ranks")
    state = asked.select("k", "c", F.explode(F.array("r1", "r2")).alias("r"), "lo", "hi").distinct()
    state = materialise(state.select("k", "c", "r", "lo", "hi", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("prefix")),
                        "quantile-state")
    left = 64
    while left and not state.where("lo < hi").isEmpty():
        narrow = state.where("lo < hi").drop("lo", "hi")
        width = min(DIGIT, left)
        left -= width
        part = rows.withColumn("u", ordered_bits(F.col("x")))
        prefix = F.shiftrightunsigned("u", left + width) if left + width < 64 else F.lit(0).cast("long")
        digit = F.shiftrightunsigned("u", left).bitwiseAND(F.lit((1 << width) - 1))
        part = part.select("k", "c", "x", prefix.alias("prefix"), digit.alias("digit"))
        if left + width < 64:  # only rows with a prefix that is still open
            part = part.join(narrow.select("k", "c", "prefix").distinct(), ["k", "c", "prefix"], "left_semi")
            if left + 2 * width == 64:  # the first digit leaves few rows: they are what the next rounds read
                part = materialise(part, "quantile-rows")
                rows = part.select("k", "c", "x")
        counts = part.groupBy("k", "c", "prefix", "digit").agg(F.count(F.lit(1)).alias("m"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        before = Window.partitionBy("k", "c", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
        start = F.col("below") + F.col("before")
        found = (narrow.join(counts, ["k", "c", "prefix"]).where((start <= F.col("r")) & (F.col("r") < start + F.col("m")))
                 .select("k", "c", "r", "lo", "hi", start.alias("below"),
                         F.shiftleft("prefix", width).bitwiseOR(F.col("digit")).alias("prefix")))
        state = materialise(found.unionByName(state.where("lo = hi")), "quantile-state")
    at = lambda r, v: state.select("k", "c", F.col("r").alias(r), F.col("lo").alias(v))
    out = asked.select("k", "c", "g", "n", "q", "r1", "r2", "part").join(at("r1", "v1"), ["k", "c", "r1"]).join(
        at("r2", "v2"), ["k", "c", "r2"])
    value = F.when((F.col("v1") == F.col("v2")) | (F.col("part") == 0), F.col("v1")).otherwise(
        F.col("v1") + (F.col("v2") - F.col("v1")) * F.col("part"))
    head = [F.col("g").cast(df.schema[group].dataType).alias(group)] if group else []
    return out.select(*head, F.element_at(names, F.col("c")).alias("column_name"), "q", "n", value.alias("value"))
