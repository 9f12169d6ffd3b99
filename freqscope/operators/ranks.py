"""Exact order statistics without a sorted list of a group.

The wanted rank's value is closed in on from both sides: each round cuts every group's
range into ``BINS`` equal bins, counts the bins with partial aggregation, goes on with the
bin that holds the rank, and shrinks the range to the least and largest value in it.  It
ends when these are equal.  A round divides the range by at least ``BINS``; per group
only ``BINS`` counts meet in one task, whatever its size, also without any grouping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions.hashing import broadcast_bytes
from ..session import cut_lineage

BINS = 1024


def nearest_ranks(df: DataFrame, keys: list[str], value: str, percents: list[float]) -> DataFrame:
    """``(keys, percent, n, value)``: the element at round-half-even(p / 100 * (n - 1)),
    0-based, of each group's non-null values."""
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).cast("double").alias("x")).where("x is not null")
    rows = cut_lineage(rows)
    asked = F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("percent")
    state = (rows.groupBy(*names).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
             .where("n > 0").select(*names, asked, "n", "lo", "hi"))
    rank = F.bround(F.col("percent") / 100.0 * (F.col("n") - 1), 0).cast("bigint")
    state = cut_lineage(state.withColumn("left", rank))  # values of the range that come before the wanted one
    strings = [n for n in names if isinstance(rows.schema[n].dataType, T.StringType)]
    while True:
        open_ = state.where("lo < hi")
        # rows and bytes of text: two numbers
        size = open_.agg(F.count("*").alias("n"), F.coalesce(F.sum(sum((F.coalesce(F.octet_length(n), F.lit(0)) for n in strings), F.lit(0))),
                                                             F.lit(0)).alias("text")).first()
        if not size["n"]:
            break
        if broadcast_bytes(size["n"], len(open_.columns)) + 2 * size["text"] <= params.BROADCAST_BOUND_BYTES:
            open_ = F.broadcast(open_)  # measured small: the values stay where they are
        same = [F.col(f"s.{n}").eqNullSafe(F.col(f"r.{n}")) for n in names]
        inside = F.col("x").between(F.col("lo"), F.col("hi"))
        place = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        # one row per group and percent: broadcast for few groups, else an equi-join
        met = rows.alias("r").join(open_.alias("s"), [*same, inside] if same else inside)
        bins = (met.select(*[F.col(f"s.{n}").alias(n) for n in names], "percent", "n", "left", place.alias("bin"), "x")
                .groupBy(*names, "percent", "n", "left", "bin")
                .agg(F.count("*").alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi")))
        before = F.coalesce(F.sum("c").over(Window.partitionBy(*names, "percent").orderBy("bin")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        bins = bins.withColumn("before", before).where("before <= left and left < before + c")
        state = cut_lineage(state.where("lo = hi").unionByName(
            bins.select(*names, "percent", "n", "lo", "hi", (F.col("left") - F.col("before")).alias("left"))))
    return state.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "percent", "n", F.col("lo").alias(value))
