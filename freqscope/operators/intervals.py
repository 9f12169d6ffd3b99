"""Counts in the intervals that a table of requests asks for.

A request is a row ``(item, a, b)``: the item's count in the slots a to b, both
included.  Slots before 0 or the retention count as empty, as does a request with b < a.
No join compares ranges alone: a request becomes one row per bin of slots it touches and meets
counts by equality; it meets a sketch's cells by chunks of slots (``reads``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from .reads import KEY, dyadic_sums, ring_sums
from .windowed import dyadic_cells, ring_cells

#: slots of one bin of the binned joins
BIN_SLOTS = 16


def _asked(requests: DataFrame) -> DataFrame:
    return requests.select("item", F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")) \
        .where("item is not null and a is not null and b is not null").distinct()


def _at_level(level: int):
    return lambda seg: F.struct(F.lit(level).cast("bigint").alias("level"), seg.cast("bigint").alias("seg"))


def dyadic_cover(requests: DataFrame, levels: int = params.DYADIC_LEVELS) -> DataFrame:
    """J3 planner: ``(all columns, level, seg)``, the maximal aligned segments inside [a, b].

    Below the top level a cover has at most a left edge (an odd first segment) and a
    right edge (an even last one); the top level holds the run between them."""
    a, b = F.greatest(F.col("a"), F.lit(0).cast("bigint")), F.col("b")
    parts = []
    for level in range(levels):
        first, last = F.shiftright(a + ((1 << level) - 1), level), F.shiftright(b + 1, level) - 1
        if level == levels - 1:
            segs = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        else:
            left = F.when((first <= last) & (F.pmod(first, F.lit(2)) == 1), first)
            right = F.when((first <= last) & (F.pmod(last, F.lit(2)) == 0), last)
            segs = F.filter(F.array(left, right), lambda s: s.isNotNull())
        parts.append(F.transform(segs, _at_level(level)))
    return requests.withColumn("piece", F.explode(F.concat(*parts))).select(*requests.columns, "piece.level", "piece.seg")


def _bins(requests: DataFrame) -> DataFrame:
    a, b = F.greatest(F.col("a"), F.lit(0).cast("bigint")), F.col("b")
    span = F.sequence(F.floor(a / BIN_SLOTS).cast("bigint"), F.floor(b / BIN_SLOTS).cast("bigint"))
    return requests.where(a <= b).withColumn("bin", F.explode(span))


def _bin(slot: str) -> Column:
    return F.floor(F.col(slot) / BIN_SLOTS).cast("bigint").alias("bin")


def requested_counts(counts: DataFrame, requests: DataFrame) -> DataFrame:
    """``(item, a, b, true_count)`` from ``(item, slot, cnt)``: requests meet counts by (item, bin)."""
    met = _bins(_asked(requests)).join(counts.select("item", "slot", "cnt", _bin("slot")), ["item", "bin"])
    return met.where("slot between a and b").groupBy(*KEY).agg(F.sum("cnt").cast("bigint").alias("true_count"))


def requested_dyadic(counts: DataFrame, requests: DataFrame, width: int = params.WIDTH, levels: int = params.DYADIC_LEVELS,
                     min_width: int = params.DYADIC_MIN_WIDTH, depth: int = params.DEPTH,
                     seed: int = params.DYADIC_SEED) -> DataFrame:
    """``(item, a, b, est)``, the sum of the cover's Count-Min reads.  An item is hashed once
    per row; the levels' columns are that hash mod their widths."""
    newest = counts.agg(F.max("slot")).first()[0]  # one number
    cells = dyadic_cells(counts, [width], levels, min_width, depth, seed)
    return dyadic_sums(cells, _asked(requests), -1 if newest is None else newest, width, levels, min_width, depth, seed)


def requested_ring(counts: DataFrame, requests: DataFrame, T: Column, buffer_slots: Column, width: int = params.WIDTH,
                   depth: int = params.DEPTH, seed: int = params.RING_SEED) -> DataFrame:
    """``(item, a, b, est)``, the sum over the retained slots of the interval of the
    slots' Count-Min reads."""
    cells = ring_cells(counts, T, buffer_slots, [width], depth, seed)
    lo = F.greatest(T - buffer_slots + 1, F.lit(0).cast("bigint"))
    return ring_sums(cells, _asked(requests), lo, T, width, depth, seed)


def answered(requests: DataFrame, **answers: DataFrame) -> DataFrame:
    """Every request with one column per answer, 0 where there is none; repeated requests repeat."""
    out = requests
    for name, answer in answers.items():
        value = answer.columns[-1]
        out = out.join(answer.withColumnRenamed(value, name), KEY, "left")
    return out.select(*requests.columns, *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in answers])
