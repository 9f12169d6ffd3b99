"""Frequent items with k counters (G21): a mergeable summary with its error bound.

A summary is a frame ``(item, cnt, lost, n)``: at most k items with lower bounds of their
counts, ``lost`` (the same in every row) the most that any count is below the truth, ``n`` the
rows summed up.  Two or more summaries merge by adding counters, then subtracting the
(k + 1)-th largest from all and dropping what is not positive: each such subtraction takes
away at least k + 1 times as much, so ``lost`` stays below ``n / (k + 1)`` in any order of
merges.  Every item with a larger count is in the summary.

A row of a null item carries ``lost`` and ``n`` where no counter is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SCHEMA = "item string, cnt bigint, lost bigint, n bigint"
_NAMES = ["item", "cnt", "lost", "n"]


class _Counters:
    """The summary of one task: never more than k counters between two batches."""

    def __init__(self, k: int):
        self.k, self.lost, self.n = k, 0, 0
        self.held = pa.table({"item": pa.array([], pa.string()), "cnt": pa.array([], pa.int64())})

    def add(self, items: pa.Array, counts: pa.Array) -> None:
        self.n += pc.sum(counts).as_py() or 0
        both = pa.concat_tables([self.held, pa.table({"item": items.cast(pa.string()), "cnt": counts.cast(pa.int64())})])
        both = both.group_by("item").aggregate([("cnt", "sum")]).rename_columns(["item", "cnt"])
        if both.num_rows > self.k:
            cut = both["cnt"].take(pc.select_k_unstable(both, self.k + 1, [("cnt", "descending")]))[self.k].as_py()
            self.lost += cut
            both = both.set_column(1, "cnt", pc.subtract(both["cnt"], cut)).filter(pc.greater(both["cnt"], cut))
        self.held = both

    def rows(self) -> pa.RecordBatch:
        items, counts = self.held["item"].to_pylist() + [None], self.held["cnt"].to_pylist() + [0]
        size = len(items)
        return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(counts, pa.int64()), pa.array([self.lost] * size, pa.int64()),
                                           pa.array([self.n] * size, pa.int64())], names=_NAMES)


def task_summaries(rows: DataFrame, item: str, cnt: str | None, k: int) -> DataFrame:
    """One summary per task, next to each other.  ``item`` may be an array of items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counters(k)
        for batch in batches:
            items = batch.column(0)
            if pa.types.is_list(items.type) or pa.types.is_large_list(items.type):
                items = items.flatten()
            counts = batch.column(1) if cnt else pa.array([1]).take(pa.array([0] * len(items), pa.int64()))
            full = pc.is_valid(items)
            held.add(items.filter(full), counts.filter(full))
        yield held.rows()

    return rows.select(item, *([cnt] if cnt else [])).mapInArrow(run, SCHEMA)


def merge_summaries(parts: DataFrame, k: int) -> DataFrame:
    """One summary of all rows of ``parts``, which holds one or more summaries.

    Only k + 1 counters reach one task, for the value to subtract."""
    heads = parts.where("item is null").agg(F.coalesce(F.sum("lost"), F.lit(0)).cast("bigint").alias("lost"),
                                            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n"))
    added = parts.where("item is not null").groupBy("item").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    first = added.select("cnt").orderBy(F.desc("cnt")).limit(k + 1)
    cut = first.agg(F.when(F.count("*") > k, F.min("cnt")).otherwise(F.lit(0)).cast("bigint").alias("cut")).scalar()
    lost, n = heads.select("lost").scalar() + cut, heads.select("n").scalar()
    left = added.where(F.col("cnt") > cut).select("item", (F.col("cnt") - cut).alias("cnt"))
    head = parts.sparkSession.range(1).select(F.lit(None).cast("string").alias("item"), F.lit(0).cast("bigint").alias("cnt"))
    return left.unionByName(head).select("item", "cnt", lost.cast("bigint").alias("lost"), n.cast("bigint").alias("n"))


def summarise(rows: DataFrame, item: str, cnt: str | None, k: int) -> DataFrame:
    """One pass over ``rows``; the tasks' summaries are written once, as several plans read them."""
    return merge_summaries(cut_lineage(task_summaries(rows, item, cnt, k)), k)


def covered(truth: DataFrame, summary: DataFrame, true: str, k: int) -> DataFrame:
    """``inside``: the true count lies within the summary's bounds, and the bound within n / (k + 1)."""
    head = summary.where("item is null")
    most, n = head.select("lost").scalar(), head.select("n").scalar()
    mine = F.broadcast(summary.where("item is not null").select("item", F.col("cnt").alias("low")))  # k rows
    low = F.coalesce("low", F.lit(0))
    inside = (F.col(true) >= low) & (F.col(true) <= low + most) & (most * (k + 1) <= n)
    return truth.join(mine, "item", "left").select(*truth.columns, inside.alias("inside"))
