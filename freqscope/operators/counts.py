"""Exact counts and top-K."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params


def item_counts(df: DataFrame, item: str = "item", name: str = "cnt") -> DataFrame:
    """G1: exact count per item (partial aggregation before the shuffle).  Rows
    that carry a ``cnt`` already count as many."""
    n = F.sum("cnt") if "cnt" in df.columns else F.count(F.lit(1))
    return df.groupBy(item).agg(n.cast("bigint").alias(name))


def top_k(counts: DataFrame, k: int, item: str = "item", cnt: str = "cnt",
          ascending: bool = False) -> DataFrame:
    """Order by count (desc, or asc for bottom-k), ties by item.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every partition
    keeps k rows, so nothing unbounded reaches one task."""
    order = F.col(cnt).asc() if ascending else F.col(cnt).desc()
    return counts.orderBy(order, F.col(item).asc()).limit(k)


def ranked(df: DataFrame, order_cols, name: str = "rank") -> DataFrame:
    """Attach a dense 1..n rank to an already small (top-k) frame."""
    from pyspark.sql import Window
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order_cols)).cast("bigint"))


def horizon_targets(ev: DataFrame, start: Column, end: Column, k: int = params.TOP_K) -> DataFrame:
    """Top-k items inside [start, end].  The horizon always holds the
    newest slot, so it is never empty for a non-empty stream and the global
    fallback of the reference cannot trigger."""
    inside = ev.where(F.col("slot").between(start, end))
    top = top_k(item_counts(inside), k)
    return ranked(top, [F.col("cnt").desc(), F.col("item").asc()])


def window_candidates(eval_last_slots: int = params.EVAL_LAST_SLOTS) -> list[int]:
    """Window sizes 1, 4, 16, ...; the static superset, cut at run time by
    ``w <= max_window`` (scalar subqueries cannot sit inside lambdas)."""
    limit = eval_last_slots if eval_last_slots and eval_last_slots > 0 else 4 ** 15
    return [4 ** i for i in range(16) if 4 ** i <= limit]


def eval_points(first: Column, last: Column, n: int = params.NUM_EVAL_POINTS) -> Column:
    """W8 grid: about ``n`` evenly spaced points in [first, last], the last one
    always included (``range(first, last + 1, step)`` plus ``last``)."""
    span = last - first + 1
    num = F.least(F.lit(n).cast("bigint"), span)
    step = F.greatest(F.lit(1).cast("bigint"), F.floor(span / num).cast("bigint"))
    pts = F.sequence(first, last, step)
    return F.array_distinct(F.concat(pts, F.array(last)))


def explode_points(df: DataFrame, points: Column, name: str) -> DataFrame:
    """One row per evaluation point (points may hold scalar subqueries, so no
    lambda touches them)."""
    return df.withColumn(name, F.explode(points))
