"""Accuracy metrics of estimates against exact answers.

The percentiles sort one list per group: they are for query grids (targets x
windows / buckets / times), whose size is set by parameters.  ``percentiles=False``
leaves them out, for inputs with a row per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params

METRIC_COLUMNS = [
    "num_queries", "mae", "rmse", "mean_relative_error", "weighted_relative_l1",
    "median_relative_error", "p90_relative_error", "max_relative_error",
    "mae_active", "rmse_active", "mean_relative_error_active", "weighted_relative_l1_active",
    "false_positive_rate", "avg_false_positive_estimate", "max_false_positive_estimate",
]


def abs_rel_error(true: Column, est: Column):
    """Absolute error, and relative error that is 0 when the truth is 0."""
    ab = F.abs(est - true)
    rel = F.when(true > 0, ab / true).otherwise(F.lit(0.0))
    return ab, rel


def with_errors(df: DataFrame, true: str, est: str) -> DataFrame:
    ab, rel = abs_rel_error(F.col(true), F.col(est))
    return df.withColumn("abs_error", ab).withColumn("rel_error", rel.cast("double"))


def nearest_rank(sorted_arr: Column, n: Column, pct: float) -> Column:
    """Element at round-half-even(pct/100 * (n-1)), 0-based."""
    idx = F.bround(F.lit(pct / 100.0) * (n - 1), 0).cast("int") + 1
    return F.when(n > 0, F.element_at(sorted_arr, idx)).otherwise(F.lit(0.0))


def accuracy_aggs(true: str = "true_count", est: str = "est_count", percentiles: bool = True) -> list[Column]:
    """G23 + G25 as aggregate expressions over rows with abs_error/rel_error."""
    t, e, ab, rel = F.col(true), F.col(est), F.col("abs_error"), F.col("rel_error")
    n = F.count(F.lit(1))
    active = t > 0
    sum_true = F.sum(t)
    sorted_rel = F.sort_array(F.collect_list(rel))
    zero = F.lit(0.0)
    n_inactive = F.sum(F.when(~active, 1).otherwise(0))
    return [
        n.cast("double").alias("num_queries"),
        F.coalesce(F.avg(ab), zero).alias("mae"),
        F.coalesce(F.sqrt(F.avg(ab * ab)), zero).alias("rmse"),
        F.coalesce(F.avg(rel), zero).alias("mean_relative_error"),
        F.when(sum_true > 0, F.sum(ab) / sum_true).otherwise(zero).alias("weighted_relative_l1"),
        *([nearest_rank(sorted_rel, n, 50.0).alias("median_relative_error"),
           nearest_rank(sorted_rel, n, 90.0).alias("p90_relative_error")] if percentiles else []),
        F.coalesce(F.max(rel), zero).alias("max_relative_error"),
        F.coalesce(F.avg(F.when(active, ab)), zero).alias("mae_active"),
        F.coalesce(F.sqrt(F.avg(F.when(active, ab * ab))), zero).alias("rmse_active"),
        F.coalesce(F.avg(F.when(active, rel)), zero).alias("mean_relative_error_active"),
        F.when(sum_true > 0, F.sum(F.when(active, ab).otherwise(0)) / sum_true)
         .otherwise(zero).alias("weighted_relative_l1_active"),
        F.when(n_inactive > 0,
               F.sum(F.when(~active & (e > 0), 1).otherwise(0)) / n_inactive)
         .otherwise(zero).alias("false_positive_rate"),
        F.coalesce(F.avg(F.when(~active, e)), zero).alias("avg_false_positive_estimate"),
        F.coalesce(F.max(F.when(~active, e)), zero).cast("double")
         .alias("max_false_positive_estimate"),
    ]


def accuracy_metrics(df: DataFrame, keys: list[str], true: str = "true_count",
                     est: str = "est_count", digits: int = params.ROUND_DIGITS,
                     percentiles: bool = True) -> DataFrame:
    """One metrics row per group of ``keys``."""
    m = with_errors(df, true, est).groupBy(*keys).agg(*accuracy_aggs(true, est, percentiles))
    return round_doubles(m, digits)


def round_doubles(df: DataFrame, digits: int = params.ROUND_DIGITS) -> DataFrame:
    cols = [F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
            for c, t in df.dtypes]
    return df.select(*cols)


def error_histogram(df: DataFrame, value: str = "rel_error", bins: int = params.HIST_BINS,
                    digits: int = params.ROUND_DIGITS) -> DataFrame:
    """``bins`` equal bins over [min, max] (the last bin closed, as
    NumPy); a constant sample spreads over [v-0.5, v+0.5].

    One job finds the range; each value then falls into its bin, and the bins are
    counted with partial aggregation."""
    df = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    ends = df.agg(F.min("x").alias("a"), F.max("x").alias("b")).first()
    if ends["a"] is None:
        lo, hi, bins = 0.0, 1.0, 0
    elif ends["b"] > ends["a"]:
        lo, hi = ends["a"], ends["b"]
    else:
        lo, hi = ends["a"] - 0.5, ends["b"] + 0.5
    place = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("bigint")
    counted = df.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every.join(counted, "bin", "left").select(
        "bin",
        F.round(F.lit(lo) + F.lit(hi - lo) * F.col("bin") / F.lit(max(1, bins)), digits).alias("bin_lo"),
        F.round(F.lit(lo) + F.lit(hi - lo) * (F.col("bin") + 1) / F.lit(max(1, bins)), digits).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
