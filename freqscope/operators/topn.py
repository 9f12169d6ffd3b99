"""Top-n rows per group without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    salt_of: Column, salt_buckets: int = 64, name: str = "rank") -> DataFrame:
    """Two-phase top-n: first per (group, salt) - each salted slice of a hot
    group is ranked in its own task - then per group over at most
    ``n * salt_buckets`` survivors.  Exact: a row in the global top-n is in
    the top-n of its own slice."""
    salted = df.withColumn("_salt", F.pmod(salt_of, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (pre.drop("_salt", "_r1").withColumn(name, F.row_number().over(w2).cast("bigint"))
            .where(F.col(name) <= n))
