"""Report jobs behind the sinks K1, K2, K3 and K5: a plan's rows, written as JSON."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import write_json, write_tsv
from . import events, tokens


def write_metrics(spark: SparkSession, sf_dir: str, path: str) -> None:
    """K1: the metrics row of the flagship job."""
    write_json(events.accuracy_metrics(spark, sf_dir), path)


def write_core(spark: SparkSession, sf_dir: str, path: str) -> None:
    """K2: (target, window_slots, true, est) of the horizon's top items."""
    rows = events.window_accuracy(spark, sf_dir)
    write_json(rows.select(F.col("item").alias("target"), "window_slots", F.col("true_count").alias("true"),
                           F.col("est_count").alias("est")), path)


def write_bursts(spark: SparkSession, sf_dir: str, path: str) -> None:
    """K3: burst scores per bucket and target."""
    rows = events.bucket_burst_estimates(spark, sf_dir)
    write_json(rows.select("bucket", F.col("item").alias("target"), "true_burst", "est_burst", "true_recent",
                           "true_history", "est_recent", "est_history"), path)


def write_token_report(spark: SparkSession, sf_dir: str, path: str) -> None:
    """K5, three folders under ``path``: ``statistics`` (tokens, distinct tokens, bytes of an exact
    dictionary, in one row), ``intersection`` (each sketch's overlap with the true top list, a row per
    width, a column per sketch) and ``errors`` (every sketch, width and token set)."""
    write_json(tokens.dictionary_stats(spark, sf_dir).withColumn("depth", F.lit(tokens.P.TOKEN_DEPTH))
               .withColumn("widths", F.array(*[F.lit(w) for w in tokens.P.TOKEN_WIDTHS])), f"{path}/statistics")
    overlap = tokens.topk_overlap(spark, sf_dir).groupBy("R").pivot("sketch", list(tokens.SKETCHES)).agg(F.first("overlap"))
    write_tsv(overlap.orderBy("R"), f"{path}/intersection")
    write_json(tokens.token_error_sets(spark, sf_dir), f"{path}/errors")
