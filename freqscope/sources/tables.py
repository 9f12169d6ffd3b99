"""Readers for the Parquet tables and the canonical event frame.

The canonical event frame is ``(ts, item)``, counted as ``(item, slot, cnt)``:

* ``item``  = ``event_type || ':' || user_id``
* ``slot``  = whole ``slot_seconds`` elapsed since the first event (P2)

The slot arithmetic uses ``timestamp_diff`` on the TIMESTAMP_NTZ column, so it
does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions.text import tokenize


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df


def with_slots(df: DataFrame, ts_col: str = "ts", slot_seconds: int = params.SLOT_SECONDS,
               origin: Column | None = None) -> DataFrame:
    """Add ``slot`` (P2); rows before the origin get negative slots and are
    dropped by the P8 guard, exactly like the reference's sketches ignore them."""
    if origin is None:
        origin = df.select(F.min(ts_col)).scalar()
    micros = F.timestamp_diff("MICROSECOND", origin, F.col(ts_col))
    slot = F.floor(micros / F.lit(slot_seconds * 1_000_000)).cast("bigint")
    return df.withColumn("slot", slot).where(F.col("slot") >= 0)


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events ``(ts, item)``: only the three needed columns reach the scan."""
    return (read_table(spark, sf_dir, "events", ["ts", "event_type", "user_id"])
            .where(F.col("ts").isNotNull() & F.col("event_type").isNotNull() & F.col("user_id").isNotNull())
            .select("ts", F.concat(F.col("event_type"), F.lit(":"), F.col("user_id").cast("string")).alias("item")))


def documents_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 over ``documents.text``: one row per token occurrence."""
    docs = read_table(spark, sf_dir, "documents", ["text"]).where(F.col("text").isNotNull())
    return docs.select(F.explode(tokenize(F.col("text"))).alias("token"))


def distinct_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 over ``pages.url``: non-null, unique URLs (U3).  Each task combines its own
    rows before the shuffle, so a hot URL travels once per task."""
    return read_table(spark, sf_dir, "pages", ["url"]).where(F.col("url").isNotNull()).distinct()
