"""Text-file sources of the reference formats.

Every reader has an explicit schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions.text import tokenize


def _parse_ts(col):
    # Strip, drop a trailing 'Z', naive means UTC.  Parsed as TIMESTAMP_NTZ
    # so the session time zone never shifts the value.
    s = F.regexp_replace(F.trim(col), "Z$", "")
    return F.coalesce(
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")),
    ).cast("timestamp_ntz")


def read_events_csv(spark: SparkSession, path: str, slot_seconds: int = params.SLOT_SECONDS,
                    strict: bool = False, trim_items: bool = False,
                    max_seconds: float | None = None,
                    max_events: int | None = None) -> DataFrame:
    """S1 (lenient) / S2 (strict) event CSV with ``timestamp`` or ``slot``.

    Returns ``(row_id, ts, item, slot)``.  Lenient mode drops rows with a bad
    timestamp/slot or a missing item; strict mode raises on them (D16: ``trim``
    is an option).  ``max_events`` (P5) counts raw rows in file order,
    ``max_seconds`` (P4) cuts on elapsed time (0/None = no limit, D8).
    """
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .schema(T.StructType([T.StructField(c, T.StringType()) for c in
                                 _header(spark, path)]))
           .csv(path)
           .withColumn("row_id", F.monotonically_increasing_id()))
    if max_events:
        raw = raw.orderBy("row_id").limit(int(max_events))
    item = F.col("ngram")
    if trim_items:
        item = F.trim(item)
    cols = raw.columns
    if "timestamp" in cols:
        ts = _parse_ts(F.col("timestamp"))
        df = raw.select("row_id", ts.alias("ts"), item.alias("item"))
        if strict:
            bad = df.where(F.col("ts").isNull() | F.col("item").isNull()
                           | (F.length("item") == 0)).limit(1).count()
            if bad:
                raise ValueError(f"malformed event rows in {path}")
        df = df.where(F.col("ts").isNotNull() & F.col("item").isNotNull())
        df = with_slots_from_ts(df, slot_seconds)
        if max_seconds:
            df = df.where(F.col("elapsed_s") <= F.lit(float(max_seconds)))
        return df.drop("elapsed_s")
    if "slot" in cols:
        slot = F.col("slot").try_cast("bigint")
        df = raw.select("row_id", F.lit(None).cast("timestamp_ntz").alias("ts"),
                        item.alias("item"), slot.alias("raw_slot"))
        if strict:
            if df.where(F.col("raw_slot").isNull() | F.col("item").isNull()).limit(1).count():
                raise ValueError(f"malformed event rows in {path}")
        df = df.where(F.col("raw_slot").isNotNull() & F.col("item").isNotNull())
        base = df.select(F.min("raw_slot")).scalar()  # P3: rebase to the first slot
        return df.select("row_id", "ts", "item", (F.col("raw_slot") - base).alias("slot"))
    raise ValueError("event file needs a 'timestamp' or a 'slot' column next to 'ngram'")


def with_slots_from_ts(df: DataFrame, slot_seconds: int) -> DataFrame:
    origin = df.select(F.min("ts")).scalar()
    micros = F.timestamp_diff("MICROSECOND", origin, F.col("ts"))
    return (df.withColumn("slot", F.floor(micros / F.lit(slot_seconds * 1_000_000)).cast("bigint"))
              .withColumn("elapsed_s", micros / F.lit(1e6)))


def _names(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names of the first header line, read as CSV so that quotes count."""
    row = spark.read.option("sep", sep).option("header", False).csv(path).limit(1).collect()
    return [str(c or "").strip() for c in row[0]] if row else []


def _header(spark: SparkSession, path: str) -> list[str]:
    names = _names(spark, path, ",")
    if not names:
        return ["ngram"]
    if "ngram" not in names:
        raise ValueError("event file has no 'ngram' column")
    return names


def read_query_log_tokens(spark: SparkSession, path: str) -> DataFrame:
    """S3: tab-separated log, field 1 is the query; lines with < 2 fields are
    skipped; the header line of every file is skipped (D11).  One row per token, one
    pass over the log."""
    log = (spark.read.option("header", True).option("sep", "\t").option("quote", "").option("enforceSchema", True)
           .schema("first string, query string").csv(path))
    return log.where(F.col("query").isNotNull()).select(F.explode(tokenize(F.col("query"))).alias("token"))


def read_url_list(spark: SparkSession, path: str, column: str = "ClickURL") -> DataFrame:
    """TSV with a header; lines with more or fewer fields than it are dropped;
    distinct non-null URLs.  Lines are parsed whole, as pruned columns would hide a
    field too many."""
    names = _names(spark, path, "\t")
    if column not in names:
        raise ValueError(f"no column {column!r} in {path}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = (spark.read.option("header", True).option("sep", "\t").option("mode", "DROPMALFORMED")
          .option("columnPruning", False).schema(schema).csv(path))
    return df.select(F.col(column).alias("url")).where(F.col("url").isNotNull()).distinct()
