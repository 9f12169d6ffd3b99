"""Shared helpers of the corpus operators: tables, shared storage, iteration."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark (file, directory or any Spark path)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, by the rule of the session."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts lineage: lost executors cost a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def field(df: DataFrame, name: str) -> T.StructField:
    return T.StructField(name, df.schema[name].dataType, True)


#: rows that a map over texts holds in Python at a time
SLICE_ROWS = 1000


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], list], schema: T.StructType,
              slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` for functions that turn one batch into one list of columns.

    ``fn`` gets slices of a batch and returns one array or list per field of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                cols = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                        for c, f in zip(fn(batch.slice(at, slice_rows)), arrow)]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.mapInArrow(run, schema)


def text_or_empty(column: str):
    """Null texts count as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def hash_sample(df: DataFrame, hashed, wanted: int, total: int) -> DataFrame:
    """About ``wanted`` of ``total`` rows, twice as many at most: those of the least hashes.

    The share is compared with all 63 bits of the hash, so it does not round to nothing
    on tables of any size that a count can hold."""
    if total <= wanted:
        return df
    return df.where(F.shiftrightunsigned(F.xxhash64(*hashed), 1) < F.lit(wanted * (1 << 63) // total)).limit(2 * wanted)
