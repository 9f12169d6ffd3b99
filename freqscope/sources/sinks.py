"""Sinks (K1-K5): JSON lines and tab-separated tables, written by executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1/K2/K3/K5: one JSON object per row."""
    df.write.mode(mode).json(path)


def write_tsv(df: DataFrame, path: str, digits: int = 6, mode: str = "overwrite") -> None:
    """K4: tab separated with a header; doubles printed with ``digits``
    decimals and a missing metric written as NaN."""
    cols = []
    for name, dtype in df.dtypes:
        if dtype in ("double", "float"):
            # a null formats as cut-off text, not as null
            cols.append(F.when(F.col(name).isNull(), F.lit("NaN"))
                        .otherwise(F.format_string(f"%.{digits}f", F.col(name))).alias(name))
        else:
            cols.append(F.col(name))
    (df.select(*cols).write.mode(mode).option("sep", "\t").option("header", True)
       .csv(path))
