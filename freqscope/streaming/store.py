"""Tables that a stream keeps by merging one delta per micro-batch.

Batch ``b`` writes its own delta into a folder named by ``b``; every ``FAN`` deltas are merged
into one folder of the next level, every ``FAN`` of those into one above, and so on.  So a
batch's work grows with the batch (each row is rewritten once per level), not with the
history, and a read opens at most ``FAN - 1`` folders a level.

Which folders make up the table follows from the number of batches alone, in the
manner of its digits; there is no manifest to keep in step.  A batch that runs again
overwrites what it wrote, from inputs that are deleted only one batch later, so every
batch counts exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN = 8


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def newest(spark: SparkSession, folder: str) -> int:
    """The largest number that names a folder in ``folder``; -1 if there is none."""
    path, fs = _path(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


class DeltaTable:
    """``how``: ``sum`` adds the value columns of a key; ``last`` keeps the values of
    the highest batch."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], values: dict[str, str],
                 key_types: dict[str, str], how: str = "sum", fan: int | None = None):
        self.spark, self.folder, self.keys, self.values, self.how, self.fan = spark, folder, keys, values, how, fan or FAN
        columns = {**{k: key_types[k] for k in keys}, **values, **({"batch": "bigint"} if how == "last" else {})}
        self.schema = T._parse_datatype_string(", ".join(f"{c} {t}" for c, t in columns.items()))

    def _at(self, level: int, number: int) -> str:
        return f"{self.folder}/{level}/{number}"

    def live(self, batches: int) -> list[tuple[int, int]]:
        """(level, number) of the folders that hold the first ``batches`` batches."""
        level = 0
        while self.fan ** (level + 1) <= batches:
            level += 1
        out, done = [], 0
        while done < batches:
            size = self.fan ** level
            if done + size <= batches:
                out.append((level, done // size))
                done += size
            else:
                level -= 1
        return out

    def _merge(self, df: DataFrame) -> DataFrame:
        if self.how == "sum":
            return df.groupBy(*self.keys).agg(*[F.sum(v).cast(t).alias(v) for v, t in self.values.items()])
        last = F.max_by(F.struct(*self.values, "batch"), "batch").alias("v")
        return df.groupBy(*self.keys).agg(last).select(*self.keys, "v.*")

    def _read(self, folders: list[tuple[int, int]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._at(*f) for f in folders])

    def append(self, delta: DataFrame, batch: int, keep: Column | None = None) -> None:
        """Write the delta of ``batch``, its keys distinct, and merge what is full.
        Merged rows outside ``keep`` are left out (the table's retention)."""
        if self.how == "last":
            delta = delta.withColumn("batch", F.lit(batch).cast("bigint"))
        self._write(delta, 0, batch)
        level, n = 1, batch + 1
        while n % self.fan ** level == 0:
            number = batch // self.fan ** level
            rows = self._merge(self._read([(level - 1, number * self.fan + k) for k in range(self.fan)]))
            self._write(rows if keep is None else rows.where(keep), level, number)
            level += 1
        if batch:
            self._forget(batch - 1)

    def _write(self, df: DataFrame, level: int, number: int) -> None:
        df.select(*self.schema.names).write.mode("overwrite").parquet(self._at(level, number))

    def _forget(self, batch: int) -> None:
        """Delete the folders that ``batch`` merged into larger ones."""
        level = 1
        while (batch + 1) % self.fan ** level == 0:
            for k in range(self.fan):
                delete(self.spark, self._at(level - 1, batch // self.fan ** level * self.fan + k))
            level += 1

    def read(self, batches: int, where: Column | None = None) -> DataFrame:
        """The table after ``batches`` batches; a filter on keys reaches the scans."""
        rows = self._read(self.live(batches))
        merged = self._merge(rows if where is None else rows.where(where))
        return merged.select(*self.keys, *self.values)
