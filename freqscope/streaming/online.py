"""Streaming jobs whose results exist while the stream runs (ST4, ST6-ST9).

Each micro-batch becomes one table of ``(hour, item, cnt)``, written once and read by all
that follows; a part (cells, bursts, hitters, snapshots) merges it into tables it keeps
(``store.DeltaTable``).  After every batch the part's result can be read; a batch that
runs again overwrites its own folders, and a driver that starts again goes on after the
last batch.

Late rows (ST4): a row is late if its hour lies more than ``RETENTION_HOURS`` before the
newest hour of the batches before it.  Late rows change no state; they are counted per hour
and item in a table of their own and summed over all batches in ``marks``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params as P
from ..operators.counts import ranked, top_k
from ..operators.sketch import cm_min, event_cells, event_probes
from ..operators.summary import covered, merge_summaries, task_summaries
from ..operators.topn import top_n_per_group
from ..operators.windowed import burst_score
from ..plans.events_sql import D, burst, sha_idx
from .jobs import HOUR, MAX_FILES, event_stream, progress_folder
from .store import DeltaTable, delete, newest

R = P.ROUND_DIGITS
RETENTION_HOURS = P.EVAL_LAST_SLOTS
TYPES = {"hour": "bigint", "item": "string", "bucket": "bigint", "level": "bigint", "seg": "bigint", "row": "bigint",
         "col": "bigint", "at_hour": "bigint", "rank": "bigint"}
COUNT = {"cnt": "bigint"}
#: hours between two snapshots, items in one
SNAPSHOT_HOURS, SNAPSHOT_ITEMS = 24, P.TOP_K
#: counters of the heavy-hitter summary
COUNTERS = 256


@dataclass
class Batch:
    """One micro-batch after late rows are gone."""

    number: int
    counts: DataFrame
    first: int | None  # least hour
    newest: int | None  # newest hour of this and all earlier batches
    before: int | None  # newest hour of the earlier batches

    @property
    def horizon(self) -> int:
        """The least hour that a row of a later batch can have."""
        return self.newest - RETENTION_HOURS


class Part:
    """What one job keeps: ``step`` merges a batch, ``result`` reads the state."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _table(self, name: str, keys: list[str], values: dict[str, str] = COUNT, how: str = "sum") -> DeltaTable:
        return DeltaTable(self.spark, f"{self.folder}/{name}", keys, values, TYPES, how)

    def step(self, batch: Batch) -> None:
        raise NotImplementedError

    def result(self, batches: int) -> DataFrame:
        raise NotImplementedError


class Cells(Part):
    """ST6: Count-Min cells of every hour and of the dyadic segments above it."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.cells = self._table("cells", ["level", "seg", "row", "col"])

    def step(self, batch):
        hourly = event_cells(batch.counts, ["hour"], P.DEPTH, P.WIDTH, P.RING_SEED)
        level = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(P.DYADIC_LEVELS - 1).cast("bigint")))
        width = F.greatest(F.expr(f"shiftright({P.WIDTH}L, level)"), F.lit(P.DYADIC_MIN_WIDTH).cast("bigint"))
        up = (hourly.withColumn("level", level)
              .groupBy("level", F.expr("shiftright(hour, level)").alias("seg"), "row",
                       F.pmod(F.col("col"), width).cast("bigint").alias("col"))
              .agg(F.sum("cnt").cast("bigint").alias("cnt")))
        self.cells.append(up, batch.number)

    def result(self, batches):
        return self.cells.read(batches)


class Bursts(Part):
    """ST7: the burst score of every item at every bucket it occurs in.

    Kept: bucket counts no older than the horizon and the ``recent + history`` buckets
    before it.  A batch scores again the points its own buckets can change, no others."""

    r, h = P.RECENT_BUCKETS, P.HISTORY_BUCKETS

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.buckets = self._table("buckets", ["bucket", "item"])
        self.scores = self._table("scores", ["bucket", "item"],
                                  {"recent": "bigint", "history": "bigint", "burst": "double"}, "last")

    def step(self, batch):
        span = P.BUCKET_SLOTS
        new = (batch.counts.groupBy(F.floor(F.col("hour") / span).cast("bigint").alias("bucket"), "item")
               .agg(F.sum("cnt").cast("bigint").alias("cnt")))
        tail = self.r + self.h - 1
        keep = None if batch.newest is None else F.col("bucket") >= batch.horizon // span - tail
        self.buckets.append(new, batch.number, keep)
        if batch.first is None:
            scored = self.spark.createDataFrame([], self.scores.schema).drop("batch")
        else:
            changed = new.groupBy("item").agg(F.min("bucket").alias("from"))
            lately = F.col("bucket") >= batch.first // span - tail
            state = self.buckets.read(batch.number + 1, lately).join(changed, "item")
            w = Window.partitionBy("item").orderBy("bucket")
            recent = F.sum("cnt").over(w.rangeBetween(-(self.r - 1), 0))
            history = F.coalesce(F.sum("cnt").over(w.rangeBetween(-tail, -self.r)), F.lit(0))
            scored = (state.select("bucket", "item", "from", recent.cast("bigint").alias("recent"),
                                   history.cast("bigint").alias("history"))
                      .where(F.col("bucket") >= F.col("from"))
                      .withColumn("burst", F.round(burst_score(F.col("recent"), F.col("history"), self.r, self.h), R)))
        self.scores.append(scored, batch.number)

    def result(self, batches):
        return self.scores.read(batches)


class Hitters(Part):
    """ST8: a summary of ``COUNTERS`` counters that batches are merged into; the items'
    exact counts are kept beside it to check its bound."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.totals = self._table("totals", ["item"])

    def _summary(self, number: int) -> str:
        return f"{self.folder}/summary/{number}"

    def step(self, batch):
        per_item = batch.counts.groupBy("item").agg(F.sum("cnt").cast("bigint").alias("cnt"))
        self.totals.append(per_item, batch.number)
        parts = task_summaries(per_item, "item", "cnt", COUNTERS)
        if batch.number:
            parts = parts.unionByName(self.spark.read.parquet(self._summary(batch.number - 1)))
        merge_summaries(parts, COUNTERS).write.mode("overwrite").parquet(self._summary(batch.number))
        if batch.number > 1:
            delete(self.spark, self._summary(batch.number - 2))

    def result(self, batches):
        """The most frequent items, and whether the summary's bounds hold for them."""
        totals = self.totals.read(batches).select("item", F.col("cnt").alias("true_cnt"))
        if not batches:
            return totals.select(F.lit(0).cast("bigint").alias("rank"), "item", "true_cnt", F.lit(True).alias("inside"))
        top = top_k(totals, P.TOP_K, "item", "true_cnt")
        checked = covered(top, self.spark.read.parquet(self._summary(batches - 1)), "true_cnt", COUNTERS)
        return ranked(checked, [F.col("true_cnt").desc(), F.col("item").asc()]).select("rank", "item", "true_cnt", "inside")


class Snapshots(Part):
    """ST9: at every ``SNAPSHOT_HOURS``-th hour the stream has reached, the items with the
    largest counts of the last ``SLIDING_SLOTS`` hours, exact and estimated from the hourly
    cells of that state.  A batch takes the snapshots it reaches, and again those that
    its rows change."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.counts = self._table("counts", ["hour", "item"])
        self.cells = self._table("cells", ["hour", "row", "col"])
        self.taken = self._table("taken", ["at_hour", "rank"],
                                 {"item": "string", "true_cnt": "bigint", "est": "bigint"}, "last")

    def step(self, batch):
        span = P.SLIDING_SLOTS
        keep = None if batch.newest is None else F.col("hour") > batch.horizon - span
        self.counts.append(batch.counts, batch.number, keep)
        hourly = event_cells(batch.counts, ["hour"], P.DEPTH, P.WIDTH, P.RING_SEED)
        self.cells.append(hourly, batch.number, keep)
        if batch.first is None:
            points = []
        else:
            start = batch.first if batch.before is None else min(batch.first, batch.before + 1)
            points = range(-(-start // SNAPSHOT_HOURS) * SNAPSHOT_HOURS, batch.newest + 1, SNAPSHOT_HOURS)
        self.taken.append(self._snapshots(batch.number + 1, points[0], points[-1]) if len(points) else
                          self.spark.createDataFrame([], self.taken.schema).drop("batch"), batch.number)

    def _snapshots(self, batches: int, first: int, last: int) -> DataFrame:
        span, step = P.SLIDING_SLOTS, SNAPSHOT_HOURS
        inside = (F.col("hour") > first - span) & (F.col("hour") <= last)
        # the points p = 0 mod step with hour <= p < hour + span
        from_ = F.ceil(F.greatest(F.col("hour"), F.lit(first)) / step).cast("bigint") * step
        to = F.floor(F.least(F.col("hour") + span - 1, F.lit(last)) / step).cast("bigint") * step
        exact = (self.counts.read(batches, inside).withColumn("from", from_).withColumn("to", to)
                 .where("`from` <= `to`")
                 .withColumn("at_hour", F.explode(F.sequence("from", "to", F.lit(step).cast("bigint"))))
                 .groupBy("at_hour", "item").agg(F.sum("cnt").cast("bigint").alias("true_cnt")))
        order = [F.col("true_cnt").desc(), F.col("item").asc()]
        top = top_n_per_group(exact, ["at_hour"], order, SNAPSHOT_ITEMS, F.xxhash64("item"))
        rank = F.row_number().over(Window.partitionBy("at_hour").orderBy(*order)).cast("bigint")
        top = top.select("at_hour", "item", "true_cnt", rank.alias("rank"))
        hours = F.explode(F.sequence(F.col("at_hour") - span + 1, F.col("at_hour")))
        probes = event_probes(top.select("at_hour", "item", hours.alias("hour")), P.DEPTH, P.WIDTH, P.RING_SEED,
                              extra=["at_hour", "hour"])
        per_hour = cm_min(probes, self.cells.read(batches, inside), ["hour", "row", "col"], ["at_hour", "item", "hour"], P.DEPTH)
        est = per_hour.groupBy("at_hour", "item").agg(F.sum("est").cast("bigint").alias("est"))
        return top.join(est, ["at_hour", "item"]).select("at_hour", "rank", "item", "true_cnt", "est")

    def result(self, batches):
        return self.taken.read(batches)


class Loss(Part):
    """ST4: rows that came, rows that came too late, and the newest hour."""

    def step(self, batch):
        pass

    def result(self, batches):
        marks = self.spark.read.parquet(f"{self.folder}/marks/{batches - 1}") if batches else \
            self.spark.createDataFrame([], MARKS)
        return marks.select("n_rows", "n_late", "newest_hour")


MARKS = "batch bigint, newest_hour bigint, n_rows bigint, n_late bigint"


class Online:
    """A stream with one part: call ``run`` to take what has arrived, ``result`` to read."""

    def __init__(self, spark: SparkSession, sf_dir: str, part: type[Part], max_files: int = MAX_FILES):
        self.spark, self.sf_dir, self.max_files = spark, sf_dir, max_files
        self.base = progress_folder(spark, f"online-{part.__name__.lower()}", sf_dir)
        self.part = part(spark, self.base)
        self.late = DeltaTable(spark, f"{self.base}/late", ["hour", "item"], COUNT, TYPES)

    def _mark(self, number: int):
        return self.spark.read.schema(MARKS).parquet(f"{self.base}/marks/{number}").first()

    def sink(self, rows: DataFrame, number: int) -> None:
        """All of one batch; the mark comes last and says that the batch is complete."""
        old = self._mark(number - 1) if number else None
        before = old["newest_hour"] if old else None
        path = f"{self.base}/batch/{number}"
        hour = F.floor(F.unix_seconds("t") / F.lit(HOUR)).cast("bigint")
        rows.groupBy(hour.alias("hour"), "item").agg(F.count("*").alias("cnt")).write.mode("overwrite").parquet(path)
        counts = self.spark.read.parquet(path)
        is_late = F.lit(False) if before is None else F.col("hour") < before - RETENTION_HOURS
        seen = counts.agg(F.min(F.when(~is_late, F.col("hour"))).alias("first"), F.max("hour").alias("last"),
                          F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"),
                          F.coalesce(F.sum(F.when(is_late, F.col("cnt"))), F.lit(0)).alias("late")).first()
        now = max((h for h in (before, seen["last"]) if h is not None), default=None)
        self.late.append(counts.where(is_late), number)
        self.part.step(Batch(number, counts.where(~is_late), seen["first"], now, before))
        total = [number, now, (old["n_rows"] if old else 0) + seen["n"], (old["n_late"] if old else 0) + seen["late"]]
        self.spark.createDataFrame([total], MARKS).coalesce(1).write.mode("overwrite").parquet(f"{self.base}/marks/{number}")
        if number:
            delete(self.spark, f"{self.base}/batch/{number - 1}")
            delete(self.spark, f"{self.base}/marks/{number - 2}")

    def run(self) -> int:
        """Take all that has arrived; the number of batches so far."""
        query = (event_stream(self.spark, self.sf_dir, self.max_files, watermark=False).writeStream.foreachBatch(self.sink)
                 .option("checkpointLocation", f"{self.base}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
        return self.batches()

    def batches(self) -> int:
        """Batches that are complete: the newest mark's number and one."""
        return newest(self.spark, f"{self.base}/marks") + 1

    def result(self, batches: int) -> DataFrame:
        return self.part.result(batches)

    def close(self, result: DataFrame) -> DataFrame:
        """Write the result beside the state, delete the state, return the result."""
        path = f"{self.base}-result-{uuid.uuid4().hex}"
        result.write.parquet(path)
        delete(self.spark, self.base)
        return self.spark.read.parquet(path)


def _run(spark: SparkSession, sf_dir: str, part: type[Part]) -> DataFrame:
    job = Online(spark, sf_dir, part)
    return job.close(job.result(job.run()))


def online_cells(spark, sf_dir):
    """ST6: cells of all dyadic levels, kept by delta merges while the stream runs."""
    return _run(spark, sf_dir, Cells)


def online_bursts(spark, sf_dir):
    """ST7: burst scores, scored in the batch that brings or changes them."""
    return _run(spark, sf_dir, Bursts)


def online_hitters(spark, sf_dir):
    """ST8: exact most frequent items, each checked against the merged summary's bounds."""
    return _run(spark, sf_dir, Hitters)


def online_snapshots(spark, sf_dir):
    """ST9: evaluation of the state at every 24th hour, exact against estimated."""
    return _run(spark, sf_dir, Snapshots)


def online_loss(spark, sf_dir):
    """ST4: rows read and rows that were too late, over all batches."""
    return _run(spark, sf_dir, Loss)


JOBS = {n: globals()[n] for n in ["online_cells", "online_bursts", "online_hitters", "online_snapshots", "online_loss"]}


def oracle() -> dict[str, str]:
    """Batch twins.  They hold where no row is late: the tables' files make one batch."""
    from . import jobs
    base = jobs.oracle()
    ev = """ev AS (SELECT epoch_us(ts) AS us, event_type || ':' || CAST(user_id AS VARCHAR) AS item
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL)"""
    hour = f"CAST(floor(us / {D(HOUR * 1_000_000)}) AS BIGINT)"
    step, span = SNAPSHOT_HOURS, P.SLIDING_SLOTS
    q = {"online_cells": base["stream_dyadic_cells"], "online_bursts": base["stream_burst"]}
    q["online_hitters"] = f"""WITH {ev},
t AS (SELECT item, CAST(count(*) AS BIGINT) AS true_cnt FROM ev GROUP BY item ORDER BY true_cnt DESC, item LIMIT {P.TOP_K})
SELECT CAST(row_number() OVER (ORDER BY true_cnt DESC, item) AS BIGINT) AS rank, item, true_cnt, TRUE AS inside FROM t"""
    q["online_snapshots"] = f"""WITH {ev},
hc AS (SELECT {hour} AS hour, item, count(*) AS cnt FROM ev GROUP BY ALL),
hr AS (SELECT CAST(ceil(min(hour) / {step}) AS BIGINT) AS a, CAST(floor(max(hour) / {step}) AS BIGINT) AS b FROM hc),
pts AS (SELECT unnest(generate_series(a, b)) * {step} AS at_hour FROM hr),
x AS (SELECT at_hour, item, CAST(sum(cnt) AS BIGINT) AS true_cnt FROM pts JOIN hc ON hour <= at_hour AND hour > at_hour - {span} GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY at_hour ORDER BY true_cnt DESC, item) AS BIGINT) AS rank FROM x
      QUALIFY rank <= {SNAPSHOT_ITEMS}),
cells AS (SELECT hour, CAST(t.r AS BIGINT) AS row, {sha_idx('item', 't.r', P.RING_SEED, str(P.WIDTH))} AS col, sum(cnt) AS cnt
  FROM hc, range(0, {P.DEPTH}) t(r) GROUP BY ALL),
p AS (SELECT DISTINCT item, CAST(u.r AS BIGINT) AS row, {sha_idx('item', 'u.r', P.RING_SEED, str(P.WIDTH))} AS col
  FROM k, range(0, {P.DEPTH}) u(r)),
ph AS (SELECT p.item, c.hour, CASE WHEN count(*) = {P.DEPTH} THEN min(c.cnt) ELSE 0 END AS est
  FROM p JOIN cells c ON c.row = p.row AND c.col = p.col GROUP BY ALL)
SELECT k.at_hour, k.rank, k.item, k.true_cnt, CAST(sum(ph.est) AS BIGINT) AS est
FROM k JOIN ph ON ph.item = k.item AND ph.hour <= k.at_hour AND ph.hour > k.at_hour - {span} GROUP BY ALL"""
    q["online_loss"] = f"""WITH {ev}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_late, max({hour}) AS newest_hour FROM ev HAVING count(*) > 0"""
    return q
