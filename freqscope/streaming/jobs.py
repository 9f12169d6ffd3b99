"""Structured Streaming versions of the windowed jobs (ST1-ST9).

Every job reads the ``events`` Parquet as a file stream, runs with
``trigger(availableNow=True)`` and writes each micro-batch through
``foreachBatch`` into ``<spark.checkpoint.dir>/.../batch=<id>``: a retried
batch overwrites its own folder, so the sink is idempotent.  The folder is named by
job and table, so a driver that starts again goes on from its checkpoint.  The result
is the latest version of every key across batches (update mode emits changed keys only).

Stream time is the event time as a UTC instant; windows are epoch-aligned
(an hour = slot, ten hours = bucket).  The watermark (ST4) keeps state for the
retention horizon only; rows older than it are dropped by Spark.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .. import params
from ..functions.hashing import bounded_broadcast
from ..operators.counts import eval_points, ranked, top_k
from ..operators.sketch import cm_min, event_cells, event_probes
from ..operators.windowed import burst_score
from ..plans.events_sql import D, burst, sha_idx
from ..session import ensure_checkpoint_dir

P = params
R = params.ROUND_DIGITS
HOUR = 3600
RETENTION_SECONDS = P.EVAL_LAST_SLOTS * P.SLOT_SECONDS
RETENTION = f"{RETENTION_SECONDS} seconds"
#: files of one micro-batch
MAX_FILES = 1000


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = MAX_FILES, watermark: bool = True) -> DataFrame:
    """The events table, a file or a directory of files, as a stream."""
    folder = sf_dir.rstrip("/")
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # as a pattern that only this name fits: a plain path would have to be a directory
    raw = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
           .parquet(f"{folder}/[e]vents.parquet"))
    epoch = F.lit(datetime.datetime(1970, 1, 1)).cast("timestamp_ntz")
    us = F.timestamp_diff("MICROSECOND", epoch, F.col("ts"))
    rows = (raw.where(F.col("ts").isNotNull() & F.col("event_type").isNotNull()
                      & F.col("user_id").isNotNull())
            .select(F.timestamp_micros(us).alias("t"),
                    F.concat(F.col("event_type"), F.lit(":"), F.col("user_id").cast("string"))
                    .alias("item")))
    return rows.withWatermark("t", RETENTION) if watermark else rows


def progress_folder(spark: SparkSession, name: str, sf_dir: str) -> str:
    """One folder per job and table: a driver that starts again finds it."""
    table = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/freqscope-stream/{name}-{table}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def run_to_table(spark: SparkSession, df: DataFrame, name: str, keys: list[str], sf_dir: str,
                 mode: str = "update", late: list[int] | None = None) -> DataFrame:
    """Run to the end of the data and return the latest version of each key.

    Batches and checkpoint lie in the job's own folder until the result is written;
    a run that was stopped goes on after its last batch.  ``late`` gets the number
    of rows the watermark dropped in this run (ST4)."""
    base = progress_folder(spark, name, sf_dir)
    out = f"{base}/out"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (df.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if late is not None:
        late.append(sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"]))
    res = spark.read.parquet(out)
    vals = [c for c in res.columns if c not in keys and c != "batch"]
    latest = res.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.col("batch")).alias("v"))
    latest = latest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in vals])
    result = f"{base}-result-{uuid.uuid4().hex}"
    latest.write.parquet(result)
    _delete(spark, base)
    return spark.read.parquet(result)


def _hour(col) -> F.Column:
    return F.floor(F.unix_seconds(col) / F.lit(HOUR)).cast("bigint")


def slot_counts_of(ev: DataFrame) -> DataFrame:
    agg = ev.groupBy(F.window("t", "1 hour"), "item").agg(F.count(F.lit(1)).alias("cnt"))
    return agg.select(_hour(F.col("window.start")).alias("hour"), "item",
                      F.col("cnt").cast("bigint").alias("cnt"))


def stream_slot_counts(spark, sf_dir):
    """ST1: tumbling one-hour slots, exact count per (slot, item)."""
    return run_to_table(spark, slot_counts_of(event_stream(spark, sf_dir)), "slots", ["hour", "item"], sf_dir)


def stream_bucket_counts(spark, sf_dir):
    """ST2: tumbling ten-hour buckets."""
    ev = event_stream(spark, sf_dir)
    span = P.BUCKET_SLOTS * HOUR
    agg = ev.groupBy(F.window("t", f"{span} seconds"), "item").agg(F.count(F.lit(1)).alias("cnt"))
    agg = agg.select(F.floor(F.unix_seconds(F.col("window.start")) / F.lit(span)).cast("bigint")
                     .alias("bucket"), "item", F.col("cnt").cast("bigint").alias("cnt"))
    return run_to_table(spark, agg, "buckets", ["bucket", "item"], sf_dir)


def stream_sliding_counts(spark, sf_dir):
    """ST3: sliding four-hour windows every hour (start hour per window)."""
    ev = event_stream(spark, sf_dir)
    agg = ev.groupBy(F.window("t", "4 hours", "1 hour"), "item").agg(F.count(F.lit(1)).alias("cnt"))
    agg = agg.select(_hour(F.col("window.start")).alias("start_hour"), "item",
                     F.col("cnt").cast("bigint").alias("cnt"))
    return run_to_table(spark, agg, "sliding", ["start_hour", "item"], sf_dir)


def _cells(counts: DataFrame) -> DataFrame:
    """Level 0: each (hour, item) is hashed once, not each event."""
    cells = event_cells(counts, ["hour"], P.DEPTH, P.WIDTH, P.RING_SEED)
    return cells.select("hour", "row", "col", F.col("cnt").cast("bigint").alias("cnt"))


def stream_sketch_cells(spark, sf_dir):
    """ST6: per-hour Count-Min cells of the counts the stream maintains."""
    return _cells(stream_slot_counts(spark, sf_dir))


def stream_dyadic_cells(spark, sf_dir):
    """ST6: the hourly cells rolled up to the dyadic levels.  A level's width
    divides the one below it, so its cells are sums of theirs; nothing is hashed again."""
    level = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(P.DYADIC_LEVELS - 1).cast("bigint")))
    up = _cells(stream_slot_counts(spark, sf_dir)).withColumn("level", level)
    width = F.greatest(F.expr(f"shiftright({P.WIDTH}L, level)"), F.lit(P.DYADIC_MIN_WIDTH).cast("bigint"))
    return (up.groupBy("level", F.expr("shiftright(hour, level)").alias("seg"), "row",
                       F.pmod(F.col("col"), width).cast("bigint").alias("col"))
            .agg(F.sum("cnt").cast("bigint").alias("cnt")))


def stream_burst(spark, sf_dir):
    """ST7: burst score of every item at every bucket it occurs in, from the bucket
    counts the stream maintains."""
    r, h = P.RECENT_BUCKETS, P.HISTORY_BUCKETS
    w = Window.partitionBy("item").orderBy("bucket")
    recent = F.sum("cnt").over(w.rangeBetween(-(r - 1), 0))
    history = F.coalesce(F.sum("cnt").over(w.rangeBetween(-(r + h - 1), -r)), F.lit(0))
    out = stream_bucket_counts(spark, sf_dir).select(
        "bucket", "item", recent.cast("bigint").alias("recent"), history.cast("bigint").alias("history"))
    return out.withColumn("burst", F.round(burst_score(F.col("recent"), F.col("history"), r, h), R))


def stream_heavy_hitters(spark, sf_dir):
    """ST8: the items with the largest Count-Min estimates over all hours, from the
    cells the stream maintains (cells of all hours add up), next to their counts."""
    counts = stream_slot_counts(spark, sf_dir)
    total = counts.groupBy("item").agg(F.sum("cnt").cast("bigint").alias("true_cnt"))
    cells = _cells(counts).groupBy("row", "col").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    probes = event_probes(total, P.DEPTH, P.WIDTH, P.RING_SEED, extra=["true_cnt"])
    est = cm_min(probes, bounded_broadcast(cells, P.DEPTH * P.WIDTH), ["row", "col"], ["item", "true_cnt"], P.DEPTH)
    top = est.orderBy(F.col("est").desc(), F.col("item").asc()).limit(P.TOP_K)
    return ranked(top, [F.col("est").desc(), F.col("item").asc()]).select("rank", "item", "true_cnt", "est")


def stream_evaluation(spark, sf_dir):
    """ST9: at about ten hours of the stream, the most frequent items' count in the
    last 32 hours, exact and estimated from the cells the stream maintains."""
    counts = stream_slot_counts(spark, sf_dir)
    items = top_k(counts.groupBy("item").agg(F.sum("cnt").alias("cnt")), P.TOP_K).select("item")
    items = bounded_broadcast(items, P.TOP_K, P.ITEM_BYTES)
    hours = counts.agg(F.min("hour").alias("a"), F.max("hour").alias("b"))
    points = hours.where(F.col("a").isNotNull()).select(F.explode(eval_points(F.col("a"), F.col("b"))).alias("at_hour"))
    grid = bounded_broadcast(points, P.NUM_EVAL_POINTS + 2)

    def last(df: DataFrame, value: str, name: str) -> DataFrame:
        inside = (F.col("hour") <= F.col("at_hour")) & (F.col("hour") > F.col("at_hour") - P.SLIDING_SLOTS)
        return df.join(grid, inside).groupBy("item", "at_hour").agg(F.sum(value).cast("bigint").alias(name))

    probes = event_probes(items, P.DEPTH, P.WIDTH, P.RING_SEED)
    per_hour = cm_min(probes, _cells(counts), ["row", "col"], ["item", "hour"], P.DEPTH)
    exact = last(counts.join(items, "item"), "cnt", "true_cnt")
    every = items.join(grid, F.lit(True))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return (every.join(exact, ["item", "at_hour"], "left").join(last(per_hour, "est", "est"), ["item", "at_hour"], "left")
            .select("item", "at_hour", zero("true_cnt"), zero("est")))


def _decay_state(lam: float):
    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        value, last = (state.get if state.exists else (0.0, None))
        for pdf in pdfs:
            runs = pdf.groupby("slot").size().sort_index()
            for slot, c in runs.items():
                slot = int(slot)
                if last is None or slot >= last:
                    base = 0.0 if last is None else value * math.exp(-lam * (slot - last))
                    value, last = base + float(c), slot
                else:  # late row inside the watermark: decay it to the last slot
                    value += float(c) * math.exp(-lam * (last - slot))
        state.update((value, last))
        # an item that stays away for the retention leaves the state
        state.setTimeoutTimestamp(max((last + 1) * HOUR * 1000 + RETENTION_SECONDS * 1000,
                                      state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"item": [key[0]], "last_slot": [last], "decayed": [value]})
    return fn


def decayed_of(ev: DataFrame) -> DataFrame:
    return ev.withColumn("slot", _hour(F.col("t"))).groupBy("item").applyInPandasWithState(
        _decay_state(P.DECAY_LAMBDA), "item string, last_slot long, decayed double",
        "value double, last long", "update", GroupStateTimeout.EventTimeTimeout)


def stream_decayed(spark, sf_dir):
    """ST5: running exponentially decayed count per item kept in keyed state
    ``(value, last_slot)``; the value is read at the item's last slot."""
    res = run_to_table(spark, decayed_of(event_stream(spark, sf_dir)), "decayed", ["item"], sf_dir)
    return res.select("item", "last_slot", F.round("decayed", R).alias("decayed"))


JOBS = {n: globals()[n] for n in [
    "stream_slot_counts", "stream_bucket_counts", "stream_sliding_counts", "stream_sketch_cells",
    "stream_dyadic_cells", "stream_burst", "stream_heavy_hitters", "stream_evaluation", "stream_decayed"]}


def oracle() -> dict[str, str]:
    ev = """ev AS (SELECT epoch_us(ts) AS us, event_type || ':' || CAST(user_id AS VARCHAR) AS item
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL)"""
    hour = f"CAST(floor(us / {D(HOUR * 1_000_000)}) AS BIGINT)"
    q = {}
    q["stream_slot_counts"] = f"""WITH {ev}
SELECT {hour} AS hour, item, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY ALL"""
    span = P.BUCKET_SLOTS * HOUR * 1_000_000
    q["stream_bucket_counts"] = f"""WITH {ev}
SELECT CAST(floor(us / {D(span)}) AS BIGINT) AS bucket, item, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY ALL"""
    q["stream_sliding_counts"] = f"""WITH {ev}
SELECT {hour} - t.k AS start_hour, item, CAST(count(*) AS BIGINT) AS cnt FROM ev, range(0, 4) t(k) GROUP BY ALL"""
    q["stream_sketch_cells"] = f"""WITH {ev}
SELECT {hour} AS hour, CAST(t.r AS BIGINT) AS row, {sha_idx('item', 't.r', P.RING_SEED, str(P.WIDTH))} AS col,
       CAST(count(*) AS BIGINT) AS cnt FROM ev, range(0, {P.DEPTH}) t(r) GROUP BY ALL"""
    cells = f"""{ev},
hc AS (SELECT {hour} AS hour, item, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY ALL),
cells AS (SELECT hour, CAST(t.r AS BIGINT) AS row, {sha_idx('item', 't.r', P.RING_SEED, str(P.WIDTH))} AS col,
  CAST(sum(cnt) AS BIGINT) AS cnt FROM hc, range(0, {P.DEPTH}) t(r) GROUP BY ALL)"""
    q["stream_dyadic_cells"] = f"""WITH {cells}
SELECT CAST(t.l AS BIGINT) AS level, hour >> t.l AS seg, row,
  CAST(col % greatest({P.WIDTH} >> t.l, {P.DYADIC_MIN_WIDTH}) AS BIGINT) AS col, CAST(sum(cnt) AS BIGINT) AS cnt
FROM cells, range(0, {P.DYADIC_LEVELS}) t(l) GROUP BY ALL"""
    r, h = P.RECENT_BUCKETS, P.HISTORY_BUCKETS
    q["stream_burst"] = f"""WITH {ev},
b AS (SELECT CAST(floor(us / {D(span)}) AS BIGINT) AS bucket, item, count(*) AS cnt FROM ev GROUP BY ALL),
s AS (SELECT x.bucket, x.item, CAST(sum(CASE WHEN y.bucket > x.bucket - {r} THEN y.cnt ELSE 0 END) AS BIGINT) AS recent,
  CAST(sum(CASE WHEN y.bucket <= x.bucket - {r} THEN y.cnt ELSE 0 END) AS BIGINT) AS history
  FROM b x JOIN b y ON x.item = y.item AND y.bucket <= x.bucket AND y.bucket > x.bucket - {r + h} GROUP BY ALL)
SELECT *, round({burst('recent', 'history', r, h)}, {R}) AS burst FROM s"""
    probe = f"""t AS (SELECT item, CAST(sum(cnt) AS BIGINT) AS true_cnt FROM hc GROUP BY item),
p AS (SELECT item, true_cnt, CAST(u.r AS BIGINT) AS row, {sha_idx('item', 'u.r', P.RING_SEED, str(P.WIDTH))} AS col
  FROM t, range(0, {P.DEPTH}) u(r))"""
    q["stream_heavy_hitters"] = f"""WITH {cells}, {probe},
a AS (SELECT row, col, sum(cnt) AS cnt FROM cells GROUP BY ALL),
e AS (SELECT item, true_cnt, CAST(min(a.cnt) AS BIGINT) AS est FROM p JOIN a USING (row, col) GROUP BY ALL)
SELECT CAST(row_number() OVER (ORDER BY est DESC, item) AS BIGINT) AS rank, item, true_cnt, est
FROM (SELECT * FROM e ORDER BY est DESC, item LIMIT {P.TOP_K})"""
    q["stream_evaluation"] = f"""WITH {cells}, {probe},
top AS (SELECT item FROM t ORDER BY true_cnt DESC, item LIMIT {P.TOP_K}),
hr AS (SELECT min(hour) AS a, max(hour) AS b FROM hc),
pts AS (SELECT DISTINCT CAST(unnest(list_concat(generate_series(a, b, greatest(1, CAST(floor((b - a + 1) /
  least({P.NUM_EVAL_POINTS}, b - a + 1)) AS BIGINT))), [b])) AS BIGINT) AS at_hour FROM hr),
ph AS (SELECT p.item, c.hour, CASE WHEN count(*) = {P.DEPTH} THEN min(c.cnt) ELSE 0 END AS est
  FROM p JOIN top USING (item) JOIN cells c ON c.row = p.row AND c.col = p.col GROUP BY ALL)
SELECT top.item, pts.at_hour,
  CAST(coalesce((SELECT sum(cnt) FROM hc WHERE hc.item = top.item AND hour <= at_hour AND hour > at_hour - {P.SLIDING_SLOTS}), 0) AS BIGINT) AS true_cnt,
  CAST(coalesce((SELECT sum(est) FROM ph WHERE ph.item = top.item AND hour <= at_hour AND hour > at_hour - {P.SLIDING_SLOTS}), 0) AS BIGINT) AS est
FROM top, pts"""
    q["stream_decayed"] = f"""WITH {ev},
s AS (SELECT item, {hour} AS slot FROM ev),
m AS (SELECT item, max(slot) AS last_slot FROM s GROUP BY item)
SELECT s.item, m.last_slot, round(sum(exp({D(-P.DECAY_LAMBDA)} * (m.last_slot - s.slot))), {R}) AS decayed
FROM s JOIN m ON s.item = m.item GROUP BY s.item, m.last_slot"""
    return q
