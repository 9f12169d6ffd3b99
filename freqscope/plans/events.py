"""Jobs over the ``events`` table: exact windowed counts, the four windowed
sketch models, burst and decay scores, accuracy reports (E1-E4, E8)."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params
from ..operators import counts as C
from ..operators import metrics as M
from ..operators import windowed as WM
from ..operators.sketch import cm_min, event_cells, event_probes
from ..session import cut_lineage
from ..sources.tables import event_items

R = params.ROUND_DIGITS


class EventJob:
    """Shared pieces of every events job.

    One small job finds the first and last event, so the newest slot T, the horizon
    and every range filter are literals; a filter on ``ts`` reaches the scan.
    ``ev`` is the exact ``(item, slot, cnt)`` table, aggregated once; with ``horizon``
    it starts at the horizon (at the dyadic boundary before it), and with ``shared``
    it is written to the shared folder because several plans read it."""

    def __init__(self, spark: SparkSession, sf_dir: str, slot_seconds: int = params.SLOT_SECONDS,
                 eval_last: int = params.EVAL_LAST_SLOTS, k: int = params.TOP_K,
                 horizon: bool = False, shared: bool = False):
        self.spark, self.k, self.eval_last = spark, k, eval_last
        raw = event_items(spark, sf_dir)
        span = slot_seconds * 1_000_000
        # one local job: the origin and the whole slots up to the last event
        first = raw.agg(F.min("ts").alias("origin"), F.max("ts").alias("last")).select(
            "origin", F.floor(F.timestamp_diff("MICROSECOND", "origin", "last") / F.lit(span)).alias("T")).first()
        long = lambda x: F.lit(x).cast("bigint")
        if first["origin"] is None:
            start = None
            self.T = self.hs = self.maxw = long(None)
        else:
            length = min(eval_last, first["T"] + 1) if eval_last else first["T"] + 1
            start = first["T"] - length + 1
            self.T, self.hs, self.maxw = long(first["T"]), long(start), long(length)
        if horizon and start:
            align = 1 << (params.DYADIC_LEVELS - 1)
            begins = first["origin"] + datetime.timedelta(microseconds=start // align * align * span)
            raw = raw.where(F.col("ts") >= F.lit(begins).cast("timestamp_ntz"))
        micros = F.timestamp_diff("MICROSECOND", F.lit(first["origin"]).cast("timestamp_ntz"), F.col("ts"))
        self.ev = (raw.select("item", F.floor(micros / F.lit(span)).cast("bigint").alias("slot"))
                   .groupBy("item", "slot").agg(F.count(F.lit(1)).cast("bigint").alias("cnt")))
        if shared:
            self.ev = cut_lineage(self.ev)
        self.windows = C.window_candidates(eval_last)
        self.targets = C.horizon_targets(self.ev, self.hs, self.T, k)

    @property
    def items(self) -> DataFrame:
        return self.ev.select("item").distinct()

    def bucket_points(self, bucket_slots=params.BUCKET_SLOTS, recent=params.RECENT_BUCKETS,
                      history=params.HISTORY_BUCKETS):
        """Evaluation buckets inside the horizon (D7): from the first bucket
        whose recent+history range starts in the horizon up to the newest one;
        only the newest when the horizon is shorter than that."""
        hb = F.ceil(self.hs / F.lit(bucket_slots)).cast("bigint")  # the first whole bucket
        maxb = F.floor(self.T / F.lit(bucket_slots)).cast("bigint")
        first = hb + recent + history - 1
        return F.when(maxb < first, F.array(maxb)).otherwise(C.eval_points(first, maxb))


def _job(spark, sf_dir, horizon: bool = False, shared: bool = False) -> EventJob:
    return EventJob(spark, sf_dir, horizon=horizon, shared=shared)


# ---------------------------------------------------------------------------
# Exact counts
# ---------------------------------------------------------------------------

def event_slots(spark, sf_dir):
    """Events and distinct items per slot, with the bucket."""
    j = _job(spark, sf_dir)
    return (j.ev.groupBy("slot")
            .agg(F.sum("cnt").cast("bigint").alias("n_events"),
                 F.count(F.lit(1)).cast("bigint").alias("n_items"))
            .select("slot", F.floor(F.col("slot") / F.lit(params.BUCKET_SLOTS)).cast("bigint")
                    .alias("bucket"), "n_events", "n_items"))


def item_counts(spark, sf_dir):
    j = _job(spark, sf_dir)
    return C.item_counts(j.ev)


def topk_items(spark, sf_dir):
    j = _job(spark, sf_dir)
    top = C.top_k(C.item_counts(j.ev), params.TOP_K)
    return C.ranked(top, [F.col("cnt").desc(), F.col("item").asc()]).select("rank", "item", "cnt")


def horizon_topk(spark, sf_dir):
    j = _job(spark, sf_dir, horizon=True)
    return j.targets.select("rank", "item", "cnt")


def item_slot_counts(spark, sf_dir):
    """G4 + P9: per-slot exact counts of the targets inside the horizon."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    return WM.slot_counts(j.ev, lo=j.hs, hi=j.T, items=j.targets).select("item", "slot", "cnt")


def item_bucket_counts(spark, sf_dir):
    j = _job(spark, sf_dir)
    return WM.bucket_counts(j.ev, params.BUCKET_SLOTS).select("item", "bucket", "cnt")


def interval_counts(spark, sf_dir):
    """Exact count of each target in each window [T-w+1, T]."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    return WM.window_truth(j.ev, j.targets, j.T, j.windows, j.maxw)


def prefix_counts(spark, sf_dir):
    """Dense per-slot counts of the targets over the horizon and their
    running prefix sums (one bounded partition per target)."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    spine = j.targets.select("item", F.explode(F.sequence(j.hs, j.T)).alias("slot"))
    cnt = WM.slot_counts(j.ev, lo=j.hs, items=j.targets)
    dense = spine.join(cnt, ["item", "slot"], "left").select(
        "item", "slot", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"))
    w = Window.partitionBy("item").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return dense.withColumn("prefix", F.sum("cnt").over(w).cast("bigint"))


def sliding_counts(spark, sf_dir):
    """Count in the last 32 slots at every (item, slot) with events.  The
    window runs over pre-aggregated (item, slot) rows, so a hot item's
    partition holds at most one row per slot, never its raw events."""
    j = _job(spark, sf_dir)
    cnt = WM.slot_counts(j.ev)
    w = Window.partitionBy("item").orderBy("slot").rangeBetween(-(params.SLIDING_SLOTS - 1), 0)
    return cnt.withColumn("sliding_cnt", F.sum("cnt").over(w).cast("bigint"))


def burst_slots(spark, sf_dir):
    """Slot-level burst score series of each target at every slot."""
    j = _job(spark, sf_dir, shared=True)
    r, h = params.RECENT_SLOTS, params.HISTORY_SLOTS
    spine = j.targets.select("item", F.explode(F.sequence(F.lit(0).cast("bigint"), j.T))
                             .alias("slot"))
    cnt = WM.slot_counts(j.ev, items=j.targets)
    dense = spine.join(cnt, ["item", "slot"], "left").select(
        "item", "slot", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("cnt"))
    base = Window.partitionBy("item").orderBy("slot")
    recent = F.sum("cnt").over(base.rowsBetween(-(r - 1), 0))
    history = F.coalesce(F.sum("cnt").over(base.rowsBetween(-(r + h - 1), -r)), F.lit(0))
    out = dense.select("item", "slot", recent.cast("bigint").alias("recent_cnt"),
                       history.cast("bigint").alias("history_cnt"))
    # no history range before slot r (hist_end < hist_start): score 0
    score = F.when(F.col("slot") < r, F.lit(0.0)).otherwise(
        WM.burst_score(F.col("recent_cnt"), F.col("history_cnt"), r, h))
    return out.withColumn("burst", F.round(score, R))


def burst_buckets(spark, sf_dir):
    """W6/G5/P10 (exact side): recent/history bucket counts and burst score of
    the horizon targets at the evaluation buckets."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    ev_h = j.ev.where(F.col("slot") >= j.hs)
    pts = j.bucket_points()
    tr = WM.bucket_truth(ev_h, j.targets, pts)
    grid = j.targets.select("item", F.explode(pts).alias("point"))
    r, h = params.RECENT_BUCKETS, params.HISTORY_BUCKETS
    out = grid.join(tr, ["item", "point"], "left").select(
        F.col("point").alias("bucket"), "item",
        F.coalesce("recent", F.lit(0)).cast("bigint").alias("true_recent"),
        F.coalesce("history", F.lit(0)).cast("bigint").alias("true_history"))
    return out.withColumn("true_burst", F.round(
        WM.burst_score(F.col("true_recent"), F.col("true_history"), r, h), R))


def decayed_counts(spark, sf_dir):
    """Exact decayed count of every item at T."""
    j = _job(spark, sf_dir)
    d = WM.decayed_truth(j.ev, j.T, params.DECAY_LAMBDA)
    return d.select("item", F.round("true_decayed", R).alias("true_decayed"))


def decayed_grid(spark, sf_dir):
    """Exact decayed counts of the targets at about ten evaluation times,
    the last being T (each slot row feeds the times at or after it)."""
    j = _job(spark, sf_dir, shared=True)
    lam = params.DECAY_LAMBDA
    pts = C.eval_points(F.lit(0).cast("bigint"), j.T)
    cnt = WM.slot_counts(j.ev, items=j.targets)
    ex = cnt.select("item", "slot", "cnt", F.explode(pts).alias("t")) \
        .where(F.col("t") >= F.col("slot"))
    s = ex.groupBy("item", "t").agg(
        F.sum(F.col("cnt") * F.exp(F.lit(-lam) * (F.col("t") - F.col("slot")))).alias("d"))
    grid = j.targets.select("item", F.explode(pts).alias("t"))
    return grid.join(s, ["item", "t"], "left").select(
        "item", "t", F.round(F.coalesce("d", F.lit(0.0)), R).alias("true_decayed"))


# ---------------------------------------------------------------------------
# Sketch models
# ---------------------------------------------------------------------------

def ring_cells(spark, sf_dir):
    """Per-slot Count-Min cells of the retained slots."""
    j = _job(spark, sf_dir, horizon=True)
    return WM.ring_cells(j.ev, j.T, j.maxw, [params.WIDTH]).select("slot", "row", "col", "cnt")


def ring_window_estimates(spark, sf_dir):
    """J2/W3 for every item: true and estimated counts in each last-w window."""
    j = _job(spark, sf_dir, shared=True)
    items = j.items
    est = WM.ring_estimates(j.ev, items, j.T, j.windows, j.maxw, [params.WIDTH]).drop("width")
    tru = WM.window_truth(j.ev, items, j.T, j.windows, j.maxw, targets_bounded=False)
    return tru.join(est, ["item", "window_slots"]).select(
        "item", "window_slots", "true_count", "est_count")


def _accuracy_rows(df: DataFrame) -> DataFrame:
    ab, rel = M.abs_rel_error(F.col("true_count"), F.col("est_count"))
    return df.withColumn("abs_error", ab.cast("bigint")).withColumn("rel_error", F.round(rel, R))


def window_accuracy(spark, sf_dir, sf_job: EventJob | None = None):
    """E1 flagship (ring model): targets x windows, true vs estimated."""
    j = sf_job or _job(spark, sf_dir, horizon=True, shared=True)
    est = WM.ring_estimates(j.ev, j.targets, j.T, j.windows, j.maxw, [params.WIDTH],
                            items_bound=j.k).drop("width")
    tru = WM.window_truth(j.ev, j.targets, j.T, j.windows, j.maxw)
    out = tru.join(est, ["item", "window_slots"]).select(
        "item", "window_slots", "true_count", "est_count")
    return _accuracy_rows(out)


def dyadic_cells(spark, sf_dir):
    """Multi-resolution cells over the whole stream."""
    j = _job(spark, sf_dir)
    return WM.dyadic_cells(j.ev, [params.WIDTH]).select("level", "seg", "row", "col", "cnt")


def dyadic_estimates(spark, sf_dir):
    """Targets x windows answered from dyadic segments."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    est = WM.dyadic_estimates(j.ev, j.targets, j.T, j.windows, j.maxw, [params.WIDTH]) \
        .drop("width")
    tru = WM.window_truth(j.ev, j.targets, j.T, j.windows, j.maxw)
    out = tru.join(est, ["item", "window_slots"]).select(
        "item", "window_slots", "true_count", "est_count")
    return _accuracy_rows(out)


def bucket_burst_estimates(spark, sf_dir):
    """Bucket-sketch recent/history counts and burst scores of the
    horizon targets at the evaluation buckets, next to the exact ones."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    r, h = params.RECENT_BUCKETS, params.HISTORY_BUCKETS
    ev_h = j.ev.where(F.col("slot") >= j.hs)
    pts = j.bucket_points()
    tr = WM.bucket_truth(ev_h, j.targets, pts)
    es = WM.bucket_estimates(ev_h, j.targets, pts, [params.WIDTH]).drop("width")
    grid = j.targets.select("item", F.explode(pts).alias("point"))
    z = F.lit(0)
    out = (grid.join(tr, ["item", "point"], "left")
           .join(es.withColumnRenamed("recent", "er").withColumnRenamed("history", "eh"),
                 ["item", "point"], "left")
           .select(F.col("point").alias("bucket"), "item",
                   F.coalesce("recent", z).cast("bigint").alias("true_recent"),
                   F.coalesce("history", z).cast("bigint").alias("true_history"),
                   F.coalesce("er", z).cast("bigint").alias("est_recent"),
                   F.coalesce("eh", z).cast("bigint").alias("est_history")))
    tb = WM.burst_score(F.col("true_recent"), F.col("true_history"), r, h)
    eb = WM.burst_score(F.col("est_recent"), F.col("est_history"), r, h)
    ab = F.abs(eb - tb)
    return out.select("*", F.round(tb, R).alias("true_burst"), F.round(eb, R).alias("est_burst"),
                      F.round(ab, R).alias("abs_error"),
                      F.round(F.when(tb > 0, ab / tb).otherwise(0.0), R).alias("rel_error"))


def decay_sketch_estimates(spark, sf_dir):
    """Decayed count of every item at T, exact and from the
    forward-decay sketch."""
    j = _job(spark, sf_dir, shared=True)
    lam = params.DECAY_LAMBDA
    tru = WM.decayed_truth(j.ev, j.T, lam)
    est = WM.decay_estimates(j.ev, j.items, j.T, [params.WIDTH], lam).drop("width")
    return tru.join(est, "item").select(
        "item", F.round("true_decayed", R).alias("true_decayed"),
        F.round("est_decayed", R).alias("est_decayed"))


# ---------------------------------------------------------------------------
# Accuracy reports
# ---------------------------------------------------------------------------

def accuracy_metrics(spark, sf_dir):
    """G23/G24/G25 over the flagship grid, plus the ring's memory."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    wa = window_accuracy(spark, sf_dir, j)
    m = M.accuracy_metrics(wa.drop("abs_error", "rel_error"), [])
    counters = (j.maxw * params.WIDTH * params.DEPTH).cast("double")
    return m.select("*", counters.alias("total_counters"),
                    (counters * 4.0).alias("estimated_bytes"))


def active_inactive(spark, sf_dir):
    """G25 over every item x window: active metrics and false positives."""
    wa = ring_window_estimates(spark, sf_dir)
    m = M.accuracy_metrics(wa, [], percentiles=False)
    return m.select("num_queries", "mae_active", "rmse_active", "mean_relative_error_active",
                    "weighted_relative_l1_active", "false_positive_rate",
                    "avg_false_positive_estimate", "max_false_positive_estimate")


def error_histogram(spark, sf_dir):
    """20-bin histogram of the flagship relative errors."""
    wa = window_accuracy(spark, sf_dir)
    return M.error_histogram(wa, "rel_error")


def error_matrix(spark, sf_dir):
    """Relative error per target (rows) and window (columns)."""
    wa = window_accuracy(spark, sf_dir)
    wins = [4 ** i for i in range(16) if 4 ** i <= params.EVAL_LAST_SLOTS]
    p = wa.groupBy("item").pivot("window_slots", wins).agg(F.first("rel_error"))
    return p.select("item", *[F.col(str(w)).alias(f"w{w}") for w in wins])


def errors_sorted(spark, sf_dir):
    """T5: flagship relative errors in ascending order with their rank."""
    wa = window_accuracy(spark, sf_dir)
    w = Window.orderBy("rel_error", "item", "window_slots")
    return wa.select(F.row_number().over(w).cast("bigint").alias("pos"), "item", "window_slots",
                     "rel_error")


def _ring_rows(j: EventJob, widths, depth: int = params.DEPTH):
    est = WM.ring_estimates(j.ev, j.targets, j.T, j.windows, j.maxw, widths, depth, items_bound=j.k)
    tru = WM.window_truth(j.ev, j.targets, j.T, j.windows, j.maxw)
    return est.join(tru, ["item", "window_slots"])


def width_sweep(spark, sf_dir):
    """Ring model at every width in one job; best = lowest weighted
    relative L1 (ties: smaller width)."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    ws = list(params.SWEEP_WIDTHS)
    m = M.accuracy_metrics(_ring_rows(j, ws), ["width"])
    counters = (j.maxw * F.col("width") * params.DEPTH).cast("double")
    m = m.select("width", F.lit(params.DEPTH).cast("bigint").alias("depth"), "num_queries", "mae",
                 "rmse", "mean_relative_error", "weighted_relative_l1",
                 counters.alias("total_counters"), (counters * 4.0).alias("estimated_bytes"))
    best = Window.orderBy("weighted_relative_l1", "width")
    return m.withColumn("is_best", F.row_number().over(best) == 1)


MODEL_RANK = {"ring": 0, "dyadic": 1, "bucket": 2, "decay": 3}


def model_rows(j: EventJob, widths, depth: int = params.DEPTH) -> DataFrame:
    """(model, width, depth, metrics..., counters, bytes) for the four
    models on common targets and horizon (D20)."""
    lam = params.DECAY_LAMBDA
    ring = M.accuracy_metrics(_ring_rows(j, widths, depth), ["width"]) \
        .withColumn("model", F.lit("ring")) \
        .withColumn("total_counters", (j.maxw * F.col("width") * depth).cast("double")) \
        .withColumn("bytes_per_counter", F.lit(4.0))
    dest = WM.dyadic_estimates(j.ev, j.targets, j.T, j.windows, j.maxw, widths, depth=depth)
    dtru = WM.window_truth(j.ev, j.targets, j.T, j.windows, j.maxw)
    L, mw = params.DYADIC_LEVELS, params.DYADIC_MIN_WIDTH
    dy_counters = sum(
        ((F.floor(j.T / F.lit(2 ** lv)) + 1) * F.greatest(F.col("width") / F.lit(2 ** lv),
                                                             F.lit(float(mw))))
        for lv in range(L)) * depth
    dy = M.accuracy_metrics(dest.join(dtru, ["item", "window_slots"]), ["width"]) \
        .withColumn("model", F.lit("dyadic")) \
        .withColumn("total_counters", dy_counters.cast("double")) \
        .withColumn("bytes_per_counter", F.lit(4.0))
    r, h = params.RECENT_BUCKETS, params.HISTORY_BUCKETS
    ev_h = j.ev.where(F.col("slot") >= j.hs)
    pts = j.bucket_points()
    tr = WM.bucket_truth(ev_h, j.targets, pts)
    es = WM.bucket_estimates(ev_h, j.targets, pts, widths, depth=depth)
    grid = WM.with_widths(j.targets.select("item", F.explode(pts).alias("point")), widths)
    z = F.lit(0)
    b = (grid.join(tr, ["item", "point"], "left")
         .join(es.withColumnRenamed("recent", "er").withColumnRenamed("history", "eh"),
               ["width", "item", "point"], "left")
         .select("width",
                 WM.burst_score(F.coalesce("recent", z), F.coalesce("history", z), r, h)
                 .alias("true_count"),
                 WM.burst_score(F.coalesce("er", z), F.coalesce("eh", z), r, h)
                 .alias("est_count")))
    nb = F.floor(j.T / F.lit(params.BUCKET_SLOTS)) + 1
    bu = M.accuracy_metrics(b, ["width"]) \
        .withColumn("model", F.lit("bucket")) \
        .withColumn("total_counters", (nb * F.col("width") * depth).cast("double")) \
        .withColumn("bytes_per_counter", F.lit(8.0))
    dtr = WM.decayed_truth(j.ev, j.T, lam, j.targets)
    dse = WM.decay_estimates(j.ev, j.targets, j.T, widths, lam, depth)
    dc = dse.join(dtr, "item").select("width", F.col("true_decayed").alias("true_count"),
                                      F.col("est_decayed").alias("est_count"))
    ad = M.accuracy_metrics(dc, ["width"]) \
        .withColumn("model", F.lit("decay")) \
        .withColumn("total_counters", (F.col("width") * depth).cast("double")) \
        .withColumn("bytes_per_counter", F.lit(8.0))
    cols = ["model", "width", "num_queries", "mae", "rmse", "mean_relative_error",
            "weighted_relative_l1", "total_counters", "bytes_per_counter"]
    allm = ring.select(*cols).unionByName(dy.select(*cols)).unionByName(bu.select(*cols)) \
        .unionByName(ad.select(*cols))
    return allm.select("model", "width", F.lit(depth).cast("bigint").alias("depth"),
                       "num_queries", "mae", "rmse", "mean_relative_error",
                       "weighted_relative_l1", "total_counters",
                       (F.col("total_counters") * F.col("bytes_per_counter"))
                       .alias("estimated_bytes"))


def model_comparison(spark, sf_dir):
    """Four models x sweep widths, ordered by model, width, depth."""
    j = _job(spark, sf_dir, shared=True)
    rows = model_rows(j, list(params.SWEEP_WIDTHS))
    rank = F.create_map(*[x for k, v in MODEL_RANK.items() for x in (F.lit(k), F.lit(v))])
    return M.round_doubles(rows.withColumn("model_rank", rank[F.col("model")].cast("bigint")))


def error_vs_memory(spark, sf_dir):
    """Configurations at or below the 90th percentile (linear) of bytes."""
    j = _job(spark, sf_dir, shared=True)
    rows = model_rows(j, list(params.SWEEP_WIDTHS))
    p90 = rows.select(F.percentile(F.col("estimated_bytes"), F.lit(0.9))).scalar()
    return M.round_doubles(rows.where(F.col("estimated_bytes") <= p90).select(
        "model", "width", "estimated_bytes", "weighted_relative_l1",
        p90.alias("bytes_p90")))


def depth_sweep(spark, sf_dir):
    """E3 over widths x depths: the four models at every depth of the sweep."""
    j = _job(spark, sf_dir, shared=True)
    rows = None
    for depth in params.SWEEP_DEPTHS:
        part = model_rows(j, list(params.SWEEP_WIDTHS[:2]), depth)
        rows = part if rows is None else rows.unionByName(part)
    return M.round_doubles(rows)


def last_active_buckets(spark, sf_dir):
    """P10: each target's last evaluation bucket with recent events, its counts and scores."""
    b = bucket_burst_estimates(spark, sf_dir).where(F.col("true_recent") > 0)
    row = F.max_by(F.struct("true_recent", "true_history", "true_burst", "est_burst"), "bucket")
    return b.groupBy("item").agg(F.max("bucket").alias("bucket"), row.alias("r")).select("item", "bucket", "r.*")


def ring_series(spark, sf_dir):
    """W4/W5/W7 from the sketch: at every slot of the horizon, each target's count in
    the last 32 slots and its burst score, exact and estimated from the ring cells."""
    j = _job(spark, sf_dir, horizon=True, shared=True)
    r, h = params.RECENT_SLOTS, params.HISTORY_SLOTS
    spine = j.targets.select("item", F.explode(F.sequence(j.hs, j.T)).alias("slot"))
    cells = WM.ring_cells(j.ev, j.T, j.maxw, [params.WIDTH])
    probes = event_probes(WM.with_widths(j.targets.select("item"), [params.WIDTH]), params.DEPTH, "width",
                          params.RING_SEED, extra=["width"])
    est = cm_min(probes, cells, ["width", "row", "col"], ["item", "slot"], params.DEPTH)
    exact = WM.slot_counts(j.ev, lo=j.hs, items=j.targets)
    dense = (spine.join(exact, ["item", "slot"], "left").join(est, ["item", "slot"], "left")
             .select("item", "slot", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("true"),
                     F.coalesce("est", F.lit(0)).cast("bigint").alias("est")))
    w = Window.partitionBy("item").orderBy("slot")
    total = lambda c, a, b: F.coalesce(F.sum(c).over(w.rowsBetween(a, b)), F.lit(0)).cast("bigint")
    cols = ["item", "slot"]
    for name in ("true", "est"):
        score = F.when(F.col("slot") < j.hs + r, F.lit(0.0)).otherwise(
            WM.burst_score(total(name, -(r - 1), 0), total(name, -(r + h - 1), -r), r, h))
        cols += [total(name, -(params.SLIDING_SLOTS - 1), 0).alias(f"{name}_sliding"),
                 F.round(score, R).alias(f"{name}_burst")]
    return dense.select(*cols)


def decay_grid_estimates(spark, sf_dir):
    """E1 for decay: at about ten times the targets' decayed counts, exact and from the
    forward-decay sketch of the events up to then."""
    j = _job(spark, sf_dir, shared=True)
    lam = params.DECAY_LAMBDA
    pts = C.eval_points(F.lit(0).cast("bigint"), j.T)
    then = (j.ev.select("item", "slot", "cnt", F.explode(pts).alias("t")).where(F.col("t") >= F.col("slot"))
            .groupBy("item", "t").agg(F.sum(F.col("cnt") * F.exp(F.lit(lam) * (F.col("slot") - F.col("t")))).alias("wt")))
    cells = event_cells(then, ["t"], params.DEPTH, params.WIDTH, params.DECAY_SEED, cnt="wt")
    probes = event_probes(j.targets.select("item"), params.DEPTH, params.WIDTH, params.DECAY_SEED)
    est = cm_min(probes, cells, ["row", "col"], ["item", "t"], params.DEPTH)
    grid = j.targets.select("item", F.explode(pts).alias("t"))
    out = (grid.join(then, ["item", "t"], "left").join(est, ["item", "t"], "left")
           .select("item", "t", F.coalesce("wt", F.lit(0.0)).alias("a"), F.coalesce("est", F.lit(0.0)).cast("double").alias("b")))
    _, rel = M.abs_rel_error(F.col("a"), F.col("b"))
    return out.select("item", "t", F.round("a", R).alias("true_decayed"), F.round("b", R).alias("est_decayed"),
                      F.round(rel, R).alias("rel_error"))


def _point_matrix(df: DataFrame, point: str) -> DataFrame:
    """Rows per item, one column per evaluation point, by the point's place."""
    places = params.NUM_EVAL_POINTS + 2  # the grid holds at most two more than asked for
    place = F.dense_rank().over(Window.partitionBy("item").orderBy(point)) - 1
    p = df.withColumn("place", place).groupBy("item").pivot("place", list(range(places))).agg(F.first("rel_error"))
    return p.select("item", *[F.col(str(k)).alias(f"p{k}") for k in range(places)])


def time_error_matrix(spark, sf_dir):
    """Relative error of the decayed counts per target and evaluation time."""
    return _point_matrix(decay_grid_estimates(spark, sf_dir), "t")


def bucket_error_matrix(spark, sf_dir):
    """Relative error of the burst scores per target and evaluation bucket."""
    return _point_matrix(bucket_burst_estimates(spark, sf_dir), "bucket")


def dyadic_memory(spark, sf_dir):
    """Per level the segments, width, counters, bytes, and cells that are stored."""
    j = _job(spark, sf_dir, shared=True)
    cells = WM.dyadic_cells(j.ev, [params.WIDTH]).groupBy("level").agg(F.count(F.lit(1)).cast("bigint").alias("stored_cells"))
    level = F.col("level")
    width = WM.level_width("width", "level", params.DYADIC_MIN_WIDTH)
    segments = F.floor(j.T / F.pow(F.lit(2.0), level)).cast("bigint") + 1
    return cells.withColumn("width", F.lit(params.WIDTH).cast("bigint")).select(
        "level", segments.alias("segments"), width.cast("bigint").alias("width"),
        (segments * width * params.DEPTH).cast("bigint").alias("total_counters"),
        (segments * width * params.DEPTH * 4).cast("bigint").alias("estimated_bytes"), "stored_cells")


JOBS = {n: globals()[n] for n in [
    "event_slots", "item_counts", "topk_items", "horizon_topk", "item_slot_counts",
    "item_bucket_counts", "interval_counts", "prefix_counts", "sliding_counts",
    "burst_slots", "burst_buckets", "decayed_counts", "decayed_grid", "ring_cells",
    "ring_window_estimates", "window_accuracy", "dyadic_cells", "dyadic_estimates",
    "bucket_burst_estimates", "decay_sketch_estimates", "accuracy_metrics",
    "active_inactive", "error_histogram", "error_matrix", "errors_sorted", "width_sweep",
    "model_comparison", "error_vs_memory", "depth_sweep", "last_active_buckets", "ring_series",
    "decay_grid_estimates", "time_error_matrix", "bucket_error_matrix", "dyadic_memory"]}
