"""Time-windowed frequency models over the canonical event frame.

Every model takes the counts ``(item, slot, cnt)``, a frame of query ``items`` and a
list of sketch ``widths``; widths are exploded into a key column so a whole
width sweep is one job (E2).  Interval reads never loop over slots: each
pre-aggregated ``(item, slot)`` row is expanded into the few query windows that
contain it (``filter(windows, w -> w >= T - slot + 1)``) and summed, so the
range join J5 becomes an explode plus a grouped sum.

* ring      (G13, J2, W3): per-slot Count-Min, retention ``buffer`` slots
* dyadic    (G14, J3):     one Count-Min per dyadic segment and level
* bucket    (G15, J4, W6): per-bucket Count-Min, burst scores on buckets
* decay     (G16, X14):    forward-decayed Count-Min, weights relative to T
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.hashing import bounded_broadcast
from .reads import ring_sums
from .sketch import cm_min, event_cells, event_probes


def _check_widths(widths) -> list[int]:
    ws = [int(w) for w in widths]
    for w in ws:
        if w <= 0 or w & (w - 1) or w > 1 << 28:
            raise ValueError("sketch widths must be powers of two up to 2^28")
    return ws


def with_widths(df: DataFrame, widths) -> DataFrame:
    ws = _check_widths(widths)
    return df.withColumn("width", F.explode(F.array(*[F.lit(w).cast("bigint") for w in ws])))


def slot_counts(ev: DataFrame, lo: Column | None = None, hi: Column | None = None,
                items: DataFrame | None = None) -> DataFrame:
    """Exact ``(item, slot, cnt)``; optional slot range and item set (P9, a
    semi join with a top-k list of ``params.TOP_K`` rows)."""
    df = ev.select("item", "slot", "cnt")
    if lo is not None:
        df = df.where(F.col("slot") >= lo)
    if hi is not None:
        df = df.where(F.col("slot") <= hi)
    if items is not None:
        df = df.join(_small(items.select("item")), "item", "left_semi")
    return df


def _small(items: DataFrame, rows: int = params.TOP_K) -> DataFrame:
    """A top-k list: its rows and the length of its items have parameter bounds."""
    return bounded_broadcast(items, rows, params.ITEM_BYTES)


def _wins(windows) -> Column:
    return F.array(*[F.lit(int(w)).cast("bigint") for w in windows])


def window_sums(df: DataFrame, T: Column, windows, max_window: Column, value: str,
                keys: list[str], name: str) -> DataFrame:
    """Sum ``value`` over the windows [T-w+1, T] that contain each row's slot.

    ``windows`` is the static candidate list (a handful of sizes); each row
    expands into the windows containing its slot, so no range join is needed."""
    ex = df.select(*keys, "slot", value, F.explode(_wins(windows)).alias("window_slots"))
    ex = ex.where((F.col("window_slots") <= max_window)
                  & (F.col("window_slots") >= T - F.col("slot") + 1))
    return ex.groupBy(*keys, "window_slots").agg(F.sum(value).alias(name))


def query_grid(items: DataFrame, windows, max_window: Column, widths=None) -> DataFrame:
    g = items.select("item", F.explode(_wins(windows)).alias("window_slots")) \
        .where(F.col("window_slots") <= max_window)
    return with_widths(g, widths) if widths is not None else g


def window_truth(ev: DataFrame, items: DataFrame, T: Column, windows: Column,
                 max_window: Column, targets_bounded: bool = True) -> DataFrame:
    """Exact count of each item in each window [T-w+1, T], zeros kept."""
    lo = T - max_window + 1
    counts = slot_counts(ev, lo=lo, items=items if targets_bounded else None)
    sums = window_sums(counts, T, windows, max_window, "cnt", ["item"], "true_count")
    grid = query_grid(items, windows, max_window)
    return (grid.join(sums, ["item", "window_slots"], "left")
            .select("item", "window_slots",
                    F.coalesce("true_count", F.lit(0)).cast("bigint").alias("true_count")))


# ----------------------------------------------------------------------------
# Ring model
# ----------------------------------------------------------------------------

def ring_cells(ev: DataFrame, T: Column, buffer_slots: Column, widths,
               depth: int = params.DEPTH, seed: int = params.RING_SEED) -> DataFrame:
    """``(width, slot, row, col, cnt)`` for the retained slots
    ``slot > T - buffer_slots`` (ST4: older slots read as 0)."""
    counts = with_widths(slot_counts(ev, lo=T - buffer_slots + 1), widths)
    return event_cells(counts, ["width", "slot"], depth, "width", seed)


def ring_estimates(ev: DataFrame, items: DataFrame, T: Column, windows: Column,
                   max_window: Column, widths, depth: int = params.DEPTH,
                   seed: int = params.RING_SEED, buffer_slots: Column | None = None,
                   items_bound: int | None = None) -> DataFrame:
    """J2 + W3: estimated count per (width, item, window) = sum over retained
    slots in the window of the per-slot Count-Min minimum."""
    buffer_slots = max_window if buffer_slots is None else buffer_slots
    cells = ring_cells(ev, T, buffer_slots, widths, depth, seed)
    lo = F.greatest(T - max_window + 1, T - buffer_slots + 1)
    cells = cells.where(F.col("slot") >= lo)
    if items_bound is None:
        # a row per item: windows are intervals that end at T
        asked = query_grid(items.select("item"), windows, max_window) \
            .select("item", (T - F.col("window_slots") + 1).alias("a"), T.alias("b")).distinct()
        reads = [ring_sums(cells.where(F.col("width") == w), asked, lo, T, w, depth, seed).select(
            F.lit(w).cast("bigint").alias("width"), "item", (F.col("b") - F.col("a") + 1).alias("window_slots"),
            F.col("est").alias("est_count")) for w in _check_widths(widths)]
        sums = reads[0]
        for more in reads[1:]:
            sums = sums.unionByName(more)
    else:
        probes = event_probes(with_widths(items.select("item"), widths), depth, "width", seed,
                              extra=["width"])
        probes = bounded_broadcast(probes, items_bound * depth * len(list(widths)), params.ITEM_BYTES)
        per_slot = cm_min(probes, cells, ["width", "row", "col"], ["width", "item", "slot"], depth)
        sums = window_sums(per_slot, T, windows, max_window, "est", ["width", "item"], "est_count")
    grid = query_grid(items, windows, max_window, widths)
    return (grid.join(sums, ["width", "item", "window_slots"], "left")
            .select("width", "item", "window_slots",
                    F.coalesce("est_count", F.lit(0)).cast("bigint").alias("est_count")))


# ----------------------------------------------------------------------------
# Dyadic (multi-resolution) model
# ----------------------------------------------------------------------------

def level_width(width: str, level: str, min_width: int) -> Column:
    return F.greatest(F.expr(f"shiftright({width}, {level})"), F.lit(min_width).cast("bigint"))


def dyadic_cells(ev: DataFrame, widths, levels: int = params.DYADIC_LEVELS,
                 min_width: int = params.DYADIC_MIN_WIDTH, depth: int = params.DEPTH,
                 seed: int = params.DYADIC_SEED, lo: Column | None = None) -> DataFrame:
    """``(width, level, seg, row, col, cnt)``; segment = slot >> level,
    width halves per level down to ``min_width``; one seed for every segment
    so levels roll up (D4)."""
    _check_widths([min_width])
    counts = with_widths(slot_counts(ev, lo=lo), widths).withColumn("w0", F.greatest("width", F.lit(min_width).cast("bigint")))
    # every level's width divides w0, so levels are sums of the slots' cells: each row is hashed once
    base = event_cells(counts, ["width", "slot"], depth, "w0", seed)
    lv = base.withColumn("level", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(levels - 1).cast("bigint"))))
    return (lv.groupBy("width", "level", F.expr("shiftright(slot, cast(level as int))").alias("seg"), "row",
                       F.pmod(F.col("col"), level_width("width", "level", min_width)).alias("col"))
            .agg(F.sum("cnt").alias("cnt")))


def dyadic_segments(T: Column, windows, max_window: Column, levels: int) -> DataFrame:
    """J3 planner as rows: the maximal aligned dyadic segments (level capped at
    ``levels - 1``) inside each window [T-w+1, T]; identical to the greedy
    left-to-right decomposition."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    base = spark.range(1).select(F.explode(_wins(windows)).alias("window_slots")) \
        .where(F.col("window_slots") <= max_window)
    base = base.select("window_slots", (T - F.col("window_slots") + 1).alias("a"), T.alias("b"))
    lv = base.withColumn("level", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(levels - 1).cast("bigint"))))
    lv = (lv.withColumn("size", F.expr("shiftleft(1L, level)"))
            .withColumn("first", F.expr("shiftright(a + size - 1, level)"))
            .withColumn("last", F.expr("shiftright(b + 1, level) - 1")))
    segs = lv.where(F.col("first") <= F.col("last")) \
             .withColumn("seg", F.explode(F.sequence(F.col("first"), F.col("last"))))
    psize = F.col("size") * 2
    pstart = F.shiftright(F.col("seg"), 1) * psize
    parent_inside = (pstart >= F.col("a")) & (pstart + psize - 1 <= F.col("b"))
    keep = (F.col("level") == levels - 1) | ~parent_inside
    return segs.where(keep).select("window_slots", "level", "seg")


def dyadic_estimates(ev: DataFrame, items: DataFrame, T: Column, windows: Column,
                     max_window: Column, widths, levels: int = params.DYADIC_LEVELS,
                     min_width: int = params.DYADIC_MIN_WIDTH, depth: int = params.DEPTH,
                     seed: int = params.DYADIC_SEED) -> DataFrame:
    segs = dyadic_segments(T, windows, max_window, levels)
    lo = F.shiftleft(F.shiftright(T - max_window + 1, levels - 1), levels - 1)
    cells = dyadic_cells(ev, widths, levels, min_width, depth, seed, lo=lo)
    # a window of w slots has at most 2 * levels + w / 2^(levels - 1) segments
    bound = sum(2 * levels + -(-int(w) // 2 ** (levels - 1)) for w in windows)
    cells = cells.join(bounded_broadcast(segs.select("level", "seg").distinct(), bound), ["level", "seg"],
                       "left_semi")
    it = with_widths(items.select("item"), widths)
    it = it.withColumn("level", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(levels - 1).cast("bigint"))))
    it = it.withColumn("wl", level_width("width", "level", min_width))
    probes = event_probes(it, depth, "wl", seed, extra=["width", "level", "wl"])
    per_seg = cm_min(probes, cells, ["width", "level", "row", "col"],
                     ["width", "item", "level", "seg"], depth)
    sums = (per_seg.join(bounded_broadcast(segs, bound), ["level", "seg"])
            .groupBy("width", "item", "window_slots").agg(F.sum("est").alias("est_count")))
    grid = query_grid(items, windows, max_window, widths)
    return (grid.join(sums, ["width", "item", "window_slots"], "left")
            .select("width", "item", "window_slots",
                    F.coalesce("est_count", F.lit(0)).cast("bigint").alias("est_count")))


# ----------------------------------------------------------------------------
# Bucketed burst model
# ----------------------------------------------------------------------------

def bucket_counts(ev: DataFrame, bucket_slots: int, items: DataFrame | None = None) -> DataFrame:
    df = ev.withColumn("bucket", F.floor(F.col("slot") / F.lit(bucket_slots)).cast("bigint"))
    if items is not None:
        df = df.join(_small(items.select("item")), "item", "left_semi")
    return df.groupBy("item", "bucket").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def burst_ranges(df: DataFrame, points: Column, value: str, keys: list[str],
                 recent: int, history: int, pos: str = "bucket") -> DataFrame:
    """Sum ``value`` into the recent range [B-r+1, B] and the history range
    [B-r-h+1, B-r] of every evaluation point B (G5/J4 without a range join)."""
    ex = df.select(*keys, pos, value, F.explode(points).alias("point"))
    ex = ex.where((F.col("point") >= F.col(pos))
                  & (F.col("point") <= F.col(pos) + recent + history - 1))
    is_recent = F.col("point") - F.col(pos) < recent
    return ex.groupBy(*keys, "point").agg(
        F.sum(F.when(is_recent, F.col(value)).otherwise(0)).alias("recent"),
        F.sum(F.when(~is_recent, F.col(value)).otherwise(0)).alias("history"))


def burst_score(recent: Column, history: Column, r: int, h: int) -> Column:
    """(recent/r) / (history/h + 1e-9) (D21: epsilon always added)."""
    return (recent / F.lit(float(r))) / (history / F.lit(float(h)) + F.lit(params.BURST_EPSILON))


def bucket_cells(ev: DataFrame, widths, bucket_slots: int = params.BUCKET_SLOTS,
                 depth: int = params.DEPTH, seed: int = params.BURST_SEED) -> DataFrame:
    """``(width, bucket, row, col, cnt)``."""
    counts = with_widths(bucket_counts(ev, bucket_slots), widths)
    return event_cells(counts, ["width", "bucket"], depth, "width", seed)


def bucket_estimates(ev: DataFrame, items: DataFrame, points: Column, widths,
                     bucket_slots: int = params.BUCKET_SLOTS, recent: int = params.RECENT_BUCKETS,
                     history: int = params.HISTORY_BUCKETS, depth: int = params.DEPTH,
                     seed: int = params.BURST_SEED) -> DataFrame:
    """Per (width, point, item): estimated recent/history counts from the
    bucket sketch (sum of per-bucket minima)."""
    cells = bucket_cells(ev, widths, bucket_slots, depth, seed)
    probes = event_probes(with_widths(items.select("item"), widths), depth, "width", seed,
                          extra=["width"])
    per_bucket = cm_min(probes, cells, ["width", "row", "col"], ["width", "item", "bucket"], depth)
    return burst_ranges(per_bucket, points, "est", ["width", "item"], recent, history)


def bucket_truth(ev: DataFrame, items: DataFrame, points: Column,
                 bucket_slots: int = params.BUCKET_SLOTS, recent: int = params.RECENT_BUCKETS,
                 history: int = params.HISTORY_BUCKETS) -> DataFrame:
    counts = bucket_counts(ev, bucket_slots, items)
    return burst_ranges(counts, points, "cnt", ["item"], recent, history)


# ----------------------------------------------------------------------------
# Forward-decay model
# ----------------------------------------------------------------------------

def decay_weight(slot: Column, T: Column, lam: float) -> Column:
    """X14 (D5): weight exp(lambda (slot - T)) relative to the newest slot, so
    the exponent is never positive and needs no cap."""
    return F.exp(F.lit(lam) * (slot - T))


def decayed_truth(ev: DataFrame, T: Column, lam: float, items: DataFrame | None = None) -> DataFrame:
    """Sum of exp(-lambda (T - slot)) over slot <= T, per item."""
    counts = slot_counts(ev, hi=T, items=items)
    return counts.groupBy("item").agg(
        F.sum(F.col("cnt") * decay_weight(F.col("slot"), T, lam)).alias("true_decayed"))


def decay_estimates(ev: DataFrame, items: DataFrame, T: Column, widths, lam: float,
                    depth: int = params.DEPTH, seed: int = params.DECAY_SEED) -> DataFrame:
    """Linear forward-decay Count-Min; plain minimum read."""
    counts = slot_counts(ev, hi=T)
    w = counts.select("item", (F.col("cnt") * decay_weight(F.col("slot"), T, lam)).alias("wt"))
    per_item = with_widths(w.groupBy("item").agg(F.sum("wt").alias("wt")), widths)
    cells = event_cells(per_item, ["width"], depth, "width", seed, cnt="wt")
    probes = event_probes(with_widths(items.select("item"), widths), depth, "width", seed,
                          extra=["width"])
    return cm_min(probes, cells, ["width", "row", "col"], ["width", "item"], depth) \
        .withColumnRenamed("est", "est_decayed")
