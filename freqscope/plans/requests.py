"""Jobs that answer requests over ``events``: intervals a user asks for (J2, J3, G3) and
exact percentiles of all errors (G24); their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params
from ..operators import intervals as I
from ..operators.metrics import abs_rel_error
from ..operators.ranks import nearest_ranks
from ..session import cut_lineage
from . import events
from .events_sql import D, base, sha_idx

P = params
R = params.ROUND_DIGITS
PERCENTS = (0.0, 25.0, 50.0, 90.0, 99.0, 100.0)


def _thirds(counts):
    """Two requests per item: the first and the last third of the slots it is seen in."""
    seen = counts.groupBy("item").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    third = F.floor((F.col("hi") - F.col("lo")) / 3).cast("bigint")
    ends = F.array(F.struct(F.col("lo").alias("a"), (F.col("lo") + third).alias("b")),
                   F.struct((F.col("hi") - third).alias("a"), F.col("hi").alias("b")))
    return seen.select("item", F.explode(ends).alias("r")).select("item", "r.a", "r.b").distinct()


def requested_intervals(spark, sf_dir):
    """Each item's first and last third, counted exactly, from the dyadic cells
    and from the per-slot cells of the retained slots."""
    j = events._job(spark, sf_dir, shared=True)
    asked = cut_lineage(_thirds(j.ev))
    return I.answered(asked, true_count=I.requested_counts(j.ev, asked), dyadic_est=I.requested_dyadic(j.ev, asked),
                      ring_est=I.requested_ring(j.ev, asked, j.T, j.maxw))


def error_percentiles(spark, sf_dir):
    """Exact nearest-rank percentiles of the relative errors of every item's window
    counts, per window and over all of them (window_slots null)."""
    rows = events.ring_window_estimates(spark, sf_dir)
    rows = cut_lineage(rows.select("window_slots", abs_rel_error(F.col("true_count"), F.col("est_count"))[1].alias("rel_error")))
    each = nearest_ranks(rows, ["window_slots"], "rel_error", list(PERCENTS))
    every = nearest_ranks(rows, [], "rel_error", list(PERCENTS)).withColumn("window_slots", F.lit(None).cast("bigint"))
    return each.unionByName(every).select("window_slots", "percent", "n", F.round("rel_error", R).alias("rel_error"))


JOBS = {"requested_intervals": requested_intervals, "error_percentiles": error_percentiles}


def oracle() -> dict[str, str]:
    from . import events_sql
    L, mw, d = P.DYADIC_LEVELS, P.DYADIC_MIN_WIDTH, P.DEPTH
    q = {}
    q["requested_intervals"] = f"""WITH {base()},
c AS (SELECT item, slot, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY ALL),
seen AS (SELECT item, min(slot) AS lo, max(slot) AS hi FROM c GROUP BY item),
rq AS (SELECT item, lo AS a, lo + (hi - lo) // 3 AS b FROM seen UNION SELECT item, hi - (hi - lo) // 3, hi FROM seen),
tr AS (SELECT item, a, b, sum(cnt) AS n FROM rq JOIN c USING (item) WHERE slot BETWEEN a AND b GROUP BY ALL),
rc AS (SELECT slot, t.r AS row, {sha_idx('item', 't.r', P.RING_SEED, str(P.WIDTH))} AS col, sum(cnt) AS cnt
  FROM c, hz, range(0, {d}) t(r) WHERE slot > hz.T - hz.maxw GROUP BY ALL),
rp AS (SELECT item, a, b, u.r AS row, {sha_idx('item', 'u.r', P.RING_SEED, str(P.WIDTH))} AS col FROM rq, range(0, {d}) u(r)),
rs AS (SELECT item, a, b, slot, CASE WHEN count(*) = {d} THEN min(cnt) ELSE 0 END AS m
  FROM rp JOIN rc USING (row, col) WHERE slot BETWEEN a AND b GROUP BY ALL),
ring AS (SELECT item, a, b, sum(m) AS n FROM rs GROUP BY ALL),
sg0 AS (SELECT item, a, b, t.l AS level, unnest(generate_series((a + (1 << t.l) - 1) >> t.l, ((b + 1) >> t.l) - 1)) AS seg
  FROM rq, range(0, {L}) t(l) WHERE ((a + (1 << t.l) - 1) >> t.l) <= ((b + 1) >> t.l) - 1),
sg AS (SELECT * FROM sg0 WHERE level = {L - 1} OR NOT ((seg >> 1) * (2 << level) >= a
  AND (seg >> 1) * (2 << level) + (2 << level) - 1 <= b)),
dc AS (SELECT t.l AS level, slot >> t.l AS seg, u.r AS row,
  {sha_idx('item', 'u.r', P.DYADIC_SEED, f'greatest({P.WIDTH} >> t.l, {mw})')} AS col, sum(cnt) AS cnt
  FROM c, range(0, {L}) t(l), range(0, {d}) u(r) GROUP BY ALL),
dp AS (SELECT item, a, b, level, seg, u.r AS row, {sha_idx('item', 'u.r', P.DYADIC_SEED, f'greatest({P.WIDTH} >> level, {mw})')} AS col
  FROM sg, range(0, {d}) u(r)),
ds AS (SELECT item, a, b, level, seg, CASE WHEN count(*) = {d} THEN min(cnt) ELSE 0 END AS m
  FROM dp JOIN dc USING (level, seg, row, col) GROUP BY ALL),
dy AS (SELECT item, a, b, sum(m) AS n FROM ds GROUP BY ALL)
SELECT rq.item, rq.a, rq.b, CAST(coalesce(tr.n, 0) AS BIGINT) AS true_count, CAST(coalesce(dy.n, 0) AS BIGINT) AS dyadic_est,
  CAST(coalesce(ring.n, 0) AS BIGINT) AS ring_est
FROM rq LEFT JOIN tr USING (item, a, b) LEFT JOIN dy USING (item, a, b) LEFT JOIN ring USING (item, a, b)"""
    values = ", ".join(f"({D(p)})" for p in PERCENTS)
    q["error_percentiles"] = f"""WITH rows AS ({events_sql.oracle()['ring_window_estimates']}),
e AS (SELECT window_slots, CASE WHEN true_count > 0 THEN abs(est_count - true_count) / true_count ELSE {D(0)} END AS x FROM rows),
g AS (SELECT window_slots, list_sort(list(x)) AS l FROM e GROUP BY window_slots
      UNION ALL SELECT NULL, list_sort(list(x)) FROM e HAVING count(*) > 0)
SELECT window_slots, p.percent, CAST(len(l) AS BIGINT) AS n, round(l[CAST(round_even(p.percent / 100 * (len(l) - 1), 0) AS BIGINT) + 1], {R}) AS rel_error
FROM g, (VALUES {values}) p(percent)"""
    return q
