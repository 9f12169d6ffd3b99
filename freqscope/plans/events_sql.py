"""DuckDB twins of the events jobs (the correctness oracle).

Each statement recomputes the job from the raw ``events`` view with the same
parameters and the same floating-point operation order as the Spark plan.
"""

from __future__ import annotations

from .. import params

P = params
R = params.ROUND_DIGITS


def D(x) -> str:
    """A DOUBLE literal (DuckDB reads 0.01 as DECIMAL otherwise)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def sha_idx(item: str, row: str, seed: int, width: str) -> str:
    """X6 in DuckDB: sha256('{seed}-{row}-{item}') first 8 bytes mod width."""
    return (f"CAST((('0x' || substr(sha256('{seed}-' || CAST({row} AS VARCHAR) || '-' || {item}),"
            f" 1, 16))::UBIGINT % CAST({width} AS UBIGINT)) AS BIGINT)")


def _wins_values() -> str:
    return ", ".join(f"({4 ** i})" for i in range(16))


def base(k: int = P.TOP_K) -> str:
    slot_us = P.SLOT_SECONDS * 1_000_000
    return f"""
ev0 AS (
  SELECT event_id, ts, event_type || ':' || CAST(user_id AS VARCHAR) AS item
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL AND user_id IS NOT NULL),
ev AS (
  SELECT event_id, ts, item,
         CAST(floor((epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM ev0)) / {D(slot_us)}) AS BIGINT) AS slot
  FROM ev0),
hz AS (
  SELECT T, maxw, T - maxw + 1 AS hs
  FROM (SELECT max(slot) AS T, least({P.EVAL_LAST_SLOTS}, max(slot) + 1) AS maxw FROM ev)),
wins AS (
  SELECT CAST(w AS BIGINT) AS window_slots FROM (VALUES {_wins_values()}) v(w), hz WHERE w <= hz.maxw),
tg AS (
  SELECT item, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, item) AS BIGINT) AS rank FROM (
    SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM ev, hz WHERE ev.slot BETWEEN hz.hs AND hz.T
    GROUP BY item ORDER BY cnt DESC, item LIMIT {k}) t)"""


def burst(rc: str, hc: str, r: int, h: int) -> str:
    return f"(({rc}) / {D(r)}) / (({hc}) / {D(h)} + {D(P.BURST_EPSILON)})"


def points_cte() -> str:
    bs, r, h = P.BUCKET_SLOTS, P.RECENT_BUCKETS, P.HISTORY_BUCKETS
    return f"""
bp AS (SELECT CAST(ceil(hs / {D(bs)}) AS BIGINT) + {r + h - 1} AS first,
              CAST(floor(T / {D(bs)}) AS BIGINT) AS maxb FROM hz),
pts AS (SELECT CAST(unnest(CASE WHEN maxb < first THEN [maxb] ELSE list_distinct(list_concat(
          generate_series(first, maxb, greatest(1, CAST(floor((maxb - first + 1) /
            least({P.NUM_EVAL_POINTS}, maxb - first + 1)) AS BIGINT))), [maxb])) END) AS BIGINT) AS point
        FROM bp)"""


def ring_ctes(items: str, widths: list[int], prefix: str = "r", depth: int = P.DEPTH) -> str:
    """Ring estimates for ``items`` (a CTE with column ``item``) over widths:
    gives CTE ``{prefix}_es(width, item, window_slots, est)``."""
    wv = ", ".join(f"({w})" for w in widths)
    seed, d = P.RING_SEED, depth
    return f"""
{prefix}_w AS (SELECT CAST(w AS BIGINT) AS width FROM (VALUES {wv}) v(w)),
{prefix}_c AS (SELECT item, slot, count(*) AS cnt FROM ev, hz WHERE slot >= hz.T - hz.maxw + 1 GROUP BY ALL),
{prefix}_cells AS (
  SELECT ww.width, c.slot, t.r AS row, {sha_idx('c.item', 't.r', seed, 'ww.width')} AS col, sum(c.cnt) AS cnt
  FROM {prefix}_c c, {prefix}_w ww, range(0, {d}) t(r) GROUP BY ALL),
{prefix}_pr AS (
  SELECT ww.width, i.item, t.r AS row, {sha_idx('i.item', 't.r', seed, 'ww.width')} AS col
  FROM {items} i, {prefix}_w ww, range(0, {d}) t(r)),
{prefix}_ps AS (
  SELECT p.width, p.item, c.slot, CASE WHEN count(*) = {d} THEN min(c.cnt) ELSE 0 END AS est
  FROM {prefix}_pr p JOIN {prefix}_cells c ON p.width = c.width AND p.row = c.row AND p.col = c.col
  GROUP BY p.width, p.item, c.slot),
{prefix}_es AS (
  SELECT ps.width, ps.item, w.window_slots, sum(ps.est) AS est
  FROM {prefix}_ps ps, wins w, hz WHERE w.window_slots >= hz.T - ps.slot + 1 GROUP BY ALL)"""


def truth_cte(items: str, name: str = "tr") -> str:
    return f"""
{name} AS (
  SELECT e.item, w.window_slots, count(*) AS tc
  FROM ev e JOIN {items} i ON e.item = i.item CROSS JOIN hz CROSS JOIN wins w
  WHERE e.slot >= hz.T - hz.maxw + 1 AND w.window_slots >= hz.T - e.slot + 1 GROUP BY ALL)"""


def dyadic_ctes(items: str, widths: list[int], prefix: str = "d", depth: int = P.DEPTH) -> str:
    wv = ", ".join(f"({w})" for w in widths)
    L, mw, seed, d = P.DYADIC_LEVELS, P.DYADIC_MIN_WIDTH, P.DYADIC_SEED, depth
    return f"""
{prefix}_w AS (SELECT CAST(w AS BIGINT) AS width FROM (VALUES {wv}) v(w)),
{prefix}_sg0 AS (SELECT w.window_slots, hz.T - w.window_slots + 1 AS a, hz.T AS b, t.l AS level
  FROM wins w, hz, range(0, {L}) t(l)),
{prefix}_sg1 AS (SELECT window_slots, a, b, level,
    unnest(generate_series((a + (1 << level) - 1) >> level, ((b + 1) >> level) - 1)) AS seg
  FROM {prefix}_sg0 WHERE ((a + (1 << level) - 1) >> level) <= ((b + 1) >> level) - 1),
{prefix}_segs AS (SELECT window_slots, level, seg FROM {prefix}_sg1
  WHERE level = {L - 1} OR NOT ((seg >> 1) * (2 << level) >= a
                                AND (seg >> 1) * (2 << level) + (2 << level) - 1 <= b)),
{prefix}_c AS (SELECT item, slot, count(*) AS cnt FROM ev GROUP BY ALL),
{prefix}_s AS (SELECT item, t.l AS level, slot >> t.l AS seg, sum(cnt) AS cnt
  FROM {prefix}_c, range(0, {L}) t(l) GROUP BY ALL),
{prefix}_cells AS (
  SELECT ww.width, s.level, s.seg, t.r AS row,
         {sha_idx('s.item', 't.r', seed, f'greatest(ww.width >> s.level, {mw})')} AS col,
         sum(s.cnt) AS cnt
  FROM {prefix}_s s, {prefix}_w ww, range(0, {d}) t(r) GROUP BY ALL),
{prefix}_pr AS (
  SELECT ww.width, i.item, t.l AS level, u.r AS row,
         {sha_idx('i.item', 'u.r', seed, f'greatest(ww.width >> t.l, {mw})')} AS col
  FROM {items} i, {prefix}_w ww, range(0, {L}) t(l), range(0, {d}) u(r)),
{prefix}_ps AS (
  SELECT p.width, p.item, c.level, c.seg, CASE WHEN count(*) = {d} THEN min(c.cnt) ELSE 0 END AS est
  FROM {prefix}_pr p JOIN {prefix}_cells c
    ON p.width = c.width AND p.level = c.level AND p.row = c.row AND p.col = c.col
  GROUP BY p.width, p.item, c.level, c.seg),
{prefix}_es AS (
  SELECT ps.width, ps.item, sg.window_slots, sum(ps.est) AS est
  FROM {prefix}_ps ps JOIN {prefix}_segs sg ON ps.level = sg.level AND ps.seg = sg.seg GROUP BY ALL)"""


def bucket_ctes(items: str, widths: list[int], prefix: str = "b", depth: int = P.DEPTH) -> str:
    """Exact and sketched recent/history bucket counts at the points."""
    wv = ", ".join(f"({w})" for w in widths)
    bs, r, h, seed, d = P.BUCKET_SLOTS, P.RECENT_BUCKETS, P.HISTORY_BUCKETS, P.BURST_SEED, depth
    return f"""
{prefix}_w AS (SELECT CAST(w AS BIGINT) AS width FROM (VALUES {wv}) v(w)),
{prefix}_bc AS (SELECT item, CAST(floor(slot / {D(bs)}) AS BIGINT) AS bucket, count(*) AS cnt
  FROM ev, hz WHERE slot >= hz.hs GROUP BY ALL),
{prefix}_tbc AS (SELECT bc.* FROM {prefix}_bc bc JOIN {items} i ON bc.item = i.item),
{prefix}_tr AS (SELECT bc.item, p.point,
    sum(CASE WHEN p.point - bc.bucket < {r} THEN bc.cnt ELSE 0 END) AS recent,
    sum(CASE WHEN p.point - bc.bucket >= {r} THEN bc.cnt ELSE 0 END) AS history
  FROM {prefix}_tbc bc, pts p WHERE p.point >= bc.bucket AND p.point <= bc.bucket + {r + h - 1}
  GROUP BY ALL),
{prefix}_cells AS (
  SELECT ww.width, bc.bucket, t.r AS row, {sha_idx('bc.item', 't.r', seed, 'ww.width')} AS col,
         sum(bc.cnt) AS cnt
  FROM {prefix}_bc bc, {prefix}_w ww, range(0, {d}) t(r) GROUP BY ALL),
{prefix}_pr AS (
  SELECT ww.width, i.item, t.r AS row, {sha_idx('i.item', 't.r', seed, 'ww.width')} AS col
  FROM {items} i, {prefix}_w ww, range(0, {d}) t(r)),
{prefix}_pb AS (
  SELECT p.width, p.item, c.bucket, CASE WHEN count(*) = {d} THEN min(c.cnt) ELSE 0 END AS est
  FROM {prefix}_pr p JOIN {prefix}_cells c ON p.width = c.width AND p.row = c.row AND p.col = c.col
  GROUP BY p.width, p.item, c.bucket),
{prefix}_es AS (SELECT pb.width, pb.item, p.point,
    sum(CASE WHEN p.point - pb.bucket < {r} THEN pb.est ELSE 0 END) AS recent,
    sum(CASE WHEN p.point - pb.bucket >= {r} THEN pb.est ELSE 0 END) AS history
  FROM {prefix}_pb pb, pts p WHERE p.point >= pb.bucket AND p.point <= pb.bucket + {r + h - 1}
  GROUP BY ALL)"""


def decay_ctes(items: str, widths: list[int], prefix: str = "a", depth: int = P.DEPTH) -> str:
    wv = ", ".join(f"({w})" for w in widths)
    lam, seed, d = P.DECAY_LAMBDA, P.DECAY_SEED, depth
    return f"""
{prefix}_w AS (SELECT CAST(w AS BIGINT) AS width FROM (VALUES {wv}) v(w)),
{prefix}_c AS (SELECT item, slot, count(*) AS cnt FROM ev, hz WHERE slot <= hz.T GROUP BY ALL),
{prefix}_wt AS (SELECT c.item, sum(c.cnt * exp({D(lam)} * (c.slot - hz.T))) AS wt FROM {prefix}_c c, hz
  GROUP BY c.item),
{prefix}_tr AS (SELECT wt.item, wt.wt AS true_decayed FROM {prefix}_wt wt JOIN {items} i ON wt.item = i.item),
{prefix}_cells AS (
  SELECT ww.width, t.r AS row, {sha_idx('x.item', 't.r', seed, 'ww.width')} AS col, sum(x.wt) AS cnt
  FROM {prefix}_wt x, {prefix}_w ww, range(0, {d}) t(r) GROUP BY ALL),
{prefix}_pr AS (
  SELECT ww.width, i.item, t.r AS row, {sha_idx('i.item', 't.r', seed, 'ww.width')} AS col
  FROM {items} i, {prefix}_w ww, range(0, {d}) t(r)),
{prefix}_es AS (
  SELECT p.width, p.item, CASE WHEN count(*) = {d} THEN min(c.cnt) ELSE 0 END AS est_decayed
  FROM {prefix}_pr p JOIN {prefix}_cells c ON p.width = c.width AND p.row = c.row AND p.col = c.col
  GROUP BY p.width, p.item)"""


def metric_aggs(t: str = "true_count", e: str = "est_count") -> str:
    """The accuracy aggregates over a relation with true/est columns."""
    ab = f"abs({e} - {t})"
    rel = f"(CASE WHEN {t} > 0 THEN abs({e} - {t}) / {t} ELSE {D(0)} END)"
    act = f"{t} > 0"
    n = "count(*)"
    srt = f"list_sort(list({rel}))"

    def rank(p):
        return (f"CASE WHEN {n} > 0 THEN {srt}[CAST(round_even({D(p / 100.0)} * ({n} - 1), 0) AS INTEGER) + 1]"
                f" ELSE {D(0)} END")
    ninact = f"sum(CASE WHEN NOT ({act}) THEN 1 ELSE 0 END)"
    return f"""
  round(CAST({n} AS DOUBLE), {R}) AS num_queries,
  round(coalesce(avg({ab}), 0), {R}) AS mae,
  round(coalesce(sqrt(avg({ab} * {ab})), 0), {R}) AS rmse,
  round(coalesce(avg({rel}), 0), {R}) AS mean_relative_error,
  round(CASE WHEN sum({t}) > 0 THEN sum({ab}) / sum({t}) ELSE 0 END, {R}) AS weighted_relative_l1,
  round({rank(50)}, {R}) AS median_relative_error,
  round({rank(90)}, {R}) AS p90_relative_error,
  round(coalesce(max({rel}), 0), {R}) AS max_relative_error,
  round(coalesce(avg(CASE WHEN {act} THEN {ab} END), 0), {R}) AS mae_active,
  round(coalesce(sqrt(avg(CASE WHEN {act} THEN {ab} * {ab} END)), 0), {R}) AS rmse_active,
  round(coalesce(avg(CASE WHEN {act} THEN {rel} END), 0), {R}) AS mean_relative_error_active,
  round(CASE WHEN sum({t}) > 0 THEN sum(CASE WHEN {act} THEN {ab} ELSE 0 END) / sum({t}) ELSE 0 END, {R})
    AS weighted_relative_l1_active,
  round(CASE WHEN {ninact} > 0 THEN sum(CASE WHEN NOT ({act}) AND {e} > 0 THEN 1 ELSE 0 END) / {ninact}
    ELSE 0 END, {R}) AS false_positive_rate,
  round(coalesce(avg(CASE WHEN NOT ({act}) THEN {e} END), 0), {R}) AS avg_false_positive_estimate,
  round(CAST(coalesce(max(CASE WHEN NOT ({act}) THEN {e} END), 0) AS DOUBLE), {R})
    AS max_false_positive_estimate"""


def _wa_select() -> str:
    """window_accuracy as CTE ``wa``."""
    return f"""{base()},{ring_ctes('tg', [P.WIDTH])},{truth_cte('tg')},
wa0 AS (
  SELECT g.item, w.window_slots, CAST(coalesce(tr.tc, 0) AS BIGINT) AS true_count,
         CAST(coalesce(es.est, 0) AS BIGINT) AS est_count
  FROM tg g CROSS JOIN wins w
  LEFT JOIN tr ON tr.item = g.item AND tr.window_slots = w.window_slots
  LEFT JOIN r_es es ON es.item = g.item AND es.window_slots = w.window_slots),
wa AS (
  SELECT item, window_slots, true_count, est_count, CAST(abs(est_count - true_count) AS BIGINT) AS abs_error,
         round(CASE WHEN true_count > 0 THEN abs(est_count - true_count) / true_count ELSE {D(0)} END, {R})
           AS rel_error
  FROM wa0)"""


def _rwe_select() -> str:
    """ring_window_estimates as CTE ``rwe`` (all items)."""
    return f"""{base()},
it AS (SELECT DISTINCT item FROM ev),{ring_ctes('it', [P.WIDTH])},
tra AS (SELECT c.item, w.window_slots, sum(c.cnt) AS tc FROM r_c c, wins w, hz
        WHERE w.window_slots >= hz.T - c.slot + 1 GROUP BY ALL),
rwe AS (
  SELECT i.item, w.window_slots, CAST(coalesce(tra.tc, 0) AS BIGINT) AS true_count,
         CAST(coalesce(es.est, 0) AS BIGINT) AS est_count
  FROM it i CROSS JOIN wins w
  LEFT JOIN tra ON tra.item = i.item AND tra.window_slots = w.window_slots
  LEFT JOIN r_es es ON es.item = i.item AND es.window_slots = w.window_slots)"""


def _model_rows(widths: list[int], depth: int = P.DEPTH) -> str:
    """E3 rows as CTE ``mr``."""
    d, L, mw = depth, P.DYADIC_LEVELS, P.DYADIC_MIN_WIDTH
    r, h, bs = P.RECENT_BUCKETS, P.HISTORY_BUCKETS, P.BUCKET_SLOTS
    dy_terms = " + ".join(
        f"(floor(hz.T / {D(2 ** lv)}) + 1) * greatest(m.width / {D(2 ** lv)}, {D(mw)})"
        for lv in range(L))
    mets = "num_queries, mae, rmse, mean_relative_error, weighted_relative_l1"
    return f"""{base()},{ring_ctes('tg', widths, depth=depth)},{truth_cte('tg')},{dyadic_ctes('tg', widths, depth=depth)},
{points_cte()},{bucket_ctes('tg', widths, depth=depth)},{decay_ctes('tg', widths, depth=depth)},
ring_q AS (SELECT ww.width, g.item, w.window_slots, coalesce(tr.tc, 0) AS true_count,
                  coalesce(es.est, 0) AS est_count
  FROM tg g CROSS JOIN wins w CROSS JOIN r_w ww
  LEFT JOIN tr ON tr.item = g.item AND tr.window_slots = w.window_slots
  LEFT JOIN r_es es ON es.width = ww.width AND es.item = g.item AND es.window_slots = w.window_slots),
dy_q AS (SELECT ww.width, g.item, w.window_slots, coalesce(tr.tc, 0) AS true_count,
                coalesce(es.est, 0) AS est_count
  FROM tg g CROSS JOIN wins w CROSS JOIN d_w ww
  LEFT JOIN tr ON tr.item = g.item AND tr.window_slots = w.window_slots
  LEFT JOIN d_es es ON es.width = ww.width AND es.item = g.item AND es.window_slots = w.window_slots),
bu_q AS (SELECT ww.width,
    {burst('coalesce(t.recent, 0)', 'coalesce(t.history, 0)', r, h)} AS true_count,
    {burst('coalesce(e.recent, 0)', 'coalesce(e.history, 0)', r, h)} AS est_count
  FROM tg g CROSS JOIN pts p CROSS JOIN b_w ww
  LEFT JOIN b_tr t ON t.item = g.item AND t.point = p.point
  LEFT JOIN b_es e ON e.width = ww.width AND e.item = g.item AND e.point = p.point),
ad_q AS (SELECT e.width, t.true_decayed AS true_count, e.est_decayed AS est_count
  FROM a_es e JOIN a_tr t ON e.item = t.item),
m_ring AS (SELECT 'ring' AS model, width, {metric_aggs()} FROM ring_q GROUP BY width),
m_dy AS (SELECT 'dyadic' AS model, width, {metric_aggs()} FROM dy_q GROUP BY width),
m_bu AS (SELECT 'bucket' AS model, width, {metric_aggs()} FROM bu_q GROUP BY width),
m_ad AS (SELECT 'decay' AS model, width, {metric_aggs()} FROM ad_q GROUP BY width),
mr0 AS (
  SELECT m.model, m.width, {mets}, CAST(hz.maxw * m.width * {d} AS DOUBLE) AS total_counters,
         {D(4)} AS bpc FROM m_ring m, hz
  UNION ALL
  SELECT m.model, m.width, {mets}, CAST(({dy_terms}) * {d} AS DOUBLE), {D(4)} FROM m_dy m, hz
  UNION ALL
  SELECT m.model, m.width, {mets}, CAST((floor(hz.T / {D(bs)}) + 1) * m.width * {d} AS DOUBLE), {D(8)}
  FROM m_bu m, hz
  UNION ALL
  SELECT m.model, m.width, {mets}, CAST(m.width * {d} AS DOUBLE), {D(8)} FROM m_ad m),
mr AS (SELECT model, width, CAST({d} AS BIGINT) AS depth, {mets}, total_counters,
              total_counters * bpc AS estimated_bytes FROM mr0)"""


def oracle() -> dict[str, str]:
    r, h = P.RECENT_SLOTS, P.HISTORY_SLOTS
    rb, hb = P.RECENT_BUCKETS, P.HISTORY_BUCKETS
    bs, lam = P.BUCKET_SLOTS, P.DECAY_LAMBDA
    q: dict[str, str] = {}
    q["event_slots"] = f"""WITH {base()}
SELECT slot, CAST(floor(slot / {D(bs)}) AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n_events,
       CAST(count(DISTINCT item) AS BIGINT) AS n_items FROM ev GROUP BY slot"""
    q["item_counts"] = f"""WITH {base()}
SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY item"""
    q["topk_items"] = f"""WITH {base()}
SELECT CAST(row_number() OVER (ORDER BY cnt DESC, item) AS BIGINT) AS rank, item, cnt FROM (
  SELECT item, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY item ORDER BY cnt DESC, item LIMIT {P.TOP_K}) t"""
    q["horizon_topk"] = f"""WITH {base()}
SELECT rank, item, cnt FROM tg"""
    q["item_slot_counts"] = f"""WITH {base()}
SELECT e.item, e.slot, CAST(count(*) AS BIGINT) AS cnt
FROM ev e JOIN tg ON e.item = tg.item CROSS JOIN hz WHERE e.slot BETWEEN hz.hs AND hz.T GROUP BY ALL"""
    q["item_bucket_counts"] = f"""WITH {base()}
SELECT item, CAST(floor(slot / {D(bs)}) AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS cnt
FROM ev GROUP BY ALL"""
    q["interval_counts"] = f"""WITH {base()},{truth_cte('tg')}
SELECT g.item, w.window_slots, CAST(coalesce(tr.tc, 0) AS BIGINT) AS true_count
FROM tg g CROSS JOIN wins w LEFT JOIN tr ON tr.item = g.item AND tr.window_slots = w.window_slots"""
    q["prefix_counts"] = f"""WITH {base()},
sp AS (SELECT g.item, CAST(unnest(generate_series(hz.hs, hz.T)) AS BIGINT) AS slot FROM tg g, hz),
c AS (SELECT e.item, e.slot, count(*) AS cnt FROM ev e JOIN tg ON e.item = tg.item CROSS JOIN hz
      WHERE e.slot >= hz.hs GROUP BY ALL),
d AS (SELECT sp.item, sp.slot, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
      FROM sp LEFT JOIN c ON c.item = sp.item AND c.slot = sp.slot)
SELECT item, slot, cnt, CAST(sum(cnt) OVER (PARTITION BY item ORDER BY slot
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS prefix FROM d"""
    q["sliding_counts"] = f"""WITH {base()},
c AS (SELECT item, slot, CAST(count(*) AS BIGINT) AS cnt FROM ev GROUP BY ALL)
SELECT item, slot, cnt, CAST(sum(cnt) OVER (PARTITION BY item ORDER BY slot
  RANGE BETWEEN {P.SLIDING_SLOTS - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS sliding_cnt FROM c"""
    q["burst_slots"] = f"""WITH {base()},
sp AS (SELECT g.item, CAST(unnest(generate_series(0, hz.T)) AS BIGINT) AS slot FROM tg g, hz),
c AS (SELECT e.item, e.slot, count(*) AS cnt FROM ev e JOIN tg ON e.item = tg.item GROUP BY ALL),
d AS (SELECT sp.item, sp.slot, CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
      FROM sp LEFT JOIN c ON c.item = sp.item AND c.slot = sp.slot),
f AS (SELECT item, slot,
  CAST(sum(cnt) OVER (PARTITION BY item ORDER BY slot ROWS BETWEEN {r - 1} PRECEDING AND CURRENT ROW) AS BIGINT)
    AS recent_cnt,
  CAST(coalesce(sum(cnt) OVER (PARTITION BY item ORDER BY slot
    ROWS BETWEEN {r + h - 1} PRECEDING AND {r} PRECEDING), 0) AS BIGINT) AS history_cnt FROM d)
SELECT item, slot, recent_cnt, history_cnt,
  round(CASE WHEN slot < {r} THEN {D(0)} ELSE {burst('recent_cnt', 'history_cnt', r, h)} END, {R}) AS burst
FROM f"""
    q["burst_buckets"] = f"""WITH {base()},{points_cte()},{bucket_ctes('tg', [P.WIDTH])}
SELECT p.point AS bucket, g.item, CAST(coalesce(t.recent, 0) AS BIGINT) AS true_recent,
  CAST(coalesce(t.history, 0) AS BIGINT) AS true_history,
  round({burst('coalesce(t.recent, 0)', 'coalesce(t.history, 0)', rb, hb)}, {R}) AS true_burst
FROM tg g CROSS JOIN pts p LEFT JOIN b_tr t ON t.item = g.item AND t.point = p.point"""
    q["decayed_counts"] = f"""WITH {base()},
c AS (SELECT item, slot, count(*) AS cnt FROM ev, hz WHERE slot <= hz.T GROUP BY ALL)
SELECT c.item, round(sum(c.cnt * exp({D(lam)} * (c.slot - hz.T))), {R}) AS true_decayed
FROM c, hz GROUP BY c.item"""
    q["decayed_grid"] = f"""WITH {base()},
gp AS (SELECT T + 1 AS span, least({P.NUM_EVAL_POINTS}, T + 1) AS num, T FROM hz),
pts AS (SELECT CAST(unnest(list_distinct(list_concat(generate_series(0, T,
          greatest(1, CAST(floor(span / num) AS BIGINT))), [T]))) AS BIGINT) AS t FROM gp),
c AS (SELECT e.item, e.slot, count(*) AS cnt FROM ev e JOIN tg ON e.item = tg.item GROUP BY ALL),
s AS (SELECT c.item, p.t, sum(c.cnt * exp({D(-lam)} * (p.t - c.slot))) AS d FROM c, pts p
      WHERE p.t >= c.slot GROUP BY ALL)
SELECT g.item, p.t, round(coalesce(s.d, {D(0)}), {R}) AS true_decayed
FROM tg g CROSS JOIN pts p LEFT JOIN s ON s.item = g.item AND s.t = p.t"""
    q["ring_cells"] = f"""WITH {base()},{ring_ctes('tg', [P.WIDTH])}
SELECT slot, CAST(row AS BIGINT) AS row, col, CAST(cnt AS BIGINT) AS cnt FROM r_cells"""
    q["ring_window_estimates"] = f"""WITH {_rwe_select()}
SELECT * FROM rwe"""
    q["window_accuracy"] = f"""WITH {_wa_select()}
SELECT * FROM wa"""
    q["dyadic_cells"] = f"""WITH {base()},{dyadic_ctes('tg', [P.WIDTH])}
SELECT CAST(level AS BIGINT) AS level, CAST(seg AS BIGINT) AS seg, CAST(row AS BIGINT) AS row, col,
       CAST(cnt AS BIGINT) AS cnt FROM d_cells"""
    q["dyadic_estimates"] = f"""WITH {base()},{dyadic_ctes('tg', [P.WIDTH])},{truth_cte('tg')},
x AS (SELECT g.item, w.window_slots, CAST(coalesce(tr.tc, 0) AS BIGINT) AS true_count,
             CAST(coalesce(es.est, 0) AS BIGINT) AS est_count
  FROM tg g CROSS JOIN wins w
  LEFT JOIN tr ON tr.item = g.item AND tr.window_slots = w.window_slots
  LEFT JOIN d_es es ON es.item = g.item AND es.window_slots = w.window_slots)
SELECT item, window_slots, true_count, est_count, CAST(abs(est_count - true_count) AS BIGINT) AS abs_error,
       round(CASE WHEN true_count > 0 THEN abs(est_count - true_count) / true_count ELSE {D(0)} END, {R})
         AS rel_error FROM x"""
    q["bucket_burst_estimates"] = f"""WITH {base()},{points_cte()},{bucket_ctes('tg', [P.WIDTH])},
x AS (SELECT p.point AS bucket, g.item, CAST(coalesce(t.recent, 0) AS BIGINT) AS true_recent,
        CAST(coalesce(t.history, 0) AS BIGINT) AS true_history,
        CAST(coalesce(e.recent, 0) AS BIGINT) AS est_recent, CAST(coalesce(e.history, 0) AS BIGINT) AS est_history
  FROM tg g CROSS JOIN pts p
  LEFT JOIN b_tr t ON t.item = g.item AND t.point = p.point
  LEFT JOIN b_es e ON e.item = g.item AND e.point = p.point),
y AS (SELECT *, {burst('true_recent', 'true_history', rb, hb)} AS tb,
        {burst('est_recent', 'est_history', rb, hb)} AS eb FROM x)
SELECT bucket, item, true_recent, true_history, est_recent, est_history, round(tb, {R}) AS true_burst,
  round(eb, {R}) AS est_burst, round(abs(eb - tb), {R}) AS abs_error,
  round(CASE WHEN tb > 0 THEN abs(eb - tb) / tb ELSE {D(0)} END, {R}) AS rel_error FROM y"""
    q["decay_sketch_estimates"] = f"""WITH {base()},
it AS (SELECT DISTINCT item FROM ev),{decay_ctes('it', [P.WIDTH])}
SELECT t.item, round(t.true_decayed, {R}) AS true_decayed, round(e.est_decayed, {R}) AS est_decayed
FROM a_tr t JOIN a_es e ON t.item = e.item"""
    q["accuracy_metrics"] = f"""WITH {_wa_select()}
SELECT {metric_aggs()}, CAST(hz.maxw * {P.WIDTH} * {P.DEPTH} AS DOUBLE) AS total_counters,
  CAST(hz.maxw * {P.WIDTH} * {P.DEPTH} AS DOUBLE) * {D(4)} AS estimated_bytes
FROM wa, hz GROUP BY hz.maxw"""
    q["active_inactive"] = f"""WITH {_rwe_select()},
m AS (SELECT {metric_aggs()} FROM rwe)
SELECT num_queries, mae_active, rmse_active, mean_relative_error_active, weighted_relative_l1_active,
       false_positive_rate, avg_false_positive_estimate, max_false_positive_estimate FROM m"""
    nb = P.HIST_BINS
    q["error_histogram"] = f"""WITH {_wa_select()},
mm AS (SELECT min(rel_error) AS mn, max(rel_error) AS mx FROM wa),
lh AS (SELECT CASE WHEN mx > mn THEN mn ELSE mn - {D(0.5)} END AS lo,
              CASE WHEN mx > mn THEN mx ELSE mx + {D(0.5)} END AS hi FROM mm WHERE mn IS NOT NULL),
b AS (SELECT CAST(least(floor((wa.rel_error - lh.lo) / (lh.hi - lh.lo) * {nb}), {nb - 1}) AS BIGINT) AS bin,
             count(*) AS n FROM wa, lh WHERE wa.rel_error IS NOT NULL GROUP BY ALL),
sp AS (SELECT CAST(range AS BIGINT) AS bin FROM range(0, {nb}))
SELECT sp.bin, round(lh.lo + (lh.hi - lh.lo) * sp.bin / {nb}, {R}) AS bin_lo,
       round(lh.lo + (lh.hi - lh.lo) * (sp.bin + 1) / {nb}, {R}) AS bin_hi,
       CAST(coalesce(b.n, 0) AS BIGINT) AS n
FROM sp CROSS JOIN lh LEFT JOIN b ON b.bin = sp.bin"""
    wins = [4 ** i for i in range(16) if 4 ** i <= P.EVAL_LAST_SLOTS]
    piv = ", ".join(f"max(CASE WHEN window_slots = {w} THEN rel_error END) AS w{w}" for w in wins)
    q["error_matrix"] = f"""WITH {_wa_select()}
SELECT item, {piv} FROM wa GROUP BY item"""
    q["errors_sorted"] = f"""WITH {_wa_select()}
SELECT CAST(row_number() OVER (ORDER BY rel_error, item, window_slots) AS BIGINT) AS pos, item,
       window_slots, rel_error FROM wa"""
    ws = list(P.SWEEP_WIDTHS)
    q["width_sweep"] = f"""WITH {base()},{ring_ctes('tg', ws)},{truth_cte('tg')},
q AS (SELECT ww.width, g.item, w.window_slots, coalesce(tr.tc, 0) AS true_count, coalesce(es.est, 0) AS est_count
  FROM tg g CROSS JOIN wins w CROSS JOIN r_w ww
  LEFT JOIN tr ON tr.item = g.item AND tr.window_slots = w.window_slots
  LEFT JOIN r_es es ON es.width = ww.width AND es.item = g.item AND es.window_slots = w.window_slots),
m AS (SELECT width, {metric_aggs()} FROM q GROUP BY width)
SELECT m.width, CAST({P.DEPTH} AS BIGINT) AS depth, num_queries, mae, rmse, mean_relative_error,
  weighted_relative_l1, CAST(hz.maxw * m.width * {P.DEPTH} AS DOUBLE) AS total_counters,
  CAST(hz.maxw * m.width * {P.DEPTH} AS DOUBLE) * {D(4)} AS estimated_bytes,
  row_number() OVER (ORDER BY weighted_relative_l1, m.width) = 1 AS is_best
FROM m, hz"""
    rank_case = "CASE model WHEN 'ring' THEN 0 WHEN 'dyadic' THEN 1 WHEN 'bucket' THEN 2 ELSE 3 END"
    q["model_comparison"] = f"""WITH {_model_rows(ws)}
SELECT model, width, depth, num_queries, mae, rmse, mean_relative_error, weighted_relative_l1,
  round(total_counters, {R}) AS total_counters, round(estimated_bytes, {R}) AS estimated_bytes,
  CAST({rank_case} AS BIGINT) AS model_rank FROM mr"""
    q["error_vs_memory"] = f"""WITH {_model_rows(ws)},
p AS (SELECT quantile_cont(estimated_bytes, 0.9) AS p90 FROM mr)
SELECT model, width, round(estimated_bytes, {R}) AS estimated_bytes, weighted_relative_l1,
       round(p.p90, {R}) AS bytes_p90
FROM mr, p WHERE estimated_bytes <= p.p90"""
    q["depth_sweep"] = " UNION ALL ".join(f"""SELECT * FROM (WITH {_model_rows(ws[:2], depth)}
SELECT model, width, depth, num_queries, mae, rmse, mean_relative_error, weighted_relative_l1,
  round(total_counters, {R}) AS total_counters, round(estimated_bytes, {R}) AS estimated_bytes FROM mr)"""
                                          for depth in P.SWEEP_DEPTHS)
    q["last_active_buckets"] = f"""SELECT item, bucket, true_recent, true_history, true_burst, est_burst
FROM ({q["bucket_burst_estimates"]}) WHERE true_recent > 0
QUALIFY row_number() OVER (PARTITION BY item ORDER BY bucket DESC) = 1"""

    def frame(col: str, a: str, b: str) -> str:
        return (f"CAST(coalesce(sum({col}) OVER (PARTITION BY item ORDER BY slot ROWS BETWEEN {a} AND {b}), 0) AS BIGINT)")

    series = []
    for name in ("true", "est"):
        c = f"{name}_"
        series.append(f"{frame(c, f'{P.SLIDING_SLOTS - 1} PRECEDING', 'CURRENT ROW')} AS {name}_sliding")
        rc, hc = frame(c, f"{r - 1} PRECEDING", "CURRENT ROW"), frame(c, f"{r + h - 1} PRECEDING", f"{r} PRECEDING")
        series.append(f"round(CASE WHEN slot < hs + {r} THEN {D(0)} ELSE {burst(rc, hc, r, h)} END, {R}) AS {name}_burst")
    q["ring_series"] = f"""WITH {base()},{ring_ctes('tg', [P.WIDTH])},
sp AS (SELECT g.item, CAST(unnest(generate_series(hz.hs, hz.T)) AS BIGINT) AS slot, hz.hs FROM tg g, hz),
d AS (SELECT sp.item, sp.slot, sp.hs, coalesce(c.cnt, 0) AS true_, coalesce(e.est, 0) AS est_
  FROM sp LEFT JOIN r_c c ON c.item = sp.item AND c.slot = sp.slot
  LEFT JOIN r_ps e ON e.item = sp.item AND e.slot = sp.slot)
SELECT item, slot, {', '.join(series)} FROM d"""
    q["decay_grid_estimates"] = f"""WITH {base()},
gp AS (SELECT T + 1 AS span, least({P.NUM_EVAL_POINTS}, T + 1) AS num, T FROM hz),
pts AS (SELECT CAST(unnest(list_distinct(list_concat(generate_series(0, T,
          greatest(1, CAST(floor(span / num) AS BIGINT))), [T]))) AS BIGINT) AS t FROM gp),
c AS (SELECT item, slot, count(*) AS cnt FROM ev GROUP BY ALL),
wt AS (SELECT c.item, p.t, sum(c.cnt * exp({D(lam)} * (c.slot - p.t))) AS wt FROM c, pts p WHERE p.t >= c.slot GROUP BY ALL),
cells AS (SELECT x.t, k.r AS row, {sha_idx('x.item', 'k.r', P.DECAY_SEED, str(P.WIDTH))} AS col, sum(x.wt) AS wt
  FROM wt x, range(0, {P.DEPTH}) k(r) GROUP BY ALL),
pr AS (SELECT g.item, k.r AS row, {sha_idx('g.item', 'k.r', P.DECAY_SEED, str(P.WIDTH))} AS col FROM tg g, range(0, {P.DEPTH}) k(r)),
es AS (SELECT pr.item, c.t, CASE WHEN count(*) = {P.DEPTH} THEN min(c.wt) ELSE 0 END AS est
  FROM pr JOIN cells c ON c.row = pr.row AND c.col = pr.col GROUP BY ALL),
x AS (SELECT g.item, p.t, coalesce(w.wt, {D(0)}) AS a, CAST(coalesce(e.est, 0) AS DOUBLE) AS b FROM tg g CROSS JOIN pts p
  LEFT JOIN wt w ON w.item = g.item AND w.t = p.t LEFT JOIN es e ON e.item = g.item AND e.t = p.t)
SELECT item, t, round(a, {R}) AS true_decayed, round(b, {R}) AS est_decayed,
  round(CASE WHEN a > 0 THEN abs(b - a) / a ELSE {D(0)} END, {R}) AS rel_error FROM x"""
    for name, source, point in (("time_error_matrix", "decay_grid_estimates", "t"),
                                ("bucket_error_matrix", "bucket_burst_estimates", "bucket")):
        places = ", ".join(f"max(CASE WHEN place = {k} THEN rel_error END) AS p{k}" for k in range(P.NUM_EVAL_POINTS + 2))
        q[name] = f"""SELECT item, {places} FROM (SELECT item, rel_error,
  dense_rank() OVER (PARTITION BY item ORDER BY {point}) - 1 AS place FROM ({q[source]})) GROUP BY item"""
    q["dyadic_memory"] = f"""WITH {base()},{dyadic_ctes('tg', [P.WIDTH])},
s AS (SELECT CAST(level AS BIGINT) AS level, CAST(count(*) AS BIGINT) AS stored_cells FROM d_cells GROUP BY level),
x AS (SELECT s.level, CAST(floor(hz.T / pow({D(2)}, s.level)) AS BIGINT) + 1 AS segments,
  CAST(greatest({P.WIDTH} >> s.level, {P.DYADIC_MIN_WIDTH}) AS BIGINT) AS width, stored_cells FROM s, hz)
SELECT level, segments, width, CAST(segments * width * {P.DEPTH} AS BIGINT) AS total_counters,
  CAST(segments * width * {P.DEPTH} * 4 AS BIGINT) AS estimated_bytes, stored_cells FROM x"""
    return q
