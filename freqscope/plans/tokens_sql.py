"""DuckDB twins of the query-log sketch jobs."""

from __future__ import annotations

from .. import params
from ..functions.hashing import affine_family
from .events_sql import D, sha_idx

P = params
R = params.ROUND_DIGITS

BASE = """
tk AS (SELECT unnest(regexp_extract_all(lower(text), '([a-z0-9]+)', 1)) AS token
       FROM documents WHERE text IS NOT NULL),
c AS (SELECT token, CAST(count(*) AS BIGINT) AS cnt FROM tk GROUP BY token),
cx AS (SELECT token, cnt, CAST(('0x' || substr(md5(token), 1, 16))::UBIGINT AS HUGEINT) AS x FROM c)"""


def pos_cte(width: int, kind: str) -> str:
    p = P.MERSENNE_61
    cols = affine_family(f"{kind}/{width}", P.TOKEN_DEPTH, p)
    signs = affine_family(f"{kind}/{width}/sign", P.TOKEN_DEPTH, p)
    vals = ", ".join(f"({i}, {a}, {b}, {c}, {d})" for i, ((a, b), (c, d)) in enumerate(zip(cols, signs)))
    sign = f"CASE WHEN ((CAST(co.c AS HUGEINT) * cx.x + co.d) % {p}) % 2 = 0 THEN 1 ELSE -1 END" \
        if kind == "csketch" else "1"
    return f"""
co_{kind}{width} AS (SELECT * FROM (VALUES {vals}) v(r, a, b, c, d)),
pos_{kind}{width} AS (SELECT cx.token, cx.cnt, CAST(co.r AS BIGINT) AS row,
    CAST(((CAST(co.a AS HUGEINT) * cx.x + co.b) % {p}) % {width} AS BIGINT) AS col, {sign} AS sign
  FROM cx, co_{kind}{width} co)"""


def cells_cte(width: int, kind: str) -> str:
    w = "cnt * sign" if kind == "csketch" else "cnt"
    return f"""
cells_{kind}{width} AS (SELECT row, col, CAST(sum({w}) AS BIGINT) AS cnt FROM pos_{kind}{width} GROUP BY row, col)"""


def est_cte(width: int, kind: str, probe: str = "c") -> str:
    val = "coalesce(ce.cnt, 0)" + (" * p.sign" if kind == "csketch" else "")
    agg = f"min({val})" if kind == "cm" else f"list_sort(list({val}))[{P.TOKEN_DEPTH // 2 + 1}]"
    return f"""
est_{kind}{width} AS (SELECT p.token, CAST({agg} AS BIGINT) AS est
  FROM pos_{kind}{width} p JOIN (SELECT DISTINCT token FROM {probe}) pr ON pr.token = p.token
  LEFT JOIN cells_{kind}{width} ce ON ce.row = p.row AND ce.col = p.col GROUP BY p.token)"""


def _one(width: int, kind: str, probe: str = "c") -> str:
    return pos_cte(width, kind) + "," + cells_cte(width, kind) + "," + est_cte(width, kind, probe)


def _sets() -> str:
    n = P.TOKEN_EVAL_SET_SIZE
    return f"""
sets AS (
  SELECT * FROM (SELECT 'frequent' AS set, token, cnt FROM c ORDER BY cnt DESC, token LIMIT {n})
  UNION ALL
  SELECT * FROM (SELECT 'random' AS set, token, cnt FROM c
                 ORDER BY md5('{P.TOKEN_SAMPLE_SEED}:' || token), token LIMIT {n})
  UNION ALL
  SELECT * FROM (SELECT 'infrequent' AS set, token, cnt FROM c ORDER BY cnt, token LIMIT {n}))"""


def oracle() -> dict[str, str]:
    w0 = P.TOKEN_WIDTHS[0]
    q: dict[str, str] = {}
    q["bottomk_tokens"] = f"""WITH {BASE}
SELECT CAST(row_number() OVER (ORDER BY cnt, token) AS BIGINT) AS rank, token, cnt
FROM (SELECT token, cnt FROM c ORDER BY cnt, token LIMIT {P.TOKEN_EVAL_SET_SIZE})"""
    q["token_hashes"] = f"""WITH {BASE},{pos_cte(w0, 'csketch')}
SELECT token, CAST(CAST(('0x' || substr(md5(token), 1, 16))::UBIGINT AS HUGEINT) AS VARCHAR) AS tok_id,
       row, col, CAST(sign AS BIGINT) AS sign, {sha_idx('token', 'row', P.RING_SEED, str(w0))} AS sha_col
FROM pos_csketch{w0}"""
    q["cm_cells"] = f"""WITH {BASE},{pos_cte(w0, 'cm')},{cells_cte(w0, 'cm')}
SELECT * FROM cells_cm{w0}"""
    for kind, name in (("cm", "cm_estimates"), ("cmedian", "cmedian_estimates"),
                       ("csketch", "csketch_estimates")):
        q[name] = f"""WITH {BASE},{_one(w0, kind)}
SELECT c.token, c.cnt AS true_cnt, e.est FROM c JOIN est_{kind}{w0} e ON e.token = c.token"""
    q["cm_merge"] = q["cm_cells"]
    q["cm_fold"] = f"""WITH {BASE},{pos_cte(w0, 'cm')},{cells_cte(w0, 'cm')}
SELECT row, col % {w0 // 4} AS col, CAST(sum(cnt) AS BIGINT) AS cnt FROM cells_cm{w0} GROUP BY ALL"""
    q["heavy_hitters"] = f"""WITH {BASE},{_one(w0, 'cm')},
e AS (SELECT c.token, c.cnt AS true_cnt, e.est FROM c JOIN est_cm{w0} e ON e.token = c.token
      ORDER BY e.est DESC, c.token LIMIT {P.TOKEN_TOP_TRACKED})
SELECT CAST(row_number() OVER (ORDER BY est DESC, token) AS BIGINT) AS rank, token, est, true_cnt FROM e"""
    parts, unions = [], []
    for width in P.TOKEN_WIDTHS:
        for kind in ("cm", "cmedian", "csketch"):
            parts.append(pos_cte(width, kind))
            parts.append(cells_cte(width, kind))
            parts.append(est_cte(width, kind))
            unions.append(f"""SELECT '{kind}' AS sketch, CAST({width} AS BIGINT) AS R,
  CAST((SELECT count(*) FROM (SELECT token FROM est_{kind}{width} ORDER BY est DESC, token
        LIMIT {P.TOKEN_TOP_TRACKED}) t JOIN t100 USING (token)) AS BIGINT) AS overlap""")
    q["topk_overlap"] = f"""WITH {BASE},
t100 AS (SELECT token FROM c ORDER BY cnt DESC, token LIMIT {P.TOKEN_TRUE_TOP}),{','.join(parts)}
{' UNION ALL '.join(unions)}"""
    parts, unions = [], []
    for width in P.TOKEN_WIDTHS:
        for kind in ("cm", "cmedian", "csketch"):
            parts.append(pos_cte(width, kind))
            parts.append(cells_cte(width, kind))
            parts.append(est_cte(width, kind, "sets"))
            unions.append(f"""SELECT s.set, CAST({width} AS BIGINT) AS R, '{kind}' AS sketch, s.token,
  s.cnt AS true_cnt, e.est FROM sets s JOIN est_{kind}{width} e ON e.token = s.token""")
    q["token_error_sets"] = f"""WITH {BASE},{_sets()},{','.join(parts)},
u AS ({' UNION ALL '.join(unions)})
SELECT *, round(CASE WHEN true_cnt > 0 THEN abs(est - true_cnt) / true_cnt ELSE {D(0)} END, {R}) AS rel_error,
  CAST(row_number() OVER (PARTITION BY set, R, sketch ORDER BY true_cnt DESC, token) AS BIGINT) AS rank
FROM u"""
    q["cmm_estimates"] = f"""WITH {BASE},{_one(w0, 'cm')},
rt AS (SELECT row, sum(cnt) AS total FROM cells_cm{w0} GROUP BY row),
mm AS (SELECT p.token, greatest(min(ce.cnt - (rt.total - ce.cnt) / {D(w0 - 1)}), {D(0)}) AS m
  FROM pos_cm{w0} p JOIN cells_cm{w0} ce USING (row, col) JOIN rt USING (row) GROUP BY p.token)
SELECT c.token, c.cnt AS true_cnt, e.est, round(mm.m, {R}) AS mean_min
FROM c JOIN est_cm{w0} e ON e.token = c.token JOIN mm ON mm.token = c.token"""
    q["frequent_tokens"] = f"""WITH {BASE}
SELECT token, cnt, TRUE AS bounded FROM c WHERE cnt * {P.TOKEN_TOP_TRACKED + 1} > (SELECT sum(cnt) FROM c)"""
    q["dictionary_stats"] = f"""WITH {BASE}
SELECT CAST(sum(cnt) AS BIGINT) AS total_tokens, CAST(count(*) AS BIGINT) AS unique_tokens,
       CAST(sum(strlen(token) + 8) AS BIGINT) AS dict_bytes FROM c"""
    return q
