"""DuckDB twins of the membership and hash-quality jobs."""

from __future__ import annotations

import math

from .. import params
from ..functions.murmur import murmur_int_sql, murmur_sql
from .events_sql import D
from .membership import avalanche_coefficients

P = params
R = params.ROUND_DIGITS
LN2SQ = math.log(2) ** 2
LN2 = math.log(2)


def _size(n: str, p: float):
    m = f"CAST(ceil(-({n} * {D(math.log(p))}) / {D(LN2SQ)}) AS BIGINT)"
    k = f"CAST(ceil({m} / {n} * {D(LN2)}) AS BIGINT)"
    return m, k


def _pos(src: str, key: str, m: str, k: str, extra: str = "") -> str:
    """Positions of ``src`` keys: columns (extra..., key, i, pos)."""
    seed = P.BLOOM_SEED
    d = f"sha256('{seed}:' || CAST({key} AS VARCHAR))"
    h1 = f"CAST((('0x' || substr({d}, 1, 16))::UBIGINT % CAST({m} AS UBIGINT)) AS BIGINT)"
    half = f"CAST(greatest(1, ({m}) // 2) AS UBIGINT)"
    h2 = f"1 + 2 * CAST((('0x' || substr({d}, 17, 16))::UBIGINT % {half}) AS BIGINT)"
    return f"""(SELECT {extra} key, i, (h1 + i * h2) % m_ AS pos FROM (
      SELECT {extra} {key} AS key, {h1} AS h1, {h2} AS h2, {m} AS m_,
             CAST(unnest(range(0, {k})) AS BIGINT) AS i FROM {src}))"""


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    keys = """keys AS (SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_orderkey IS NOT NULL),
nk AS (SELECT count(*) AS n FROM keys)"""
    m, k = _size("(SELECT n FROM nk)", P.BLOOM_FP_TARGETS[0])
    q["bloom_positions"] = f"""WITH {keys}
SELECT DISTINCT pos FROM {_pos('keys', 'key', m, k)}"""
    q["bloom_membership"] = f"""WITH {keys},
ab AS (SELECT s.key FROM (SELECT key + (SELECT max(key) FROM keys) AS key FROM keys) s
       WHERE s.key NOT IN (SELECT key FROM keys)),
bits AS (SELECT DISTINCT pos FROM {_pos('keys', 'key', m, k)}),
pr AS (SELECT 'present' AS probe_set, key FROM keys UNION ALL SELECT 'absent', key FROM ab),
pp AS (SELECT pr.probe_set, p.key, p.pos FROM {_pos('pr', 'key', m, k)} p JOIN pr ON pr.key = p.key),
t AS (SELECT probe_set, key, count(b.pos) = count(*) AS present FROM pp LEFT JOIN bits b ON b.pos = pp.pos
      GROUP BY probe_set, key)
SELECT probe_set, CAST(count(*) AS BIGINT) AS n_probes, CAST(sum(CAST(present AS BIGINT)) AS BIGINT) AS n_positive,
       round(avg(CAST(present AS DOUBLE)), {R}) AS positive_rate FROM t GROUP BY probe_set"""
    cfgs = []
    for p in P.BLOOM_FP_TARGETS:
        mm, kk = _size("nk.n", p)
        cfgs.append(f"SELECT 'p={p}' AS cfg, {mm} AS m, {kk} AS k FROM nk")
    for j in range(4):
        mm = f"CAST(pow({D(2)}, CAST(ceil(log2(nk.n)) AS BIGINT) + {j}) AS BIGINT)"
        kk = f"greatest(1, CAST(floor({D(0.7)} * {mm} / nk.n) AS BIGINT))"
        cfgs.append(f"SELECT 'R=2^(log2N+{j})' AS cfg, {mm} AS m, {kk} AS k FROM nk")
    q["bloom_fp_sweep"] = f"""WITH keys AS (SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_orderkey IS NOT NULL),
nk AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM keys),
cfg AS ({' UNION ALL '.join(cfgs)}),
ab AS (SELECT s.key FROM (SELECT key + (SELECT max(key) FROM keys) AS key FROM keys) s
       WHERE s.key NOT IN (SELECT key FROM keys)),
kc AS (SELECT cfg.cfg, cfg.m, cfg.k, keys.key FROM cfg, keys),
ac AS (SELECT cfg.cfg, cfg.m, cfg.k, ab.key FROM cfg, ab),
bits AS (SELECT DISTINCT cfg, pos FROM {_pos('kc', 'key', 'm', 'k', 'cfg, m, k,')}),
pp AS {_pos('ac', 'key', 'm', 'k', 'cfg, m, k,')},
t AS (SELECT pp.cfg, pp.m, pp.k, pp.key, count(b.pos) = count(*) AS present
      FROM pp LEFT JOIN bits b ON b.cfg = pp.cfg AND b.pos = pp.pos GROUP BY ALL)
SELECT t.cfg, t.m, t.k, CAST(count(*) AS BIGINT) AS n_absent,
       round(pow(1 - exp(-CAST(t.k AS DOUBLE) * any_value(nk.n) / CAST(t.m AS DOUBLE)), CAST(t.k AS DOUBLE)), {R})
         AS theoretical_fp,
       round(avg(CAST(present AS DOUBLE)), {R}) AS observed_fp
FROM t, nk GROUP BY t.cfg, t.m, t.k"""
    mu, ku = _size("(SELECT n FROM nu)", P.BLOOM_FP_TARGETS[0])
    q["url_bloom"] = f"""WITH u AS (SELECT DISTINCT url AS key FROM pages WHERE url IS NOT NULL),
nu AS (SELECT count(*) AS n FROM u),
bits AS (SELECT DISTINCT pos FROM {_pos('u', 'key', mu, ku)}),
fk AS (SELECT 'fake' || md5(key) || '.com' AS key FROM u WHERE 'fake' || md5(key) || '.com' NOT IN (SELECT key FROM u)),
t AS (SELECT p.key, count(b.pos) = count(*) AS present FROM {_pos('fk', 'key', mu, ku)} p
      LEFT JOIN bits b ON b.pos = p.pos GROUP BY p.key)
SELECT CAST(count(*) AS BIGINT) AS n_absent, CAST(sum(CAST(present AS BIGINT)) AS BIGINT) AS n_false_positive,
       round(avg(CAST(present AS DOUBLE)), {R}) AS observed_fp FROM t"""
    a, b, c, d = avalanche_coefficients()
    pr, out = P.AVALANCHE_PRIME, 1 << P.AVALANCHE_OUTPUT_BITS

    def poly(x, cs):
        acc = str(cs[0])
        for cc in cs[1:]:
            acc = f"(({acc}) * {x} + {cc}) % {pr}"
        return f"(({acc}) % {out})"

    def md5h(x):
        return f"CAST((('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 16))::UBIGINT % {out}) AS BIGINT)"
    funcs = [("2-universal", [a, b]), ("3-universal", [a, b, c]), ("4-universal", [a, b, c, d])]
    sel = " UNION ALL ".join(
        [f"SELECT '{n}' AS func, j, xor({poly('x', cs)}, {poly('y', cs)}) AS ch FROM xj" for n, cs in funcs]
        + [f"SELECT 'md5' AS func, j, xor({md5h('x')}, {md5h('y')}) AS ch FROM xj"])
    q["avalanche_matrix"] = f"""WITH keys AS (SELECT ((k % {1 << P.AVALANCHE_INPUT_BITS}) + {1 << P.AVALANCHE_INPUT_BITS}) % {1 << P.AVALANCHE_INPUT_BITS} AS x
  FROM (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey IS NOT NULL)),
xj AS (SELECT x, CAST(t.j AS BIGINT) AS j, xor(x, CAST(1 AS BIGINT) << t.j) AS y
       FROM keys, range(0, {P.AVALANCHE_INPUT_BITS}) t(j)),
e AS ({sel})
SELECT func, j AS input_bit, CAST(o.i AS BIGINT) AS output_bit,
       round(avg(CAST((ch >> o.i) & 1 AS DOUBLE)), {R}) AS p
FROM e, range(0, {P.AVALANCHE_OUTPUT_BITS}) o(i) GROUP BY ALL"""
    q["murmur_bloom"] = f"""WITH {keys},
mk AS (SELECT {m} AS m, {k} AS k),
ab AS (SELECT s.key FROM (SELECT key + (SELECT max(key) FROM keys) AS key FROM keys) s
       WHERE s.key NOT IN (SELECT key FROM keys)),
pr AS (SELECT 'present' AS probe_set, key FROM keys UNION ALL SELECT 'absent', key FROM ab),
pi AS (SELECT probe_set, key, CAST(key AS VARCHAR) AS name, {P.BLOOM_SEED} + unnest(range(0, (SELECT k FROM mk))) AS seed FROM pr),
pp AS (SELECT probe_set, key, h % (SELECT m FROM mk) AS pos FROM {murmur_sql('pi', 'name', 'seed', 'h')}),
bits AS (SELECT DISTINCT pos FROM pp WHERE probe_set = 'present'),
t AS (SELECT probe_set, key, count(b.pos) = count(*) AS present FROM pp LEFT JOIN bits b ON b.pos = pp.pos GROUP BY probe_set, key)
SELECT probe_set, CAST(count(*) AS BIGINT) AS n_probes, CAST(sum(CAST(present AS BIGINT)) AS BIGINT) AS n_positive FROM t GROUP BY probe_set"""
    head = q["avalanche_matrix"].split("e AS (")[0]
    q["avalanche_murmur"] = f"""{head}hx AS {murmur_int_sql('xj', 'x', 'hx')}, hxy AS {murmur_int_sql('hx', 'y', 'hy')},
e AS (SELECT j, xor(hx, hy) & {out - 1} AS ch FROM hxy)
SELECT 'murmur3' AS func, j AS input_bit, CAST(o.i AS BIGINT) AS output_bit, round(avg(CAST((ch >> o.i) & 1 AS DOUBLE)), {R}) AS p
FROM e, range(0, {P.AVALANCHE_OUTPUT_BITS}) o(i) GROUP BY ALL"""
    return q
