"""DuckDB twins of the near-duplicate URL jobs."""

from __future__ import annotations

from .. import params
from ..functions.hashing import minhash_family
from .events_sql import D

P = params
R = params.ROUND_DIGITS
PR = params.MINHASH_PRIME


def base(n_hashes: int) -> str:
    coef = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(minhash_family(n_hashes)))
    return f"""
u AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL),
sh AS (SELECT url, CASE WHEN length(lower(url)) < 3 THEN [lower(url)] ELSE
         list_distinct(list_transform(range(1, length(lower(url)) - 1), lambda i: substr(lower(url), i, 3)))
       END AS sh FROM u),
hx AS (SELECT url, CAST(CAST(('0x' || substr(md5(s), 1, 16))::UBIGINT AS HUGEINT) % {PR} AS BIGINT) AS h
       FROM (SELECT url, unnest(sh) AS s FROM sh)),
coef AS (SELECT * FROM (VALUES {coef}) v(i, a, b)),
mh AS (SELECT hx.url, CAST(coef.i AS BIGINT) AS i,
              min(CAST((CAST(coef.a AS HUGEINT) * hx.h + coef.b) % {PR} AS BIGINT)) AS v
       FROM hx, coef GROUP BY ALL),
sig AS (SELECT url, list(v ORDER BY i) AS sig FROM mh GROUP BY url),
q AS (SELECT url AS query FROM u ORDER BY md5('{P.LSH_QUERY_SEED}:' || url), url LIMIT {P.LSH_NUM_QUERIES})"""


def bucket_expr(tbl: str, sig: str, K: str) -> str:
    return (f"CAST(('0x' || substr(md5(CAST({tbl} AS VARCHAR) || ':' || "
            f"array_to_string({sig}[{tbl} * {K} + 1 : {tbl} * {K} + {K}], ',')), 1, 15))::UBIGINT AS BIGINT)")


def lsh_ctes(K: int = P.LSH_K, L: int = P.LSH_L) -> str:
    return f"""
bk AS (SELECT s.url, CAST(t.tbl AS BIGINT) AS tbl, {bucket_expr('t.tbl', 's.sig', str(K))} AS bucket
       FROM sig s, range(0, {L}) t(tbl)),
qb AS (SELECT bk.url AS query, tbl, bucket FROM bk JOIN q ON bk.url = q.query),
cand AS (SELECT DISTINCT qb.query, bk.url AS candidate FROM bk JOIN qb ON bk.tbl = qb.tbl AND bk.bucket = qb.bucket
         WHERE bk.url <> qb.query),
sc AS (SELECT c.query, c.candidate,
         len(list_intersect(a.sh, b.sh)) / (len(a.sh) + len(b.sh) - len(list_intersect(a.sh, b.sh))) AS jaccard
       FROM cand c JOIN sh a ON a.url = c.query JOIN sh b ON b.url = c.candidate),
t10 AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY jaccard DESC, candidate)
                                      AS BIGINT) AS rank FROM sc) WHERE rank <= 10)"""


def bf_ctes() -> str:
    return """
ix AS (SELECT url, len(sh) AS nb, unnest(sh) AS s FROM sh),
qx AS (SELECT sh.url AS query, len(sh.sh) AS na, unnest(sh.sh) AS s FROM sh JOIN q ON sh.url = q.query),
ov AS (SELECT qx.query, ix.url AS candidate, count(*) AS inter, any_value(qx.na) AS na, any_value(ix.nb) AS nb
       FROM ix JOIN qx ON ix.s = qx.s GROUP BY qx.query, ix.url),
bf AS (SELECT query, candidate, inter / (na + nb - inter) AS jaccard FROM ov WHERE candidate <> query),
bf10 AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY jaccard DESC, candidate)
                                       AS BIGINT) AS rank FROM bf) WHERE rank <= 10)"""


def oracle() -> dict[str, str]:
    K, L = P.LSH_K, P.LSH_L
    q: dict[str, str] = {}
    q["url_shingles"] = f"""WITH {base(1)}
SELECT url, unnest(sh) AS shingle FROM sh"""
    q["minhash_signatures"] = f"""WITH {base(K * L)}
SELECT url, i AS idx, v AS minhash FROM mh"""
    q["lsh_buckets"] = f"""WITH {base(K * L)},{lsh_ctes()}
SELECT url, tbl, bucket FROM bk"""
    q["lsh_candidates"] = f"""WITH {base(K * L)},{lsh_ctes()}
SELECT query, candidate FROM cand"""
    k, l = P.LSH_PRUNE_K, P.LSH_PRUNE_L
    sizes = ", ".join(f"({b})" for b in P.LSH_BUCKETS)
    q["lsh_pruned"] = f"""WITH {base(k * l)},
bb AS (SELECT CAST(B AS BIGINT) AS B FROM (VALUES {sizes}) v(B)),
ex AS (SELECT s.url, CAST(t.tbl AS BIGINT) AS tbl, {bucket_expr('t.tbl', 's.sig', str(k))} AS bucket FROM sig s, range(0, {l}) t(tbl)),
bk AS (SELECT url, tbl, B, CASE WHEN B > 0 THEN bucket % B ELSE bucket END AS bucket FROM ex, bb),
cand AS (SELECT DISTINCT x.B, x.url AS query, y.url AS candidate FROM bk x JOIN q ON x.url = q.query
         JOIN bk y ON x.B = y.B AND x.tbl = y.tbl AND x.bucket = y.bucket WHERE x.url <> y.url),
sc AS (SELECT c.B, len(list_intersect(a.sh, b.sh)) / (len(a.sh) + len(b.sh) - len(list_intersect(a.sh, b.sh))) AS jaccard
       FROM cand c JOIN sh a ON a.url = c.query JOIN sh b ON b.url = c.candidate),
g AS (SELECT B, count(*) AS n, avg(jaccard) AS mj FROM sc GROUP BY B),
tot AS (SELECT (SELECT count(*) FROM q) * ((SELECT count(*) FROM u) - 1) AS possible)
SELECT bb.B, CAST(coalesce(g.n, 0) AS BIGINT) AS n_pairs,
       round(CASE WHEN possible > 0 THEN coalesce(g.n, 0) / possible ELSE {D(0)} END, {R}) AS share,
       round(coalesce(g.mj, {D(0)}), {R}) AS mean_jaccard
FROM bb LEFT JOIN g ON g.B = bb.B, tot"""
    q["lsh_top10"] = f"""WITH {base(K * L)},{lsh_ctes()}
SELECT query, candidate, round(jaccard, {R}) AS jaccard, rank FROM t10"""
    q["jaccard_bruteforce"] = f"""WITH {base(1)},{bf_ctes()}
SELECT query, candidate, round(jaccard, {R}) AS jaccard, rank FROM bf10"""
    q["lsh_quality"] = f"""WITH {base(K * L)},{lsh_ctes()},{bf_ctes()},
x AS (SELECT CAST((SELECT count(*) FROM q) AS DOUBLE) AS n_queries,
             CAST((SELECT count(*) FROM sc) AS DOUBLE) AS n_pairs,
             coalesce((SELECT avg(jaccard) FROM sc), {D(0)}) AS mja,
             coalesce((SELECT avg(jaccard) FROM t10), {D(0)}) AS mjt,
             CAST((SELECT count(*) FROM t10 JOIN bf10 USING (query, candidate)) AS DOUBLE) AS hits,
             CAST((SELECT count(*) FROM bf10) AS DOUBLE) AS exact)
SELECT n_queries, round(n_pairs / n_queries, {R}) AS avg_candidates, round(mja, {R}) AS mean_jaccard_all,
       round(mjt, {R}) AS mean_jaccard_top10,
       round(CASE WHEN exact > 0 THEN hits / exact ELSE {D(0)} END, {R}) AS recall_at_10 FROM x"""
    nmax = max(P.LSH_TUNE_K) * max(P.LSH_TUNE_L)
    cfg = ", ".join(f"({k}, {l})" for k in P.LSH_TUNE_K for l in P.LSH_TUNE_L)
    q["lsh_tuning"] = f"""WITH {base(nmax)},
cfg AS (SELECT CAST(K AS BIGINT) AS K, CAST(L AS BIGINT) AS L FROM (VALUES {cfg}) v(K, L)),
bt AS (SELECT s.url, s.sig, c.K, c.L, CAST(unnest(range(0, c.L)) AS BIGINT) AS tbl FROM sig s, cfg c),
bk AS (SELECT url, K, L, tbl, {bucket_expr('tbl', 'sig', 'K')} AS bucket FROM bt),
qb AS (SELECT bk.* FROM bk JOIN q ON bk.url = q.query),
cand AS (SELECT DISTINCT bk.K, bk.L, qb.url AS query, bk.url AS candidate
         FROM bk JOIN qb ON bk.K = qb.K AND bk.L = qb.L AND bk.tbl = qb.tbl AND bk.bucket = qb.bucket
         WHERE bk.url <> qb.url),
sc AS (SELECT c.K, c.L, len(list_intersect(a.sh, b.sh)) / (len(a.sh) + len(b.sh) - len(list_intersect(a.sh, b.sh)))
         AS jaccard FROM cand c JOIN sh a ON a.url = c.query JOIN sh b ON b.url = c.candidate),
agg AS (SELECT K, L, avg(jaccard) AS mj, count(*) AS n FROM sc GROUP BY K, L)
SELECT cfg.K, cfg.L, round(coalesce(agg.mj, {D(0)}), {R}) AS mean_jaccard,
       CAST(coalesce(agg.n, 0) AS BIGINT) AS n_pairs
FROM cfg LEFT JOIN agg ON agg.K = cfg.K AND agg.L = cfg.L"""
    q["lsh_scurve"] = f"""WITH {base(K * L)},{lsh_ctes()},{bf_ctes()},
x AS (SELECT bf.jaccard, CASE WHEN c.query IS NULL THEN 0 ELSE 1 END AS hit
      FROM bf LEFT JOIN cand c ON c.query = bf.query AND c.candidate = bf.candidate)
SELECT CAST(least(floor(jaccard * 10), 9) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n_pairs,
       CAST(sum(hit) AS BIGINT) AS n_retrieved, round(sum(hit) / count(*), {R}) AS observed_rate,
       round(avg(1 - pow(1 - pow(jaccard, {D(K)}), {D(L)})), {R}) AS mean_predicted
FROM x GROUP BY ALL"""
    return q
