"""MinHash signatures, banded LSH and exact Jaccard re-ranking
(X2, X10-X13, G19, G20, J6-J8, W9, G29, E7, X16)."""

from __future__ import annotations

import heapq
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.hashing import band_bucket, bounded_broadcast, minhash_family
from ..functions.text import jaccard, shingles
from .topn import top_n_per_group

P = params
#: a task cuts a query's list when it is this many times as long as asked
KEPT = 8
#: URLs whose pairs a task holds at once
STEP = 64


def url_shingles(urls: DataFrame) -> DataFrame:
    """``(url, sh)``: distinct 3-gram array per URL."""
    return urls.select("url", shingles(F.col("url")).alias("sh"))


def signature_of(shingle_list: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min over shingles of (a_i h + b_i) mod P.  h and a are below 2^33, so h is cut
    into 17 low bits and the rest and every product stays in 64 bits."""
    p = np.uint64(P.MINHASH_PRIME)
    h = np.array([int.from_bytes(md5(s.encode()).digest()[:8], "big") % P.MINHASH_PRIME for s in shingle_list],
                 dtype=np.uint64)[:, None]
    low = h & np.uint64((1 << 17) - 1)
    return (((a * (h >> np.uint64(17)) % p) << np.uint64(17)) + a * low + b).__mod__(p).min(axis=0).astype(np.int64)


def signatures(sh: DataFrame, n_hashes: int) -> DataFrame:
    """``(url, sh, sig)``; h = md5 base hash of a shingle reduced mod P.

    One vectorised pass: a URL's shingles and the coefficients make one matrix, and
    its column minima are the signature.  Nothing is shuffled."""
    pairs = np.array(minhash_family(n_hashes), dtype=np.uint64)

    def run(batches):
        for batch in batches:
            sig = [signature_of(s, pairs[:, 0], pairs[:, 1]) for s in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sig, pa.list_(pa.int64()))], names=["url", "sh", "sig"])

    return sh.select("url", "sh").mapInArrow(run, "url string, sh array<string>, sig array<long>")


def bands(sig: DataFrame, K: int, L: int, extra: list[str] | None = None, buckets: Column | None = None) -> DataFrame:
    """``(url, tbl, bucket)``; table t hashes sig[t*K : t*K+K], into ``buckets``
    buckets (D6) where that column is given and above 0."""
    extra = extra or []
    t = sig.select("url", "sig", *extra,
                   F.explode(F.sequence(F.lit(0), F.lit(L - 1))).alias("tbl"))
    band = F.slice(F.col("sig"), F.col("tbl") * K + 1, F.lit(K))
    return t.select("url", *extra, F.col("tbl").cast("bigint").alias("tbl"),
                    band_bucket(F.col("tbl"), band, buckets).alias("bucket"))


def sample_queries(urls: DataFrame, n: int = P.LSH_NUM_QUERIES, seed: int = P.LSH_QUERY_SEED) -> DataFrame:
    """A repeatable sample of n URLs (md5 order of a seeded key)."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("url")))
    return urls.orderBy(key, F.col("url")).limit(n).select(F.col("url").alias("query"))


def candidates(index: DataFrame, query_bands: DataFrame, keys: list[str] | None = None,
               tables: int = P.LSH_L, variants: int = 1) -> DataFrame:
    """Distinct (query, candidate) pairs sharing a bucket in any table,
    self excluded.  The query side (num_queries x L rows, a parameter bound)
    is broadcast, so the index is streamed and never shuffled for the probe; so it is
    with ``keys`` of at most ``variants`` values."""
    keys = keys or []
    qb = query_bands.select(*keys, F.col("url").alias("query"), "tbl", "bucket")
    j = index.join(bounded_broadcast(qb, P.LSH_NUM_QUERIES * tables * variants, P.URL_BYTES), [*keys, "tbl", "bucket"])
    return (j.where(F.col("url") != F.col("query"))
            .select(*keys, "query", F.col("url").alias("candidate")).distinct())


def with_jaccard(pairs: DataFrame, sh: DataFrame, queries_sh: DataFrame) -> DataFrame:
    """Exact Jaccard of each pair from the shingle arrays."""
    c = pairs.join(sh.select(F.col("url").alias("candidate"), F.col("sh").alias("c_sh")),
                   "candidate")
    c = c.join(bounded_broadcast(queries_sh.select(F.col("url").alias("query"), F.col("sh").alias("q_sh")),
                                 P.LSH_NUM_QUERIES, 30 * P.URL_BYTES), "query")
    return c.withColumn("jaccard", jaccard(F.col("q_sh"), F.col("c_sh"))).drop("c_sh", "q_sh")


def top10(scored: DataFrame, n: int = 10, keys: list[str] | None = None) -> DataFrame:
    """The n most similar candidates per query (ties by candidate)."""
    keys = keys or []
    return top_n_per_group(scored, [*keys, "query"],
                           [F.col("jaccard").desc(), F.col("candidate").asc()], n,
                           F.xxhash64("candidate"))


def query_groups(queries: DataFrame, limit: int = P.BROADCAST_BOUND_BYTES // 2) -> list[list]:
    """The query rows (num_queries of them, a parameter) in groups whose text and
    signatures stay below ``limit`` bytes: each group goes to the tasks with the code."""
    groups: list[list] = [[]]
    size = 0
    for row in queries.collect():
        n = 80 * len(row["sh"]) + len(row["url"]) + (40 * len(row["sig"]) if "sig" in row else 0)
        if groups[-1] and size + n > limit:
            groups.append([])
            size = 0
        groups[-1].append(row)
        size += n
    return groups


class QueryBlock:
    """A group of queries as an inverted shingle index and a signature matrix."""

    def __init__(self, rows: list) -> None:
        self.urls = [r["url"] for r in rows]
        self.size = np.array([len(r["sh"]) for r in rows], dtype=np.int64)
        #: a row per place of the signature, a column per query
        self.by_value = np.array([r["sig"] for r in rows], dtype=np.int64).T.copy() if rows and "sig" in rows[0] else None
        index: dict[str, list[int]] = {}
        for k, r in enumerate(rows):
            for s in r["sh"]:
                index.setdefault(s, []).append(k)
        self.index = {s: np.array(v) for s, v in index.items()}
        self.number = {u: k for k, u in enumerate(self.urls)}

    def jaccard(self, shingle_list: list[str]) -> np.ndarray:
        """X12 of one URL against every query."""
        met = [self.index[s] for s in shingle_list if s in self.index]
        inter = np.bincount(np.concatenate(met), minlength=len(self.urls)) if met else np.zeros(len(self.urls), np.int64)
        return inter / (self.size + len(shingle_list) - inter)

    def bands_met(self, sig: np.ndarray, grid: list[tuple[int, int]]) -> np.ndarray:
        """J6 of one URL, per (K, L): the queries that share a whole band with it.  Values are compared
        once; a K's bands are found once, for its largest L."""
        same = self.by_value == sig[:, None]
        most: dict[int, int] = {}
        for K, L in grid:
            most[K] = max(L, most.get(K, 0))
        whole = {}
        for K, L in most.items():
            whole[K] = same[0:K * L:K]
            for i in range(1, K):
                whole[K] = whole[K] & same[i:K * L:K]
        return np.array([whole[K][:L].any(axis=0) for K, L in grid])


def nearest(sh: DataFrame, queries_sh: DataFrame, n: int = 10) -> DataFrame:
    """Each query's ``n`` nearest URLs with positive Jaccard (self excluded), by
    comparison with all.  A task keeps ``n`` rows per query, so pairs never leave it."""
    out = None
    for rows in query_groups(queries_sh.select("url", "sh")):
        block = QueryBlock(rows)

        def run(batches, block=block):
            best: list[list] = [[] for _ in block.urls]
            for batch in batches:
                for url, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    j = block.jaccard(s)
                    for k in np.flatnonzero(j > 0).tolist():
                        if block.urls[k] != url:
                            best[k].append((-j[k], url))
                            if len(best[k]) >= KEPT * n:
                                best[k] = heapq.nsmallest(n, best[k])
            best = [heapq.nsmallest(n, x) for x in best]
            rows = [(block.urls[k], u, -j) for k, x in enumerate(best) for j, u in x]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))],
                names=["query", "candidate", "jaccard"])

        part = sh.select("url", "sh").mapInArrow(run, "query string, candidate string, jaccard double")
        out = part if out is None else out.unionByName(part)
    return top10(out, n)


def banding_sums(sig: DataFrame, queries_sig: DataFrame, grid: list[tuple[int, int]]) -> DataFrame:
    """Per task ``(K, L, bin, n_pairs, n_met, sum_jaccard, sum_predicted, overlaps)``
    of all query/URL pairs; bins are tenths of the Jaccard index, ``overlaps`` tells pairs
    with a common shingle.  Pairs are summed where they are made."""
    out = None
    schema = "K long, L long, bin long, n_pairs long, n_met long, sum_jaccard double, sum_predicted double, overlaps boolean"
    for rows in query_groups(queries_sig.select("url", "sh", "sig")):
        block = QueryBlock(rows)

        def run(batches, block=block):
            sums = np.zeros((len(grid), 2, 10, 4))

            def add(place, j, met):
                pairs = np.bincount(place, minlength=20)
                some = np.flatnonzero(j)  # the rest adds nothing to sums of the Jaccard index
                powers = {K: j[some] ** K for K in {K for K, _ in grid}}
                for c, (K, L) in enumerate(grid):
                    chance = 1 - (1 - powers[K]) ** L
                    values = (pairs, np.bincount(place[met[:, c]], minlength=20),
                              np.bincount(place[some], weights=j[some] * met[some, c], minlength=20),
                              np.bincount(place[some], weights=chance, minlength=20))
                    for v, w in enumerate(values):
                        sums[c, :, :, v] += w.reshape(2, 10)

            for batch in batches:
                if not batch.num_rows:
                    continue
                urls, lists = (batch.column(k).to_pylist() for k in range(2))
                sigs = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                for a in range(0, len(urls), STEP):
                    some = range(a, min(a + STEP, len(urls)))
                    use = np.ones((len(some), len(block.urls)), bool)
                    for i, at in enumerate(some):
                        if urls[at] in block.number:
                            use[i, block.number[urls[at]]] = False
                    j = np.array([block.jaccard(lists[at]) for at in some])[use]
                    met = np.array([block.bands_met(sigs[at], grid).T for at in some])[use]
                    add(np.minimum(np.floor(j * 10), 9).astype(int) + 10 * (j > 0), j, met)
            at = np.argwhere(sums[..., 0] > 0)
            v = sums[at[:, 0], at[:, 1], at[:, 2]]
            k, l = np.array(grid, dtype=np.int64).reshape(-1, 2)[at[:, 0]].T
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(l, pa.int64()), pa.array(at[:, 2], pa.int64()), pa.array(v[:, 0].astype(np.int64)),
                 pa.array(v[:, 1].astype(np.int64)), pa.array(v[:, 2]), pa.array(v[:, 3]), pa.array(at[:, 1] == 1)],
                names=["K", "L", "bin", "n_pairs", "n_met", "sum_jaccard", "sum_predicted", "overlaps"])

        part = sig.select("url", "sh", "sig").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def retrieval_probability(j: Column, K: int, L: int) -> Column:
    """1 - (1 - J^K)^L."""
    return 1 - F.pow(1 - F.pow(j, F.lit(float(K))), F.lit(float(L)))
