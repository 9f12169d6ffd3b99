"""Membership and hash-quality jobs: Bloom filters over ``orders`` keys and
``pages`` URLs (G18, J9, G28, U4, E6, X15) and the avalanche matrix (G22, X8)."""

from __future__ import annotations

import math
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import params
from ..functions.murmur import murmur3_32_seeds, murmur3_ints
from ..operators import bloom as B
from ..session import cut_lineage
from ..sources.tables import read_table

P = params
R = params.ROUND_DIGITS


def _keys(spark: SparkSession, sf_dir: str):
    k = read_table(spark, sf_dir, "orders", ["o_orderkey"]).where(F.col("o_orderkey").isNotNull())
    return k.select(F.col("o_orderkey").alias("key")).distinct()


def _absent(keys):
    """U4: shifted keys (key + max key) are absent by construction; the anti
    join keeps that true for any key distribution."""
    mx = keys.select(F.max("key")).scalar()
    shifted = keys.select((F.col("key") + mx).alias("key"))
    return shifted.join(keys, "key", "left_anti")


def _sized(keys, fp_rates, budgets=0):
    """``[(name, m, k)]``, numbers in the driver: filters for target rates and, doubled ``budgets``
    times, bit budgets from the next power of two on.  A table without keys is sized for one."""
    n = F.lit(max(keys.count(), 1)).cast("double")
    sizes = [(f"p={p}", *B.bloom_size(n, p)) for p in fp_rates]
    for j in range(budgets):
        m = F.pow(F.lit(2.0), F.ceil(F.log2(n)).cast("bigint") + j).cast("bigint")
        k = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(0.7) * m / n).cast("bigint"))
        sizes.append((f"R=2^(log2N+{j})", m, k))
    row = keys.sparkSession.range(1).select(n.alias("n"), *[c.alias(f"{x}{i}") for i, (_, m, k) in enumerate(sizes)
                                                            for x, c in (("m", m), ("k", k))]).first()
    return row["n"], [(name, row[f"m{i}"], row[f"k{i}"]) for i, (name, _, _) in enumerate(sizes)]


def bloom_positions(spark, sf_dir):
    """The set bits of a filter over all order keys, sized for p = 0.01."""
    keys = _keys(spark, sf_dir)
    n = keys.select(F.count(F.lit(1))).scalar()
    m, k = B.bloom_size(n, P.BLOOM_FP_TARGETS[0])
    return B.build(keys, "key", m, k)


def bloom_membership(spark, sf_dir):
    """Every inserted key tests present (no false negatives); the
    observed false-positive rate on absent keys."""
    keys = cut_lineage(_keys(spark, sf_dir))
    _, [(_, size, k)] = _sized(keys, P.BLOOM_FP_TARGETS[:1])
    m, k = F.lit(size), F.lit(k)
    bits = B.words(keys, "key", m, k)
    probes = keys.select(F.lit("present").alias("probe_set"), "key") \
        .unionByName(_absent(keys).select(F.lit("absent").alias("probe_set"), "key"))
    res = B.probe(bits, cut_lineage(probes), "key", m, k, carry=["probe_set"], bits=[size])
    return res.groupBy("probe_set").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_probes"),
        F.sum(F.col("present").cast("bigint")).cast("bigint").alias("n_positive"),
        F.round(F.avg(F.col("present").cast("double")), R).alias("positive_rate"))


def bloom_fp_sweep(spark, sf_dir):
    """Filters sized from target rates (p = 1e-2, 1e-3, 1e-4) and
    from bit budgets R = 2^(ceil(log2 N) + j) with k = max(1, int(0.7 R/N)),
    all built and probed in one job (config id as a key column).  A key is hashed once for
    all sizes."""
    keys = cut_lineage(_keys(spark, sf_dir))
    n, cfgs = _sized(keys, P.BLOOM_FP_TARGETS, 4)
    cfg = F.array(*[F.struct(F.lit(c).alias("cfg"), F.lit(m).cast("bigint").alias("m"), F.lit(k).cast("bigint").alias("k"))
                    for c, m, k in cfgs])

    def every(some):
        return B.digests(some, "key").withColumn("c", F.explode(cfg)).select("c.cfg", "c.m", "c.k", "key", "digest_")

    bits = B.words(every(keys), "key", F.col("m"), F.col("k"), extra=["cfg", "m", "k"])
    # blocks of probes are read again from files if a task is repeated, so they stay the same blocks
    hit = B.probe(bits, every(cut_lineage(_absent(keys))), "key", F.col("m"), F.col("k"), extra=["cfg", "m", "k"],
                  bits=[m for _, m, _ in cfgs])
    out = hit.groupBy("cfg", "m", "k").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_absent"),
        F.avg(F.col("present").cast("double")).alias("observed_fp"))
    return out.select("cfg", "m", "k", "n_absent",
                      F.round(B.theoretical_fp(F.lit(n), F.col("m").cast("double"),
                                               F.col("k").cast("double")), R).alias("theoretical_fp"),
                      F.round("observed_fp", R).alias("observed_fp"))


def url_bloom(spark, sf_dir):
    """E6 on URLs: a filter over the distinct page URLs (p = 0.01) probed with
    ``fake{n}.com`` names that no URL equals."""
    from ..sources.tables import distinct_urls
    urls = cut_lineage(distinct_urls(spark, sf_dir).select(F.col("url").alias("key")))
    _, [(_, size, k)] = _sized(urls, P.BLOOM_FP_TARGETS[:1])
    m, k = F.lit(size), F.lit(k)
    bits = B.words(urls, "key", m, k)
    fake = urls.select(F.concat(F.lit("fake"), F.md5("key"), F.lit(".com")).alias("key")) \
        .join(urls, "key", "left_anti")
    res = B.probe(bits, cut_lineage(fake), "key", m, k, bits=[size])
    return res.agg(F.count(F.lit(1)).cast("bigint").alias("n_absent"),
                   F.sum(F.col("present").cast("bigint")).cast("bigint").alias("n_false_positive"),
                   F.round(F.avg(F.col("present").cast("double")), R).alias("observed_fp"))


# ---------------------------------------------------------------------------
# Avalanche matrix
# ---------------------------------------------------------------------------

def avalanche_coefficients():
    """Four coefficients in [1, P) from the legacy NumPy generator seeded 42."""
    rs = np.random.RandomState(P.AVALANCHE_COEFF_SEED)
    return [int(rs.randint(1, P.AVALANCHE_PRIME)) for _ in range(4)]


def _poly(x, coeffs):
    """X8 as ``poly_hash``, of an array."""
    p = P.AVALANCHE_PRIME
    acc = np.full(len(x), coeffs[0], np.int64)
    for c in coeffs[1:]:
        acc = (acc * x + c) % p
    return acc % (1 << P.AVALANCHE_OUTPUT_BITS)


def _md5(x):
    """``md5_u64`` of the decimal texts, mod 2^output bits (at most 16): the last of the eight bytes."""
    low = b"".join([md5(b"%d" % v).digest()[6:8] for v in x.tolist()])
    return np.frombuffer(low, ">u2").astype(np.int64) % (1 << P.AVALANCHE_OUTPUT_BITS)


def _hashes():
    a, b, c, d = avalanche_coefficients()
    return [("2-universal", lambda x: _poly(x, [a, b])), ("3-universal", lambda x: _poly(x, [a, b, c])),
            ("4-universal", lambda x: _poly(x, [a, b, c, d])), ("md5", _md5)]


def avalanche_matrix(spark, sf_dir):
    """P(output bit i flips | input bit j flips) over all order keys, folded
    into the input bits, for each hash function."""
    return _avalanche(_keys(spark, sf_dir), _hashes())


def _avalanche(keys, hashes):
    """``hashes``: ``(name, of an array of keys)``.  A key is hashed once, and once per flipped bit; a task counts the flips
    by (function, input bit, output bit) and sends these counts alone."""
    ib, ob = P.AVALANCHE_INPUT_BITS, P.AVALANCHE_OUTPUT_BITS
    schema = "f int, input_bit bigint, output_bit bigint, flips bigint, n bigint"
    bits = np.arange(1 << ob)[:, None] >> np.arange(ob) & 1

    def run(batches):
        flips, n = np.zeros((len(hashes), ib, ob), np.int64), 0
        for batch in batches:
            x = batch.column(0).to_numpy()
            n += len(x)
            for f, (_, h) in enumerate(hashes):
                hx = h(x)
                for j in range(ib):
                    flips[f, j] += np.bincount(hx ^ h(x ^ (1 << j)), minlength=1 << ob) @ bits
        if n:
            f, j, i = (v.ravel() for v in np.indices(flips.shape))
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), *[pa.array(v, pa.int64()) for v in (j, i, flips.ravel(), np.full(flips.size, n))]],
                                             names=["f", "input_bit", "output_bit", "flips", "n"])

    x = keys.select(F.pmod(F.col("key"), F.lit(1 << ib)).cast("bigint").alias("x"))
    g = x.mapInArrow(run, schema).groupBy("f", "input_bit", "output_bit").agg(F.sum("flips").alias("flips"), F.sum("n").alias("n"))
    names = F.array(*[F.lit(name) for name, _ in hashes])
    return g.select(F.get(names, F.col("f")).alias("func"), "input_bit", "output_bit", F.round(F.col("flips") / F.col("n"), R).alias("p"))


# ---------------------------------------------------------------------------
# Murmur3 (X9)
# ---------------------------------------------------------------------------

def murmur_bloom(spark, sf_dir):
    """A filter of k Murmur3 positions per key, seeds ``BLOOM_SEED + i``, sized
    for p = 0.01; all keys and as many absent ones are probed.  Keys are hashed in arrays under
    all seeds at once, and their positions travel packed."""
    keys = cut_lineage(_keys(spark, sf_dir))
    n = keys.select(F.count(F.lit(1))).scalar()
    m, k = B.bloom_size(n, P.BLOOM_FP_TARGETS[0])
    sized = keys.sparkSession.range(1).select(m.alias("m"), k.alias("k")).first()  # two numbers
    if not sized["m"]:
        return keys.select(F.lit("present").alias("probe_set"), *[F.lit(0).cast("bigint").alias(c) for c in ("n_probes", "n_positive")])
    seeds = [P.BLOOM_SEED + i for i in range(sized["k"])]
    absent = _absent(keys).select(F.lit("absent").alias("probe_set"), "key")
    # hashing again is cheaper than writing the positions
    probes = cut_lineage(keys.select(F.lit("present").alias("probe_set"), "key").unionByName(absent))
    probes = probes.select("probe_set", "key", murmur3_32_seeds(F.col("key"), seeds, sized["m"]).alias("at"))
    return B.probe_lists(B.words_of(probes.where("probe_set = 'present'"), "at"), probes, "at", ["probe_set", "key"]) \
        .groupBy("probe_set").agg(F.count("*").cast("bigint").alias("n_probes"),
                                  F.sum(F.col("present").cast("bigint")).cast("bigint").alias("n_positive"))


def avalanche_murmur(spark, sf_dir):
    """G22 for the seeded Murmur3 of 32-bit integers (seed 0), as ``avalanche_matrix``."""
    out = (1 << P.AVALANCHE_OUTPUT_BITS) - 1
    return _avalanche(_keys(spark, sf_dir), [("murmur3", lambda x: murmur3_ints(x).astype(np.int64) & out)])


JOBS = {n: globals()[n] for n in [
    "bloom_positions", "bloom_membership", "bloom_fp_sweep", "url_bloom", "avalanche_matrix", "murmur_bloom", "avalanche_murmur"]}
