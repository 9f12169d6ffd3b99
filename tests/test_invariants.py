"""Sketch invariants on the test tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_MID
from freqscope.plans import events, membership, tokens


def test_count_min_never_underestimates(spark):
    rows = events.ring_window_estimates(spark, SF_MID).collect()
    assert rows and all(r.est_count >= r.true_count for r in rows)
    d = events.dyadic_estimates(spark, SF_MID).collect()
    assert all(r.est_count >= r.true_count for r in d)


def test_merge_equals_whole(spark):
    a = {(r.row, r.col, r.cnt) for r in tokens.cm_merge(spark, SF_SMALL).collect()}
    b = {(r.row, r.col, r.cnt) for r in tokens.cm_cells(spark, SF_SMALL).collect()}
    assert a == b


def test_fold_equals_build_at_smaller_width(spark):
    from freqscope.functions.hashing import affine_family, affine_index, md5_u64
    from freqscope import params as P
    w = P.TOKEN_WIDTHS[0]
    folded = {(r.row, r.col, r.cnt) for r in tokens.cm_fold(spark, SF_SMALL).collect()}
    c = tokens.token_counts(spark, SF_SMALL)
    family = affine_family(f"cm/{w}", P.TOKEN_DEPTH, P.MERSENNE_61)
    x = md5_u64(F.col("token"))
    cols = F.array(*[F.pmod(affine_index(x, a, b, w), F.lit(w // 4)) for a, b in family])
    built = (c.select("cnt", F.posexplode(cols).alias("row", "col"))
             .groupBy("row", "col").agg(F.sum("cnt").alias("cnt")).collect())
    assert folded == {(r.row, r.col, r.cnt) for r in built}


def test_bloom_has_no_false_negatives(spark):
    rows = {r.probe_set: r for r in membership.bloom_membership(spark, SF_SMALL).collect()}
    assert rows["present"].positive_rate == 1.0
    assert rows["absent"].positive_rate < 0.05


def test_decay_sketch_upper_bounds_truth(spark):
    rows = events.decay_sketch_estimates(spark, SF_SMALL).collect()
    assert all(r.est_decayed >= r.true_decayed - 1e-6 for r in rows)


def test_sketch_families_are_independent():
    from freqscope.functions.hashing import affine_family
    from freqscope import params as P
    names = [f"{k}/1024" for k in ("cm", "cmedian", "csketch")] + ["csketch/1024/sign", "minhash"]
    pairs = [p for n in names for p in affine_family(n, 5, P.MERSENNE_61)]
    assert len(set(pairs)) == len(pairs)
    assert affine_family("cm/8", 9, P.MERSENNE_61)[:4] == affine_family("cm/8", 4, P.MERSENNE_61)


def test_bloom_positions_differ(spark):
    """With a power of two m and an odd step all k positions of a key differ."""
    from freqscope.operators import bloom
    keys = spark.range(200).withColumnRenamed("id", "key")
    pos = bloom.positions(keys, "key", F.lit(64).cast("bigint"), F.lit(9).cast("bigint"))
    assert pos.groupBy("key").agg(F.countDistinct("pos").alias("n")).where("n < 9").count() == 0


def test_urls_combine_before_the_shuffle(spark):
    from freqscope.sources.tables import distinct_urls
    plan = distinct_urls(spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2
