"""Requested intervals, exact ranks, bias-corrected reads and Murmur3 on hand-made rows."""

import random

from pyspark.sql import functions as F

from freqscope.functions import murmur
from freqscope.operators import intervals, ranks, sketch


def greedy(a, b, levels):
    """The left-to-right decomposition of [a, b]."""
    out = []
    while a <= b:
        level = min((b - a + 1).bit_length() - 1, levels - 1)
        while a % (1 << level):
            level -= 1
        out.append((level, a >> level))
        a += 1 << level
    return sorted(out)


def test_cover_equals_greedy_decomposition(spark):
    rng = random.Random(1)
    rows = [(f"i{k}", a, a + rng.randint(-2, 90)) for k in range(200) for a in [rng.randint(0, 100)]] + [("x", -5, 6), ("y", 3, 3)]
    got = {}
    df = spark.createDataFrame(rows, "item string, a long, b long")
    for r in intervals.dyadic_cover(df, 4).collect():
        got.setdefault(r["item"], []).append((r["level"], r["seg"]))
    for item, a, b in rows:
        assert sorted(got.get(item, [])) == greedy(max(a, 0), b, 4), (a, b)


def test_requests_with_nulls_repeats_and_empty_intervals(spark):
    counts = spark.createDataFrame([("a", s, s + 1) for s in range(60)] + [("b", 7, 5)], "item string, slot long, cnt long")
    asked = spark.createDataFrame([("a", 10, 20), ("a", 10, 20), ("a", 20, 10), ("a", -9, 3), ("b", 0, 100), ("c", 0, 9), (None, 0, 9),
                                   ("a", None, 5)], "item string, a long, b long")
    wide = 1 << 16
    out = intervals.answered(asked, true=intervals.requested_counts(counts, asked),
                             dyadic=intervals.requested_dyadic(counts, asked, width=wide, min_width=wide >> 3),
                             ring=intervals.requested_ring(counts, asked, F.lit(59).cast("long"), F.lit(1000).cast("long"), width=wide))
    rows = sorted((tuple(r) for r in out.collect()), key=str)
    want = {("a", 10, 20): sum(range(11, 22)), ("a", -9, 3): 10, ("b", 0, 100): 5}
    assert len(rows) == asked.count()
    for item, a, b, *counted in rows:
        assert counted == [want.get((item, a, b), 0)] * 3
    short = intervals.requested_ring(counts, asked, F.lit(59).cast("long"), F.lit(10).cast("long"), width=wide)
    assert short.count() == 0  # slots before the retention are gone


def nearest(values, p):
    values = sorted(values)
    return values[round(p / 100 * (len(values) - 1))]  # Python rounds half to even


def test_ranks_equal_a_sorted_list(spark, monkeypatch):
    monkeypatch.setattr(ranks, "BINS", 4)
    rng = random.Random(2)
    groups = {"ties": [rng.choice((0.0, 0.5, 2.0)) for _ in range(99)], "wide": [10 ** rng.uniform(-9, 9) for _ in range(200)],
              "one": [3.25], None: [rng.uniform(-1, 1) for _ in range(57)], "same": [7.0] * 40}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    percents = [0.0, 12.5, 50.0, 90.0, 100.0]
    got = {(r["g"], r["percent"]): (r["n"], r["v"]) for r in ranks.nearest_ranks(df, ["g"], "v", percents).collect()}
    assert got == {(g, p): (len(vs), nearest(vs, p)) for g, vs in groups.items() for p in percents}
    every = [v for vs in groups.values() for v in vs]
    got = {r["percent"]: r["v"] for r in ranks.nearest_ranks(df, [], "v", percents).collect()}
    assert got == {p: nearest(every, p) for p in percents}
    assert ranks.nearest_ranks(df.limit(0), ["g"], "v", percents).count() == 0


def test_mean_min_read(spark):
    cells = spark.createDataFrame([(0, 0, 10), (0, 1, 6), (1, 0, 12), (1, 2, 4)], "row long, col long, cnt long")
    probes = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("b", 0, 1), ("b", 1, 2), ("c", 0, 2), ("c", 1, 0), ("d", 0, 1), ("d", 1, 0)],
                                   "item string, row long, col long")
    got = {r["item"]: r["est"] for r in sketch.mean_min(probes, cells, ["row", "col"], ["item"], 4, 2).collect()}
    assert got == {"a": 10 - 6 / 3, "b": 4 - 12 / 3, "c": 0.0, "d": 6 - 10 / 3}
    one = sketch.mean_min(probes.where("item = 'a' and row = 0"), cells, ["row", "col"], ["item"], 1, 1).first()
    assert one["est"] == 10.0


def test_murmur_known_vectors(spark):
    # published results: (text, seed, hash)
    known = [("", 0, 0), ("", 1, 0x514E28B7), ("", 0xFFFFFFFF, 0x81F16F39), ("test", 0, 0xBA6BD213), ("test", 0x9747B28C, 0x704B81DC),
             ("Hello, world!", 0, 0xC0363E43), ("Hello, world!", 0x9747B28C, 0x24884CBA),
             ("The quick brown fox jumps over the lazy dog", 0x9747B28C, 0x2FA826CD)]
    df = spark.createDataFrame(known, "t string, s long, h long")
    for r in df.select("t", "h", murmur.murmur3_32(F.col("t"), F.col("s")).alias("got")).collect():
        assert r["got"] == r["h"], r
    four = spark.createDataFrame([("abcd", int.from_bytes(b"abcd", "little"))], "t string, x long")
    r = four.select(murmur.murmur3_32(F.col("t"), 5).alias("a"), murmur.murmur3_32_int(F.col("x"), 5).alias("b")).first()
    assert r["a"] == r["b"]


def test_murmur_arrays_equal_the_columns(spark):
    texts = ["", "a", "ab", "abc", "abcd", "12345678", "1234567890", "ü€", "x" * 37, None]
    seeds = [0, 42, 2 ** 32 - 1]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = df.select("t", murmur.murmur3_32_seeds(F.col("t"), seeds).alias("all"), murmur.murmur3_32_seeds(F.col("t"), seeds, 1000).alias("mod"),
                    F.array(*[murmur.murmur3_32(F.col("t"), s) for s in seeds]).alias("want")).collect()
    for r in got:
        if r["t"] is None:
            assert r["all"] is None and r["mod"] is None
        else:
            assert r["all"] == r["want"] and r["mod"] == [x % 1000 for x in r["want"]], r["t"]
    numbers = [0, 1, 2 ** 31 - 1, 2 ** 32 - 1, -5]
    df = spark.createDataFrame([(x,) for x in numbers], "x long").coalesce(1)
    want = [r[0] for r in df.select(murmur.murmur3_32_int(F.col("x"))).collect()]
    assert murmur.murmur3_ints(numbers).tolist() == want
