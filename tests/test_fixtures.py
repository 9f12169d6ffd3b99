"""Small cases from FIXTURES.md section 2."""

import datetime
import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from freqscope.functions.text import jaccard, shingles, tokenize
from freqscope.operators import bloom as B
from freqscope.operators import metrics as M
from freqscope.operators import windowed as WM
from freqscope.operators.sketch import _median_of
from freqscope.sources.tables import with_slots


def test_slots_from_offsets(spark):
    base = datetime.datetime(2024, 1, 1)
    rows = [(base + datetime.timedelta(seconds=s),) for s in (0, 59, 60, 119, 120)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r.slot for r in with_slots(df, "ts", 60).orderBy("ts").collect()]
    assert got == [0, 0, 1, 1, 2]


def test_timestamp_parse_lenient_and_strict(spark, tmp_path):
    from freqscope.sources.files import read_events_csv
    p = tmp_path / "ev.csv"
    p.write_text("timestamp,ngram\n2019-05-01T00:00:00Z,a\n2019-05-01T00:00:00,b\nnot-a-time,c\n")
    df = read_events_csv(spark, str(p), slot_seconds=60)
    rows = sorted((r.item, r.slot, r.ts) for r in df.collect())
    assert [r[0] for r in rows] == ["a", "b"]
    assert rows[0][2] == rows[1][2] and rows[0][1] == rows[1][1] == 0
    import pytest
    with pytest.raises(ValueError):
        read_events_csv(spark, str(p), slot_seconds=60, strict=True)


def test_slot_column_rebased(spark, tmp_path):
    from freqscope.sources.files import read_events_csv
    p = tmp_path / "slots.csv"
    p.write_text("slot,ngram\n5,a\n7,b\nx,c\n")
    got = sorted((r.item, r.slot) for r in read_events_csv(spark, str(p)).collect())
    assert got == [("a", 0), ("b", 2)]


def test_dyadic_decomposition(spark):
    def segs(a, b, levels=8):
        T = F.lit(b).cast("bigint")
        w = b - a + 1
        df = WM.dyadic_segments(T, [w], F.lit(w).cast("bigint"), levels)
        return sorted((r.level, r.seg) for r in df.collect())
    assert segs(0, 7) == [(3, 0)]
    assert segs(1, 6) == [(0, 1), (0, 6), (1, 1), (1, 2)]
    assert segs(3, 3) == [(0, 3)]


def test_burst_score(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([1, 1, 1, 1, 4, 4])], "slot long, cnt long")
    w = Window.orderBy("slot")
    r = df.select("slot", F.sum("cnt").over(w.rowsBetween(-1, 0)).alias("rec"),
                  F.sum("cnt").over(w.rowsBetween(-5, -2)).alias("his")).where("slot = 5").first()
    score = spark.range(1).select(WM.burst_score(F.lit(r.rec), F.lit(r.his), 2, 4)).first()[0]
    assert abs(score - (8 / 2) / (4 / 4 + 1e-9)) < 1e-9


def test_shingles_and_jaccard(spark):
    df = spark.createDataFrame([("ab",), ("abcd",), ("AAAA",), ("",)], "s string")
    got = [sorted(r[0]) for r in df.select(shingles(F.col("s"))).collect()]
    assert got == [["ab"], ["abc", "bcd"], ["aaa"], [""]]
    j = spark.range(1).select(
        jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("e"),
        jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))).alias("x")).first()
    assert j.e == 1.0 and abs(j.x - 1 / 3) < 1e-12


def test_percentile_nearest_rank(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("x"))
    r = df.agg(F.sort_array(F.collect_list("x")).alias("s"), F.count(F.lit(1)).alias("n")) \
        .select(M.nearest_rank(F.col("s"), F.col("n"), 50.0).alias("p50"),
                M.nearest_rank(F.col("s"), F.col("n"), 90.0).alias("p90")).first()
    assert (r.p50, r.p90) == (4.0, 8.0)


def test_metrics_small_case(spark):
    df = spark.createDataFrame([(0, 1), (2, 2), (4, 5)], "true_count long, est_count long")
    m = M.accuracy_metrics(df, []).first()
    assert abs(m.mae - 2 / 3) < 1e-6
    assert abs(m.weighted_relative_l1 - 2 / 6) < 1e-6
    assert m.false_positive_rate == 1.0
    assert abs(m.mean_relative_error - 0.25 / 3) < 1e-6


def test_count_median_even_depth(spark):
    r = spark.range(1).select(_median_of(F.array(F.lit(3), F.lit(4)), 2).alias("m"),
                              _median_of(F.array(F.lit(-4), F.lit(-3)), 2).alias("n")).first()
    assert r.m == 3 and r.n == -4


def test_bloom_sizing(spark):
    m, k = B.bloom_size(F.lit(10000), 0.01)
    r = spark.range(1).select(m.alias("m"), k.alias("k")).first()
    assert (r.m, r.k) == (95851, 7)


def test_tokenizer(spark):
    df = spark.createDataFrame([("Foo-bar 12, x_y",)], "s string")
    assert df.select(tokenize(F.col("s"))).first()[0] == ["foo", "bar", "12", "x", "y"]


def test_decay_lambda_zero_and_single_key(spark):
    rows = [(0, 1), (10, 2), (20, 3), (40, 4)]
    ev = spark.createDataFrame([("k", s, c) for s, c in rows], "item string, slot long, cnt long")
    for lam, expect in ((0.0, [1, 3, 6, 10, 10, 10]), (0.05, None)):
        got = []
        for T in (0, 10, 20, 40, 60, 100):
            d = WM.decayed_truth(ev, F.lit(T).cast("bigint"), lam).first()
            got.append(d.true_decayed)
        if expect is not None:
            assert got == expect
        else:
            want = [sum(c * math.exp(-lam * (T - s)) for s, c in rows if s <= T)
                    for T in (0, 10, 20, 40, 60, 100)]
            assert all(abs(a - b) < 1e-9 for a, b in zip(got, want))


def test_retention(spark):
    ev = spark.createDataFrame([("x", s, 1) for s in range(11)], "item string, slot long, cnt long")
    T = F.lit(10).cast("bigint")
    cells = WM.ring_cells(ev, T, F.lit(4).cast("bigint"), [64], depth=2)
    assert sorted({r.slot for r in cells.collect()}) == [7, 8, 9, 10]
