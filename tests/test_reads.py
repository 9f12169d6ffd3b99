"""Sketch reads by chunks and parts, against sketches and sums kept in Python."""

import random
from hashlib import sha256

from pyspark.sql import functions as F

from freqscope.operators import intervals, ranks, reads, windowed

WIDTH, DEPTH = 8, 3


def _col(item, row, width, seed=42):
    return int.from_bytes(sha256(f"{seed}-{row}-{item}".encode()).digest()[:8], "big") % width


def _counts():
    rng = random.Random(3)
    return {(f"i{k}", s): rng.randint(1, 9) for k in range(12) for s in rng.sample(range(100), 25)}


def _cells(counts, unit, width):
    """Cells of each (level, seg) or slot."""
    out = {}
    for (item, slot), n in counts.items():
        for at in unit(slot):
            for row in range(DEPTH):
                key = (at, row, _col(item, row, width(at)))
                out[key] = out.get(key, 0) + n
    return out


def _asked():
    rng = random.Random(4)
    return sorted({(f"i{rng.randint(0, 14)}", a, a + rng.randint(-1, 70)) for _ in range(80) for a in [rng.randint(-5, 99)]})


def _small(monkeypatch):
    monkeypatch.setattr(reads, "PART", 20)
    monkeypatch.setattr(reads, "CHUNK_SLOTS", 16)
    monkeypatch.setattr(reads, "STEP", 7)


def test_ring_and_dyadic_requests_over_chunks_and_parts(spark, monkeypatch):
    _small(monkeypatch)
    counts, asked = _counts(), _asked()
    df = spark.createDataFrame([(i, s, n) for (i, s), n in counts.items()], "item string, slot long, cnt long")
    rq = spark.createDataFrame(asked, "item string, a long, b long")
    T, buffer = 99, 80
    ring = _cells({k: n for k, n in counts.items() if k[1] > T - buffer}, lambda s: [s], lambda at: WIDTH)
    want = {}
    for item, a, b in asked:
        want[item, a, b] = sum(min(ring.get((s, r, _col(item, r, WIDTH)), 0) for r in range(DEPTH)) for s in range(max(a, 0), min(b, T) + 1))
    out = intervals.requested_ring(df, rq, F.lit(T).cast("long"), F.lit(buffer).cast("long"), WIDTH, DEPTH)
    assert {(r["item"], r["a"], r["b"]): r["est"] for r in out.collect()} == {k: v for k, v in want.items() if v}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()  # no row per request and slot

    levels, least = 3, 4
    width = lambda at: max(WIDTH >> at[0], least)
    dyadic = _cells(counts, lambda s: [(level, s >> level) for level in range(levels)], width)
    want = {}
    for item, a, b in asked:
        at, total = max(a, 0), 0
        while at <= b:
            level = max(x for x in range(levels) if at % (1 << x) == 0 and at + (1 << x) - 1 <= b)
            unit = (level, at >> level)
            total += min(dyadic.get((unit, r, _col(item, r, width(unit))), 0) for r in range(DEPTH))
            at += 1 << level
        want[item, a, b] = total
    out = intervals.requested_dyadic(df, rq, WIDTH, levels, least, DEPTH)
    assert {(r["item"], r["a"], r["b"]): r["est"] for r in out.collect()} == {k: v for k, v in want.items() if v}


def test_windows_of_every_item(spark, monkeypatch):
    _small(monkeypatch)
    counts, T, windows = _counts(), 99, [1, 4, 16, 64]
    df = spark.createDataFrame([(i, s, n) for (i, s), n in counts.items()], "item string, slot long, cnt long")
    items = df.select("item").distinct()
    got = {}
    for w in (8, 16):
        ring = _cells(counts, lambda s: [s], lambda at: w)
        for (item, _), _ in counts.items():
            for length in windows:
                got[w, item, length] = sum(min(ring.get((s, r, _col(item, r, w)), 0) for r in range(DEPTH)) for s in range(T - length + 1, T + 1))
    long = lambda x: F.lit(x).cast("long")
    out = windowed.ring_estimates(df, items, long(T), windows, long(64), [8, 16], DEPTH)
    assert {(r["width"], r["item"], r["window_slots"]): r["est_count"] for r in out.collect()} == got


def test_rounds_of_ranks_move_no_values(spark, monkeypatch):
    """The open ranges are broadcast, so no round shuffles the values."""
    joins, plain = [], F.broadcast
    monkeypatch.setattr(ranks.F, "broadcast", lambda df: joins.append(df) or plain(df))
    df = spark.createDataFrame([(k % 3, float(k * k % 101)) for k in range(300)], "g long, v double")
    got = {(r["g"], r["percent"]): r["v"] for r in ranks.nearest_ranks(df, ["g"], "v", [0.0, 50.0, 100.0]).collect()}
    for g in range(3):
        values = sorted(float(k * k % 101) for k in range(300) if k % 3 == g)
        assert [got[g, p] for p in (0.0, 50.0, 100.0)] == [values[0], values[round(0.5 * 99)], values[-1]]
    assert joins
