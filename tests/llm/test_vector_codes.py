"""Product codes on metric trees against plain rounds of nearest entries."""

import hashlib
import math
import random

import numpy as np
import pytest

from freqscope.llm import metric_tree, vector_codes

SF_SMALL = "/root/testdata/sf0.001"


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector, label) -> sorted result rows, from the contract's text."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for _, v, _ in kept] for p in range(parts)]
    first = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: kept[k][:2])[:entries]
    books = [[cut[p][k] for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for x in cut[p]:
                members.setdefault(nearest(x, books[p])[1], []).append(x)
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e
                        for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], {}
    for r, (i, _, l) in enumerate(kept):
        near = [nearest(cut[p][r], books[p]) for p in range(parts)]
        e = sum(d for d, _ in near)
        total[l] = total.get(l, 0) + e
        out.append((i, "".join(f"{k:02x}" for _, k in near), e, l))
    return sorted(((i, c, e, total[l], digest) for i, c, e, l in out), key=str)


def test_tree_balls_hold_their_points():
    rng = np.random.default_rng(1)
    for n, d in ((1, 3), (40, 2), (900, 5), (700, 1)):
        points = rng.integers(-50, 50, (n, d)).astype(float)
        t = metric_tree.build(points, leaf=8)
        assert sorted(t.order.tolist()) == list(range(n)) and t.lo[-1] == 0 and t.hi[-1] == n
        for k in range(len(t.lo)):
            mine = points[t.order[t.lo[k]:t.hi[k]]]
            assert (t.sums[k] == mine.sum(axis=0)).all()
            assert (np.sqrt(((mine - t.centre[k]) ** 2).sum(axis=1)) <= t.radius[k] + 1e-9).all()
            if t.left[k] >= 0:
                assert (t.lo[k], t.hi[t.left[k]], t.hi[k]) == (t.lo[t.left[k]], t.lo[t.right[k]], t.hi[t.right[k]])


def test_assignment_equals_brute_force_with_ties():
    rng = np.random.default_rng(2)
    for n, d, k, span in ((500, 2, 20, 6), (2000, 4, 64, 30), (300, 3, 1, 5), (64, 2, 50, 1), (800, 16, 256, 400)):
        points = rng.integers(-span, span + 1, (n, d)).astype(float)
        entries = rng.integers(-span, span + 1, (k, d)).astype(float)
        t = metric_tree.build(points)
        want = np.argmin(metric_tree._squares(points, entries), axis=1)
        assert (metric_tree.codes(t, points, entries) == want).all()
        sums, count = metric_tree.entry_sums(t, points, entries)
        assert (count == np.bincount(want, minlength=k)).all()
        for e in range(k):
            assert (sums[e] == points[want == e].sum(axis=0)).all()


def test_owned_balls_save_comparisons():
    rng = np.random.default_rng(3)
    centres = rng.integers(-10_000, 10_000, (64, 4))
    points = (centres[rng.integers(0, 64, 6000)] + rng.integers(-20, 20, (6000, 4))).astype(float)
    t, stats = metric_tree.build(points), {}
    metric_tree.assign(t, points, centres.astype(float), stats)
    assert stats["tests"] < 0.1 * 6000 * 64


def test_query_on_all_vectors(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted((tuple(r) for r in vector_codes.op13_vector_codes(spark, SF_SMALL).collect()), key=str)
    assert got == plain(rows)


def edge_rows():
    rng = random.Random(4)
    rows = [(k % 300, [rng.choice((-0.5, 0.0, 0.25, 1.5)) for _ in range(8)], rng.choice((None, 1, 2))) for k in range(700)]
    return rows + [rows[5]] * 30 + [(900, None, 1), (901, [None] + [0.0] * 7, 1), (902, [math.nan] * 8, 2),
                                    (903, [math.inf] + [0.0] * 7, 3), (904, [-0.0001] * 8, None)]


def test_edge_rows_and_small_blocks(spark, tmp_path):
    rows = edge_rows()
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<float>, label int, code string, error int")
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    small = vector_codes.vector_codes(df.repartition(3), block=50)
    assert sorted((tuple(r) for r in small.collect()), key=str) == plain(rows)
    got = sorted((tuple(r) for r in vector_codes.op13_vector_codes(spark, str(tmp_path)).collect()), key=str)
    assert got == plain(rows)
    few = df.where("vec_id < 3 or vec_id > 890").select("vec_id", "embedding", "label")
    assert sorted((tuple(r) for r in vector_codes.vector_codes(few).collect()), key=str) == plain([tuple(r) for r in few.collect()])


def test_null_ids_other_lengths_and_empty_tables(spark):
    rows = [(None, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0, 2.0, 3.0, 5.0], None), (2, [0.5] * 4, 1), (3, [0.5] * 5, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in vector_codes.vector_codes(df).collect()), key=str)
    assert got == plain(rows[:3])
    assert vector_codes.vector_codes(df.where("vec_id is null")).count() == 2
    assert vector_codes.vector_codes(df.limit(0)).count() == 0
    large = spark.createDataFrame([(1, [1e12] * 4, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        vector_codes.vector_codes(large).collect()
