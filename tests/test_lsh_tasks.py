"""What a task of the URL jobs keeps and counts."""

import random

import numpy as np
from pyspark.sql import functions as F

from freqscope.operators import lsh


def _urls(n, seed=1):
    rng = random.Random(seed)
    return [f"http://{rng.choice('abc')}.example.com/{rng.choice(['en', 'de'])}/{rng.randint(0, 99999)}" for _ in range(n)]


def test_a_task_keeps_few_urls_of_a_query(spark, monkeypatch):
    """Lists are cut while the task reads, also within one batch, and the nearest are the same."""
    longest, cut = [], lsh.heapq.nsmallest
    monkeypatch.setattr(lsh.heapq, "nsmallest", lambda n, x: longest.append(len(x)) or cut(n, x))
    frames = []

    class Whole:  # runs the task's function here
        def __init__(self, df):
            self.df = df

        def select(self, *c):
            return Whole(self.df.select(*c))

        def mapInArrow(self, run, schema):
            frames.extend(run(iter(self.df.toArrow().to_batches())))
            return self.df.sparkSession.createDataFrame([tuple(r.values()) for b in frames for r in b.to_pylist()], schema)

    sh = lsh.url_shingles(spark.createDataFrame([(u,) for u in sorted(set(_urls(500)))], "url string"))
    q = sh.orderBy("url").limit(3)
    got = {(r["query"], r["candidate"]) for r in lsh.nearest(Whole(sh), q, 5).collect()}
    assert max(longest) <= lsh.KEPT * 5
    lists = {r["url"]: set(r["sh"]) for r in sh.collect()}
    want = set()
    for query in [r["url"] for r in q.collect()]:
        near = sorted((-len(lists[query] & s) / len(lists[query] | s), u) for u, s in lists.items() if u != query)
        want |= {(query, u) for j, u in near[:5] if j < 0}
    assert got == want


def test_banding_sums_equal_pairs_counted_one_by_one(spark):
    grid = [(1, 3), (2, 2), (2, 4), (3, 2)]
    sig = lsh.signatures(lsh.url_shingles(spark.createDataFrame([(u,) for u in sorted(set(_urls(150, 2)))], "url string")), 8)
    rows = sig.collect()
    q = sig.orderBy("url").limit(20)
    got = {(r["K"], r["L"], r["bin"], r["overlaps"]): (r["a"], r["b"], round(r["c"], 6), round(r["d"], 6)) for r in
           lsh.banding_sums(sig, q, grid).groupBy("K", "L", "bin", "overlaps").agg(
               F.sum("n_pairs").alias("a"), F.sum("n_met").alias("b"), F.sum("sum_jaccard").alias("c"), F.sum("sum_predicted").alias("d")).collect()}
    want = {}
    for a in q.collect():
        for b in rows:
            if a["url"] != b["url"]:
                j = len(set(a["sh"]) & set(b["sh"])) / len(set(a["sh"]) | set(b["sh"]))
                for K, L in grid:
                    met = any(a["sig"][t * K:t * K + K] == b["sig"][t * K:t * K + K] for t in range(L))
                    key = (K, L, min(int(j * 10), 9), j > 0)
                    want[key] = np.add(want.get(key, (0, 0, 0.0, 0.0)), (1, met, j * met, 1 - (1 - j ** K) ** L))
    assert {k: (v[0], v[1], round(v[2], 6), round(v[3], 6)) for k, v in want.items()} == got


def test_values_are_compared_once_for_a_grid():
    rows = [{"url": "a", "sh": ["x"], "sig": [1, 2, 3, 4]}, {"url": "b", "sh": ["y"], "sig": [1, 9, 3, 4]}]
    met = lsh.QueryBlock(rows).bands_met(np.array([1, 9, 3, 5]), [(1, 1), (2, 1), (2, 2), (1, 4)])
    assert met.tolist() == [[True, True], [False, True], [False, True], [True, True]]
