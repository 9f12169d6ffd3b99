"""Top-k search: trees against their invariants, results against brute force."""

import duckdb
import numpy as np

from freqscope.llm import covertree as ct

SF_SMALL = "/root/testdata/sf0.001"


def clustered(rng, n, d):
    centres = rng.normal(size=(12, d)) * 40
    return np.floor(centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * 3)


def test_tree_covers_its_points():
    rng = np.random.default_rng(1)
    x = clustered(rng, 2000, 6)
    x[100:500] = x[7]
    tree = ct.Tree(x, leaf=16)
    rows = []
    todo = [(tree.root, [])]
    while todo:
        node, above = todo.pop()
        above = [*above, node]
        todo += [(c, above) for c in tree.children[node]]
        if len(tree.rows[node]):
            rows += tree.rows[node].tolist()
            for a in above:
                away = np.sqrt(((x[tree.rows[node]] - tree.centre[a]) ** 2).sum(axis=1))
                assert (away <= tree.radius[a] + 1e-6).all()
    assert sorted(rows) == list(range(2000))


def test_dual_search_prunes_and_is_exact():
    rng = np.random.default_rng(2)
    p, q = clustered(rng, 3000, 4), clustered(rng, 300, 4)
    best = ct.Best(len(q), 9)
    products = ct.dual_search(ct.Tree(q, 32), ct.Tree(p, 32), best)
    score = q @ p.T
    order = np.argsort(-score, axis=1, kind="stable")[:, :9]
    assert (best.row == order).all() and (best.score == np.take_along_axis(score, order, 1)).all()
    assert products < 0.5 * score.size


def brute(rows, k=20, every=20):
    good = [(i, np.floor(64 * np.array(v, dtype=np.float64))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {i: (i, v) for i, v in good if i % every == 0}.values():
        others = sorted((-int(a @ b), i) for i, b in good if i != q and len(a) == len(b))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(others)]
    return sorted(out)


def search(spark, rows, **sizes):
    df = spark.createDataFrame([(a, b, "l", 1, 2) for a, b in rows], "vec_id long, embedding array<float>, label string, score int, v int")
    return sorted(tuple(r) for r in ct.top_k(df, df.where("vec_id % 20 = 0"), **sizes).collect())


def test_blocks_ties_and_hot_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(np.round(rng.normal(size=(400, 3)), 1))]
    rows += [(i, [0.5, 0.25, -0.5]) for i in range(400, 700)]  # one vector holds many rows, queries among them
    assert search(spark, rows, query_block=9, candidate_block=40, leaf=8) == brute(rows)


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [1.0, float("nan")]), (40, None), (60, [1.0, None]), (80, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (5, [0.5, 0.5]), (6, [0.5, 0.5]), (7, []), (100, []), (120, [1.0]), (1, [-3.0, 1.0])]
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows[:1]) == []
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ct.top_k(df, df).count() == 0


def test_all_embeddings(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    got = sorted(tuple(r) for r in ct.op6_topk(spark, SF_SMALL).collect())
    assert got == sorted(con.execute(ct.OP6_SQL).fetchall())


def test_repeated_rows_against_sql(spark, tmp_path):
    rng = np.random.default_rng(7)
    some = [[float(np.float32(x)) for x in v] for v in np.round(rng.normal(size=(90, 2)), 1)]
    rows = [(i, v) for i, v in enumerate(some)]
    rows += [(3, some[3])] * 4 + [(5, some[5])] * 30 + [(45, [9.0, 9.0])] * 25 + [(46, [9.0, 9.0])] * 2  # candidates, beyond k
    rows += [(20, some[20])] * 2 + [(40, some[41])] * 3 + [(40, some[40])] * 30  # queries, also with several vectors
    rows += [(60, [9.0, 9.0 + k / 8]) for k in range(30)] + [(61, some[60])] * 30
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(ct.OP6_SQL).fetchall())
    assert sorted(tuple(r) for r in ct.op6_topk(spark, str(tmp_path)).collect()) == want
    asked = df.where("vec_id % 20 = 0")
    assert sorted(tuple(r) for r in ct.top_k(df, asked, query_block=4, candidate_block=11, leaf=4).collect()) == want
