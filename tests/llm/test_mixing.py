"""Mixing: posteriors by hand, rates against a plain solver, copies, edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from freqscope.llm import mixing
from freqscope.llm.common import hash_sample

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def solve(n, p, targets, ridge, steps=20_000):
    s = n.sum()
    r = np.ones(len(n))
    for _ in range(steps):
        pull = (n * r) @ p / s - targets
        r = np.maximum(0, r - (p @ pull + ridge * (r - 1)) / (1 + ridge))
    return r


def test_rates_match_a_plain_solver(spark):
    rng = np.random.default_rng(1)
    n = rng.integers(1, 500, 300).astype(float)
    p = rng.dirichlet([0.4, 0.3, 0.2], 300)
    targets = (0.7, 0.25, 0.05)
    df = spark.createDataFrame([(k, int(a), b.tolist()) for k, (a, b) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>")
    got = {r["doc_id"]: r["rate"] for r in mixing.fit_rates(df, targets, ridge=0.005).collect()}
    want = solve(n, p, np.array(targets), 0.005)
    assert max(abs(got[k] - want[k]) for k in range(300)) < 1e-6
    totals = np.array([got[k] for k in range(300)]) * n @ p / n.sum()
    assert np.abs(totals - targets).max() < 0.02 and min(got.values()) >= 0


@pytest.fixture(scope="module")
def mixed_mid(spark):
    return mixing.op5_mixing(spark, SF_MID).collect()


def solve_without_ridge(n, p, targets, steps=300_000):
    """Accelerated projected gradient on the totals alone, over groups of equal posteriors."""
    p, back = np.unique(p, axis=0, return_inverse=True)
    w = np.bincount(back.ravel(), weights=n) / n.sum()
    r = ahead = np.ones(len(w))
    for t in range(steps):
        last, r = r, np.maximum(0, ahead - p @ ((w * ahead) @ p - targets))
        ahead = r + min(t / (t + 3.0), 0.9999) * (r - last)
    return (w * r) @ p


def test_expected_totals_meet_the_targets(spark, mixed_mid):
    """Against a plain solver that knows no ridge: the targets are within reach, and met."""
    rows = mixed_mid
    assert len(rows) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    n = np.array([r["n_tokens"] for r in rows], float)
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    targets = np.array(mixing.TARGETS)
    got = (n * np.array([r["rate"] for r in rows])) @ p / n.sum()
    assert np.abs(solve_without_ridge(n, p, targets) - targets).max() < 1e-3
    assert np.abs(got - targets).max() < 1e-3
    assert all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in rows)
    assert abs(sum(r["copies"] for r in rows) - sum(r["rate"] for r in rows)) < 0.1 * len(rows)


def test_targets_out_of_reach_are_approached(spark):
    p = [[0.9, 0.1], [0.6, 0.4]]
    df = spark.createDataFrame([(k, 10, p[k % 2]) for k in range(20)], "doc_id long, n_tokens long, p array<double>")
    got = {r["doc_id"]: r["rate"] for r in mixing.fit_rates(df, (1.0, 0.0)).collect()}
    n, q = np.full(20, 10.0), np.array([p[k % 2] for k in range(20)])
    best = solve_without_ridge(n, q, np.array([1.0, 0.0]))
    totals = np.array([got[k] for k in range(20)]) * n @ q / n.sum()
    assert np.abs(totals - best).max() < 1e-4 and min(got.values()) >= 0


def test_samples_of_huge_tables_do_not_vanish(spark):
    df = spark.range(200_000)
    some = hash_sample(df, ["id"], 20_000, 10 ** 11)
    assert hash_sample(df, ["id"], 20_000, 200_000).count() in range(19_000, 21_000)
    assert hash_sample(df, ["id"], 10, 5).count() == 200_000
    bound = 20_000 * (1 << 63) // 10 ** 11
    assert bound > 0 and some.count() <= 1


def test_classifier_agrees_with_labels(spark, mixed_mid):
    labels = {r["doc_id"]: 1 if r["toxic"] else 0 if r["quality"] else 2 for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = [r for r in mixed_mid if r["doc_id"] in labels]
    best = lambda r: max(range(3), key=lambda k: r[f"p_{mixing.DOMAINS[k]}"])
    assert np.mean([best(r) == labels[r["doc_id"]] for r in rows]) > 0.85
    good = [r for r in rows if labels[r["doc_id"]] == 0]
    assert np.mean([best(r) == 0 for r in good]) > 0.95


def frames(spark):
    rng = random.Random(2)
    word = lambda bad: rng.choice(["awful", "nasty", "vile"] if bad else ["kind", "green", "river", "house"])
    rows = [(k, " ".join(word(k % 4 == 0) for _ in range(30))) for k in range(200)]
    rows += [(None, "kind river"), (500, None), (501, ""), (502, " \n"), (503, "kind " * 20_000), (7, rows[7][1])]
    docs = spark.createDataFrame([(a, b, 3, "w", 1.5) for a, b in rows], "doc_id long, text string, copies int, words string, rate double")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(0, 200, 2)] + [(None, 1, 0), (9999, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_edge_rows_and_clashing_columns(spark):
    docs, labels = frames(spark)
    mixed = mixing.mix(docs, labels, targets=(0.9, 0.1, 0.0)).collect()
    assert len(mixed) == docs.count()
    by = {r["doc_id"]: r for r in mixed}
    assert by[500]["n_tokens"] == by[501]["n_tokens"] == by[502]["n_tokens"] == 0 and by[503]["n_tokens"] == 20_000
    assert by[4]["p"][1] > 0.9 and by[5]["p"][0] > 0.9
    out = mixing.apply_mix(docs, labels, targets=(0.9, 0.1, 0.0))
    assert out.columns == docs.columns and out.schema == docs.schema
    want = sum(by[k]["copies"] for k in by if k is not None and k != 7) + 2 * by[7]["copies"] + by[None]["copies"]
    assert out.count() == want


def test_rows_of_one_id_are_drawn_by_their_own_text(spark):
    docs, labels = frames(spark)
    bad, good = "awful nasty vile " * 10, "kind green river house " * 8
    more = [(None, f"{bad}{k}") for k in range(60)] + [(None, f"{good}{k}") for k in range(60)] + [(9, bad), (9, bad + "x")]
    docs = docs.unionByName(spark.createDataFrame([(a, b, 3, "w", 1.5) for a, b in more], docs.schema))
    targets = (0.9, 0.1, 0.0)
    mixed = mixing.mix(docs, labels, targets=targets)
    assert mixed.columns == ["doc_id", "n_tokens", "p", "rate", "copies"]
    rows = mixed.collect()
    toxic = [r for r in rows if r["doc_id"] is None and r["p"][1] > 0.5]
    assert len(toxic) == 60 and {r["copies"] for r in toxic} == {0, 1}  # not one block
    out = mixing.apply_mix(docs, labels, targets=targets).collect()
    assert len(out) == sum(r["copies"] for r in rows)
    held = lambda doc, word: sum(r["doc_id"] == doc and word in r["text"] for r in out)
    assert held(None, "awful") == sum(r["copies"] for r in toxic)
    assert held(9, "awful") == sum(r["copies"] for r in rows if r["doc_id"] == 9 and r["p"][1] > 0.5)
    assert held(9, "awful") + held(9, "kind") == sum(r["copies"] for r in rows if r["doc_id"] == 9)


def test_no_labels_and_no_documents(spark):
    docs, labels = frames(spark)
    rates = {r["rate"] for r in mixing.mix(docs, labels.limit(0)).collect()}
    assert rates == {1.0}
    assert mixing.mix(docs.limit(0), labels).count() == 0
    assert mixing.apply_mix(docs.limit(0), labels).count() == 0


def test_plan_is_native(spark):
    plan = mixing.op5_mixing(spark, SF_SMALL).select(F.col("rate"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
