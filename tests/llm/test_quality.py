"""Quality: label model on known labellers, scorer, held-out labels, edge rows."""

import numpy as np

from freqscope.llm import quality

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
PROSE = "Reading about the river, people often wonder where it begins. Nobody knows for certain.\n" * 1


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(1)
    n, n_l = 20_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    right_on_good, right_on_bad = 0.97, np.linspace(0.4, 0.9, n_l)
    votes = np.zeros((n, n_l), int)
    for k in range(n_l):
        says_good = np.where(good, rng.random(n) < right_on_good, rng.random(n) > right_on_bad[k])
        votes[:, k] = np.where(rng.random(n) < 0.2, quality.ABSTAIN, np.where(says_good, quality.GOOD, quality.BAD))
    patterns, counts = np.unique(votes @ 3 ** np.arange(n_l), return_counts=True)
    posterior = quality.fit_label_model(patterns, counts)
    got = np.array([posterior[p] for p in (votes @ 3 ** np.arange(n_l)).tolist()])
    assert ((got > 0.5) == good).mean() > 0.97
    assert abs(got.mean() - 0.8) < 0.02


def test_label_model_without_documents():
    assert quality.fit_label_model(np.array([], int), np.array([], int)) == {}


def test_junk_is_seen():
    votes = lambda t: quality.features(t)[0]
    bad = lambda p: any(p // 3 ** k % 3 == quality.BAD for k in range(len(quality.LABELLERS)))
    assert not bad(votes(PROSE)) and votes("") == 0 and votes("Too short.") == 0
    for junk in ("word*** other%%% more### and&&& " * 9, "LOUD!! TEXT!! " * 20, "same " * 60, "a | b | c | d | " * 20,
                 "One line of text here.\n" * 30):
        assert bad(votes(junk)), junk


def test_shapes_and_values():
    classes = quality._class_table()[np.frombuffer("Ab12 cd !! ...".encode("utf-32-le"), "<u4")]
    codes, counts = quality.word_shapes(classes)
    assert counts.sum() == 4 and len(codes) == 4
    _, buckets, values = quality.features(PROSE)
    assert len(buckets) == len(values) and abs((values ** 2).sum() - 1) < 1e-9 and buckets.max() < quality.BUCKETS


def test_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    rows = quality.op10_quality(spark, SF_MID).collect()
    assert len(rows) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    keep = {r["doc_id"]: r["keep"] for r in rows}
    good = [keep[d] for d, q in labels.items() if q == 1]
    poor = [keep[d] for d, q in labels.items() if q == 0]
    assert np.mean(good) > 0.98 and np.mean(poor) < 0.2


def test_edge_rows(spark, tmp_path):
    rows = [(k, PROSE * (k % 5 + 1)) for k in range(60)] + [(100 + k, "junk%%% more### " * (20 + k)) for k in range(20)]
    rows += [(None, PROSE), (None, "x%%% y### " * 30), (200, None), (201, ""), (202, "y " * 150_000), (5, PROSE)]
    df = spark.createDataFrame([(a, b, 0.5, 1, "k") for a, b in rows], "doc_id long, text string, score double, votes int, keep string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = quality.op10_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["keep"] for r in got}
    assert by[3] == 1 and by[110] == 0 and by[200] == by[201] == 1
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert quality.score(df.limit(0)).count() == 0 and quality.keep_good(df.limit(0)).count() == 0


def test_each_row_has_its_own_verdict(spark):
    junk = "junk%%% more### "
    rows = [(k, PROSE * (k % 5 + 1)) for k in range(60)] + [(100 + k, junk * (20 + k)) for k in range(20)]
    rows += [(None, PROSE), (None, PROSE * 2), (None, "x%%% y### " * 30), (5, junk * 25), (110, PROSE * 3)]
    df = spark.createDataFrame([(a, b, 0.5) for a, b in rows], "doc_id long, text string, score double")
    kept = quality.keep_good(df)
    assert kept.schema == df.schema
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(a, b) for a, b in rows if b.startswith("Reading")], key=str)
    scored = quality.score(df).where("keep").collect()
    assert sorted((r["doc_id"] for r in scored), key=str) == sorted((r["doc_id"] for r in kept.collect()), key=str)
