"""Closed syncmers: choice against its definition, edits, order of documents."""

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from freqscope.llm import syncmers as sy

SF_SMALL = "/root/testdata/sf0.001"


def brute_positions(text, k, s):
    with np.errstate(over="ignore"):
        inner = (sy._mix(sy._grams(sy._code_points(text), s)) >> np.uint64(32)).tolist()
    out = []
    for i in range(len(text) - k + 1):
        w = inner[i:i + k - s + 1]
        if w.index(min(w)) in (0, k - s):
            out.append(i)
    return out


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \U0001F600é", min_size=8, max_size=120))
def test_choice(text):
    want = brute_positions(text, sy.SMALL_K, sy.SMALL_S)
    got = sy.anchors(text, sy.SMALL_K, sy.SMALL_S)[0].tolist()
    assert got == (want or [0])
    if len(want) > 1:
        assert max(np.diff(want)) <= sy.SMALL_K - sy.SMALL_S


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(words))


def test_passage_keeps_its_anchors():
    rng = random.Random(1)
    passage = prose(rng, 60)
    inside = lambda t: {h for p, h in zip(*sy.anchors(t)) if passage in t[:] and t.index(passage) <= p <= t.index(passage) + len(passage) - sy.K}
    assert inside(prose(rng, 30) + passage + prose(rng, 30)) == inside(prose(rng, 77) + passage)


def test_likeness():
    rng = random.Random(2)
    a, b = prose(rng, 300), prose(rng, 300)
    m = sy.marks
    assert sy.likeness(m(a), m(a)) == 1.0 and sy.likeness(m(""), m("")) == 1.0 and sy.likeness(m(""), m("x")) == 0.0
    assert sy.likeness(m(a), m(b)) < 0.05
    assert sy.likeness(m(a), m(a[:900] + "inserted words here " + a[900:])) > 0.9
    assert 0.55 < sy.likeness(m(a), m(sy.edited(a, b))) < 0.8
    assert sy.likeness(m("some thirty characters of text"), m("other thirty letters, no match")) < 0.2
    for t in (a, a[:200], "x", "", "ab" * 10, "a" * 5000):
        got = sy.parse(m(t).fingerprint())
        assert got.fingerprint() == m(t).fingerprint() and sy.likeness(got, m(t)) == 1.0


def test_edits_by_reuse_equal_new_marks():
    rng = random.Random(3)
    texts = [prose(rng, n) for n in (0, 1, 5, 20, 60, 120, 400)] + ["a" * 999, ""]
    for t in texts:
        for u in texts:
            changed = sy.edited(t, u)
            assert sy.marks_after_edit(sy.marks(t), len(t) - len(t) // 3, changed).fingerprint() == sy.marks(changed).fingerprint()


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (doc, text) in enumerate(order):
        text, nxt = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        changed = text[:len(text) - n] + nxt[:n]
        m, e = sy.marks(text), sy.marks(changed)
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), m.fingerprint(), e.fingerprint(),
                    sy.likeness(m, e), sy.likeness(m, sy.marks(nxt))))
    return sorted(out, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in sy.op9_syncmers(spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_edge_rows(spark):
    rows = [(5, "b b b b" * 90), (5, "a a"), (2, None), (3, ""), (None, "last one"), (-4, "é\U0001F600" * 50), (9, "word " * 3000)]
    df = spark.createDataFrame([(a, b, True, 2) for a, b in rows], "doc_id long, text string, extra boolean, bucket int")
    assert sorted((tuple(r) for r in sy.against_edits(df).collect()), key=str) == brute(rows)
    one = df.where("doc_id = 9")
    assert [tuple(r) for r in sy.against_edits(one).collect()] == brute([rows[-1]])
    assert sy.against_edits(df.limit(0)).count() == 0
    assert sy.fingerprints(df).count() == len(rows)


def test_bounds_above(spark):
    rng = random.Random(9)
    for n in (0, 1, 2, 3, 7, 50):
        cuts = sorted(rng.sample(range(0, 400, 2), n), reverse=True)
        got = spark.range(-3, 403).select("id", sy._bounds_above(cuts).alias("b")).collect()
        assert all(r["b"] == sum(c > r["id"] for c in cuts) for r in got)
