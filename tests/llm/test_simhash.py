"""SimHash: fingerprints and components against brute force; which rows stay."""

import random

import numpy as np
import xxhash

from freqscope.llm import simhash

SF_SMALL = "/root/testdata/sf0.001"

U = 1 << 64


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, bits=4):
    """rows: (id, fp) -> {index: smallest id reachable}"""
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= bits:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(doc, least.get(root(k), doc))
    return [least.get(root(k)) for k in range(len(rows))]


def test_fingerprint_edge_texts():
    for t in ("", " \n", "One", "a b c", "A B c D", "a b c d e", "É é É é x y z w", "x " * 50, "\x1c a \x85 b c d"):
        assert simhash.fingerprint(t.encode()) == brute_fingerprint(t), repr(t)


def test_all_pairs_within_four_bits_meet():
    rng = random.Random(3)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        a = np.array([x], np.uint64).view(np.int64)
        b = np.array([y], np.uint64).view(np.int64)
        import pyarrow as pa
        anchors, _ = simhash._anchor_rows(pa.RecordBatch.from_arrays([pa.array(b)], names=["fp"]))
        homes = {int(simhash._homes(a, k)[0]) for k in range(3)}
        assert homes & set(anchors.tolist())


def test_components_of_random_fingerprints(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(200):
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << b
        fps.append(x)
    fps = sorted(set(fps))
    signed = [f - U if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(5)
    roots = {r["u"]: r["root"] for r in simhash.components(simhash.link_edges(df)).collect()}
    got = [roots.get(f, f) for f in signed]
    want = brute_components(list(zip(signed, fps)))
    groups = lambda labels: {frozenset(k for k in range(len(labels)) if labels[k] == x) for x in labels}
    assert groups(got) == groups(want)


def test_hot_anchor_is_sliced(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOMES", 8)
    rng = random.Random(7)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 150:
        x = centre
        for b in rng.sample(range(64), 2):
            x ^= 1 << b
        fps.add(x)
    signed = [f - U if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r["u"]: r["root"] for r in simhash.components(simhash.link_edges(df)).collect()}
    assert {roots.get(f, f) for f in signed} == {min(signed)}


def test_hub_of_a_large_group(spark):
    edges = spark.createDataFrame([(k, 0) for k in range(1, 600)] + [(k + 1000, k) for k in range(1, 600)], "u long, v long")
    assert {(r["u"], r["root"]) for r in simhash.components(edges).collect()} == {(k + a, 0) for k in range(1, 600) for a in (0, 1000)}


def edge_frame(spark):
    same = "the quick brown fox jumps over the lazy dog again and again " * 3
    rows = [(5, same), (3, same), (3, same), (9, None), (8, ""), (7, " \n "), (None, same + "x"), (1, "lonely words of another kind here"),
            (2, "long " * 40_000)]
    return spark.createDataFrame([(a, b, "fp", 1, "c") for a, b in rows], "doc_id long, text string, fp string, root int, component string")


def test_query_edge_rows(spark, tmp_path):
    df = edge_frame(spark)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = df.select("doc_id", "text").collect()
    got = simhash.op2_simhash(spark, str(tmp_path)).collect()
    fps = [(r["doc_id"], brute_fingerprint(r["text"] or "")) for r in rows]
    want = sorted([(d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps))], key=str)
    assert sorted([tuple(r) for r in got], key=str) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    stay = sorted((r["doc_id"], r["text"]) for r in kept.where("doc_id is not null").collect())
    components = {c for c in brute_components(fps)}
    assert [d for d, _ in stay] == sorted(c for c in components if c is not None)
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_one(df.limit(0)).count() == 0


def test_unlinked_rows_of_one_id_stay(spark):
    words = [" ".join(f"{kind}{k}" for k in range(30)) for kind in ("ash", "birch", "cedar", "elm", "fir")]
    rows = [(None, words[0]), (None, words[1]), (None, words[1]), (None, words[2]), (7, words[2]), (7, words[3]), (7, words[4]),
            (7, words[4].upper()), (2, words[4]), (9, words[0].upper())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in simhash.keep_one(df).collect()), key=str)
    assert got == sorted([(None, words[1]), (7, words[2]), (7, words[3]), (2, words[4]), (9, words[0].upper())], key=str)
    none = df.selectExpr("cast(null as long) as doc_id", "text")
    assert sorted(r["text"] for r in simhash.keep_one(none).collect()) == sorted(
        [words[0].upper(), words[1], words[2], words[3], words[4].upper()])


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    fps = [(r["doc_id"], brute_fingerprint(r["text"])) for r in docs]
    want = {d: (f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op2_simhash(spark, SF_SMALL).collect()}
    assert got == want
