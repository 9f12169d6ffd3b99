"""Spelling variants: words, near words, forms and roots against brute force."""

import random
import re
import zlib
from collections import Counter

from freqscope.llm import variants

SF_SMALL = "/root/testdata/sf0.001"
UP = str.maketrans(variants.UPPER, variants.LOWER)


def brute_words(rows, min_chars=7, min_count=2):
    found = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= min_chars:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(words):
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    partners, form = {}, {}
    for w, n in words.items():
        partners[w] = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, ()) if near(w, v)]
        best = min(partners[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(partners[w]), words.get(form[w])))
    return sorted(out, key=str)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_on_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    words = brute_words(docs)
    assert len(words) > 1000
    assert result(variants.op12_variants(spark, SF_SMALL)) == brute(words)


def random_words(rng, letters, count, sizes=(7, 12)):
    words = {"".join(rng.choices(letters, k=rng.randint(*sizes))) for _ in range(count)}
    for w in list(words):
        k = rng.randrange(len(w))
        c = rng.choice(letters)
        words |= {w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]}
    return sorted(w for w in words if len(w) >= 7)


def test_random_words_and_chains(spark):
    rng = random.Random(12)
    for letters in ("ab", "acgt", "aeinorstéßÿà×", "abcdefghijklmnopqrstuvwxyz"):
        words = {w: 10 ** rng.randint(0, 7) for w in random_words(rng, letters, 150)}
        df = spark.createDataFrame(list(words.items()), "word string, n long")
        assert result(variants.variants(df)) == brute(words)


def test_hot_signatures_are_sliced(spark, monkeypatch):
    monkeypatch.setattr(variants, "HOT", 5)
    rng = random.Random(13)
    words = {w: rng.randint(1, 50) for w in random_words(rng, "abc", 200, (8, 9))}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(variants.variants(df)) == brute(words)


def test_long_chain_of_forms(spark):
    words = {"abcdefgh"[:7] + "x" * k: 10 ** (12 - k) for k in range(12)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: r["root"] for r in variants.variants(df).collect()}
    assert set(got.values()) == {"abcdefg"}


def test_edge_rows(spark, tmp_path):
    long_run = "Ab" * 30_000
    texts = [None, "", "  ", "short words only", "Straßenbahn STRASSENBAHN straßenbahn Straßenbahne straßenbahne", "ÀÉÎÕÜÝÿ ÀÉÎÕÜÝÿ àéîõüýÿ",
             long_run, long_run, long_run + "c " + long_run + "c", "abcdefgh1abcdefg abcdefgh_abcdefg", "×÷×÷×÷× ×÷×÷×÷×", "naïveté's naïvetés naïvetés"]
    rows = [(k % 9, t, "w", 5) for k, t in enumerate(texts)] + [(None, "nothing nothing nothinq nothinq", None, None)] * 2 + [(3, "nothing " * 40, "", 1)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert result(variants.op12_variants(spark, str(tmp_path))) == brute(brute_words([r[:2] for r in rows]))
    assert variants.variants(variants.word_counts(df.limit(0))).count() == 0
    assert result(variants.variants(variants.word_counts(df.where("text like 'ÀÉ%'")))) == [("ÀÉÎÕÜÝÿ", None, "ÀÉÎÕÜÝÿ", 2, 0, None)]
