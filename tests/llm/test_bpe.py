"""BPE by per-prefix dynamic programming against the tokenizers library."""

import hashlib
import random

import pytest

from freqscope.llm import bpe, pretoken

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.tokenizer_path(None))


@pytest.fixture(scope="module")
def own():
    return bpe.load(bpe.tokenizer_path(None))


def same(own, library, text):
    ids = own.encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids, repr(text[:200])
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_random_texts(own, library):
    rng = random.Random(1)
    alphabet = "ab'sStre ve  \t\n\r 12²½é漢字_-!?\x1c\x85​\U0001F600́ⅷ٣"
    for k in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        same(own, library, text + "<|endoftext|>" + text if k % 10 == 0 else text)


def test_long_pieces(own, library):
    for text in ("a" * 20_000, "ab" * 9_999, "é" * 5_000, " " * 7_000, "the" * 3_000, "\n" * 333 + "a", ""):
        same(own, library, text)


def test_chunks_split_like_the_text():
    rng = random.Random(8)
    for _ in range(2000):
        text = "".join(rng.choice("ab  '1.\n\t\u3000é") for _ in range(rng.randint(0, 20)))
        cut = pretoken.chunks(text)
        if cut is not None:
            pieces = pretoken.split(cut[0]) + [p for c in cut[1:] for p in pretoken.split(" " + c)]
            assert pieces == pretoken.split(text), repr(text)


def test_split_keeps_every_character():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000), rng.randrange(256)]))
                       for _ in range(30))
        assert "".join(pretoken.split(text)) == text


def test_decoding_broken_ids(own, library):
    rng = random.Random(4)
    for _ in range(200):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pair_test_equals_merging(own, library):
    """A pair of tokens is compatible if the library gives it back."""
    rng = random.Random(6)
    words = [k for k in range(50_256) if own.bytes_of[k].isalpha()]
    for _ in range(400):
        a, b = rng.choice(words), rng.choice(words)
        text = (own.bytes_of[a] + own.bytes_of[b]).decode()
        assert own._apart(a, b, len(own.rank)) == (library.encode(text, add_special_tokens=False).ids == [a, b])


def test_cache_is_bounded():
    made = []
    cache = pretoken.PieceCache(lambda w: made.append(w) or len(w), limit=3, longest=5)
    assert [cache[w] for w in ("a", "bb", "a", "ccc", "dddd", "a", "longer")] == [1, 2, 1, 3, 4, 1, 6]
    assert len(cache) <= 3 and made.count("a") == 2 and "longer" not in cache


def test_query(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in bpe.op8_bpe(spark, SF_SMALL).collect()}
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_edge_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "ab", 1), (3, "ab", 1), (3, "ab", 1)], "doc_id long, text string, ids int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    empty = hashlib.sha256(b"").hexdigest()
    got = sorted((tuple(r) for r in bpe.op8_bpe(spark, str(tmp_path)).collect()), key=str)
    assert len(got) == 5 and (1, 0, empty, empty) in got and (2, 0, empty, empty) in got
    assert [r["text"] for r in bpe.decode(bpe.encode(df.where("doc_id = 3"))).collect()] == ["ab", "ab"]
    assert bpe.digests(df.limit(0)).count() == 0
