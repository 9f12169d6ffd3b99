"""SentencePiece by distinct chunks: ids and decoded texts against the library."""

import hashlib
import random

import pytest
import public_tokenizers
import sentencepiece

from freqscope.llm import pieces

SF_SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a", "a ", " a  b   c ", "▁", "▁▁a▁ b", "a\nb\tc\r\n", "\x00x\x01", "<s> </s> <unk> <0x41>",
       "naïve Übermaß ¿qué?", "漢字 かな 한국어 梦", "😀 👩‍👩‍👧 \U0010ffff", "é​ x", "aaaaaaaa" * 50, "ab" * 20_000, " " * 5000,
       "x" + " " * 33 + "y", "� ͸ ", "the  the the", "1234567890 3.14", "a　b c", "ߊߊ ẞ"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def random_texts():
    rng = random.Random(11)
    alphabet = "abcdeinorst   ,.-ÄÖßéñ▁\n漢😀\x07"
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(400)]


def test_ids_and_texts_equal_the_library(spark, library):
    texts = ODD + random_texts()
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, None), (3, "again")], "doc_id long, text string").repartition(3)
    for r in pieces.encode(df).collect():
        if r["doc_id"] is not None and r["ids"] is not None and len(texts) > r["doc_id"] != 3:
            assert r["ids"] == library.encode(texts[r["doc_id"]]), repr(texts[r["doc_id"]])
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(df)).collect() if r["doc_id"] != 3}
    for k, t in enumerate(texts):
        if k != 3:
            assert back[k] == library.decode(library.encode(t)), repr(t)
    assert back[None] == ""


def test_decode_of_any_ids(library):
    model = pieces.load(pieces.model_path(None))
    rng = random.Random(5)
    low = [*range(3, 259), *range(259, 300), 1, 2]
    for _ in range(2000):
        ids = rng.choices(low, k=rng.randint(0, 8))
        assert model.decode(ids) == library.decode(ids), ids


def expected(library, text):
    ids = library.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))


def test_query_on_all_documents(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in pieces.op11_pieces(spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: expected(library, r["text"]) for r in docs}


def test_edge_rows(spark, library, tmp_path):
    rows = [(k, t, "ids", 1) for k, t in enumerate(ODD)] + [(None, "no id", None, 2), (4, None, None, 3), (4, "same id", "", 4)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in pieces.op11_pieces(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(d, *expected(library, t)) for d, t, *_ in rows], key=str)
    assert pieces.digests(df.limit(0)).count() == 0 and pieces.encode(df.limit(0)).count() == 0


def test_a_bounded_table_gives_the_same(spark, library):
    model = pieces.Pieces(pieces.model_path(None))
    model.table.limit = 3
    texts = ["one two three four five one two", "six seven one"] * 3
    at, ends, entries = pieces._chunk_table(model, texts)
    assert [entries[k][0] for k in at[:7]] == [tuple(library.encode(w)) for w in texts[0].split()]
    assert len(model.table) <= 3


def test_short_and_long_chunks_merge_alike():
    model = pieces.load(pieces.model_path(None))
    rng = random.Random(17)
    for _ in range(500):
        chunk = pieces.MARK * rng.randint(1, 20) + "".join(rng.choices("abeinorstüß,.()_0", k=rng.randint(0, 40)))
        assert model._merged_short(chunk) == model._merged(chunk)
