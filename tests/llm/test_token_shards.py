"""Token shards: Re-Pair round trips, random access, and the query by brute force."""

import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from freqscope.llm import bpe, token_shards as ts

SF_SMALL = "/root/testdata/sf0.001"


def as_block(ids, min_count=2):
    seq, first, left, right, sizes = ts.repair(np.array(ids, np.int64), min_count)
    pack = lambda x: x.astype("<u4").tobytes()
    return {"width": 4, "first_rule": first, "left": pack(left), "right": pack(right), "expansions": pack(sizes),
            "marks": pack(ts.symbol_marks(seq, first, sizes)), "lengths": [len(ids)], "sequence": pack(seq)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=300), st.data())
def test_any_range_comes_back(ids, data):
    block = as_block(ids)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert ts.read_range(block, a, b).tolist() == ids[a:b]
    assert ts.read_range(block, 0, len(ids)).tolist() == ids


def test_frequent_pairs_become_rules():
    ids = np.array([1, 2, 3] * 1000 + [7] * 64, np.int64)
    seq, first, left, right, sizes = ts.repair(ids, 8)
    assert len(seq) < 100 and first == 8
    assert (ts.expand(seq, first, left, right) == ids).all()
    for k in range(len(left)):
        assert len(ts.expand(np.array([first + k]), first, left, right)) == sizes[k]


def test_one_id_opens_only_its_path():
    ids = np.array([1, 2, 3, 4, 5, 6, 7, 8] * 20_000 + list(range(9, 5000)), np.int64)
    seq, first, left, right, sizes = ts.repair(ids, 2)
    assert len(left) > 8
    depth = [0] * len(left)
    for k in range(len(left)):
        depth[k] = 1 + max([depth[x - first] for x in (left[k], right[k]) if x >= first], default=0)
    for at in (0, 1, 7, 8, 100_003, 159_999, 160_000, len(ids) - 1):
        got, opened = ts.open_range(seq, first, left, right, sizes, at, at + 1)
        assert got.tolist() == [ids[at]] and opened <= max(depth)
    got, opened = ts.open_range(seq, first, left, right, sizes, 0, len(ids))
    assert (got == ids).all()


def test_read_range_reads_part_of_the_sequence():
    ids = list(np.random.default_rng(1).integers(0, 40, 50_000))
    block = as_block(ids, 16)
    for a, b in ((0, 1), (49_999, 50_000), (12_345, 12_400), (0, 49_999), (1, 50_000), (7, 7)):
        assert ts.read_range(block, a, b).tolist() == ids[a:b]


def test_spans_of_documents(spark):
    rows = [(k, f"word {k} and, some\nOther words " * (k % 7)) for k in range(60)] + [(None, "none"), (7, "again 7")]
    shards = ts.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), block_ids=50)
    lib = ts.library(bpe.tokenizer_path(None))
    asked = [(3, 0, 5), (3, 0, 5), (7, 2, 4), (7, -3, 900), (9, 4, 4), (9, 6, 2), (59, 10, 20), (1000, 0, 3), (None, 0, 3), (5, None, 3)]
    want = []
    for d, a, b in sorted(set(asked), key=str):
        for doc, text in rows:
            if doc is not None and doc == d and a is not None:
                ids = [*np.frombuffer(lib._whole(text), "<u4").tolist(), ts.END_ID]
                want.append((d, a, b, ids[max(a, 0):max(b, 0)]))
    got = ts.read_spans(shards, spark.createDataFrame(asked, "doc_id long, start long, stop long"))
    assert sorted((r.doc_id, r.start, r.stop, list(r.ids)) for r in got.collect()) == sorted(want)
    assert ts.read_spans(shards, spark.createDataFrame([], "doc_id long, start long, stop long")).count() == 0


PARTS = ["word", "Words", "é", "čau", "日本", "don't", "I'll", ",", ".", "...", "%%%", "a1", "12", "\n", "\n\n", " ", "  ", "\t", "\x0b", "\u3000",
         "ċ", "Ġ", "İ", "ß", "ñandú", "_", "'", "\r\n", "\xa0", "<|endoftext|>", "\U0001F600", "e\u0301", "x\ny", "x.\nÉt."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=6))
def test_encoder_equals_the_library(texts):
    lib = ts.library(bpe.tokenizer_path(None))
    got = [x.tolist() for x in lib.encode(texts)]
    assert got == [lib.library.encode(t, add_special_tokens=False).ids for t in texts]


def brute(rows, end=ts.END_ID):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.tokenizer_path(None))
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in ts.op7_token_shards(spark, SF_SMALL).collect()), key=str)
    assert got == brute(rows)


def test_edge_rows_and_many_blocks(spark):
    rows = [(5, "b b b b"), (5, "a a"), (2, None), (3, ""), (None, "last one"), (-4, "x <|endoftext|> y"), (9, "word " * 3000)]
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, shard int, block int")
    shards = ts.write_shards(df, block_ids=4)
    assert shards.count() > 3
    assert sorted((tuple(r) for r in ts.read_shards(shards).collect()), key=str) == brute(rows)
    assert ts.read_shards(ts.write_shards(df.limit(0))).count() == 0


ODD = ["a", "é", "×", "÷", "ª", "µ", "'s", "'", "re", "1", "²", ".", "-", " ", " ", "\n", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "　", "“",
       "日", "語。", "ж", "́", "😀", "\x00", "﻿", "longer than a key holds, ", "longerthanakeyholdsinallitsbytes"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=25).map("".join))
def test_parts_are_cut_between_pieces(text):
    raw = text.encode()
    if not raw:
        return
    kind = ts.byte_kinds(np.frombuffer(raw + bytes(32), np.uint8))[:len(raw)]
    lib = ts.library(bpe.tokenizer_path(None))
    ends = {len(text[:span[1]].encode()) for _, span in lib.library.pre_tokenizer.pre_tokenize_str(text)}
    assert set(ts.part_starts(kind, np.array([0])).tolist()) <= {0} | ends
    assert [x.tolist() for x in lib.encode([text])] == [lib.library.encode(text, add_special_tokens=False).ids]


def test_words_are_learnt_once_whatever_follows():
    lib = ts.LibraryEncoder(bpe.tokenizer_path(None))
    words = [a + b + c for a in "bcdfglmnpr" for b in ("aro", "evi", "ilu", "omä", "uto") for c in ("nd", "st", "rk", "lm")]
    texts = [f"{w}{m} {v}{n}\n{w}{m} {v}" for w, v in zip(words, reversed(words)) for m in (",", ".", "!!", "%%%") for n in (";", ".", "")]
    got = [x.tolist() for x in lib.encode(texts)]
    assert got == [lib.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert lib.held <= 2 * len(words) + 10  # with and without a space, and the marks


def test_dropped_parts_and_met_slots_keep_ids():
    class Small(ts.LibraryEncoder):
        LIMIT, POOL, GROUP, SLICE, _BITS = 40, 100, 16, 50, 7

    rng = np.random.default_rng(3)
    lib = Small(bpe.tokenizer_path(None))
    for _ in range(10):
        texts = ["".join(rng.choice(ODD + PARTS, rng.integers(0, 40))) for _ in range(50)]
        assert [x.tolist() for x in lib.encode(texts)] == [lib.library.encode(t, add_special_tokens=False).ids for t in texts]
        assert lib.held <= Small.LIMIT + Small.GROUP
