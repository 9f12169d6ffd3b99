"""Seeded 32-bit Murmur3 of strings and of 32-bit integers, in BIGINT columns.

Values lie in [0, 2^32).  Products of two such values pass 2^63, so one factor is split
into 16-bit halves; nothing overflows, also in ANSI mode.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the published function
C1, C2, STEP, MIX1, MIX2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
MASK = 0xFFFFFFFF


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(MASK))


def _let(x: Column, use) -> Column:
    """``use(x)`` with x computed once: an expression that names x twice would hold it twice,
    and a chain of such expressions would grow without bound."""
    return F.element_at(F.transform(F.array(x), use), 1)


def _times(x: Column, c: int) -> Column:
    def product(v: Column) -> Column:
        high = (F.shiftright(v, 16) * F.lit(c)).bitwiseAND(F.lit(0xFFFF).cast("bigint"))
        return _low(v.bitwiseAND(F.lit(0xFFFF).cast("bigint")) * F.lit(c) + F.shiftleft(high, 16))
    return _let(x, product)


def _turn(x: Column, by: int) -> Column:
    return _let(x, lambda v: _low(F.shiftleft(v, by)).bitwiseOR(F.shiftright(v, 32 - by)))


def _fold(x: Column, by: int) -> Column:
    return _let(x, lambda v: v.bitwiseXOR(F.shiftright(v, by)))


def _block(k: Column) -> Column:
    return _times(_turn(_times(k, C1), 15), C2)


def _final(h: Column, size: Column) -> Column:
    return _fold(_times(_fold(_times(_fold(h.bitwiseXOR(size), 16), MIX1), 13), MIX2), 16)


def _step(h: Column, k: Column) -> Column:
    return _low(_turn(h.bitwiseXOR(_block(k)), 13) * F.lit(5) + F.lit(STEP))


def _little_endian(hex8: Column) -> Column:
    parts = [F.substring(hex8, at, 2) for at in (7, 5, 3, 1)]
    return F.conv(F.concat(*parts), 16, 10).cast("bigint")


def murmur3_32(key: Column, seed: Column | int = 0) -> Column:
    """Of a string's UTF-8 bytes; ``seed`` in [0, 2^32)."""
    digits = F.hex(key.cast("string").cast("binary"))
    size = F.octet_length(key.cast("string")).cast("bigint")
    blocks = F.floor(size / 4).cast("int")
    starts = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
    words = F.transform(starts, lambda i: _little_endian(F.substring(digits, i * 8 + 1, F.lit(8))))
    seed = (F.lit(seed) if isinstance(seed, int) else seed).cast("bigint")
    h = F.aggregate(words, seed, _step)
    tail = _little_endian(F.rpad(F.substring(digits, blocks * 8 + 1, F.lit(8)), 8, "0"))
    return _final(h.bitwiseXOR(_block(tail)), size)


def murmur3_32_int(x: Column, seed: Column | int = 0) -> Column:
    """Of the four little-endian bytes of an integer's low 32 bits."""
    seed = (F.lit(seed) if isinstance(seed, int) else seed).cast("bigint")
    return _final(_step(seed, _low(x.cast("bigint"))), F.lit(4).cast("bigint"))


# ----------------------------------------------------------------------------
# The same over arrays: 32-bit products wrap
# ----------------------------------------------------------------------------

def _np_turn(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint32(by) | x >> np.uint32(32 - by)


def _np_block(k: np.ndarray) -> np.ndarray:
    return _np_turn(k * np.uint32(C1), 15) * np.uint32(C2)


def _np_step(h: np.ndarray, k: np.ndarray) -> np.ndarray:
    return _np_turn(h ^ _np_block(k), 13) * np.uint32(5) + np.uint32(STEP)


def _np_final(h: np.ndarray, size: int) -> np.ndarray:
    h = h ^ np.uint32(size)
    h = (h ^ h >> np.uint32(16)) * np.uint32(MIX1)
    h = (h ^ h >> np.uint32(13)) * np.uint32(MIX2)
    return h ^ h >> np.uint32(16)


def murmur3_ints(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """``murmur3_32_int`` of an array's low 32 bits, unsigned."""
    k = (np.asarray(x).astype(np.int64) & MASK).astype(np.uint32)
    return _np_final(_np_step(np.full(k.shape, seed, np.uint32), k), 4)


def murmur3_texts(texts: pa.Array, seeds: list[int]) -> np.ndarray:
    """``murmur3_32`` of non-null texts under each seed: a row of unsigned values per text.  Texts
    of one length are hashed together."""
    raw = texts.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
    out = np.empty((len(raw), len(seeds)), np.uint32)
    sizes = np.diff(ends)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        padded = np.zeros((len(rows), size // 4 * 4 + 4), np.uint8)  # the blocks, then the tail
        if size:
            padded[:, :size] = data[ends[rows][:, None] + np.arange(size)]
        blocks = padded.view("<u4")
        h = np.tile(np.array(seeds, np.uint32), (len(rows), 1))
        for i in range(size // 4):
            h = _np_step(h, blocks[:, i, None])
        out[rows] = _np_final(h ^ _np_block(blocks[:, -1, None]), size)
    return out


def murmur3_32_seeds(key: Column, seeds: list[int], mod: int = 1 << 32) -> Column:
    """``murmur3_32`` of a text under each seed, modulo ``mod``, as one list; null for null."""
    @F.arrow_udf("array<bigint>")
    def hashes(texts: pa.Array) -> pa.Array:
        at = murmur3_texts(texts.fill_null(""), seeds).astype(np.int64) % mod
        ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(seeds))
        return pa.ListArray.from_arrays(ends, pa.array(at.ravel()), mask=texts.is_null())

    return hashes(key.cast("string"))


def _sql_times(x: str, c: int) -> str:
    return f"(({x})::HUGEINT * {c} % 4294967296)::BIGINT"


def _sql_turn(x: str, by: int) -> str:
    return f"((({x}) << {by}) & {MASK} | (({x}) >> {32 - by}))"


def _sql_block(k: str) -> str:
    return _sql_times(_sql_turn(_sql_times(k, C1), 15), C2)


def _sql_step(h: str, k: str) -> str:
    return f"(({_sql_turn(f'xor({h}, {_sql_block(k)})', 13)} * 5 + {STEP}) & {MASK})"


def _sql_final(source: str, h: str, size: str, name: str) -> str:
    """``source`` with one more column, step by step so that no expression is repeated."""
    rows = f"SELECT *, xor({h}, {size}) AS m0 FROM {source}"
    rows = f"SELECT *, {_sql_times('xor(m0, m0 >> 16)', MIX1)} AS m1 FROM ({rows})"
    rows = f"SELECT *, {_sql_times('xor(m1, m1 >> 13)', MIX2)} AS m2 FROM ({rows})"
    return f"(SELECT * EXCLUDE (m0, m1, m2), xor(m2, m2 >> 16) AS {name} FROM ({rows}))"


def murmur_sql(source: str, text: str, seed: str, name: str) -> str:
    """In DuckDB: ``source`` with the hash of its column ``text`` as one more column."""
    def little(h):
        return f"('0x' || substr({h}, 7, 2) || substr({h}, 5, 2) || substr({h}, 3, 2) || substr({h}, 1, 2))::BIGINT"

    size, digits = f"strlen({text})::BIGINT", f"hex(encode({text}))"
    words = f"list_transform(range(0, {size} // 4), lambda i: {little(f'substr({digits}, (i * 8 + 1)::BIGINT, 8)')})"
    h = f"list_reduce(list_prepend(({seed})::BIGINT, {words}), lambda h, k: {_sql_step('h', 'k')})"
    tail = little(f"rpad(substr({digits}, ({size} // 4) * 8 + 1), 8, '0')")
    return _sql_final(source, f"xor({h}, {_sql_block(tail)})", size, name)


def murmur_int_sql(source: str, x: str, name: str) -> str:
    """The same of a column of integers, seed 0."""
    return _sql_final(source, _sql_step("0", f"({x} & {MASK})"), "4", name)
