"""Bloom filters as tables of bit words.

Positions use double hashing over one sha256 per key: h1 and h2 are the first
and second 8-byte words of sha256("{seed}:{key}") reduced mod m, and
pos_i = (h1 + i * h2) mod m, with an odd step h2.

Positions never travel as rows of their own.  A task cuts its keys into blocks of at most
``BLOCK_KEYS`` and sends, per block and slice of the filter, one row of packed positions (and
key numbers, for probes); a slice answers with the numbers of the keys it misses, and the
block puts its keys together again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import params
from ..functions.hashing import broadcast_bytes

#: bits of a filter word, as Spark's bitmap functions cut them
WORD_BITS = 32768
#: words of a slice, the unit that meets its positions in one call
SLICE_WORDS = 32
SLICE_BITS = WORD_BITS * SLICE_WORDS
#: keys of a block: a key's number in it takes two bytes
BLOCK_KEYS = 1 << 16
U64 = "decimal(20,0)"


def bloom_size(n: Column, p: float):
    """X15 sizing: m = ceil(-N ln p / ln2^2), k = ceil(m / N ln 2)."""
    m = F.ceil(-(n * F.lit(math.log(p))) / F.lit(math.log(2) ** 2)).cast("bigint")
    k = F.ceil(m / n * F.lit(math.log(2))).cast("bigint")
    return m, k


def theoretical_fp(n: Column, m: Column, k: Column) -> Column:
    """(1 - e^(-kN/m))^k."""
    return F.pow(1 - F.exp(-k * n / m), k)


def digests(keys: DataFrame, key: str, seed: int = params.BLOOM_SEED) -> DataFrame:
    """``keys`` with the first 16 bytes of each key's sha256.  Taken before the keys meet several
    filter sizes, so a key is hashed once for all of them."""
    d = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    return keys.withColumn("digest_", F.unhex(F.substring(d, 1, 32)))


def key_hashes(keys: DataFrame, key: str, m: Column, seed: int = params.BLOOM_SEED) -> DataFrame:
    if "digest_" not in keys.columns:
        keys = digests(keys, key, seed)
    d, mm = F.hex("digest_"), m.cast(U64)
    h1, h2 = (F.conv(F.substring(d, at, 16), 16, 10).cast(U64) for at in (1, 17))
    # odd, so never 0, and all k positions differ when m is a power of two
    half = F.greatest(F.lit(1).cast("bigint"), F.floor(m / F.lit(2)).cast("bigint")).cast(U64)
    return keys.withColumn("h1", F.pmod(h1, mm).cast("bigint")) \
               .withColumn("h2", 1 + 2 * F.pmod(h2, half).cast("bigint"))


def positions(keys: DataFrame, key: str, m: Column, k: Column, extra: list[str] | None = None,
              seed: int = params.BLOOM_SEED) -> DataFrame:
    """``(extra..., key, i, pos)`` for i in 0..k-1."""
    extra = extra or []
    taken = [c for c in ("digest_",) if c in keys.columns]
    h = key_hashes(keys.select(*dict.fromkeys([*extra, key, *taken])), key, m, seed)
    h = h.withColumn("m_", m).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1)))
    return h.select(*extra, key, "i",
                    F.pmod(F.col("h1") + F.col("i") * F.col("h2"), F.col("m_")).alias("pos"))


def build(keys: DataFrame, key: str, m: Column, k: Column, extra: list[str] | None = None) -> DataFrame:
    """Set bits ``(extra..., pos)``."""
    extra = extra or []
    return positions(keys, key, m, k, extra).select(*extra, "pos").distinct()


# ----------------------------------------------------------------------------
# Packed positions
# ----------------------------------------------------------------------------

def _fields(df: DataFrame, names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _digest_positions(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, key numbers)`` by double hashing, from ``digest_``, ``m_`` and ``k_`` (one size)."""
    known = np.flatnonzero(batch.column("digest_").is_valid().to_numpy(zero_copy_only=False))
    if not len(known):
        return np.empty(0, np.uint64), known.astype(np.uint64)
    m, k = np.uint64(batch.column("m_")[0].as_py()), batch.column("k_")[0].as_py()
    two = np.frombuffer(b"".join(batch.column("digest_").drop_null().to_pylist()), ">u8").reshape(-1, 2)
    h1 = two[:, 0].astype(np.uint64) % m
    h2 = np.uint64(1) + np.uint64(2) * (two[:, 1].astype(np.uint64) % np.uint64(max(1, int(m) // 2)))
    at = (h1[:, None] + np.arange(k, dtype=np.uint64) * h2[:, None]) % m
    return at.ravel(), np.repeat(known, k).astype(np.uint64)


def _listed_positions(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The same from lists of positions in ``at_``."""
    lists = batch.column("at_")
    size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint64), np.repeat(np.arange(len(size)), size).astype(np.uint64)


def _by_filter(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each filter, told apart by ``names``."""
    if not names or not batch.num_rows:
        yield (), batch
        return
    code = np.zeros(batch.num_rows, np.int64)
    for n in names:
        codes = batch.column(n).dictionary_encode(null_encoding="encode")
        code = np.unique(code * len(codes.dictionary) + codes.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    ends = np.flatnonzero(np.diff(code[order], append=-1)) + 1
    for a, b in zip([0, *ends[:-1]], ends):
        part = batch.take(pa.array(order[a:b]))
        yield tuple(part.column(n)[0].as_py() for n in names), part


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """``batches`` as blocks of one filter and at most ``BLOCK_KEYS`` rows; a task holds 16 of them at most."""
    held: dict[tuple, list[pa.RecordBatch]] = {}
    total = 0

    def block(name: tuple) -> pa.RecordBatch:
        return pa.concat_batches(held.pop(name))

    for batch in batches:
        for name, part in _by_filter(batch, names):
            for a in range(0, part.num_rows, BLOCK_KEYS):
                some = part.slice(a, BLOCK_KEYS)
                if sum(x.num_rows for x in held.get(name, [])) + some.num_rows > BLOCK_KEYS:
                    total -= sum(x.num_rows for x in held[name])
                    yield name, block(name)
                held.setdefault(name, []).append(some)
                total += some.num_rows
        if total > 16 * BLOCK_KEYS:
            for name in list(held):
                yield name, block(name)
            total = 0
    for name in list(held):
        yield name, block(name)


def _slices(at: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(slice, from, to)`` over sorted positions."""
    part = at // np.uint64(SLICE_BITS)
    ends = np.flatnonzero(part[1:] != part[:-1]) + 1
    for a, b in zip([0, *ends.tolist()], [*ends.tolist(), len(at)]):
        if b > a:
            yield int(part[a]), a, b


def _pack(at: np.ndarray) -> bytes:
    """Places in a slice: all low halves, then all high bytes (which repeat, so they shrink on the way)."""
    at = at % np.uint64(SLICE_BITS)
    return at.astype("<u2").tobytes() + (at >> np.uint64(16)).astype("u1").tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    n = len(packed) // 3
    return np.frombuffer(packed, "<u2", n).astype(np.int64) | np.frombuffer(packed, "u1", n, 2 * n).astype(np.int64) << 16


def _written(keys: DataFrame, extra: list[str], apart: list[str], positions_of: Callable) -> DataFrame:
    schema = T.StructType([*_fields(keys, extra), T.StructField("slice_", T.LongType()), T.StructField("at_", T.BinaryType())])
    arrow = to_arrow_schema(schema)
    n = len(extra)

    def pack(batches):
        for name, block in _blocks(batches, [*extra, *apart]):
            at = np.unique(positions_of(block)[0])
            rows = [(s, _pack(at[a:b])) for s, a, b in _slices(at)]
            yield pa.RecordBatch.from_arrays([*[pa.array([v] * len(rows), arrow.field(i).type) for i, v in enumerate(name[:n])],
                                              pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=arrow)

    out = T.StructType([*_fields(keys, extra), T.StructField("word", T.LongType()), T.StructField("bits", T.BinaryType())])
    fields = to_arrow_schema(out)

    def fill(rows: pa.Table) -> pa.Table:
        on = np.zeros(SLICE_BITS, np.uint8)
        for packed in rows.column("at_").to_pylist():
            on[_unpack(packed)] = 1
        bits = np.packbits(on, bitorder="little").reshape(SLICE_WORDS, -1)
        used = np.flatnonzero(bits.any(axis=1))
        first = rows.column("slice_")[0].as_py() * SLICE_WORDS + 1  # Spark numbers a bitmap's words from 1
        cols = [*[[rows.column(e)[0].as_py()] * len(used) for e in extra], (first + used).tolist(), [bits[u].tobytes() for u in used]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields)], schema=fields)

    return keys.mapInArrow(pack, schema).groupBy(*extra, "slice_").applyInArrow(fill, out)


def _met(filter_words: DataFrame, probes: DataFrame, extra: list[str], apart: list[str], back: list[str],
         positions_of: Callable) -> DataFrame:
    """``(extra..., back..., present)`` of every probe.  A block's keys go along with its packed positions, so
    that the numbers that come back always meet the keys they were given for."""
    kind = T.StructType(_fields(probes, back))
    sent = [T.StructField("block_", T.LongType()), T.StructField("at_", T.BinaryType()), T.StructField("ids_", T.BinaryType()),
            T.StructField("keys_", T.ArrayType(kind))]
    schema = T.StructType([*_fields(probes, extra), T.StructField("slice_", T.LongType()), *sent])
    arrow, n = to_arrow_schema(schema), len(extra)

    def pack(batches):
        task, seq = TaskContext.get().partitionId(), 0
        for name, block in _blocks(batches, [*extra, *apart]):
            number, seq = (task << 32) + seq, seq + 1
            at, ids = positions_of(block)
            known = np.unique(ids)
            both = np.sort(at << np.uint64(16) | ids)
            at, ids = both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype("<u2")
            lost = np.setdiff1d(np.arange(block.num_rows), known).astype("<u2")  # a null key is in no filter
            struct = pa.StructArray.from_arrays([block.column(c) for c in back], fields=list(arrow.field("keys_").type.value_type))
            rows = [(s, _pack(at[a:b]), ids[a:b].tobytes()) for s, a, b in _slices(at)] + [(-1 - number, None, lost.tobytes())]
            whole = pa.ListArray.from_arrays(pa.array([0] * len(rows) + [block.num_rows], pa.int32()), struct, type=arrow.field("keys_").type,
                                             mask=pa.array([True] * (len(rows) - 1) + [False]))
            cols = [*[pa.array([v] * len(rows), arrow.field(i).type) for i, v in enumerate(name[:n])],
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([number] * len(rows), pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()), whole]
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    missed = T.StructType([*_fields(probes, extra), sent[0], sent[2], sent[3]])

    def look(asked: pa.Table, words_: pa.Table) -> pa.Table:
        out = asked.select([*extra, "block_", "ids_", "keys_"])
        if not asked.num_rows or asked.column("at_").null_count:
            return out
        bits = np.zeros((SLICE_WORDS, WORD_BITS // 8), np.uint8)
        for word, some in zip(words_.column("word").to_pylist(), words_.column("bits").to_pylist()):
            bits[(word - 1) % SLICE_WORDS] = np.frombuffer(some, np.uint8)
        off = np.unpackbits(bits.ravel(), bitorder="little") == 0
        ids = [np.frombuffer(i, "<u2")[off[_unpack(p)]].tobytes()
               for p, i in zip(asked.column("at_").to_pylist(), asked.column("ids_").to_pylist())]
        return out.set_column(n + 1, "ids_", pa.array(ids, pa.binary()))

    answer = T.StructType([*_fields(probes, extra), *_fields(probes, back), T.StructField("present", T.BooleanType())])
    fields = to_arrow_schema(answer)

    def gather(rows: pa.Table) -> pa.Table:
        keys = rows.column("keys_").combine_chunks().flatten()
        present = np.ones(len(keys), bool)
        present[np.frombuffer(b"".join(rows.column("ids_").to_pylist()), "<u2")] = False
        cols = [*[pa.array([rows.column(e)[0].as_py()] * len(keys), fields.field(e).type) for e in extra], *keys.flatten(), pa.array(present)]
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(cols, fields)], schema=fields)

    by_slice = F.floor((F.col("word") - 1) / SLICE_WORDS).cast("bigint").alias("slice_")
    asked = probes.mapInArrow(pack, schema).groupBy(*extra, "slice_")
    held = filter_words.select(*extra, "word", "bits", by_slice).groupBy(*extra, "slice_")
    return asked.cogroup(held).applyInArrow(look, missed).groupBy("block_").applyInArrow(gather, answer)


def _hashed(keys: DataFrame, key: str, m: Column, k: Column, names: list[str]) -> DataFrame:
    """``names``, the digest of ``key`` and the size of the filter, in columns."""
    if "digest_" not in keys.columns:
        keys = digests(keys, key)
    return keys.select(*names, "digest_", m.cast("bigint").alias("m_"), k.cast("bigint").alias("k_"))


def words(keys: DataFrame, key: str, m: Column, k: Column, extra: list[str] | None = None) -> DataFrame:
    """G18 as dense words ``(extra..., word, bits)`` of 32,768 bits.  Each block of keys sends its
    different positions to their slices, about two bytes each."""
    extra = extra or []
    return _written(_hashed(keys, key, m, k, extra), extra, ["m_", "k_"], _digest_positions)


def _bit(bits: Column, pos: Column) -> Column:
    """Whether a word has the bit of a position."""
    at = F.bitmap_bit_position(pos + 1)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def probe(filter_words: DataFrame, probes: DataFrame, key: str, m: Column, k: Column,
          extra: list[str] | None = None, carry: list[str] | None = None, bits: list[int] | None = None) -> DataFrame:
    """``(extra..., carry..., key, present)``; a key is present when all k of
    its positions are set.  ``extra`` names the filter, ``carry`` goes along.  Keys and what
    goes along must not repeat.  ``bits``: the sizes of all filters; words that these prove small are
    broadcast, a key's k positions are then looked up where the key is, and one row per key is
    shuffled.  Otherwise blocks of packed positions go to their slices of the filter."""
    extra, carry = extra or [], carry or []
    n = sum(-(-m // WORD_BITS) for m in bits) if bits else None
    if n is None or broadcast_bytes(n, len(filter_words.columns), WORD_BITS // 8) > params.BROADCAST_BOUND_BYTES:
        back = [*carry, key]
        return _met(filter_words, _hashed(probes, key, m, k, [*extra, *back]), extra, ["m_", "k_"], back, _digest_positions)
    pp = positions(probes, key, m, k, [*extra, *carry]) \
        .withColumn("word", F.bitmap_bucket_number(F.col("pos") + 1))
    j = pp.join(F.broadcast(filter_words), [*extra, "word"], "left")
    hit = F.coalesce(_bit(F.col("bits"), F.col("pos")), F.lit(False))
    return j.groupBy(*extra, *carry, key).agg(F.min(hit).alias("present"))


def words_of(keys: DataFrame, at: str) -> DataFrame:
    """G18 from lists of positions: ``(word, bits)``."""
    return _written(keys.select(F.col(at).cast("array<bigint>").alias("at_")), [], [], _listed_positions)


def probe_lists(filter_words: DataFrame, probes: DataFrame, at: str, keys: list[str]) -> DataFrame:
    """J9 from lists of positions: ``(keys..., present)``."""
    probes = probes.select(*keys, F.col(at).cast("array<bigint>").alias("at_"))
    return _met(filter_words, probes, [], [], keys, _listed_positions)
