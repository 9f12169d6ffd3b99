"""Sketch reads over intervals of slots, for tables with a row per item.

A read needs every cell of its columns in its interval, so joining rows to cells makes a row per
item and slot.  Here time is cut into chunks of slots and the requests into parts of at most about
``PART``; the cells of a chunk and the requests of a part meet in one call, as a dense array of at
most ``DENSE`` cells, and one row per request and chunk comes out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sha_row_index

KEY = ["item", "a", "b"]
PART = 1 << 17
DENSE = 1 << 20
CHUNK_SLOTS = 512
#: requests read in one step
STEP = 1024


def chunk_slots(width: int, depth: int, least: int = 1) -> int:
    """Slots of a chunk: a power of two, so that dyadic segments up to ``least`` slots lie in one chunk."""
    return max(least, min(CHUNK_SLOTS, 1 << max(0, (DENSE // (width * depth)).bit_length() - 1)))


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def _met(asked: DataFrame, cells: DataFrame, lo: Column, hi: Column, slots: int, width: int, depth: int, seed: int,
         kernel: Callable) -> DataFrame:
    """``(item, a, b, est)`` where est > 0.  ``asked``: distinct requests; ``cells``: with their ``chunk``;
    ``kernel(cells, cols, first, last)``: the sums of requests whose slots are counted from the chunk's first."""
    parts = -(-asked.count() // PART)  # one number
    schema = asked.select(*KEY, F.lit(0).cast("bigint").alias("est")).schema
    cols = F.array(*[sha_row_index(F.col("item"), F.lit(r), seed, width) for r in range(depth)])
    inside = asked.select(*KEY, F.greatest("a", lo).alias("from_"), F.least("b", hi).alias("to_")).where("from_ <= to_")
    span = F.sequence(F.floor(F.col("from_") / slots).cast("bigint"), F.floor(F.col("to_") / slots).cast("bigint"))
    part = F.pmod(F.xxhash64(*KEY), _long(max(parts, 1))).alias("part")
    probes = inside.select(*KEY, "from_", "to_", cols.alias("cols"), part, F.explode(span).alias("chunk"))
    spread = cells.withColumn("part", F.explode(F.sequence(_long(0), _long(max(parts, 1) - 1))))

    def read(asked_: pa.Table, cells_: pa.Table) -> pa.Table:
        out = asked_.select(KEY)
        if not asked_.num_rows or not cells_.num_rows:
            return out.slice(0, 0).append_column("est", pa.array([], pa.int64()))
        base = asked_.column("chunk")[0].as_py() * slots
        first = np.maximum(asked_.column("from_").to_numpy() - base, 0)
        last = np.minimum(asked_.column("to_").to_numpy() - base, slots - 1)
        at = asked_.column("cols").combine_chunks().flatten().to_numpy().reshape(-1, depth)
        held = {c: cells_.column(c).to_numpy() for c in cells_.column_names if c not in ("chunk", "part")}
        reader = kernel(held, base)
        est = np.concatenate([reader(at[k:k + STEP], first[k:k + STEP], last[k:k + STEP]) for k in range(0, len(at), STEP)])
        return out.append_column("est", pa.array(est, pa.int64())).filter(pa.array(est > 0))

    keys = ["chunk", "part"]
    met = probes.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(read, schema)
    return met.groupBy(*KEY).agg(F.sum("est").cast("bigint").alias("est"))


def _least(dense: np.ndarray, at: np.ndarray, seg=None) -> np.ndarray:
    """Least of the rows' cells: all segments of each request, or one (``seg``)."""
    pick = (lambda r: dense[r][at[:, r]]) if seg is None else (lambda r: dense[r][at[:, r], seg])
    out = pick(0)
    for r in range(1, len(dense)):
        out = np.minimum(out, pick(r))
    return out


def _run(least: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sums of the segments first to last."""
    total = np.zeros((len(least), least.shape[1] + 1), np.int64)
    np.cumsum(least, axis=1, out=total[:, 1:])
    row = np.arange(len(least))
    return total[row, last + 1] - total[row, first]


def ring_sums(cells: DataFrame, asked: DataFrame, lo: Column, hi: Column, width: int, depth: int, seed: int) -> DataFrame:
    """Sums over the slots max(a, lo) to min(b, hi) of the slots' Count-Min reads, from ``(slot, row, col, cnt)``."""
    slots = chunk_slots(width, depth)

    def kernel(c: dict, base: int) -> Callable:
        dense = np.zeros((depth, width, slots), np.int64)
        dense[c["row"], c["col"], c["slot"] - base] = c["cnt"]
        return lambda at, first, last: _run(_least(dense, at), first, last)

    cells = cells.select("slot", "row", "col", "cnt", F.floor(F.col("slot") / slots).cast("bigint").alias("chunk"))
    return _met(asked, cells, lo, hi, slots, width, depth, seed, kernel)


def dyadic_sums(cells: DataFrame, asked: DataFrame, newest: int, width: int, levels: int, min_width: int, depth: int,
                seed: int) -> DataFrame:
    """Sums over the segments of a request's dyadic cover of their Count-Min reads, from
    ``(level, seg, row, col, cnt)``; ``newest``: the last slot with cells.  Chunks are made of whole top
    segments, so the part of a cover in a chunk is the cover of the interval's part in it."""
    base_width = max(width, min_width)
    slots = chunk_slots(base_width, depth, 1 << (levels - 1))

    def kernel(c: dict, base: int) -> Callable:
        dense = []
        for level in range(levels):
            here = c["level"] == level
            dense.append(np.zeros((depth, max(width >> level, min_width), slots >> level), np.int64))
            dense[level][c["row"][here], c["col"][here], c["seg"][here] - (base >> level)] = c["cnt"][here]

        def read(at, first, last):
            est = np.zeros(len(at), np.int64)
            for level, cells_ in enumerate(dense):
                col = at % cells_.shape[1]
                a, b = first + (1 << level) - 1 >> level, (last + 1 >> level) - 1
                some = a <= b
                if level == levels - 1:
                    est[some] += _run(_least(cells_, col[some]), a[some], b[some])
                else:
                    for edge, odd in ((a, 1), (b, 0)):
                        use = some & (edge % 2 == odd)
                        est[use] += _least(cells_, col[use], edge[use])
            return est
        return read

    chunk = F.floor(F.expr("shiftleft(seg, cast(level as int))") / slots).cast("bigint").alias("chunk")
    cells = cells.select("level", "seg", "row", "col", "cnt", chunk)
    end = (newest // slots + 1) * slots - 1  # a whole chunk, so that no cover changes
    return _met(asked, cells, _long(0), _long(end), slots, base_width, depth, seed, kernel)
