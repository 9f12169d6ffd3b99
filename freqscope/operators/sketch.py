"""Linear frequency sketches as cell tables.

A sketch is a DataFrame ``(key..., row, col, cnt)`` with zero cells absent.
Building one is ``pre-aggregate per (key, item)`` -> ``explode depth rows`` ->
``groupBy(key, row, col).sum``; reading one joins probe rows ``(item, row,
col)`` to the cells and takes a min (Count-Min), a median (Count-Median) or a
signed median (Count-Sketch) per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params
from ..functions.hashing import (affine_family, affine_mod_61, bounded_broadcast, broadcast_bytes,
                                 sha_row_index)


# ----------------------------------------------------------------------------
# Seeded sha256 family (windowed models)
# ----------------------------------------------------------------------------

def rows_of(df: DataFrame, depth: int) -> DataFrame:
    return df.withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                     F.lit(depth - 1).cast("bigint"))))


def event_cells(counts: DataFrame, keys: list[str], depth: int, width, seed: int,
                item: str = "item", cnt: str = "cnt") -> DataFrame:
    """``counts`` is already aggregated per (keys, item); hashing
    runs once per such row, never per raw event."""
    wcols = [] if isinstance(width, int) else [width]
    exploded = rows_of(counts.select(*dict.fromkeys([*keys, *wcols, item, cnt])), depth)
    col = sha_row_index(F.col(item), F.col("row"), seed,
                        width if isinstance(width, int) else F.col(width))
    return (exploded.withColumn("col", col)
            .groupBy(*keys, "row", "col").agg(F.sum(cnt).alias("cnt")))


def event_probes(items: DataFrame, depth: int, width, seed: int, item: str = "item",
                 extra: list[str] | None = None) -> DataFrame:
    """Probe rows ``(item, row, col)`` for a point query."""
    extra = extra or []
    exploded = rows_of(items.select(item, *extra), depth)
    col = sha_row_index(F.col(item), F.col("row"), seed,
                        width if isinstance(width, int) else F.col(width))
    return exploded.withColumn("col", col)


def cm_min(probes: DataFrame, cells: DataFrame, join_keys: list[str], group_keys: list[str],
           depth: int, value: str = "cnt") -> DataFrame:
    """J1 per group: min over the ``depth`` rows; a missing cell reads 0, so a
    group with fewer than ``depth`` matched rows estimates 0."""
    joined = probes.join(cells, join_keys)
    return (joined.groupBy(*group_keys)
            .agg(F.min(value).alias("m"), F.count(F.lit(1)).alias("n"))
            .select(*group_keys,
                    F.when(F.col("n") == depth, F.col("m")).otherwise(F.lit(0)).alias("est")))


def mean_min(probes: DataFrame, cells: DataFrame, join_keys: list[str], group_keys: list[str], width: int,
             depth: int, value: str = "cnt", row_keys: list[str] | None = None) -> DataFrame:
    """G17's read, over linear cells: each row's cell less the mean of its other cells
    (the noise expected of collisions), the least of the rows, at least 0.

    ``row_keys``: the columns of ``cells`` that tell sketches apart; a row's total is the sum of its cells."""
    totals = cells.groupBy(*(row_keys or []), "row").agg(F.sum(value).alias("total"))
    met = probes.join(cells, join_keys).join(totals, [*(row_keys or []), "row"])
    noise = (F.col("total") - F.col(value)) / F.lit(float(max(1, width - 1)))
    least = met.groupBy(*group_keys).agg(F.min(F.col(value) - (noise if width > 1 else F.lit(0.0))).alias("m"),
                                         F.count("*").alias("n"))
    # a row without a cell reads 0 less noise, so the estimate is 0
    return least.select(*group_keys, F.when(F.col("n") == depth, F.greatest("m", F.lit(0.0))).otherwise(F.lit(0.0)).alias("est"))


# ----------------------------------------------------------------------------
# 2-universal family over md5 token ids (query-log sketches)
# ----------------------------------------------------------------------------

#: (sketch kind, width)
Spec = tuple[str, int]
CELL = ["sketch", "R", "row", "col"]


def _family_rows(specs: list[Spec], depth: int) -> Column:
    """The coefficients of every sketch row as one literal array.  Each sketch kind and width has a family
    of its own, so their errors are independent; only Count-Sketch has signs."""
    long = lambda v: F.lit(v).cast("bigint")
    cut = lambda a, b: (a >> 31, a & ((1 << 31) - 1), b)
    out = []
    for kind, width in specs:
        cols = affine_family(f"{kind}/{width}", depth, params.MERSENNE_61)
        signs = affine_family(f"{kind}/{width}/sign", depth, params.MERSENNE_61) if kind == "csketch" else [(0, 0)] * depth
        for row in range(depth):
            values = zip(("a1", "a0", "b", "s1", "s0", "t"), (*cut(*cols[row]), *cut(*signs[row])))
            out.append(F.struct(F.lit(kind).alias("sketch"), long(width).alias("R"), long(row).alias("row"),
                                *[long(v).alias(n) for n, v in values]))
    return F.array(*out)


def sketch_positions(tokens: DataFrame, specs: list[Spec], depth: int = params.TOKEN_DEPTH,
                     token: str = "token", extra: list[str] | None = None) -> DataFrame:
    """``(token, extra..., sketch, R, row, col, sign)`` of every distinct token, for all sketches
    in one pass: the token is hashed once, and the families' coefficients are rows."""
    extra = extra or []
    digest = F.md5(F.col(token))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
    hashed = tokens.select(token, *extra, half(1).alias("_high"), half(9).alias("_low"))
    met = hashed.select(token, *extra, "_high", "_low", F.explode(_family_rows(specs, depth)).alias("_f"))
    affine = lambda a1, a0, b: affine_mod_61(F.col("_high"), F.col("_low"), F.col(f"_f.{a1}"), F.col(f"_f.{a0}"), F.col(f"_f.{b}"))
    odd = F.pmod(affine("s1", "s0", "t"), F.lit(2))
    sign = F.when(F.col("_f.sketch") == "csketch", 1 - 2 * odd).otherwise(F.lit(1)).cast("bigint")
    return met.select(token, *extra, "_f.sketch", "_f.R", "_f.row", F.pmod(affine("a1", "a0", "b"), F.col("_f.R")).alias("col"),
                      sign.alias("sign"))


def sketch_cells(positions: DataFrame, cnt: str = "cnt") -> DataFrame:
    """Cells of all sketches in ``positions``: (sketch, R, row, col, cell)."""
    return positions.groupBy(*CELL).agg(F.sum(F.col(cnt) * F.col("sign")).cast("bigint").alias("cell"))


def sketch_estimates(positions: DataFrame, cells: DataFrame, keys: list[str], depth: int = params.TOKEN_DEPTH) -> DataFrame:
    """``(sketch, R, keys..., est)``: the least or the (signed) median of a key's cells.  The rows' values stand in
    ``depth`` columns, so the grouping keeps no lists; a row without a cell reads 0."""
    value = F.col("cell") * F.col("sign")
    met = positions.join(cells, CELL).groupBy("sketch", "R", *keys).agg(
        *[F.max(F.when(F.col("row") == r, value)).alias(f"_v{r}") for r in range(depth)])
    values = F.array(*[F.coalesce(F.col(f"_v{r}"), F.lit(0)).cast("bigint") for r in range(depth)])
    est = F.when(F.col("sketch") == "cm", F.array_min(values)).otherwise(_median_of(F.sort_array(values), depth))
    return met.select("sketch", "R", *keys, est.cast("bigint").alias("est"))


def token_positions(tokens: DataFrame, width: int, kind: str, depth: int = params.TOKEN_DEPTH,
                    token: str = "token", extra: list[str] | None = None) -> DataFrame:
    """``(token, extra..., row, col, sign)`` per distinct token and row."""
    return sketch_positions(tokens, [(kind, width)], depth, token, extra).drop("sketch", "R")


def token_cells(counts: DataFrame, width: int, kind: str, depth: int = params.TOKEN_DEPTH,
                token: str = "token", cnt: str = "cnt", keys: list[str] | None = None) -> DataFrame:
    """G8-G10 cells from exact per-token counts; the positions are computed
    inline, once per distinct token."""
    keys = keys or []
    pos = token_positions(counts, width, kind, depth, token, extra=[*keys, cnt])
    return (pos.groupBy(*keys, "row", "col")
            .agg(F.sum(F.col(cnt) * F.col("sign")).cast("bigint").alias("cnt")))


def _median_of(sorted_arr: Column, n: int) -> Column:
    """Middle element; even length takes floor of the mean of the two
    middle values (floor, not truncation, for negative signed sums)."""
    m = n // 2
    if n % 2:
        return F.element_at(sorted_arr, m + 1)
    lo = F.element_at(sorted_arr, m)
    hi = F.element_at(sorted_arr, m + 1)
    return F.floor((lo + hi) / F.lit(2)).cast("bigint")


def token_estimates(counts: DataFrame, specs: list[Spec], depth: int = params.TOKEN_DEPTH,
                    token: str = "token", cnt: str = "cnt") -> DataFrame:
    """``(sketch, R, token, cnt, est)`` of every token, for all sketches in one plan.

    Cells are bounded by depth x width rows, a parameter, so they are
    broadcast when that bound is small; otherwise the join shuffles."""
    positions = sketch_positions(counts, specs, depth, token, [cnt])
    small = bounded_broadcast(sketch_cells(positions, cnt), cell_bound(specs, depth), KIND_BYTES)
    return sketch_estimates(positions, small, [token, cnt], depth)


#: a sketch's name in a row
KIND_BYTES = 16


def by_broadcast(specs: list[Spec], depth: int = params.TOKEN_DEPTH) -> list[list[Spec]]:
    """The sketches whose cells together may be broadcast, and the rest."""
    small: list[Spec] = []
    for spec in sorted(specs, key=lambda x: x[1]):
        if broadcast_bytes(cell_bound([*small, spec], depth), len(CELL) + 1, KIND_BYTES) > params.BROADCAST_BOUND_BYTES:
            break
        small.append(spec)
    return [part for part in (small, [x for x in specs if x not in small]) if part]


def cell_bound(specs: list[Spec], depth: int) -> int:
    return depth * sum(width for _, width in specs)


# ----------------------------------------------------------------------------
# Merge and fold
# ----------------------------------------------------------------------------

def merge_cells(*cell_frames: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sketches with the same shape and seed add cell-wise."""
    keys = keys or []
    u = cell_frames[0]
    for c in cell_frames[1:]:
        u = u.unionByName(c)
    return u.groupBy(*keys, "row", "col").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def fold_cells(cells: DataFrame, new_width: int, keys: list[str] | None = None) -> DataFrame:
    """G12 (D3): fold by ``col mod new_width``, which keeps lookups by
    ``hash mod new_width`` correct when new_width divides the old width."""
    keys = keys or []
    return (cells.groupBy(*keys, "row", F.pmod(F.col("col"), F.lit(new_width)).alias("col"))
            .agg(F.sum("cnt").cast("bigint").alias("cnt")))
