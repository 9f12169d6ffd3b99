"""Hash families as Column expressions.

Coefficients come from a digest of the family's name and the row, and are inlined
as literals, so every executor (and DuckDB) evaluates the same function.  Wide
arithmetic uses DECIMAL(38,0) (products stay below 2^125 < 10^38); callers hash
distinct items, never raw events.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import params

U64 = "decimal(20,0)"
WIDE = "decimal(38,0)"


def _hex_u64(hex_digest: Column) -> Column:
    """First 8 bytes (16 hex digits) of a digest, big endian, unsigned."""
    return F.conv(F.substring(hex_digest, 1, 16), 16, 10).cast(U64)


def md5_u64(s: Column) -> Column:
    """Token id = first 8 bytes of md5, big endian."""
    return _hex_u64(F.md5(s))


def sha_row_index(item: Column, row: Column, seed: int, width: int | Column,
                  pow2: bool = True) -> Column:
    """sha256("{seed}-{row}-{item}") first 8 bytes mod width.

    For a power-of-two literal width up to 2^28 only the low 28 bits matter,
    so the fast path stays in BIGINT.  A width column is taken to hold powers
    of two up to 2^28 (the sweeps validate this) unless ``pow2`` is False.
    """
    digest = F.sha2(F.concat_ws("-", F.lit(str(seed)), row.cast("string"), item), 256)
    if (isinstance(width, int) and width > 0 and width & (width - 1) == 0
            and width <= 1 << 28) or (isinstance(width, Column) and pow2):
        low28 = F.conv(F.substring(digest, 10, 7), 16, 10).cast("bigint")
        w = F.lit(width) if isinstance(width, int) else width
        return F.pmod(low28, w).cast("bigint")
    w = width if isinstance(width, Column) else F.lit(width)
    return F.pmod(_hex_u64(digest), w.cast(U64)).cast("bigint")


@lru_cache(maxsize=None)
def affine_family(name: str, rows: int, p: int) -> tuple[tuple[int, int], ...]:
    """A pair (a, b) with 0 < a < p and 0 <= b < p for each row.

    Each row's pair is read from the SHA-256 of the family's name and the row's
    number, so families with different names are independent, and a family's first
    rows do not change when more are asked for."""
    def pair(row: int) -> tuple[int, int]:
        digest = hashlib.sha256(f"{name}/{row}".encode()).digest()
        return (1 + int.from_bytes(digest[:16], "big") % (p - 1), int.from_bytes(digest[16:], "big") % p)

    return tuple(pair(row) for row in range(rows))


def _affine_mod_p(x_u64: Column, a: int, b: int, p: int) -> Column:
    return F.pmod(F.lit(a).cast(WIDE) * x_u64 + F.lit(b).cast(WIDE), F.lit(p).cast(WIDE))


def affine_index(x_u64: Column, a: int, b: int, width: int, p: int = params.MERSENNE_61) -> Column:
    """((a x + b) mod P) mod R."""
    return F.pmod(_affine_mod_p(x_u64, a, b, p).cast("bigint"), F.lit(width)).cast("bigint")


def affine_sign(x_u64: Column, a: int, b: int, p: int = params.MERSENNE_61) -> Column:
    """+1 when ((a' x + b') mod P) is even, else -1."""
    v = _affine_mod_p(x_u64, a, b, p).cast("bigint")
    return F.when(F.pmod(v, F.lit(2)) == 0, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")


def _rotate_61(v: Column, k: int) -> Column:
    """v * 2^k mod 2^61 - 1, for 0 <= v < 2^61: the 61 bits turn."""
    low = F.shiftleft(v.bitwiseAND(F.lit((1 << (61 - k)) - 1)), k)
    return low + F.shiftright(v, 61 - k)


def affine_mod_61(high: Column, low: Column, a_high: Column, a_low: Column, b: Column) -> Column:
    """(a x + b) mod 2^61 - 1 in BIGINT alone, for x = high * 2^32 + low (32 bits each) and
    a = a_high * 2^31 + a_low.  All partial products stay below 2^63."""
    p = F.lit(params.MERSENNE_61)
    parts = [_rotate_61(F.pmod(a_high * high, p), 2), _rotate_61(F.pmod(a_high * low, p), 31), _rotate_61(F.pmod(a_low * high, p), 32)]
    return F.pmod(F.pmod(parts[0] + parts[1] + parts[2], p) + F.pmod(a_low * low, p) + b, p)


def minhash_family(n: int) -> tuple[tuple[int, int], ...]:
    """X11: the first ``n`` rows of the MinHash family."""
    return affine_family("minhash", n, params.MINHASH_PRIME)


def band_bucket(table: Column, band: Column, buckets: Column | None = None) -> Column:
    """X13 as an exact band id: md5("{table}:{v1,v2,...}"), 60 bits; reduced mod ``buckets``
    where that is given and above 0 (a table of that many buckets: different bands may share one)."""
    key = F.concat(table.cast("string"), F.lit(":"),
                   F.array_join(band.cast("array<string>"), ","))
    exact = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")
    return exact if buckets is None else F.when(buckets > 0, F.pmod(exact, F.greatest(buckets, F.lit(1)))).otherwise(exact)


def poly_hash(x: Column, coeffs, p: int, out_mod: int) -> Column:
    """Horner evaluation of sum(c_i x^(deg-i)) mod p, reduced every step
    (D9), then mod ``out_mod``.  With p < 2^21 and x < 2^31 every product stays
    below 2^52."""
    acc = F.lit(int(coeffs[0])).cast("bigint")
    for c in coeffs[1:]:
        acc = F.pmod(acc * x + F.lit(int(c)), F.lit(p))
    if len(coeffs) == 1:
        acc = F.pmod(acc, F.lit(p))
    return F.pmod(acc, F.lit(out_mod)).cast("bigint")


#: an UnsafeRow of n fields takes 8 + 8 n bytes; the hash relation adds a key copy
#: and map entries of about the same size again
def broadcast_bytes(rows: int, fields: int, string_bytes: int = 0) -> int:
    return rows * 2 * (8 + 8 * fields + string_bytes)


def bounded_broadcast(df: DataFrame, bound_rows: int, string_bytes: int = 0,
                      limit: int = params.BROADCAST_BOUND_BYTES) -> DataFrame:
    """Broadcast ``df`` only when a bound derived from job parameters (not from
    the data) proves it small; otherwise leave the choice to the planner/AQE.
    ``string_bytes``: a bound on the text of a row; a frame of unbounded text
    must not come here."""
    if broadcast_bytes(bound_rows, len(df.columns), string_bytes) <= limit:
        return F.broadcast(df)
    return df
