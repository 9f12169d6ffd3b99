"""Token sketches in one pass: BIGINT hashing against Python's integers, estimates against plain ones."""

from hashlib import md5
from statistics import median_low

import pytest
from pyspark.sql import functions as F

from freqscope import params
from freqscope.functions.hashing import affine_family, affine_mod_61
from freqscope.operators import sketch as S

PRIME = params.MERSENNE_61


def test_affine_mod_61_equals_whole_integers(spark):
    edges = [0, 1, 2, (1 << 31) - 1, 1 << 31, (1 << 32) - 1, 1 << 32, PRIME - 1, PRIME, PRIME + 1, (1 << 63) - 1, 1 << 63, (1 << 64) - 1]
    xs = edges + [int.from_bytes(md5(str(k).encode()).digest()[:8], "big") for k in range(200)]
    pairs = [(1, 0), (PRIME - 1, PRIME - 1), ((1 << 31) - 1, 5), (1 << 31, PRIME - 1), *affine_family("test", 5, PRIME)]
    rows = [(str(x), x >> 32, x & 0xFFFFFFFF, a >> 31, a & ((1 << 31) - 1), b, (a * x + b) % PRIME) for x in xs for a, b in pairs]
    df = spark.createDataFrame(rows, "x string, high long, low long, a1 long, a0 long, b long, want long")
    got = affine_mod_61(*[F.col(c) for c in ("high", "low", "a1", "a0", "b")])
    assert df.where(got != F.col("want")).count() == 0


@pytest.mark.parametrize("limit", [params.BROADCAST_BOUND_BYTES, 100_000, 0])
def test_estimates_by_either_join_equal_plain_ones(spark, monkeypatch, limit):
    """Limits under which all, some and no cells are broadcast give the same rows."""
    monkeypatch.setattr(params, "BROADCAST_BOUND_BYTES", limit)
    monkeypatch.setattr(S, "bounded_broadcast", lambda df, rows, size=0: F.broadcast(df) if S.broadcast_bytes(
        rows, len(df.columns), size) <= limit else df)
    counts = {f"t{k}é": 1 + k * k % 37 for k in range(300)} | {"": 4}
    specs = [(kind, width) for kind in ("cm", "cmedian", "csketch") for width in (16, 256)]
    parts = S.by_broadcast(specs)
    assert len(parts) == (2 if limit == 100_000 else 1) and sorted(sum(parts, [])) == sorted(specs)
    df = spark.createDataFrame(list(counts.items()), "token string, cnt long")
    got = {(r.sketch, r.R, r.token): (r.cnt, r.est) for part in parts for r in S.token_estimates(df, part).collect()}
    assert len(got) == len(specs) * len(counts)
    ids = {t: int.from_bytes(md5(t.encode()).digest()[:8], "big") for t in counts}
    for kind, width in specs:
        cols = affine_family(f"{kind}/{width}", params.TOKEN_DEPTH, PRIME)
        signs = affine_family(f"{kind}/{width}/sign", params.TOKEN_DEPTH, PRIME)
        place = lambda t, r: (cols[r][0] * ids[t] + cols[r][1]) % PRIME % width
        sign = lambda t, r: 1 - 2 * ((signs[r][0] * ids[t] + signs[r][1]) % PRIME % 2) if kind == "csketch" else 1
        cells = {}
        for t, n in counts.items():
            for r in range(params.TOKEN_DEPTH):
                cells[r, place(t, r)] = cells.get((r, place(t, r)), 0) + n * sign(t, r)
        for t, n in counts.items():
            values = [cells[r, place(t, r)] * sign(t, r) for r in range(params.TOKEN_DEPTH)]
            assert got[kind, width, t] == (n, min(values) if kind == "cm" else median_low(values))
