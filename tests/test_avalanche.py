"""The avalanche jobs' array hashes equal the column hashes, and flips are counted key by key."""

import numpy as np
from pyspark.sql import functions as F

from freqscope import params as P
from freqscope.functions.hashing import md5_u64, poly_hash
from freqscope.plans import membership


def test_array_hashes_equal_the_columns(spark):
    xs = [0, 1, 9, 10, 123456789, 2 ** 31 - 1]
    out = 1 << P.AVALANCHE_OUTPUT_BITS
    a, b, c, d = membership.avalanche_coefficients()
    x = F.col("x")
    df = spark.createDataFrame([(v,) for v in xs], "x long").coalesce(1)
    columns = {"2-universal": poly_hash(x, [a, b], P.AVALANCHE_PRIME, out), "3-universal": poly_hash(x, [a, b, c], P.AVALANCHE_PRIME, out),
               "4-universal": poly_hash(x, [a, b, c, d], P.AVALANCHE_PRIME, out),
               "md5": F.pmod(md5_u64(x.cast("string")), F.lit(out).cast("decimal(20,0)")).cast("long")}
    want = df.select(*[v.alias(n) for n, v in columns.items()]).collect()
    for name, h in membership._hashes():
        assert h(np.array(xs)).tolist() == [r[name] for r in want], name


def test_flips_of_known_hashes(spark):
    keys = spark.createDataFrame([(3,), (5,), (-1,), (5 + (1 << 31),)], "key long").repartition(2)
    low = (1 << P.AVALANCHE_OUTPUT_BITS) - 1
    rows = membership._avalanche(keys, [("same", lambda x: x & low), ("both", lambda x: x & (x >> 1) & 1)])
    got = {(r["func"], r["input_bit"], r["output_bit"]): r["p"] for r in rows.collect()}
    assert len(got) == 2 * P.AVALANCHE_INPUT_BITS * P.AVALANCHE_OUTPUT_BITS
    assert all(p == (j == i) for (f, j, i), p in got.items() if f == "same")
    assert got["both", 0, 0] == 0.5 and got["both", 1, 0] == 1.0 and got["both", 2, 0] == 0.0
    assert membership._avalanche(keys.limit(0), membership._hashes()).count() == 0
