"""Bloom probes: broadcast words and shuffled positions answer alike."""

from pyspark.sql import functions as F

from freqscope.operators import bloom as B


def test_broadcast_and_shuffled_probes_agree(spark):
    m, k = 40_000, 3
    keys = spark.range(4000).withColumnRenamed("id", "key")
    probes = spark.range(2000, 8000).withColumnRenamed("id", "key")
    words = B.words(keys, "key", F.lit(m), F.lit(k))
    near = B.probe(words, probes, "key", F.lit(m), F.lit(k), bits=[m])
    far = B.probe(words, probes, "key", F.lit(m), F.lit(k))
    got = {r["key"]: r["present"] for r in near.collect()}
    assert got == {r["key"]: r["present"] for r in far.collect()}
    assert len(got) == 6000 and all(got[x] for x in range(2000, 4000)) and not all(got.values())
    assert words.count() == 2
    hashed = B.probe(words, B.digests(probes, "key"), "key", F.lit(m), F.lit(k), bits=[m])
    assert got == {r["key"]: r["present"] for r in hashed.collect()}


def test_positions_travel_packed_and_answer_as_plain_sets(spark, monkeypatch):
    """Several filters over several slices and blocks, no broadcast: as Python's sets say, in few rows."""
    from hashlib import sha256
    monkeypatch.setattr(B, "BLOCK_KEYS", 700)
    sizes = {"small": (50_000, 3), "wide": (3_000_017, 5)}
    cfg = F.explode(F.array(*[F.struct(F.lit(n).alias("cfg"), F.lit(m).cast("long").alias("m"), F.lit(k).cast("long").alias("k"))
                              for n, (m, k) in sizes.items()])).alias("c")

    def every(low, high):
        return spark.range(low, high).select(F.col("id").alias("key"), cfg).select("c.*", "key")

    def at(key, m, k):
        d = sha256(f"42:{key}".encode()).digest()
        h1, h2 = int.from_bytes(d[:8], "big") % m, 1 + 2 * (int.from_bytes(d[8:16], "big") % (m // 2))
        return {(h1 + i * h2) % m for i in range(k)}

    words = B.words(every(0, 3000), "key", F.col("m"), F.col("k"), ["cfg", "m", "k"])
    found = B.probe(words, every(2500, 4500), "key", F.col("m"), F.col("k"), ["cfg", "m", "k"])
    got = {(r["cfg"], r["key"]): r["present"] for r in found.collect()}
    want = {}
    for name, (m, k) in sizes.items():
        bits = set().union(*(at(x, m, k) for x in range(3000)))
        want.update({(name, x): at(x, m, k) <= bits for x in range(2500, 4500)})
    assert got == want and not all(want.values())
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence" not in plan  # no row per position


def test_null_keys_and_empty_filters(spark):
    probes = spark.createDataFrame([("a",), (None,)], "key string")
    words = B.words(probes.where("key is not null"), "key", F.lit(100), F.lit(3))
    assert {r["key"]: r["present"] for r in B.probe(words, probes, "key", F.lit(100), F.lit(3)).collect()} == {"a": True, None: False}
    none = B.words(probes.limit(0), "key", F.lit(100), F.lit(3))
    assert none.count() == 0
    assert not any(r["present"] for r in B.probe(none, probes, "key", F.lit(100), F.lit(3)).collect())


def test_lists_of_positions(spark):
    rows = spark.createDataFrame([("a", [1, 70_000, 5_000_000]), ("b", [2, 2, 9]), ("c", [1, 9])], "key string, at array<long>")
    words = B.words_of(rows.where("key <> 'c'"), "at")
    more = rows.union(spark.createDataFrame([("d", [1, 3])], rows.schema))
    assert {r["key"]: r["present"] for r in B.probe_lists(words, more, "at", ["key"]).collect()} == {"a": True, "b": True, "c": True, "d": False}
