"""Operator 2: near-duplicates by SimHash, found with anchor points.

Fingerprint: 4-word shingles of the lower-cased text, each hashed with XXH64
(seed 42); a bit is 1 if it is set in over half of the hashes.  Fingerprints that
differ in at most four bits are linked.

Anchors: the 64 bits are cut into three blocks of 21, 21 and 22 bits, so two
linked fingerprints differ in at most one bit (the threshold, 4 // 3) of some
block.  In each block the anchors are a covering code, the Hamming code [15, 11]
times all words of the remaining bits: covering radius 1.  A fingerprint's home is
its nearest anchor (within the radius); copies of it go to each anchor within
radius plus threshold, 2 bits: about 14 an anchor block, 44 in all.  Each linked
pair meets at the home of either side, where all 64 bits are compared.  A covering
code of all 64 bits with the threshold 4 needs at least 830 copies for as few
comparisons, hence the blocks.

Groups: each task joins the links it finds into trees and hands on one edge per
fingerprint; rounds of large-star and small-star steps connect the trees.  Equal
fingerprints are one node from the start.  An anchor that is home to more than
``HOMES`` fingerprints is dealt out in slices; its copies go to every slice.

Defined results: a null or empty text, or one without words, has fingerprint zero,
linked like any other; fewer than four words are one shingle; repeated ids and
rows are kept, each with its component; null ids are kept, and are a component's
id only if it holds nothing else; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, map_arrow, stored, table, text_or_empty

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: (first bit, bits) of the blocks; the first 15 bits of a block carry the code
BLOCKS = ((0, 21), (21, 21), (42, 22))
CODE_BITS, RADIUS, STEP = 15, 1, MAX_BITS // len(BLOCKS)
HOMES = 2048
HOT_BROADCAST_ROWS = 100_000
DROP_BROADCAST_ROWS = 2_000_000

_BITS = np.array([[(b >> k) & 1 for k in range(8)] for b in range(256)], dtype=np.float64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())],
                 dtype=np.uint64)
    codes = h.astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256, dtype=np.int64)
    ones = (np.bincount(codes.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as the long with the same 64 bits."""
    schema = T.StructType([field(docs, id_col), T.StructField("fp", T.LongType())])

    def run(batch: pa.RecordBatch) -> list:
        fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        return [batch.column(0), pa.array(fps.view(np.int64))]

    return map_arrow(docs.select(id_col, text_or_empty(text_col).cast("binary").alias("text")), run, schema)


def _syndrome(v: np.ndarray) -> np.ndarray:
    """Of the 15 code bits: the xor of the numbers 1..15 of the bits that are set."""
    s = np.zeros(v.shape, dtype=np.int64)
    for k in range(CODE_BITS):
        s ^= np.where((v >> k) & 1, k + 1, 0)
    return s


def _masks(bits: int, reach: int) -> list[np.ndarray]:
    """By syndrome: the flips of at most ``reach`` bits that lead to an anchor."""
    from itertools import combinations
    flips = np.array([sum(1 << k for k in c) for n in range(reach + 1) for c in combinations(range(bits), n)])
    syn = _syndrome(flips)
    return [flips[syn == s] for s in range(1 << (CODE_BITS.bit_length()))]


_REACH = {bits: _masks(bits, RADIUS + STEP) for _, bits in BLOCKS}


def _block(fps: np.ndarray, block: int) -> np.ndarray:
    first, bits = BLOCKS[block]
    return ((fps.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _homes(fps: np.ndarray, block: int) -> np.ndarray:
    v = _block(fps, block)
    s = _syndrome(v)
    return (block << 22) | np.where(s > 0, v ^ (1 << np.maximum(s - 1, 0)), v)


def _anchor_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, fp) for every anchor within radius plus threshold."""
    fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    anchors, copies = [], []
    for block, (_, bits) in enumerate(BLOCKS):
        v = _block(fps, block)
        s = _syndrome(v)
        for syn, flips in enumerate(_REACH[bits]):
            at = np.flatnonzero(s == syn)
            if len(at) and len(flips):
                anchors.append(((block << 22) | (v[at, None] ^ flips)).ravel())
                copies.append(np.repeat(fps[at], len(flips)))
    return np.concatenate(anchors), np.concatenate(copies)


class _Forest:
    """Union-find over the links of one task; the least value is the root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.setdefault(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up[x]
        return top

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> pa.RecordBatch:
        kids = [x for x, y in self.up.items() if x != y]
        roots = [self.root(x) for x in kids]
        return pa.RecordBatch.from_arrays([pa.array(kids, pa.int64()), pa.array(roots, pa.int64())],
                                          names=["u", "v"])


_KEEP = 500_000  # fingerprints in a task's forest before it hands on its edges


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor and slice, homes first: only the homes of
        the current anchor slice are held, its copies stream past."""
        forest, now, held = _Forest(), None, np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, home, fp = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            fp = fp.astype(np.int64).view(np.uint64)
            cuts = np.flatnonzero(np.diff(key)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if key[a] != now:
                    now, held = key[a], np.empty(0, np.uint64)
                n = a + int(home[a:b].sum())
                if n > a:
                    held = np.concatenate([held, fp[a:n]])
                if not len(held):
                    continue
                wide = max(1, 4_000_000 // len(held))
                for c in range(a, b, wide):
                    y = fp[c:min(b, c + wide)]
                    i, j = np.nonzero(np.bitwise_count(held[:, None] ^ y[None, :]) <= max_bits)
                    differ = held[i] != y[j]
                    for p, q in zip(held[i[differ]].view(np.int64).tolist(), y[j[differ]].view(np.int64).tolist()):
                        forest.link(p, q)
            if len(forest.up) > _KEEP:
                yield forest.edges()
                forest = _Forest()
        yield forest.edges()

    return run


def link_edges(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Trees (u, v), u > v, that connect all fingerprints within ``max_bits``.

    ``distinct``: one long column ``fp`` without repetitions."""
    if max_bits // len(BLOCKS) > STEP:
        raise ValueError(f"the blocks carry thresholds below {len(BLOCKS) * (STEP + 1)} bits")
    rows = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("fp", T.LongType())])
    copies = map_arrow(distinct, lambda b: list(map(pa.array, _anchor_rows(b))), rows, 10_000)

    def homes(batch: pa.RecordBatch) -> list:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        return [pa.array(np.concatenate([_homes(fps, k) for k in range(len(BLOCKS))])),
                pa.array(np.tile(fps, len(BLOCKS)))]

    home = map_arrow(distinct, homes, rows, 10_000)
    hot = stored(home.groupBy("anchor").count().where(F.col("count") > HOMES)
                 .select("anchor", F.ceil(F.col("count") / HOMES).cast("int").alias("slices")), "hot-anchors")
    small = hot.count() <= HOT_BROADCAST_ROWS  # two numbers a row: a few MB at most
    both = (copies.withColumn("home", F.lit(False)).unionByName(home.withColumn("home", F.lit(True)))
            .join(F.broadcast(hot) if small else hot, "anchor", "left"))
    pick = F.when(F.col("slices").isNull(), F.array(F.lit(0))) \
        .when(F.col("home"), F.array(F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int"))) \
        .otherwise(F.sequence(F.lit(0), F.col("slices") - 1))
    cells = both.select(F.explode(pick).alias("slice"), "anchor", "home", "fp") \
        .select((F.col("anchor") + F.col("slice").cast("long") * (1 << 24)).alias("cell"), "home", "fp")
    return (cells.repartition("cell").sortWithinPartitions("cell", F.desc("home"))
            .mapInArrow(_links(max_bits), "u long, v long"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v -> (u, root) for every u that is not a root itself.

    Large-star and small-star steps until nothing changes; each round is one
    table in the shared folder, and only its count and checksum reach the driver."""
    def sign(df):
        return tuple(df.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first())

    now = stored(edges.distinct(), "edges")
    mark = sign(now)
    while mark[0]:
        after = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
        seen, mark = mark, sign(after)
        now = after
        if seen == mark:
            break
    return now.select("u", F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp, root, component): one row per row of ``docs``; ``root`` is the least
    fingerprint that links reach, ``component`` the smallest id there."""
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct-fingerprints")
    roots = components(link_edges(distinct.select("fp"), max_bits))
    rooted = distinct.join(roots, distinct["fp"] == roots["u"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return fps.join(rooted.join(least, "root").select("fp", "root", "component"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for each root, with all its columns: that of the least id
    (null if there is no other); among rows that repeat this id, that of the least text.

    Ids decide, so texts are not shuffled while the ids to drop fit a broadcast of
    ``DROP_BROADCAST_ROWS`` rows; beyond it Spark joins by shuffling.  Rows that
    share an id are looked at by (id, fingerprint)."""
    found = stored(near_duplicates(docs, id_col, text_col, max_bits, shingle), "near-duplicates")
    by_id = found.groupBy(F.col(id_col).alias("one_id")).agg(
        F.count("*").alias("rows"), F.min(F.col(id_col).eqNullSafe(F.col("component"))).alias("stays"))
    drop = stored(by_id.where("rows > 1 or not stays"), "dropped-ids")
    n = drop.agg(F.count("*"), F.count_if(F.col("rows") > 1)).first()
    fits = (lambda df: F.broadcast(df)) if n[0] <= DROP_BROADCAST_ROWS else (lambda df: df)
    once = docs.join(fits(drop), docs[id_col].eqNullSafe(drop["one_id"]), "left_anti")
    if not n[1]:
        return once
    again = drop.where("rows > 1")
    many = docs.join(fits(again), docs[id_col].eqNullSafe(again["one_id"]), "left_semi")
    cols = [F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    many = many.select(F.struct(*cols).alias("row"), F.col(id_col).alias("one_id"),
                       text_or_empty(text_col).alias("text"))
    schema = T.StructType([*many.schema.fields, T.StructField("fp", T.LongType())])

    def run(batch: pa.RecordBatch) -> list:
        fps = [fingerprint(t.encode(), shingle) for t in batch.column(2).to_pylist()]
        return [*batch.columns, pa.array(np.array(fps, dtype=np.uint64).view(np.int64))]

    heads = found.where(F.col(id_col).eqNullSafe(F.col("component"))) \
        .select(F.col(id_col).alias("head"), F.col("fp").alias("head_fp"), "root").distinct()
    best = (map_arrow(many, run, schema)
            .join(heads, F.col("one_id").eqNullSafe(F.col("head")) & (F.col("fp") == F.col("head_fp")))
            .groupBy("root").agg(F.min_by("row", "text").alias("row")))
    return once.unionByName(best.select(*[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)]))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
