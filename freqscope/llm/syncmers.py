"""Operator 9: document fingerprints from closed syncmers.

All k-mers of a text (``K`` code points) are looked at; one is kept if the least of
its inner s-mers (``S`` code points, by hash, the leftmost of equals) lies at its
first or last place.  The choice depends on the k-mer alone, so a passage yields the
same anchors wherever it stands, and at least one anchor every K - S + 1 places.

Fingerprint: for each anchor in order, the gap to the one before (1 byte) and 32
bits of its hash, in base64.  Texts below ``SHORT`` code points, which hold few long
k-mers, carry a second list after a colon, of k-mers of ``SMALL_K``.  Likeness of two
fingerprints: anchors are matched by hash, the n-th occurrence with the n-th; matches
vote for their shift in position, and those whose shift has at least ``VOTES`` votes
count.  Twice their number over the number of anchors of both is the likeness, 0 to 1.
It is taken on the second lists if both have one.

Defined results: a text shorter than k is one anchor, its whole text; a null or
empty text has the empty fingerprint, like only to another empty one; null ids come
last; rows that repeat an id follow in order of their texts; a single document is its
own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import field, map_arrow, table, text_or_empty

K, S = 24, 8
SHORT, SMALL_K, SMALL_S = 256, 8, 4
VOTES = 3
#: id ranges per shuffle partition; several even out the partitions
RANGES_A_PARTITION = 4
ROWS_AT_ONCE = 500
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _grams(x: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``n`` words: runs of doubling widths,
    joined by the binary digits of ``n``."""
    out, have, power, out_power = None, 0, _BASE, np.uint64(1)
    width = 1
    while True:
        if n & width:
            if out is None:
                out = x
            else:  # a run of ``width`` words, then the ``have`` words after it
                m = len(out) - width
                out = x[:m] * out_power + out[width:]
            have, out_power = have + width, out_power * power
        if width * 2 > n:
            return out
        x = x[:-width] * power + x[width:]
        power = power * power
        width *= 2


def _least(x: np.ndarray, places: int) -> np.ndarray:
    """Minimum of each run of ``places`` values, by doubling."""
    width = 1
    while width * 2 <= places:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = places - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)


Anchors = tuple[np.ndarray, np.ndarray]


def _whole(x: np.ndarray) -> Anchors:
    one = _mix(_grams(x, len(x)) + np.uint64(len(x))) >> np.uint64(32)
    return np.zeros(1, np.int64), one.astype(np.uint32)


def anchors(text: str, k: int = K, s: int = S, part: bool = False) -> Anchors:
    """(positions, 32-bit hashes) of the closed syncmers of a text.  A text too
    short to hold one is one anchor itself, unless it is ``part`` of another."""
    if not text or part and len(text) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    x = _code_points(text)
    with np.errstate(over="ignore"):
        if len(x) < k:
            return _whole(x)
        inner = (_mix(_grams(x, s)) >> np.uint64(32)).astype(np.uint32)
        places, n = k - s + 1, len(x) - k + 1
        before = _least(inner[:-1], places - 1)[:n]  # all inner s-mers but the last
        last = inner[places - 1:]
        where = np.flatnonzero((inner[:n] <= np.minimum(before, last)) | (last < before))
        if not len(where) and not part:
            return _whole(x)
        whole = _mix(_grams(x, k)[where]) >> np.uint64(32)
    return where, whole.astype(np.uint32)


@dataclass(frozen=True)
class Marks:
    """The anchors of a text: its long k-mers, and its small ones if it is short."""
    long: Anchors
    small: Anchors | None

    def fingerprint(self) -> str:
        return pack(*self.long) + ("" if self.small is None or not len(self.small[0]) else ":" + pack(*self.small))


def marks(text: str) -> Marks:
    return Marks(anchors(text), anchors(text, SMALL_K, SMALL_S) if len(text) < SHORT else None)


def marks_after_edit(old: Marks, kept: int, changed: str) -> Marks:
    """The marks of ``changed``, whose first ``kept`` code points are those of the
    text with the marks ``old``: anchors inside them stand, the rest is computed."""
    if len(changed) < SHORT or kept < K:
        return marks(changed)
    where, hashes = old.long
    stay = where <= kept - K
    more, new = anchors(changed[kept - K + 1:], part=True)
    return Marks((np.concatenate((where[stay], more + (kept - K + 1))), np.concatenate((hashes[stay], new))), None)


_ROW = np.dtype([("gap", "u1"), ("hash", "<u4")])


def pack(where: np.ndarray, hashes: np.ndarray) -> str:
    row = np.empty(len(where), _ROW)
    row["gap"] = np.diff(where, prepend=0)
    row["hash"] = hashes
    return base64.b64encode(row.tobytes()).decode()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    row = np.frombuffer(base64.b64decode(fingerprint), _ROW)
    return np.cumsum(row["gap"].astype(np.int64)), row["hash"].astype(np.uint32)


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash << 32 | occurrence number) ascending, and where each came from."""
    order = np.argsort(hashes, kind="stable")
    h = hashes[order].astype(np.uint64)
    new = np.concatenate(([True], h[1:] != h[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    return h << np.uint64(32) | (np.arange(len(h)) - first).astype(np.uint64), order


def parse(fingerprint: str) -> Marks:
    long, _, small = fingerprint.partition(":")
    return Marks(unpack(long), unpack(small) if small or not long else None)


def likeness(a: Marks, b: Marks) -> float:
    if a.small is not None and b.small is not None:
        return _matched(a.small, b.small)
    return _matched(a.long, b.long)


def _matched(a: Anchors, b: Anchors) -> float:
    n = len(a[0]) + len(b[0])
    if not n:
        return 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0
    ka, oa = _numbered(a[1])
    kb, ob = _numbered(b[1])
    _, i, j = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    shift = a[0][oa[i]] - b[0][ob[j]]
    _, which, votes = np.unique(shift, return_inverse=True, return_counts=True)
    need = min(VOTES, len(a[0]), len(b[0]))
    return 2.0 * int((votes[which] >= need).sum()) / n


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint): one narrow pass."""
    schema = T.StructType([field(docs, id_col), T.StructField("fingerprint", T.StringType())])

    def run(batch: pa.RecordBatch) -> list:
        return [batch.column(0), [marks(t).fingerprint() for t in batch.column(1).to_pylist()]]

    return map_arrow(docs.select(id_col, text_or_empty(text_col).alias("text")), run, schema)


# -- documents against their edited texts ------------------------------------

def edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _bounds_above(cuts: list) -> Column:
    """How many of the descending bounds are above ``id``: first by groups of about the
    square root of their number, then within one group."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k:k + step] for k in range(0, len(cuts), step)]
    above = lambda bounds: F.size(F.filter(bounds, lambda c: c > F.col("id")))
    whole = above(F.array(*[F.lit(g[-1]) for g in groups]))  # groups that lie above as a whole
    held = F.array(*[F.array(*[F.lit(c) for c in g]) for g in [*groups, groups[-1][:1]]])
    inside = F.when(whole < len(groups), above(F.element_at(held, whole + 1))).otherwise(0)
    return F.least(whole * step, F.lit(len(cuts))) + inside


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, extra, id, text) such that each bucket holds a range of ids and
    the first row after it, marked ``extra``.

    Bounds come from the ids alone, a few per shuffle partition; each bucket's extra
    row is its successor's first, so whole texts are shuffled once and no task holds
    more than one range."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    ids = rows.select("id")
    parts = RANGES_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)], 10_000).alias("c")).first()["c"] \
        if parts > 1 else None
    cuts = sorted(set(cuts or ()), reverse=True)
    # descending ids: bucket = number of bounds the id does not reach; nulls last
    bucket = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(_bounds_above(cuts))
    placed = rows.withColumn("bucket", bucket)
    heads = {r["bucket"]: r["head"] for r in
             ids.withColumn("bucket", bucket).groupBy("bucket").agg(F.max("id").alias("head")).collect()}
    order = sorted(heads)
    before = {b: order[k - 1] for k, b in enumerate(order)}  # the first bucket's head follows the last bucket
    if not order:
        return placed.select("bucket", F.lit(False).alias("extra"), "id", "text")
    links = spark.createDataFrame([(b, before[b], heads[b]) for b in order],
                                  T.StructType([T.StructField("bucket", T.IntegerType()),
                                                T.StructField("goes_to", T.IntegerType()),
                                                T.StructField("head", docs.schema[id_col].dataType)]))
    extra = (placed.join(F.broadcast(links), "bucket").where(F.col("id").eqNullSafe(F.col("head")))
             .groupBy("goes_to").agg(F.min_by("id", "text").alias("id"), F.min("text").alias("text"))
             .select(F.col("goes_to").alias("bucket"), F.lit(True).alias("extra"), "id", "text"))
    both = placed.select("bucket", F.lit(False).alias("extra"), "id", "text").unionByName(extra)
    return both.repartition("bucket").sortWithinPartitions(
        "bucket", "extra", F.col("id").desc_nulls_last(), "text")


def against_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and their likeness;
    also the likeness to the next document's fingerprint."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([
        field(docs, id_col), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (bucket, extra, id, text, marks) of the row before
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows: list[tuple] = []
                for now in zip(*[c.slice(at, ROWS_AT_ONCE).to_pylist() for c in batch.columns]):
                    found = marks(now[3])
                    if last is not None and last[0] == now[0] and not last[1]:
                        changed = edited(last[3], now[3])
                        other = marks_after_edit(last[4], len(last[3]) - len(last[3]) // 3, changed)
                        rows.append((last[2], len(last[3]), hashlib.sha256(changed.encode()).hexdigest(),
                                     last[4].fingerprint(), other.fingerprint(), likeness(last[4], other),
                                     likeness(last[4], found)))
                    last = (*now, found)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return _in_order(docs, id_col, text_col).mapInArrow(run, schema)


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return against_edits(table(spark, sf_dir, "documents"))
