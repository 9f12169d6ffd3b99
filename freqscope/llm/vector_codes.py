"""Operator 13: product codes of vectors, fitted and assigned on metric trees.

A vector's components become integers, its parts are coded by the nearest entry of a codebook
each.  Rows are cut into blocks of ``BLOCK``; a block is one row of a stored table and
holds its points and one metric tree per part (``metric_tree``: anchors hierarchy, balls with
cached sums and counts).  A round sends the codebooks to all blocks (entries times
dimensions numbers, whatever the table's size), each task adds up its blocks, and one small
aggregate returns the entries' sums and counts.  All sums are of integers, hence
independent of the partitioning.  The last pass assigns once more and adds up errors.

Errors per label come from a sum with partial aggregation; they are joined back in salted
slices, so a label of any share of the rows, or any number of labels, is spread out.

Defined results: vectors that are null or hold null or non-finite components take no part; so do
vectors of another length than that of the first seed (the smallest id's).  Null ids are
coded but seed nothing unless all ids are null; among equal ids the smaller vector seeds first;
repeated rows count each.  Fewer rows than entries give as many entries.  A length that ``parts`` does
not divide makes the first parts longer by one; an empty table gives an empty result; other
columns are ignored.  Components whose squares add up to 2^52 or more raise ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table
from .metric_tree import Tree, build, codes, entry_sums

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
BLOCK = 4096
LABEL_SLICES = 64
_TREE = T.StructType([T.StructField(n, T.ArrayType(t)) for n, t in (
    ("order", T.IntegerType()), ("lo", T.IntegerType()), ("hi", T.IntegerType()), ("left", T.IntegerType()),
    ("right", T.IntegerType()), ("centre", T.DoubleType()), ("radius", T.DoubleType()), ("sums", T.DoubleType()))])


def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(id, label, v): v the integer components, of rows whose components are all finite."""
    x = F.col(vec_col)
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return vectors.where(F.coalesce(good, F.lit(False))) \
        .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), whole.alias("v"))


def _cuts(dims: int, parts: int) -> list[slice]:
    at = np.concatenate(([0], np.cumsum([len(p) for p in np.array_split(np.arange(dims), parts)])))
    return [slice(int(a), int(b)) for a, b in zip(at[:-1], at[1:])]


def tree_blocks(kept: DataFrame, dims: int, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """(ids, labels, points, trees): one row per block of rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = T.StructType([T.StructField("ids", T.ArrayType(kept.schema["id"].dataType)),
                           T.StructField("labels", T.ArrayType(kept.schema["label"].dataType)),
                           T.StructField("points", T.ArrayType(T.LongType())), T.StructField("trees", T.ArrayType(_TREE))])
    arrow, cuts = to_arrow_schema(schema), _cuts(dims, parts)

    def row(rows: pa.Table) -> pa.RecordBatch:
        points = rows["v"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, dims)
        size = float(np.abs(points).max(initial=0))
        if dims * 4 * size * size >= 2.0 ** 53:
            raise ValueError(f"components of {size} are too large for exact distances")
        trees = []
        for c in cuts:
            t = build(points[:, c].astype(float))
            trees.append({n: getattr(t, n).ravel() for n in _TREE.names})
        cols = [[rows["id"].combine_chunks().to_pylist()], [rows["label"].combine_chunks().to_pylist()], [points.ravel()], [trees]]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block:
                rows = pa.Table.from_batches(held)
                yield row(rows.slice(0, block))
                held = rows.slice(block).to_batches()
        rows = pa.Table.from_batches(held) if held else None
        if rows is not None and rows.num_rows:
            yield row(rows)

    return kept.where(F.size("v") == dims).mapInArrow(run, schema)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, cuts: list[slice]):
    """Each block as (batch, row, [(tree, points of the part)])."""
    for batch in batches:
        for k in range(batch.num_rows):
            points = batch.column("points")[k].values.to_numpy().reshape(-1, dims).astype(float)
            trees = batch.column("trees")[k].values
            out = []
            for p, c in enumerate(cuts):
                part = {n: trees.field(n)[p].values.to_numpy() for n in _TREE.names}
                for n in ("centre", "sums"):
                    part[n] = part[n].reshape(len(part["lo"]), -1)
                out.append((Tree(**part), np.ascontiguousarray(points[:, c])))
            yield batch, k, out


def refine(blocks: DataFrame, books: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """One round: every part to its nearest entry, entries to the floored means."""
    cuts = _cuts(dims, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [(np.zeros(b.shape), np.zeros(len(b))) for b in books]
        for _, _, parts in _blocks(batches, dims, cuts):
            for (tree, points), book, (s, n) in zip(parts, books, total):
                more, count = entry_sums(tree, points, book)
                s += more
                n += count
        for p, (s, n) in enumerate(total):
            used = np.flatnonzero(n)
            columns = [np.full(len(used), p), used, n[used].astype(np.int64)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(list(s[used].astype(np.int64)), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"])

    sums = blocks.select("points", "trees").mapInArrow(run, "part long, entry long, n long, sums array<long>")
    sums = stored(sums.select("part", "entry", F.posexplode("sums").alias("place", "s"), "n")
                  .groupBy("part", "entry", "place").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), "entry-sums")
    new = [b.copy() for b in books]
    for r in sums.collect():  # at most entries times dimensions numbers
        new[r["part"]][r["entry"], r["place"]] = r["s"] // r["n"]
    return new


def fit(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
        scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK):
    """(blocks, codebooks, dims): the stored trees, and one matrix of entries per part."""
    kept = kept_vectors(vectors, id_col, vec_col, label_col, scale)
    first = kept.orderBy(F.asc_nulls_last("id"), "v").select("id", "v")
    head = first.limit(1).collect()
    dims = len(head[0]["v"]) if head else 0
    some = F.col("id").isNotNull() if head and head[0]["id"] is not None else F.lit(True)
    seeds = first.where((F.size("v") == dims) & some).limit(entries).collect()
    start = np.array([r["v"] for r in seeds], float).reshape(len(seeds), dims)
    books = [np.ascontiguousarray(start[:, c]) for c in _cuts(dims, parts)]
    blocks = stored(tree_blocks(kept, dims, parts, block), "tree-blocks")
    for _ in range(rounds if seeds else 0):
        books = refine(blocks, books, dims)
    return blocks, books, dims


def encode(blocks: DataFrame, books: list[np.ndarray], dims: int) -> DataFrame:
    """(id, label, code, error): one row per row of the blocks."""
    cuts = _cuts(dims, len(books))
    id_type, label_type = (blocks.schema[c].dataType.elementType for c in ("ids", "labels"))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("label", label_type),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, parts in _blocks(batches, dims, cuts):
            ids = batch.column("ids")[k].values
            found = [codes(tree, points, book) for (tree, points), book in zip(parts, books)]
            error = sum(((points - book[c]) ** 2).sum(axis=1) for (_, points), book, c in zip(parts, books, found))
            text = ["".join([f"{c:02x}" for c in row]) for row in np.stack(found, axis=1).tolist()]
            yield pa.RecordBatch.from_arrays(
                [ids, batch.column("labels")[k].values, pa.array(text, pa.string()), pa.array(error.astype(np.int64))],
                names=["id", "label", "code", "error"])

    return blocks.mapInArrow(run, schema)


def codebook_digest(books: list[np.ndarray]) -> str:
    numbers = (str(int(x)) for book in books for x in book.ravel())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 **settings) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every kept row."""
    blocks, books, dims = fit(vectors, id_col, vec_col, label_col, **settings)
    coded = stored(encode(blocks, books, dims), "vector-codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")) \
        .select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SLICES - 1))).alias("at"))
    mine = coded.withColumn("slice", F.pmod(F.xxhash64("id", "code"), F.lit(LABEL_SLICES)).cast("int"))
    return (mine.join(by_label, (F.col("slice") == F.col("at")) & F.col("label").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id_col), "code", "error", "label_error",
                    F.lit(codebook_digest(books)).alias("codebooks_sha256")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))
