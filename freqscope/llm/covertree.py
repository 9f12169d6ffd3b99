"""Operator 6: exact top-k inner products by dual cover trees.

Vectors become integers (floor(64 x)).  Equal vectors are one point that keeps the
ids of its first 2 k rows, at most k rows an id: no query can want more.  Queries and candidates are dealt into
blocks, and each pair of blocks is one unit of work.  There both sides are indexed
by a cover tree: a node's children are centres more than half its radius apart that cover
its points, with the exact covering radius stored.  The trees are walked together;
for a query node (centre a, radius r) and a candidate node (centre b, radius s),

    a.b + r|b| + s|a| + r s

bounds every inner product between them, and the pair is pruned if the bound is below
the worst k-th score among the node's queries.  Pairs of leaves are multiplied.
The best points of each block pair, k and as many as a query's own id can hold, meet in
one ranking per query, ties to smaller ids.

Defined results: vectors that are null or hold a null or non-finite component take no
part, nor do null ids; vectors of another length than the first block's meet only
their like; repeated rows are candidates each; an id has one list, over all
its query rows, in which a repeated query row repeats its candidates; a query with fewer candidates gets all; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

K = 20
SCALE = 64
QUERY_EVERY = 20
#: points of a block: what one unit of work holds
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192
LEAF = 128


class Tree:
    """Cover tree over the rows of a matrix; nodes in arrays, leaves hold rows."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF) -> None:
        self.x, self.leaf = x, leaf
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.norm: list[float] = []
        self.children: list[list[int]] = []
        self.rows: list[np.ndarray] = []
        self.root = self._grow(np.arange(len(x)))

    def _node(self, rows: np.ndarray) -> tuple[int, np.ndarray]:
        """A node around the row next to the mean; its covering radius is exact."""
        p = self.x[rows]
        centre = p[np.argmin(((p - p.mean(axis=0)) ** 2).sum(axis=1))]
        away = np.sqrt(((p - centre) ** 2).sum(axis=1))
        self.centre.append(centre)
        self.radius.append(float(away.max()) * (1 + 1e-9))
        self.norm.append(float(np.sqrt((centre ** 2).sum())))
        self.children.append([])
        self.rows.append(rows)
        return len(self.centre) - 1, away

    def _grow(self, rows: np.ndarray) -> int:
        top, _ = self._node(rows)
        open_nodes = [top]
        while open_nodes:
            node = open_nodes.pop()
            rows = self.rows[node]
            if len(rows) <= self.leaf or self.radius[node] == 0.0:
                continue
            parts = self._cover(rows, self.centre[node], self.radius[node] / 2)
            if len(parts) == 1:
                continue
            # centres that cover a few points each are siblings in one leaf-to-be
            small = [p for p in parts if len(p) <= self.leaf // 8]
            parts = [p for p in parts if len(p) > self.leaf // 8]
            if small:
                loose = np.concatenate(small)
                if len(loose) == len(rows):
                    parts = [loose[k:k + self.leaf] for k in range(0, len(loose), self.leaf)]
                else:
                    parts.append(loose)
            for p in parts:
                child, _ = self._node(p)
                self.children[node].append(child)
                open_nodes.append(child)
            self.rows[node] = rows[:0]
        return top

    def _cover(self, rows: np.ndarray, first: np.ndarray, reach: float) -> list[np.ndarray]:
        """Greedy centres more than ``reach`` apart; each point joins the nearest."""
        p = self.x[rows]
        best = ((p - first) ** 2).sum(axis=1)
        owner = np.zeros(len(rows), np.int64)
        n = 1
        while True:
            far = int(np.argmax(best))
            if best[far] <= reach * reach or n >= 64:
                break
            d = ((p - p[far]) ** 2).sum(axis=1)
            closer = d < best
            owner[closer], best[closer] = n, d[closer]
            n += 1
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order])) + 1
        return [rows[q] for q in np.split(order, cuts)]


class Best:
    """Running best ``k`` scores and candidate rows of every query."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.row = np.full((n, k), -1, np.int64)
        self.worst = np.full(n, -np.inf)

    def offer(self, q: np.ndarray, score: np.ndarray, rows: np.ndarray) -> None:
        """``score``: queries by candidates.  Scores equal to the k-th stay only if
        there is room; callers break ties, so equal ones are kept by smaller row."""
        wins = score >= self.worst[q][:, None]
        live = np.flatnonzero(wins.any(axis=1))
        if not len(live):
            return
        both = np.concatenate((self.score[q[live]], np.where(wins[live], score[live], -np.inf)), axis=1)
        name = np.concatenate((self.row[q[live]], np.broadcast_to(rows, (len(live), len(rows)))), axis=1)
        # rows are numbered by smallest id, so ties go to the smaller number
        order = np.lexsort((name, -both), axis=1)[:, :self.k]
        self.score[q[live]] = np.take_along_axis(both, order, axis=1)
        self.row[q[live]] = np.take_along_axis(name, order, axis=1)
        self.worst[q[live]] = self.score[q[live]][:, -1]


def dual_search(queries: Tree, points: Tree, best: Best) -> int:
    """Walk pairs of nodes, the most promising first; returns the leaf products."""
    def bound(a: int, b: int) -> float:
        return float(queries.centre[a] @ points.centre[b]) + queries.radius[a] * points.norm[b] \
            + points.radius[b] * queries.norm[a] + queries.radius[a] * points.radius[b] + 1e-6

    def group(a: int) -> np.ndarray:
        return queries.rows[a] if len(queries.rows[a]) else np.concatenate([group(c) for c in queries.children[a]])

    members = [group(a) for a in range(len(queries.centre))]
    length = np.sqrt((queries.x ** 2).sum(axis=1))
    products, stack = 0, [(bound(queries.root, points.root), queries.root, points.root)]
    while stack:
        most, a, b = stack.pop()
        if most < best.worst[members[a]].min():
            continue
        ca, cb = queries.children[a], points.children[b]
        if ca and (not cb or queries.radius[a] > points.radius[b]):
            pairs = [(bound(c, b), c, b) for c in ca]
        elif cb:
            pairs = [(bound(a, c), a, c) for c in cb]
        else:
            own, rows = members[a], points.rows[b]
            reach = queries.x[own] @ points.centre[b] + length[own] * points.radius[b] + 1e-6
            live = own[reach >= best.worst[own]]
            if len(live):
                best.offer(live, queries.x[live] @ points.x[rows].T, rows)
                products += len(live) * len(rows)
            continue
        stack += sorted(pairs)  # the highest bound is taken next
    return products


# -- on Spark ----------------------------------------------------------------

def whole_numbers(vector: str) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound) \
        .select(F.col(id_col).cast("long").alias("id"), whole_numbers(vector_col).alias("v"))


def _matrix(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, rows as one float matrix per common length is taken by callers)."""
    whole = column.combine_chunks()
    at = whole.offsets.to_numpy()
    return np.diff(at), whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def _by_length(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """length -> (row numbers, matrix)."""
    lengths, flat = _matrix(column)
    starts = np.cumsum(lengths) - lengths
    out = {}
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        out[n] = rows, flat[starts[rows][:, None] + np.arange(n)]
    return out


def _search_unit(k: int, leaf: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: (query block, candidate block, id, v); right: the same and ids."""
        out = {"qid": [], "score": [], "ids": []}
        if left.num_rows and right.num_rows:
            left = left.sort_by("id")
            right = right.sort_by("id")  # so that row numbers follow the smallest ids
            qid, ids = left["id"].to_numpy(), right["ids"]
            points = _by_length(right["v"])
            for n, (q_rows, q) in _by_length(left["v"]).items():
                if n not in points:
                    continue
                p_rows, p = points[n]
                best = Best(len(q), k)
                dual_search(Tree(q, leaf), Tree(p, leaf), best)
                a, b = np.nonzero(best.row >= 0)
                hit = best.row[a, b]
                out["qid"].append(qid[q_rows[a]])
                out["score"].append(best.score[a, b].astype(np.int64))
                out["ids"].append(ids.take(pa.array(p_rows[hit])))
        join = lambda parts: np.concatenate([*parts, np.empty(0, np.int64)])
        ids = pa.chunked_array([c for part in out["ids"] for c in part.chunks], type=pa.list_(pa.int64()))
        return pa.table({"qid": pa.array(join(out["qid"]), pa.int64()), "score": pa.array(join(out["score"]), pa.int64()),
                         "ids": ids.combine_chunks() if len(ids) else pa.array([], pa.list_(pa.int64()))})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK, leaf: int = LEAF) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id of ``queries`` the ``k`` best pairs of
    its rows and rows of ``vectors`` with another id.  Inner products must stay below 2 ** 53."""
    all_points, asked = _usable(vectors, id_col, vector_col), _usable(queries, id_col, vector_col)
    rows_of = lambda df: df.groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("times"))
    repeat = lambda items, item, times: F.flatten(F.transform(items, lambda s: F.array_repeat(item(s), times(s))))
    counted, asked = stored(rows_of(all_points), "vector-rows"), stored(rows_of(asked), "query-rows")
    # points that may hold nothing but a query's own id
    own = counted.join(asked.select("id").distinct(), "id", "left_semi").groupBy("id").count().agg(F.max("count")).first()[0] or 0
    room, rows_kept = k + own, k * (1 + own)
    # at most 2 k ids of equal vectors: Spark cuts each task's share before the shuffle
    same = Window.partitionBy("v").orderBy("id")
    points = stored(counted.withColumn("n", F.row_number().over(same)).where(F.col("n") <= 2 * k)
                    .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", "times"))).alias("ids"))
                    .select("v", F.slice(repeat("ids", lambda s: s["id"], lambda s: s["times"]), 1, 2 * k).alias("ids"))
                    .withColumn("id", F.element_at("ids", 1)), "points")
    # numbered, as an id may ask with several vectors
    distinct = stored(asked.select("v").distinct().withColumn("id", F.monotonically_increasing_id()), "query-points")
    n_q = max(1, -(-distinct.count() // query_block))
    n_c = max(1, -(-points.count() // candidate_block))
    number = lambda n: F.pmod(F.xxhash64("v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = distinct.withColumn("q", number(n_q)).select("q", every(n_c).alias("c"), "id", "v")
    right = points.withColumn("c", number(n_c)).select(every(n_q).alias("q"), "c", "id", "v", "ids")
    found = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")) \
        .applyInArrow(_search_unit(room, leaf), "qid long, score long, ids array<long>")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), F.element_at("ids", 1))
    pairs = F.flatten(F.transform("points", lambda p: F.transform(
        p["ids"], lambda i: F.struct((-p["score"]).alias("less"), i.alias("id")))))
    lists = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= room)
             .groupBy("qid").agg(F.collect_list(F.struct("score", "ids")).alias("points"))
             .select("qid", F.slice(F.array_sort(pairs), 1, rows_kept).alias("best")))
    by_vector = distinct.join(lists, distinct["id"] == lists["qid"]).select("v", "best")
    others = F.slice(F.filter("best", lambda s: s["id"] != F.col("query_id")), 1, k)
    merged = Window.partitionBy("query_id").orderBy("hit.less", "hit.id")
    return (asked.withColumnRenamed("id", "query_id").join(by_vector, "v")
            .select("query_id", F.explode(repeat(others, lambda s: s, lambda s: F.col("times"))).alias("hit"))
            .withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("hit.id").alias("vec_id"), (-F.col("hit.less")).alias("score")))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


OP6_SQL = f"""
    WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
