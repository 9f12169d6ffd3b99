"""Near-duplicate URL search over ``pages.url`` (S4, U3, X2, G19, G20, J6-J8,
W9, G29, E7, X16)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import params
from ..operators import lsh
from ..functions.hashing import bounded_broadcast
from ..session import cut_lineage
from ..sources.tables import distinct_urls

P = params
R = params.ROUND_DIGITS


class UrlJob:
    """Distinct URLs, their shingles and, where asked for, their signatures, written
    once because the index, the queries and the exact side all read them."""

    def __init__(self, spark: SparkSession, sf_dir: str, K: int = P.LSH_K, L: int = P.LSH_L, hashes: int = 0):
        self.spark, self.K, self.L = spark, K, L
        # few bytes but much work a row: a fixed count, as merging these partitions by size would leave few tasks
        self.urls = distinct_urls(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "url")
        self.sh = lsh.url_shingles(self.urls)
        if hashes:
            self.sh = cut_lineage(lsh.signatures(self.sh, hashes))
        self.queries = lsh.sample_queries(self.sh)
        self.q_sh = self.sh.join(bounded_broadcast(self.queries.select(F.col("query").alias("url")),
                                                   P.LSH_NUM_QUERIES, P.URL_BYTES), "url", "left_semi")

    def index(self):
        return lsh.bands(self.sh, self.K, self.L)

    def candidates(self):
        return lsh.candidates(self.index(), lsh.bands(self.q_sh, self.K, self.L))

    def scored(self):
        return lsh.with_jaccard(self.candidates(), self.sh, self.q_sh)

    def exact_top10(self):
        return lsh.nearest(self.sh, self.q_sh)


def _indexed(spark, sf_dir) -> UrlJob:
    return UrlJob(spark, sf_dir, hashes=P.LSH_K * P.LSH_L)


def url_shingles(spark, sf_dir):
    """Distinct shingles of every distinct URL."""
    j = UrlJob(spark, sf_dir)
    return j.sh.select("url", F.explode("sh").alias("shingle"))


def minhash_signatures(spark, sf_dir):
    """K*L MinHash values per URL."""
    j = _indexed(spark, sf_dir)
    return j.sh.select("url", F.posexplode("sig").alias("idx", "minhash")) \
        .select("url", F.col("idx").cast("bigint").alias("idx"), "minhash")


def lsh_buckets(spark, sf_dir):
    """The band bucket of every URL in each of the L tables."""
    return _indexed(spark, sf_dir).index()


def lsh_candidates(spark, sf_dir):
    """Candidates of the sampled queries (self excluded)."""
    return _indexed(spark, sf_dir).candidates()


def lsh_pruned(spark, sf_dir):
    """Candidates under bands of ``LSH_PRUNE_K`` values, which drop most pairs, with exact
    band ids (B = 0) and with tables of B buckets, where different bands may meet; per B the
    pairs, their share of all query/URL pairs and the mean Jaccard index of what is left."""
    K, L, sizes = P.LSH_PRUNE_K, P.LSH_PRUNE_L, P.LSH_BUCKETS
    j = UrlJob(spark, sf_dir, K, L, hashes=K * L)
    every = F.explode(F.array(*[F.lit(b).cast("bigint") for b in sizes]))

    def index(sig):
        return lsh.bands(sig.withColumn("B", every), K, L, ["B"], F.col("B"))

    pairs = lsh.candidates(index(j.sh), index(j.q_sh), ["B"], L, len(sizes))
    scored = lsh.with_jaccard(pairs, j.sh, j.q_sh)
    found = scored.groupBy("B").agg(F.count("*").cast("bigint").alias("n_pairs"), F.avg("jaccard").alias("mean"))
    n = j.sh.agg(F.count("*").cast("double").alias("n_urls"))
    q = j.queries.agg(F.count("*").cast("double").alias("n_queries"))
    rows = spark.createDataFrame([(b,) for b in sizes], "B bigint")
    possible = F.col("n_queries") * (F.col("n_urls") - 1)
    return rows.join(found, "B", "left").join(n, F.lit(True)).join(q, F.lit(True)).select(
        "B", F.coalesce("n_pairs", F.lit(0)).cast("bigint").alias("n_pairs"),
        F.round(F.when(possible > 0, F.coalesce("n_pairs", F.lit(0)) / possible).otherwise(0.0), R).alias("share"),
        F.round(F.coalesce("mean", F.lit(0.0)), R).alias("mean_jaccard"))


def lsh_top10(spark, sf_dir):
    """The ten most similar candidates per query, by exact Jaccard."""
    t = lsh.top10(_indexed(spark, sf_dir).scored())
    return t.select("query", "candidate", F.round("jaccard", R).alias("jaccard"), "rank")


def jaccard_bruteforce(spark, sf_dir):
    """Exact ten nearest URLs (positive Jaccard, self excluded) of each
    query, compared against every URL."""
    t = UrlJob(spark, sf_dir).exact_top10()
    return t.select("query", "candidate", F.round("jaccard", R).alias("jaccard"), "rank")


def lsh_quality(spark, sf_dir):
    """Mean Jaccard of all candidates and of the top ten, candidates per
    query, and recall of the exact top ten."""
    j = _indexed(spark, sf_dir)
    sc = cut_lineage(j.scored().select("query", "candidate", "jaccard"))
    t10 = cut_lineage(lsh.top10(sc))
    ex = j.exact_top10()

    def tagged(df, kind, value):
        return df.select(F.lit(kind).alias("kind"), value.cast("double").alias("x"))

    every = tagged(j.queries, "query", F.lit(0)).unionByName(tagged(sc, "pair", F.col("jaccard"))) \
        .unionByName(tagged(t10, "top", F.col("jaccard"))) \
        .unionByName(tagged(ex, "exact", F.lit(0))) \
        .unionByName(tagged(t10.join(ex, ["query", "candidate"], "left_semi"), "hit", F.lit(0)))
    count = lambda kind: F.count_if(F.col("kind") == kind).cast("double")
    mean = lambda kind: F.coalesce(F.avg(F.when(F.col("kind") == kind, F.col("x"))), F.lit(0.0))
    row = every.agg(count("query").alias("n_queries"), count("pair").alias("n_pairs"),
                    mean("pair").alias("mean_jaccard_all"), mean("top").alias("mean_jaccard_top10"),
                    count("hit").alias("hits"), count("exact").alias("exact"))
    return row.select(
        "n_queries",
        F.round(F.col("n_pairs") / F.col("n_queries"), R).alias("avg_candidates"),
        F.round("mean_jaccard_all", R).alias("mean_jaccard_all"),
        F.round("mean_jaccard_top10", R).alias("mean_jaccard_top10"),
        F.round(F.when(F.col("exact") > 0, F.col("hits") / F.col("exact")).otherwise(0.0), R)
        .alias("recall_at_10"))


def lsh_tuning(spark, sf_dir):
    """Every (K, L) of the grid from one signature of max(K*L) hashes; a task
    sums its pairs by (K, L), so no pair is shuffled."""
    grid = [(k, l) for k in P.LSH_TUNE_K for l in P.LSH_TUNE_L]
    j = UrlJob(spark, sf_dir, hashes=max(k * l for k, l in grid))
    sums = lsh.banding_sums(j.sh, j.q_sh, grid).groupBy("K", "L").agg(
        F.sum("n_met").alias("n"), F.sum("sum_jaccard").alias("s"))
    every = spark.createDataFrame(grid, "K bigint, L bigint")
    return every.join(sums, ["K", "L"], "left").select(
        "K", "L", F.round(F.when(F.col("n") > 0, F.col("s") / F.col("n")).otherwise(0.0), R).alias("mean_jaccard"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_pairs"))


def lsh_scurve(spark, sf_dir):
    """Observed retrieval rate of the query/URL pairs with a common shingle, by
    tenth of their Jaccard index, against the predicted 1 - (1 - J^K)^L."""
    j = _indexed(spark, sf_dir)
    x = lsh.banding_sums(j.sh, j.q_sh, [(j.K, j.L)]).where("overlaps")
    x = x.groupBy("bin").agg(F.sum("n_pairs").cast("bigint").alias("n_pairs"),
                             F.sum("n_met").cast("bigint").alias("n_retrieved"), F.sum("sum_predicted").alias("p"))
    return x.select("bin", "n_pairs", "n_retrieved",
                    F.round(F.col("n_retrieved") / F.col("n_pairs"), R).alias("observed_rate"),
                    F.round(F.col("p") / F.col("n_pairs"), R).alias("mean_predicted"))


JOBS = {n: globals()[n] for n in [
    "url_shingles", "minhash_signatures", "lsh_buckets", "lsh_candidates", "lsh_pruned", "lsh_top10",
    "jaccard_bruteforce", "lsh_quality", "lsh_tuning", "lsh_scurve"]}
