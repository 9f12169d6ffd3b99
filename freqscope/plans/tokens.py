"""Query-log sketch jobs over ``documents.text`` tokens (E5, G8-G12, G21,
G30, T3, U1, U5, W10).

One scan tokenises the text; ``groupBy(token).count()`` (map-side partial
aggregation, so a hot token never travels as raw rows) feeds every sketch.
Hashing runs once per distinct token.  Cells are bounded by depth x width, a
parameter, so they are broadcast when that bound is small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import params
from ..functions.hashing import bounded_broadcast, sha_row_index
from ..functions.text import tokenize
from ..operators import counts as C
from ..operators import sketch as S
from ..operators.summary import covered, summarise
from ..operators.topn import top_n_per_group
from ..session import cut_lineage
from ..sources.tables import documents_tokens, read_table

P = params
R = params.ROUND_DIGITS
SKETCHES = ("cm", "cmedian", "csketch")
#: counters of the frequent-token summary
TRACKED = P.TOKEN_TOP_TRACKED


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts with map-side combine: a hot token never travels as raw rows."""
    return C.item_counts(documents_tokens(spark, sf_dir), "token")


def _cells(counts: DataFrame, width: int, kind: str) -> DataFrame:
    return S.token_cells(counts, width, kind)


def estimates(counts: DataFrame, width: int, kind: str) -> DataFrame:
    """(token, true_cnt, est) for every token."""
    return S.token_estimates(counts, [(kind, width)]).select("token", F.col("cnt").alias("true_cnt"), "est")


def bottomk_tokens(spark, sf_dir):
    """T3 + X1: the 100 rarest tokens by (count, token)."""
    c = token_counts(spark, sf_dir)
    b = C.top_k(c, P.TOKEN_EVAL_SET_SIZE, "token", "cnt", ascending=True)
    return C.ranked(b, [F.col("cnt").asc(), F.col("token").asc()]).select("rank", "token", "cnt")


def token_hashes(spark, sf_dir):
    """X3/X4/X5/X6 per distinct token and sketch row (R = 2^10)."""
    c = token_counts(spark, sf_dir)
    width = P.TOKEN_WIDTHS[0]
    pos = S.token_positions(c.select("token"), width, "csketch")
    tok_id = F.conv(F.substring(F.md5("token"), 1, 16), 16, 10)
    return pos.select("token", tok_id.alias("tok_id"), "row", "col", "sign",
                      sha_row_index(F.col("token"), F.col("row"), P.RING_SEED, width)
                      .alias("sha_col"))


def cm_cells(spark, sf_dir):
    """Count-Min cells, R = 2^10, depth 5."""
    return _cells(token_counts(spark, sf_dir), P.TOKEN_WIDTHS[0], "cm")


def cm_estimates(spark, sf_dir):
    """Count-Min estimate of every distinct token next to its count."""
    return estimates(token_counts(spark, sf_dir), P.TOKEN_WIDTHS[0], "cm")


def cmedian_estimates(spark, sf_dir):
    """Count-Median estimates."""
    return estimates(token_counts(spark, sf_dir), P.TOKEN_WIDTHS[0], "cmedian")


def csketch_estimates(spark, sf_dir):
    """Count-Sketch estimates."""
    return estimates(token_counts(spark, sf_dir), P.TOKEN_WIDTHS[0], "csketch")


def cm_merge(spark, sf_dir):
    """One sketch per document language, merged cell-wise; equals the
    sketch of the whole corpus."""
    docs = read_table(spark, sf_dir, "documents", ["lang", "text"]).where(F.col("text").isNotNull())
    per = (docs.select(F.coalesce("lang", F.lit("")).alias("lang"),
                       F.explode(tokenize(F.col("text"))).alias("token"))
           .groupBy("lang", "token").agg(F.count(F.lit(1)).cast("bigint").alias("cnt")))
    lang_cells = S.token_cells(per, P.TOKEN_WIDTHS[0], "cm", keys=["lang"])
    return S.merge_cells(lang_cells.drop("lang"))


def cm_fold(spark, sf_dir):
    """The R = 2^10 sketch folded to 2^8 columns (col mod 256)."""
    return S.fold_cells(cm_cells(spark, sf_dir), P.TOKEN_WIDTHS[0] // 4)


def heavy_hitters(spark, sf_dir):
    """G21 (D13): the 500 tokens with the largest Count-Min estimate."""
    e = estimates(token_counts(spark, sf_dir), P.TOKEN_WIDTHS[0], "cm")
    top = e.orderBy(F.col("est").desc(), F.col("token").asc()).limit(P.TOKEN_TOP_TRACKED)
    return C.ranked(top, [F.col("est").desc(), F.col("token").asc()]) \
        .select("rank", "token", "est", "true_cnt")


def cmm_estimates(spark, sf_dir):
    """G17's read: bias-corrected estimates of every token from the Count-Min cells,
    next to the plain minimum."""
    c = cut_lineage(token_counts(spark, sf_dir))
    width, depth = P.TOKEN_WIDTHS[0], P.TOKEN_DEPTH
    pos = cut_lineage(S.token_positions(c, width, "cm", extra=["cnt"]).withColumnRenamed("cnt", "true_cnt"))
    cells = cut_lineage(pos.groupBy("row", "col").agg(F.sum("true_cnt").cast("bigint").alias("cnt")))
    small = bounded_broadcast(cells, depth * width)
    keys = ["token", "true_cnt"]
    plain = S.cm_min(pos, small, ["row", "col"], keys, depth)
    mean = S.mean_min(pos, small, ["row", "col"], keys, width, depth).withColumnRenamed("est", "mean_min")
    return plain.join(mean, keys).select("token", "true_cnt", F.col("est").cast("bigint").alias("est"),
                                         F.round("mean_min", R).alias("mean_min"))


def frequent_tokens(spark, sf_dir):
    """G21 with bounded state: one pass keeps ``TRACKED`` counters per task, merged into one summary
    that holds every token of more than n / (TRACKED + 1) occurrences; a second pass counts
    the summary's tokens exactly.  ``bounded``: the count lies within the summary's bounds."""
    texts = read_table(spark, sf_dir, "documents", ["text"]).where(F.col("text").isNotNull())
    tokens = texts.select(tokenize(F.col("text")).alias("tokens"))
    found = cut_lineage(summarise(tokens, "tokens", None, TRACKED))
    few = F.broadcast(found.where("item is not null").select(F.col("item").alias("token")))  # TRACKED rows at most
    exact = C.item_counts(documents_tokens(spark, sf_dir).join(few, "token", "left_semi"), "token")
    n = found.where("item is null").select("n").scalar()
    frequent = exact.where(F.col("cnt") * (TRACKED + 1) > n).select(F.col("token").alias("item"), "cnt")
    return covered(frequent, found, "cnt", TRACKED).select(F.col("item").alias("token"), "cnt", F.col("inside").alias("bounded"))


SPECS = [(kind, width) for width in P.TOKEN_WIDTHS for kind in SKETCHES]


def all_estimates(c: DataFrame, specs=SPECS) -> DataFrame:
    """``(sketch, R, token, true_cnt, est)`` of every token and sketch.  The sketch and its width are key
    columns: one plan for the sketches whose cells may be broadcast, one for the rest."""
    parts = [S.token_estimates(c, part) for part in S.by_broadcast(specs)]
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("cnt", "true_cnt")


def _shared_counts(spark, sf_dir) -> DataFrame:
    """Token counts cut from their lineage (written to the checkpoint folder)
    because all sketches and three evaluation sets read them.  They lie in as many parts as
    a shuffle has, not in the fewer that their few bytes ask for: each row becomes 45 positions."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(token_counts(spark, sf_dir).repartition(parts, "token"))


def topk_overlap(spark, sf_dir):
    """Overlap of each sketch's top-500 with the true top-100, for
    R = 2^10, 2^14, 2^18.  The top lists are ranked in salted slices, then merged."""
    c = _shared_counts(spark, sf_dir)
    true100 = C.top_k(c, P.TOKEN_TRUE_TOP, "token", "cnt").select("token")
    top = top_n_per_group(all_estimates(c), ["sketch", "R"], [F.col("est").desc(), F.col("token").asc()],
                          P.TOKEN_TOP_TRACKED, F.xxhash64("token"))
    grid = spark.createDataFrame([(k, w) for k in SKETCHES for w in P.TOKEN_WIDTHS], "sketch string, R bigint")
    ov = top.join(true100, "token").groupBy("sketch", "R").agg(F.count(F.lit(1)).cast("bigint").alias("overlap"))
    return grid.join(ov, ["sketch", "R"], "left").select(
        "sketch", "R", F.coalesce("overlap", F.lit(0)).cast("bigint").alias("overlap"))


def eval_sets(c: DataFrame) -> DataFrame:
    """Frequent (top 100), random (100 by a seeded md5 order) and
    infrequent (bottom 100 by count, token) token sets."""
    n = P.TOKEN_EVAL_SET_SIZE
    freq = C.top_k(c, n, "token", "cnt").select(F.lit("frequent").alias("set"), "token", "cnt")
    infreq = C.top_k(c, n, "token", "cnt", ascending=True) \
        .select(F.lit("infrequent").alias("set"), "token", "cnt")
    key = F.md5(F.concat(F.lit(f"{P.TOKEN_SAMPLE_SEED}:"), F.col("token")))
    rand = c.orderBy(key, F.col("token")).limit(n).select(F.lit("random").alias("set"), "token", "cnt")
    return freq.unionByName(rand).unionByName(infreq)


def token_error_sets(spark, sf_dir):
    """Relative errors of every sketch and R on the three sets, ranked
    by true frequency within each set."""
    c = _shared_counts(spark, sf_dir)
    sets = cut_lineage(eval_sets(c))
    asked = cut_lineage(S.sketch_positions(sets.select("token").distinct(), SPECS))
    # only the cells that are asked for are summed
    few = bounded_broadcast(asked.select(*S.CELL).distinct(), 3 * P.TOKEN_EVAL_SET_SIZE * len(SPECS) * P.TOKEN_DEPTH, S.KIND_BYTES)
    cells = S.sketch_cells(S.sketch_positions(c, SPECS, extra=["cnt"]).join(few, S.CELL))
    est = S.sketch_estimates(asked, cells, ["token"])
    out = sets.join(est, "token").select("set", "R", "sketch", "token", F.col("cnt").alias("true_cnt"), "est")
    rel = F.when(F.col("true_cnt") > 0, F.abs(F.col("est") - F.col("true_cnt")) / F.col("true_cnt")) \
        .otherwise(F.lit(0.0))
    w = Window.partitionBy("set", "R", "sketch").orderBy(F.col("true_cnt").desc(), F.col("token"))
    return out.select("*", F.round(rel, R).alias("rel_error"),
                      F.row_number().over(w).cast("bigint").alias("rank"))


def dictionary_stats(spark, sf_dir):
    """Total and unique tokens, and exact-dictionary bytes (token bytes
    plus an 8-byte counter each)."""
    c = token_counts(spark, sf_dir)
    return c.agg(F.sum("cnt").cast("bigint").alias("total_tokens"),
                 F.count(F.lit(1)).cast("bigint").alias("unique_tokens"),
                 F.sum(F.octet_length("token") + 8).cast("bigint").alias("dict_bytes"))


JOBS = {n: globals()[n] for n in [
    "bottomk_tokens", "token_hashes", "cm_cells", "cm_estimates", "cmedian_estimates",
    "csketch_estimates", "cm_merge", "cm_fold", "heavy_hitters", "topk_overlap",
    "token_error_sets", "dictionary_stats", "cmm_estimates", "frequent_tokens"]}
