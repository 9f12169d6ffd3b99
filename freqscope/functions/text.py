"""Text column expressions (X1, X2, X12).  All JVM-side, no Python UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params


def tokenize(text: Column) -> Column:
    """Lower-case, maximal runs of ``[a-z0-9]``."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)


def shingles(s: Column, n: int = params.SHINGLE_N) -> Column:
    """Distinct lower-cased character n-grams; a string shorter than n
    gives the one-element set ``{s}`` (so the empty string gives ``{''}``)."""
    low = F.lower(s)
    grams = F.transform(F.sequence(F.lit(1), F.length(low) - (n - 1)),
                        lambda i: low.substr(i, F.lit(n)))
    return F.when(F.length(low) < n, F.array(low)).otherwise(F.array_distinct(grams))


def jaccard(a: Column, b: Column) -> Column:
    """X12 on two distinct arrays; both empty gives 1."""
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(inter / union)
