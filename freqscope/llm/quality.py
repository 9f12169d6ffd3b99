"""Operator 10: quality classifier from weak labels.

Heuristic labellers read the whole text and vote good, bad or abstain.
Expectation-maximisation over the counts of all vote patterns (at most
3 ** labellers rows, whatever the corpus) estimates how often each labeller votes so
on good and on bad documents; the posterior of a document's pattern is its label.
The labels of a bounded sample (``TRAIN_ROWS``) train a logistic scorer on hashed
features (word shapes and binned statistics), which scores every document.

Defined results: a null or empty text makes every labeller abstain and is kept, as its
score then is the prior's; null ids are kept; repeated rows are scored alike; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SLICE_ROWS, field, hash_sample, map_arrow, stored, table, text_or_empty

TRAIN_ROWS = 20_000
BUCKETS = 1 << 15
EM_ROUNDS = 200
KEEP_FROM = 0.5
ABSTAIN, BAD, GOOD = 0, 1, 2

# -- character classes -------------------------------------------------------

SPACE, LOWER, UPPER, DIGIT, MARK, END, SYMBOL = range(7)


@lru_cache(None)
def _class_table() -> np.ndarray:
    kinds = {"Lu": UPPER, "Lt": UPPER, "Nd": DIGIT, "Nl": DIGIT, "No": DIGIT}
    out = np.full(sys.maxunicode + 1, SYMBOL, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LM":
            out[c] = kinds.get(kind, LOWER)
        elif kind in kinds:
            out[c] = kinds[kind]
        elif kind[0] == "Z" or chr(c).isspace():
            out[c] = SPACE
    for ch in ".,;:'\"()-/’‘“”«»–—¿¡@+":
        out[ord(ch)] = MARK
    for ch in "!?…":
        out[ord(ch)] = END
    return out


# -- features ----------------------------------------------------------------

#: statistic -> bin bounds
BINS = {
    "symbols": (0.002, 0.01, 0.03, 0.08, 0.2),
    "upper": (0.05, 0.12, 0.25, 0.5),
    "letters": (0.5, 0.7, 0.85, 0.93),
    "shouts": (0.01, 0.05, 0.2, 0.5),
    "word_length": (2.5, 3.5, 4.2, 6.2, 7.5, 9.0),
    "new_pairs": (0.1, 0.3, 0.5, 0.7, 0.85, 0.95),
    "repeated_lines": (0.01, 0.1, 0.3, 0.6),
    "closed_lines": (0.1, 0.3, 0.6, 0.9),
    "words": (5, 20, 80, 400, 2000),
    "bare_marks": (0.01, 0.05, 0.15, 0.35),
    "stutter": (0.02, 0.1, 0.3, 0.6),
}
NAMES = tuple(BINS)


def statistics(text: str, classes: np.ndarray) -> dict[str, float]:
    words = text.split()
    n = np.bincount(classes, minlength=7)
    solid, letters = max(1, int(n[1:].sum())), int(n[LOWER] + n[UPPER])
    if len(words) > 1:
        h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        new_pairs, stutter = len(np.unique(pairs)) / len(pairs), float((h[:-1] == h[1:]).mean())
    else:
        new_pairs, stutter = 1.0, 0.0
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    held = sum(map(len, lines))
    # words without a letter or digit: word starts less those that hold one
    solid_at = classes != SPACE
    word_of = np.cumsum(solid_at & np.concatenate(([True], ~solid_at[:-1]))) if len(classes) else np.empty(0, np.int64)
    named = (classes >= LOWER) & (classes <= DIGIT)
    bare = int(word_of[-1]) - len(np.unique(word_of[named])) if len(word_of) else 0
    return {
        "symbols": n[SYMBOL] / solid, "upper": n[UPPER] / max(1, letters), "letters": (letters + n[DIGIT]) / solid,
        "shouts": n[END] / max(1, len(words)), "word_length": solid / max(1, len(words)), "new_pairs": new_pairs,
        "repeated_lines": 1 - sum(map(len, set(lines))) / held if held else 0.0,
        "closed_lines": sum(x[-1] in ".!?…:;\"”»)" for x in lines) / max(1, len(lines)), "words": float(len(words)),
        "bare_marks": bare / max(1, len(words)), "stutter": stutter,
    }


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else ABSTAIN


#: name -> vote of a document's statistics; all abstain below ``MIN_WORDS`` words
MIN_WORDS = 8
LABELLERS = {
    "few_symbols": lambda s: _vote(s["symbols"] > 0.06, s["symbols"] < 0.01),
    "not_shouted": lambda s: _vote(s["upper"] > 0.35, s["upper"] < 0.12),
    "letters_or_digits": lambda s: _vote(s["letters"] < 0.75, s["letters"] > 0.9),
    "few_exclamations": lambda s: _vote(s["shouts"] > 0.25, s["shouts"] < 0.05),
    "usual_words": lambda s: _vote(s["word_length"] > 9 or s["word_length"] < 2.5, 3.5 < s["word_length"] < 7),
    "varied": lambda s: _vote(s["words"] >= 20 and s["new_pairs"] < 0.4, s["words"] >= 20 and s["new_pairs"] > 0.7),
    "no_repeated_lines": lambda s: _vote(s["repeated_lines"] > 0.4, s["repeated_lines"] < 0.1),
    "named_words": lambda s: _vote(s["bare_marks"] > 0.2, s["bare_marks"] < 0.03),
    "no_stutter": lambda s: _vote(s["stutter"] > 0.15, s["stutter"] < 0.05),
    "closed_sentences": lambda s: _vote(s["words"] >= 60 and s["closed_lines"] < 0.2, s["closed_lines"] > 0.6),
}


def votes(stats: dict[str, float]) -> int:
    """The pattern of all votes, one base-3 digit each."""
    if stats["words"] < MIN_WORDS:
        return 0
    return sum(f(stats) * 3 ** k for k, f in enumerate(LABELLERS.values()))


_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _bucket(codes: np.ndarray) -> np.ndarray:
    return ((codes.astype(np.uint64) * _MULTIPLY) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def word_shapes(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the shapes of all words: runs of one character class
    count once, a run of several marks, ends or symbols as another class; six runs."""
    cut = np.flatnonzero(np.diff(classes)) + 1
    starts = np.concatenate(([0], cut))
    run = classes[starts].astype(np.int64)
    size = np.diff(np.concatenate((starts, [len(classes)])))
    code = np.where((size > 1) & (run >= MARK), run + 3, run)
    solid = run != SPACE
    first = solid & np.concatenate(([True], ~solid[:-1]))
    if not solid.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(first)
    place = np.arange(len(run)) - np.maximum.accumulate(np.where(first, np.arange(len(run)), 0))
    weight = np.where(solid & (place < 6), code * 10 ** np.minimum(place, 6), 0)
    return np.unique(np.add.reduceat(weight, at), return_counts=True)


def features(text: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(vote pattern, buckets, values); values have length 1 in all."""
    classes = _class_table()[np.frombuffer(text.encode("utf-32-le"), "<u4")]
    stats = statistics(text, classes)
    bins = np.array([1_000_000_000 + k * 1000 + int(np.searchsorted(BINS[n], stats[n])) for k, n in enumerate(NAMES)])
    shapes, counts = word_shapes(classes) if len(classes) else (np.empty(0, np.int64), np.empty(0, np.int64))
    share = counts / max(1, counts.sum())
    values = np.concatenate((np.ones(len(bins)) / len(bins) ** 0.5, share))
    return votes(stats), _bucket(np.concatenate((bins, shapes))), values / np.sqrt((values ** 2).sum())


# -- label model -------------------------------------------------------------

def fit_label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> dict[int, float]:
    """Posterior probability of a good document by vote pattern.

    Two classes; given the class, labellers vote independently.  Abstentions carry
    no evidence.  Starts from: any bad vote makes a document suspect."""
    n_l = len(LABELLERS)
    v = np.array([[p // 3 ** k % 3 for k in range(n_l)] for p in patterns.tolist()]).reshape(-1, n_l)
    w = counts.astype(float)
    good = np.where((v == BAD).any(axis=1), 0.3, np.where((v == GOOD).any(axis=1), 0.95, 0.8))
    is_bad, is_good = v == BAD, v == GOOD
    for _ in range(rounds):
        rate = {}
        for name, p in (("good", good), ("bad", 1 - good)):
            g, b = (w * p) @ is_good, (w * p) @ is_bad
            rate[name] = (g + 1.0) / (g + b + 2.0)
        prior = ((w * good).sum() + 1) / (w.sum() + 2)
        score = np.log(prior) - np.log(1 - prior) \
            + is_good @ (np.log(rate["good"]) - np.log(rate["bad"])) \
            + is_bad @ (np.log(1 - rate["good"]) - np.log(1 - rate["bad"]))
        new = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        moved, good = np.abs(new - good).max(initial=0), new
        if moved < 1e-9:
            break
    return dict(zip(patterns.tolist(), good.tolist()))


def fit_scorer(buckets: list[np.ndarray], values: list[np.ndarray], target: np.ndarray,
               steps: int = 300, ridge: float = 1e-4) -> np.ndarray:
    """Logistic regression on hashed features, the bias last; full-batch Adam."""
    row = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
    col = np.concatenate([*buckets, np.empty(0, np.int64)]).astype(np.int64)
    val = np.concatenate([*values, np.empty(0)])
    weight, m, q = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, weights=val * weight[col], minlength=len(buckets)) + weight[-1]
        error = (1 / (1 + np.exp(-z)) - target) / max(1, len(buckets))
        grad = np.append(np.bincount(col, weights=val * error[row], minlength=BUCKETS), error.sum())
        grad[:-1] += ridge * weight[:-1] / max(1, len(buckets)) ** 0.5
        m, q = 0.9 * m + 0.1 * grad, 0.99 * q + 0.01 * grad ** 2
        weight -= 0.3 * (m / (1 - 0.9 ** t)) / (np.sqrt(q / (1 - 0.99 ** t)) + 1e-10)
    return weight


# -- on Spark ----------------------------------------------------------------

def _extracted(texts: list[str]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
    """Votes, buckets and values of texts, as the feature table holds them."""
    rows = [features(t) for t in texts]
    return [r[0] for r in rows], [r[1] for r in rows], [r[2].astype(np.float32) for r in rows]


def _scores(buckets: np.ndarray, values: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Scores of the rows whose features lie between the offsets ``at``."""
    add = np.concatenate(([0.0], np.cumsum(weight[buckets] * values)))
    return 1 / (1 + np.exp(-np.round(add[at[1:]] - add[at[:-1]] + weight[-1], 9)))


def _fit(docs: DataFrame, id_col: str, text_col: str, train_rows: int) -> tuple[DataFrame, dict[int, float], np.ndarray]:
    """(feature table, posterior by vote pattern, scorer weights).

    One pass over the texts makes a table of votes and sparse features; the label
    model takes its pattern counts, the scorer a sample of about ``train_rows``
    rows by hash of id and features."""
    made = T.StructType([field(docs, id_col), T.StructField("votes", T.IntegerType()),
                         T.StructField("buckets", T.ArrayType(T.IntegerType())),
                         T.StructField("vals", T.ArrayType(T.FloatType()))])

    def extract(batch: pa.RecordBatch) -> list:
        return [batch.column(0), *_extracted(batch.column(1).to_pylist())]

    table_ = stored(map_arrow(docs.select(id_col, text_or_empty(text_col).alias("text")), extract, made), "features")
    patterns = table_.groupBy("votes").count().collect()  # at most 3 ** len(LABELLERS) rows
    posterior = fit_label_model(np.array([r["votes"] for r in patterns], dtype=np.int64),
                                np.array([r["count"] for r in patterns], dtype=np.int64))
    total = sum(r["count"] for r in patterns)
    sample = hash_sample(table_, [id_col, "buckets"], train_rows, total).select("votes", "buckets", "vals").collect()
    if total and not sample:
        raise ValueError(f"no training rows among {total}")
    weight = fit_scorer([np.array(r["buckets"]) for r in sample], [np.array(r["vals"]) for r in sample],
                        np.array([posterior[r["votes"]] for r in sample]))
    return table_, posterior, weight


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          train_rows: int = TRAIN_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """(id, weak_label, score, keep) for every row of ``docs``, from the feature table."""
    table_, posterior, weight = _fit(docs, id_col, text_col, train_rows)
    out = T.StructType([field(docs, id_col), T.StructField("weak_label", T.DoubleType()),
                        T.StructField("score", T.DoubleType()), T.StructField("keep", T.BooleanType())])

    def judge(batch: pa.RecordBatch) -> list:
        b, v = batch.column(2), batch.column(3)
        p = _scores(b.values.to_numpy(), v.values.to_numpy(), b.offsets.to_numpy(), weight)
        return [batch.column(0), [posterior[k] for k in batch.column(1).to_pylist()], pa.array(p), pa.array(p >= keep_from)]

    return map_arrow(table_, judge, out)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              train_rows: int = TRAIN_ROWS, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all their columns.

    Each row is judged by its own text in a second narrow pass, so ids do not matter."""
    _, _, weight = _fit(docs, id_col, text_col, train_rows)

    @F.arrow_udf(T.BooleanType())
    def good(texts: pa.Array) -> pa.Array:
        kept = [np.empty(0, bool)]
        for at in range(0, len(texts), SLICE_ROWS):
            _, b, v = _extracted(texts.slice(at, SLICE_ROWS).to_pylist())
            ends = np.concatenate(([0], np.cumsum([len(x) for x in b])))
            kept.append(_scores(np.concatenate(b), np.concatenate(v), ends, weight) >= keep_from)
        return pa.array(np.concatenate(kept))

    return docs.where(good(text_or_empty(text_col)))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.round("weak_label", 6).alias("weak_label"), F.round("score", 6).alias("score"),
                        F.col("keep").cast("int").alias("keep"))
