"""Operator 5: mixing sources to target weights, DataFrame functions only.

A table of labelled documents trains a naive Bayes classifier on binned statistics
and counts of telling words; it gives every document its posterior over the domains.  Rates r >= 0
then minimise, by projected gradient,

    |sum_d n_d r_d p_d - T|^2 / (2 S^2)  +  ridge / (2 S) * sum_d n_d (r_d - 1)^2

where n_d are a document's tokens, p_d its posterior, S all tokens and T the target
tokens of the domains.  The ridge only chooses among rates of equal totals those nearest to 1:
it is so small that expected domain totals meet any targets that rates can reach (those
beyond are approached in least squares).

With the residual x = (totals - T) / (ridge S), a document's gradient is zero, or points below
zero, at r_d = max(0, 1 - p_d . x): documents of one posterior share a rate.  So tokens are summed by
posterior once (the bins bound their number), and each step is one aggregate of that table: it
gives the gradient in x and its curvature, a matrix of domains by domains, whose step, halved
until the aim falls, is projected onto the rates.  A document is taken floor(r) times, and
once more if a hash of its id and text falls below the fraction.

Bounds: the classifier learns from at most about ``LABELLED_ROWS`` labelled rows, chosen
by hash of the id, and keeps ``WORDS`` words a domain.  Counts, posteriors and rates cover all rows.

Defined results: a null or empty text has no tokens and the posterior of its statistics;
labels without a document, or with null fields, are ignored; without labels all
documents have one posterior and rate 1; null ids are kept; repeated rows are treated alike; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_sample, stored, table, text_or_empty

DOMAINS = ("good", "toxic", "poor")
#: the domain of each class of ``label_class``: good, good but toxic, poor, poor and toxic
CLASS_DOMAINS = (0, 1, 2, 1)
#: share of tokens each domain shall have
TARGETS = (0.95, 0.04, 0.01)
LABELLED_ROWS = 20_000
WORDS = 64
HIT_BINS = (1, 2, 4)
STEPS = 60
RIDGE = 1e-6
TOLERANCE = 1e-9
WHITE = " \t\n\x0b\x0c\r"

SYMBOLS = "#$%&*|~^<>{}=_\\"
#: statistic -> bin bounds
BINS = {"symbols": (0.005, 0.03, 0.1), "upper": (0.05, 0.15, 0.4), "shouts": (0.002, 0.01, 0.05),
        "new_words": (0.1, 0.25, 0.45, 0.7), "word_length": (4.0, 6.2, 8.0)}


def label_class() -> Column:
    """Class of a row of ``labels``: each mix of its two labels is one class, as words
    and statistics are independent within it, but not within a domain."""
    return F.when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(),
                  F.when(F.col("quality") == 1, 0).otherwise(2) + F.when(F.col("toxic") == 1, 1).otherwise(0))


def _without(text: Column, chars: str) -> Column:
    held = "".join(f"\\{c}" if c in "\\^-[]&" else c for c in chars)
    return F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{held}]+", ""))


def document_features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n_tokens, words, bins, draw): distinct lower-case words without edge marks, one
    code for each binned statistic, a hash of id and text.  One narrow pass over the texts."""
    t = text_or_empty(text_col)
    draw = F.xxhash64(F.lit(55), F.col(id_col), t).alias("draw")
    base = docs.select(F.col(id_col), draw, t.alias("text"), F.split(F.btrim(t, F.lit(WHITE)), r"\s+").alias("all"))
    n = F.when(F.element_at("all", 1) == "", F.lit(0)).otherwise(F.size("all"))
    base = base.select(id_col, "draw", "text", n.cast("long").alias("n_tokens"),
                       F.size("all").alias("pieces"), F.array_distinct("all").alias("distinct"))
    chars = F.greatest(F.char_length("text"), F.lit(1))
    stats = {"symbols": _without(F.col("text"), SYMBOLS) / chars,
             "upper": _without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars,
             "shouts": _without(F.col("text"), "!?") / chars,
             "new_words": F.size("distinct") / F.greatest("pieces", F.lit(1)),
             "word_length": chars / F.greatest("pieces", F.lit(1))}
    codes = []
    for name, bounds in BINS.items():
        place = sum(((stats[name] >= b).cast("int") for b in bounds), F.lit(0))
        codes.append(F.concat(F.lit(f"\u0001{name}"), place.cast("string")))
    words = F.transform("distinct", lambda w: F.lower(F.btrim(w, F.lit(".,;:!?\"'()" + SYMBOLS))))
    return base.select(id_col, "n_tokens", words.alias("words"), F.array(*codes).alias("bins"), "draw")


def _hits(words: str, lexicons: dict[int, list[str]]) -> list[Column]:
    """One code for the number of a lexicon's words in a document, binned."""
    codes = []
    for domain, held in lexicons.items():
        n = F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in held])))
        place = sum(((n >= b).cast("int") for b in HIT_BINS), F.lit(0))
        codes.append(F.concat(F.lit(f"\u0001hits{domain}:"), place.cast("string")))
    return codes


def fit_domains(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label: Column | None = None, class_domains: tuple[int, ...] = CLASS_DOMAINS,
                labelled_rows: int = LABELLED_ROWS, words: int = WORDS) -> dict:
    """Naive Bayes over binned statistics, among them how many words of each rarer
    domain's lexicon a document holds.  A lexicon has the ``words`` words that are most
    over-represented in the domain and occur in a twentieth of its documents.

    The labelled sample is broadcast (bounded by ``labelled_rows``), so texts are not
    shuffled; word counts are combined by Spark, and only the best words reach the driver."""
    classes, domains = len(class_domains), max(class_domains) + 1
    known = labels.select(F.col(id_col).alias("label_id"), (label if label is not None else label_class()).alias("class")) \
        .where("label_id is not null and class is not null").dropDuplicates(["label_id"])
    total = known.count()
    sample = stored(hash_sample(known, ["label_id", F.lit(5)], labelled_rows, total), "labelled-sample")
    if total and sample.isEmpty():
        raise ValueError(f"no training rows among {total}")
    texts = docs.select(F.col(id_col).alias("text_id"), F.col(text_col).alias("the_text"))
    rows = document_features(texts.join(F.broadcast(sample), F.col("text_id") == F.col("label_id"))
                             .select(F.col("class").alias("the_class"), "the_text"), "the_class", "the_text")
    rows = stored(rows.select("the_class", F.array_distinct("words").alias("words"), "bins"), "labelled-features")
    by = {r["the_class"]: r["n"] for r in rows.groupBy("the_class").agg(F.count("*").alias("n")).collect()}
    n = [by.get(k, 0) for k in range(classes)]
    every = sum(n)
    if not every:
        return {"prior": [0.0] * classes, "lexicons": {}, "bins": {}}
    held = [sum(x for x, d in zip(n, class_domains) if d == k) for k in range(domains)]
    in_domain = [F.count_if(F.col("the_class").isin([c for c, d in enumerate(class_domains) if d == k])).alias(f"d{k}")
                 for k in range(domains)]
    counted = stored(rows.select("the_class", F.explode("words").alias("f")).groupBy("f").agg(F.count("*").alias("seen"), *in_domain),
                     "word-counts")
    lexicons = {}
    for k in range(domains):
        if not held[k] or k == held.index(max(held)):  # all but the first of the largest
            continue
        expected = F.col("seen") * (held[k] / every)
        # twice as likely in the domain as in the rest
        best = counted.where((F.col("f") != "") & (F.col(f"d{k}") * (every - held[k]) > 2 * held[k] * (F.col("seen") - F.col(f"d{k}"))) & (F.col(f"d{k}") >= max(5, held[k] / 20))) \
            .orderBy((F.pow(F.col(f"d{k}") - expected, 2) / expected).desc(), "f").limit(words).collect()
        if best:
            lexicons[k] = [r["f"] for r in best]
    each = [F.count_if(F.col("the_class") == c).alias(f"n{c}") for c in range(classes)]
    bins = rows.select("the_class", F.explode(F.concat("bins", F.array(*_hits("words", lexicons)).cast("array<string>"))).alias("f")) \
        .groupBy("f").agg(*each).collect()
    return {"prior": [math.log((x + 1) / (every + classes)) for x in n], "lexicons": lexicons,
            "bins": {r["f"]: [math.log((r[f"n{c}"] + 0.5) / (n[c] + 1.0)) for c in range(classes)] for r in bins},
            "unseen": [math.log(0.5 / (x + 1.0)) for x in n]}


def _summed(features: str, weights: dict[str, float], unseen: float) -> Column:
    """Sum of the weights of an array's features."""
    held = F.create_map(*[F.lit(x) for name, w in weights.items() for x in (name, float(w))])
    return F.aggregate(features, F.lit(0.0), lambda total, f: total + F.coalesce(held[f], F.lit(float(unseen))))


def posteriors(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
               class_domains: tuple[int, ...] = CLASS_DOMAINS) -> DataFrame:
    """(id, n_tokens, p, draw, draw2): one posterior over the domains per row, without a
    join.  A domain's share is the sum over its classes."""
    rows = document_features(docs, id_col, text_col)
    rows = rows.select(id_col, "draw", "n_tokens", F.concat("bins", F.array(*_hits("words", model["lexicons"])).cast("array<string>")).alias("bins"))
    score = [F.lit(float(x)) for x in model["prior"]]
    if model["bins"]:
        score = [x + _summed("bins", {b: v[c] for b, v in model["bins"].items()}, model["unseen"][c]) for c, x in enumerate(score)]
    rows = rows.select(id_col, "draw", "n_tokens", F.array(*score).alias("s"))
    rows = rows.select(id_col, "draw", "n_tokens", F.transform("s", lambda x: F.exp(x - F.array_max("s"))).alias("e"))
    whole = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    share = [sum((F.element_at("e", k + 1) for k, d in enumerate(class_domains) if d == domain), F.lit(0.0)) / whole
             for domain in range(max(class_domains) + 1)]
    return rows.select(id_col, "n_tokens", F.array(*share).alias("p"), "draw")


def _rate(pull: list[float]) -> Column:
    """A posterior's rate at a residual: the projection of its gradient step onto r >= 0."""
    return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col("p")[k] * float(x) for k, x in enumerate(pull)), F.lit(0.0)))


def fit_residual(weighted: DataFrame, targets: tuple[float, ...] = TARGETS, steps: int = STEPS,
                 ridge: float = RIDGE, tolerance: float = TOLERANCE) -> list[float]:
    """The residual x (see above) at which the rates are optimal; zeros after no step."""
    k = range(len(targets))
    aim = [x / sum(targets) for x in targets]
    pull = [0.0 for _ in k]
    if not steps:
        return pull
    tokens = stored(weighted.groupBy("p").agg(F.sum("n_tokens").alias("n")), "posterior-tokens")
    size = tokens.agg(F.sum("n").alias("s")).first()["s"]
    if not size:
        return pull
    share = F.col("n") / float(size)

    def worth(x: list[float], squares: float) -> float:
        return ridge / 2 * sum(a * a for a in x) + sum(a * t for a, t in zip(x, aim)) + squares / 2

    for _ in range(steps):
        rate = _rate(pull)
        free = F.when(rate > 0, share).otherwise(F.lit(0.0))
        sums = tokens.agg(F.sum(share * rate * rate).alias("q"), *[F.sum(share * rate * F.col("p")[a]).alias(f"t{a}") for a in k],
                          *[F.sum(free * F.col("p")[a] * F.col("p")[b]).alias(f"h{a}_{b}") for a in k for b in k if a <= b]).first()
        gradient = [ridge * pull[a] + aim[a] - sums[f"t{a}"] for a in k]
        if max(map(abs, gradient)) < tolerance:
            break
        curve = [[sums[f"h{min(a, b)}_{max(a, b)}"] + (ridge if a == b else 0.0) for b in k] for a in k]
        step = np.linalg.solve(curve, gradient).tolist()
        tries = [[x - d * 0.5 ** h for x, d in zip(pull, step)] for h in range(20)]
        squares = tokens.agg(*[F.sum(share * _rate(x) * _rate(x)).alias(f"q{h}") for h, x in enumerate(tries)]).first()
        best = min(range(len(tries)), key=lambda h: worth(tries[h], squares[f"q{h}"]))
        if worth(tries[best], squares[f"q{best}"]) >= worth(pull, sums["q"]):
            break  # rounding: no step lowers the aim
        pull = tries[best]
    return pull


def fit_rates(weighted: DataFrame, targets: tuple[float, ...] = TARGETS, steps: int = STEPS,
              ridge: float = RIDGE, tolerance: float = TOLERANCE) -> DataFrame:
    """``weighted`` (with n_tokens and p) plus ``rate``, without a join."""
    return weighted.withColumn("rate", _rate(fit_residual(weighted, targets, steps, ridge, tolerance)))


def _drawn(weighted: DataFrame, targets: tuple[float, ...], steps: int) -> DataFrame:
    """``weighted`` plus rate and copies."""
    rated = fit_rates(weighted, targets, steps).withColumn("rate", F.round("rate", 6))
    chance = F.pmod("draw", F.lit(1 << 20)) / float(1 << 20)
    return rated.withColumn("copies", (F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        targets: tuple[float, ...] = TARGETS, label: Column | None = None,
        class_domains: tuple[int, ...] = CLASS_DOMAINS) -> DataFrame:
    """(id, n_tokens, p, rate, copies) for every row of ``docs``."""
    model = fit_domains(docs, labels, id_col, text_col, label, class_domains)
    weighted = stored(posteriors(docs, model, id_col, text_col, class_domains), "posteriors")
    return _drawn(weighted, targets, STEPS if model["bins"] else 0).drop("draw")


def apply_mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              targets: tuple[float, ...] = TARGETS, label: Column | None = None,
              class_domains: tuple[int, ...] = CLASS_DOMAINS) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say.

    The table of posteriors holds each row's columns beside them, so that rows need not
    be found again: there is no join, and one plan at every size."""
    model = fit_domains(docs, labels, id_col, text_col, label, class_domains)
    columns = [F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]
    rows = docs.select(F.struct(F.col(id_col).alias("id"), *columns).alias("row"), F.col(text_col).alias("text"))
    # the draw is that of ``mix``: a hash of id and text
    weighted = posteriors(rows, model, "row", "text", class_domains) \
        .withColumn("draw", F.xxhash64(F.lit(55), "row.id", text_or_empty(f"row.c{docs.columns.index(text_col)}")))
    drawn = _drawn(stored(weighted, "posteriors"), targets, STEPS if model["bins"] else 0)
    return drawn.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))) \
        .select(*[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_tokens", *[F.round(F.element_at("p", k + 1), 6).alias(f"p_{d}")
                                                for k, d in enumerate(DOMAINS)], "rate", "copies")
