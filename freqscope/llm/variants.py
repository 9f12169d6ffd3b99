"""Operator 12: spelling variants, found with PartEnum signatures of letter multisets.

Words are maximal runs of letters, lower-cased (A-Z only), counted over all texts.
In the contract's query one run in 31, chosen by a checksum of document and run,
first loses a letter.  Two words are near if one inserted, deleted or replaced code
point turns one into the other.

A word's multiset of letters is a binary vector over (letter, occurrence).  A
replacement changes two places of it, an insertion one.  The places are partitioned
by letter, and the signatures enumerate the parts that stay unchanged:

* equal lengths, distance two: three parts, of which one at least agrees;
* lengths L and L + 1, distance one: two parts, of which one agrees.

Where few syllables make up all words, a multiset says little: many words share
it.  So each signature also holds the first or the last half of the word, one of
which the edit leaves alone (16 against 125 million pairs on 374,000 words of such
texts, for 2 copies more).  Words meet by an equi-join of the signatures' hashes,
and the edit distance verifies each pair inside the join.  A signature shared by more
than ``HOT`` words is joined in slices, so that no task holds it whole.

Forms: a word's near word of the largest count, where that is ``ratio`` times the
word's own.  Counts grow by that factor at each step, so pointer jumping finds the
last form of all chains in a few rounds.

Defined results: a null or empty text has no words; a null id counts as the empty
string in the checksum; repeated ids and rows count each; a word of any length is kept whole;
ties go to the smaller word in code-point order; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table, text_or_empty

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
#: by frequency in European texts, so that parts get equal shares (fixed value, any order is right)
BY_FREQUENCY = "etaoinshrdlucmfwypvbgkjqxz"
MIN_CHARS, MIN_COUNT, RATIO, EDIT_EVERY = 7, 2, 10, 31
SAME_PARTS, NEXT_PARTS = 3, 2
#: words of one signature that are compared in one slice
HOT = 4096


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, edit_every: int = 0) -> DataFrame:
    """(word, n): words of at least ``min_chars`` code points and ``min_count`` occurrences.

    ``edit_every``: where it divides the crc32 of ``<id>:<run>``, the run loses the
    code point at that checksum modulo its length; 0 edits nothing."""
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{max(1, min_chars)},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    plain = F.octet_length("run") == F.char_length("run")  # A-Z are all that lower() can change then
    words = words.select("id", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    if edit_every:
        h = F.crc32(F.concat("id", F.lit(":"), "run"))
        at = (F.col("h") % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        words = words.select("run", h.alias("h")).select(
            F.when(F.col("h") % edit_every == 0, cut).otherwise(F.col("run")).alias("run"))
    return (words.where(F.char_length("run") >= min_chars).groupBy(F.col("run").alias("word"))
            .agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def _parts(n: int) -> list[str]:
    """The letters of each of ``n`` parts."""
    rest = [c for c in LETTERS if c not in BY_FREQUENCY]
    return [BY_FREQUENCY[k::n] + "".join(rest[k::n]) for k in range(n)]


def signatures(words: DataFrame) -> DataFrame:
    """(cell, word, n, odd): one row per word and signature, ``cell`` the signature's hash.

    ``odd``: a bit per letter (modulo 64) that occurs an odd number of times."""
    odd = F.aggregate(F.split("word", ""), F.lit(0).cast("long"),
                      lambda bits, c: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)))
    size = F.char_length("word").alias("size")
    rows = words.select("word", "n", odd.alias("odd"), size, F.array_join(F.array_sort(F.split("word", "")), "").alias("letters"))
    for n in {SAME_PARTS, NEXT_PARTS}:
        for k, part in enumerate(_parts(n)):
            others = "".join(c for c in LETTERS if c not in part)
            rows = rows.withColumn(f"part{n}_{k}", F.xxhash64(F.translate("letters", others, "")))
    for less in (0, 1):
        short = F.col("size") - less
        half = F.floor(short / 2).cast("int")
        rows = rows.withColumn(f"first{less}", F.xxhash64(F.lit("first"), short, F.substring("word", F.lit(1), half))) \
            .withColumn(f"last{less}", F.xxhash64(F.lit("last"), short, F.substring("word", half + less + 1, short - half)))
    cells = [F.xxhash64(F.lit(kind), F.lit(k), F.col(f"{side}{less}"), F.col(f"part{n}_{k}"))
             for kind, n, less in (("same", SAME_PARTS, 0), ("next", NEXT_PARTS, 0), ("next", NEXT_PARTS, 1))
             for k in range(n) for side in ("first", "last")]
    return rows.select(F.array(*cells).alias("cells"), "word", "n", "odd") \
        .select(F.explode("cells").alias("cell"), "word", "n", "odd")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b), a < b: each pair of near words once.  ``words``: (word, n), words distinct."""
    copies = stored(signatures(words), "variant-signatures")
    hot = stored(copies.groupBy("cell").agg(F.count("*").alias("members")).where(F.col("members") > HOT)
                 .select("cell", F.ceil(F.col("members") / HOT).cast("int").alias("slices")), "hot-signatures")

    def meet(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        a = left.select(*on, F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("odd").alias("odd_a"))
        b = right.select(*on, F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("odd").alias("odd_b"))
        changed = F.bit_count(F.col("odd_a").bitwiseXOR(F.col("odd_b")))  # cheap, before the edit distance
        pairs = a.join(b, on).where((changed <= 2) & (F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
        return pairs.select("a", "b", "n_a", "n_b")

    if hot.isEmpty():
        found = meet(copies, copies, ["cell"])
    else:
        some = copies.join(hot, "cell")
        cold = copies.join(hot, "cell", "left_anti")
        mine = some.withColumn("slice", F.pmod(F.xxhash64("word"), F.col("slices")).cast("int"))
        every = some.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        found = meet(cold, cold, ["cell"]).unionByName(meet(mine, every, ["cell", "slice"]))
    return found.dropDuplicates(["a", "b"])


def last_forms(links: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, by pointer jumping."""
    now = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(now.join(ahead, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "forms")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) from (word, n)."""
    words = stored(words.select("word", "n"), "words")
    pairs = stored(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n"), F.col("n_a").alias("n")) \
        .unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"),
                                  F.col("n_b").alias("n")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    seen = both.groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("n"), best)
    big = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    seen = stored(seen.select("word", "n_near", F.when(big, F.col("best.near")).alias("form"),
                              F.when(big, -F.col("best.less")).alias("form_n")), "word-forms")
    roots = last_forms(seen.where("form is not null"))
    return (words.join(seen, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), F.col("n").cast("long").alias("n"),
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("form_n").cast("long").alias("form_n")))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents"), edit_every=EDIT_EVERY))
