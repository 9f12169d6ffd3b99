"""Operator 3: licence scan by canonical digests, DataFrame functions only.

A text is made canonical: lower case; copyright notices go, lines that begin with
``copyright`` or its sign and name an owner or a year, or with "all rights reserved", but
not lines that go on with words of a licence (``copyright notice``, ``copyright holders``); equivalent spellings become one; every run of characters
other than letters and digits becomes one space.  Its SHA-256 is joined to the
digests of known licence texts.  Each line's canonical form is looked up in the same
way among known one-line notices.  The known digests are a fixed list in code, so
the broadcast does not grow with the corpus, and nothing is shuffled.

Defined results: a null or empty text has the digest of the empty text and no
licence; null ids are kept; repeated rows repeat; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty
from .license_texts import DIGESTS, NOTICES, SPELLINGS, TEXTS

COPYRIGHT = r"(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: ``COPYRIGHT`` is the cut of ``OP3_SQL``; RE2 has no lookahead
NOTICE_LINE = (r"(?m)^[^\p{L}\p{N}\n]*(copyright(?![\p{L}\p{N}])(?![^\S\n]*$)"
               r"(?!\s+(notices?|holders?|owners?|laws?|licen[sc]es?|statements?|interests?|protection|permission|disclaimer|"
               r"treaty|act|and|or|in|to|for|on|as)(?![\p{L}\p{N}]))"
               r"|\(c\)(?!\s+you must)|©|all rights reserved)[^\n]*$")
_CLUES = "copyright|\\(c\\)|©|all rights reserved|licen|whilst|per cent|acknowledgement|infringement|commercial|organisation|http:"


def _lines_kept(text: Column) -> Column:
    """Lower case, one spelling, no copyright lines; line breaks stay.  Texts
    without any of the words concerned skip the replacements."""
    low = F.lower(text)
    out = F.regexp_replace(low, NOTICE_LINE, "")
    for pattern, new in SPELLINGS:
        out = F.regexp_replace(out, pattern, new)
    return F.when(low.rlike(_CLUES), out).otherwise(low)


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def canonical(text: Column) -> Column:
    return _plain(_lines_kept(text))


def _values(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    lit = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({lit(a)}, {lit(b)})" for a, b in rows) + " AS t(license, known)")


def known_digests(spark: SparkSession, rows: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """(license, digest): canonical digests; two licences never share one."""
    return _values(spark, rows).select("license", F.sha2(canonical(F.col("known")), 256).alias("digest")).distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         texts: list[tuple[str, str]] = TEXTS, notices: list[tuple[str, str]] = NOTICES,
         digests: list[tuple[str, str]] = DIGESTS) -> DataFrame:
    """(id, digest, license, notices, n_notices): ``license`` if the whole text is a
    known licence, ``notices`` the licences its lines name, sorted."""
    spark = docs.sparkSession
    # line digests are matched inside the row: a constant array of known digests
    pairs = _values(spark, notices).select(F.sha2(canonical(F.col("known")), 256).alias("digest"), "license").distinct()
    held = sorted((r["digest"], r["license"]) for r in pairs.collect())  # as many as the fixed list has
    names = F.create_map(*[F.lit(x) for pair in held for x in pair])
    kept = docs.select(F.col(id_col), _lines_kept(text_or_empty(text_col)).alias("lines"))
    lines = F.filter(F.split("lines", "\n"), lambda s: s.rlike("licen|public domain"))
    found = F.transform(lines, lambda s: F.sha2(_plain(s), 256))
    hits = F.filter(found, lambda d: d.isin([d0 for d0, _ in held]))
    marked = kept.select(F.col(id_col), F.sha2(_plain(F.col("lines")), 256).alias("digest"), hits.alias("hits"))
    known = known_digests(spark, texts)
    if digests:
        known = known.union(_values(spark, digests).select("license", F.col("known").alias("digest"))).distinct()
    joined = marked.join(F.broadcast(known), "digest", "left")
    return joined.select(id_col, "digest", "license",
                         F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda d: names[d]))), ",").alias("notices"),
                         F.size("hits").cast("long").alias("n_notices"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", F.coalesce("license", F.lit("")).alias("license"), "notices", "n_notices")


def _duck() -> str:
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def lines(text: str) -> str:
        out = f"regexp_replace(lower({text}), {lit(COPYRIGHT)}, '', 'g')"
        for pattern, new in SPELLINGS:
            out = f"regexp_replace({out}, {lit(pattern)}, {lit(new.replace('$1', chr(92) + '1'))}, 'g')"
        return out

    def plain(text: str) -> str:
        return f"trim(regexp_replace({text}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"

    def values(rows) -> str:
        return ", ".join(f"({lit(a)}, {lit(b)})" for a, b in rows)

    return f"""
    WITH known(license, t) AS (VALUES {values(TEXTS)}), note(license, t) AS (VALUES {values(NOTICES)}),
    texts AS (SELECT DISTINCT license, sha256({plain(lines('t'))}) AS digest FROM known),
    marks AS (SELECT DISTINCT license, sha256({plain(lines('t'))}) AS digest FROM note),
    docs AS (SELECT row_number() OVER () AS k, doc_id, {lines("coalesce(text, '')")} AS t FROM documents),
    cut AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM docs),
    hits AS (SELECT k, m.license FROM (SELECT k, sha256({plain('line')}) AS digest FROM cut) JOIN marks m USING (digest)),
    sums AS (SELECT k, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n FROM hits GROUP BY k),
    whole AS (SELECT k, doc_id, sha256({plain('t')}) AS digest FROM docs)
    SELECT doc_id, w.digest, coalesce(x.license, '') AS license, coalesce(s.notices, '') AS notices, coalesce(s.n, 0) AS n_notices
    FROM whole w LEFT JOIN texts x USING (digest) LEFT JOIN sums s USING (k)"""


OP3_SQL = _duck()
