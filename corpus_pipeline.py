"""Corpus pipeline: each stage calls one operator, writes Parquet, feeds the next.

documents -> quality classifier -> SimHash near-dedup -> personal data -> mixing
sources to target weights -> BPE ids.  Every stage works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freqscope.llm import bpe, mixing, pii, quality, simhash
from freqscope.llm.common import shared_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer rejects go."""
    return quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes ``[KIND]``; ``n_chars`` follows the new text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are dropped or repeated so that the domains' tokens meet the targets."""
    return mixing.apply_mix(docs, table(spark, sf_dir, "labels"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row."""
    encoded = bpe.encode(docs)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("pii", pii_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: No stage but the personal data one has an SQL form: the label model, the links'
#: components, the fitted rates and BPE are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes a table to the shared folder, so a
    lost executor or a driver restart costs one stage at most."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
