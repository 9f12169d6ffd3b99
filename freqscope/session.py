"""SparkSession helpers used by tests, the bench and the examples."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "freqscope", coalesce: bool = True) -> SparkSession:
    """A session tuned for the jobs: AQE on, UTC, no UI.

    ``coalesce=False`` keeps every shuffle at ``shuffle_partitions``: on small
    tables whose rows are cheap in bytes but costly in CPU (hashing), AQE would
    otherwise merge them into one task.  On a cluster the partition count is
    sized to the data and coalescing stays on."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", str(coalesce).lower())
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FREQSCOPE_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the one set on
    the SparkContext.  Only a session of a single local JVM (tests) gets a scratch
    folder when neither is set; on a cluster a missing setting raises."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext use the conf alone
        context = None
    if not folder and context is not None:
        folder = context.getCheckpointDir()
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="freqscope-ckpt-")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", folder)
    if context is not None and not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df):
    """Reliable checkpoint into the shared folder named by
    ``spark.checkpoint.dir`` (never a local checkpoint): survives executor
    loss and lets several plans read one materialised table."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
