"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on: AQE for runtime re-planning and skew
# splitting, UTC so timestamps agree with other engines, no web UI.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ferrite",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, read from the session.

    A private folder is made only where the setting is unset and every task
    runs in this process (master ``local`` or ``local[...]``, as in tests).
    On any other master the setting must name a folder all executors share.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ferrite-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder that no earlier call returned: rerunning a query never
    overwrites a table that another lazy frame still reads."""
    return work_dir(spark, f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str = "table"):
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it back.

    Used before a table feeds several passes (Estimator fits, tuning), so
    the passes neither recompute the lineage nor depend on executor-local
    cache blocks: a lost executor costs a re-read, not a recomputation.
    Parquet keeps column pruning and filter pushdown for what follows.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
