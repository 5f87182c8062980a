"""Result tables and models kept by what they were made from.

An entry is a Parquet table (or a saved model) in the shared folder, named by
its kind and a stamp: a digest of everything that decides its content (files
with length and time of change, parameters, version).  What is there is read;
what is not is made and written once.  A new stamp is a new entry, so nothing
is overwritten that another reader still holds.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ferrite.session import work_dir
from ferrite.sources import files

#: Part of every stamp; to be raised when what is stored changes its meaning.
VERSION = 1


def entry_path(spark: SparkSession, name: str, made_from) -> str:
    stamp = hashlib.sha256(json.dumps([VERSION, name, made_from], sort_keys=True, default=str).encode()).hexdigest()[:20]
    return f"{work_dir(spark, 'registry')}/{name}-{stamp}"


def _there(spark: SparkSession, path: str) -> bool:
    """Whether a finished entry stands at ``path`` (its writers leave _SUCCESS last)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def known_table(spark: SparkSession, name: str, made_from) -> DataFrame | None:
    path = entry_path(spark, name, made_from)
    return spark.read.parquet(path) if _there(spark, path) else None


def stored_table(spark: SparkSession, name: str, made_from, make: Callable[[], DataFrame]) -> DataFrame:
    """The table of this stamp, made and written (unrounded) if it is not there."""
    path = entry_path(spark, name, made_from)
    if not _there(spark, path):
        files.write_result(make(), path, digits=None, fmt="parquet")
    return spark.read.parquet(path)


def stored_model(spark: SparkSession, name: str, made_from, make: Callable[[], PipelineModel]) -> str:
    """Where the pipeline of this stamp is saved; it is fitted and saved if it is not there."""
    path = entry_path(spark, f"model-{name}", made_from)
    if not _there(spark, f"{path}/metadata"):
        files.save_model(make(), path)
    return path
