"""File sources and sinks.

CSV is read with an explicit schema (no inference on the big table),
NaN becomes NULL at the scan, prepared sets are Parquet partitioned by
``split`` so ``where(split = ...)`` prunes partitions, result tables are
small DataFrames written with overwrite, and fitted pipelines use Spark
ML persistence.  Paths may be any Hadoop URI (hdfs://, s3a://, file:).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.schema import RAW_CSV_SCHEMA


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL on floating columns (aggregates skip NULL, not NaN)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_readings_csv(spark: SparkSession, path: str, sep: str = ",",
                      schema: T.StructType = RAW_CSV_SCHEMA) -> DataFrame:
    """A1/A2: the raw readings CSV with a fixed schema."""
    df = (spark.read.schema(schema).option("header", True).option("sep", sep)
          .option("mode", "PERMISSIVE").csv(path))
    return nan_to_null(df)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def resolve_path(spark: SparkSession, candidates: Sequence[str]) -> str:
    """A3: the first existing path, else an error listing every candidate."""
    for c in candidates:
        if path_exists(spark, c):
            return c
    raise FileNotFoundError("no input found; tried:\n  " + "\n  ".join(candidates))


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """A4: small space-padded result tables; header names are trimmed too."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .csv(path))


def write_prepared(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Prepared rows as Parquet, one folder per split value."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def read_prepared(spark: SparkSession, path: str, split: str | None = None,
                  split_col: str = "split") -> DataFrame:
    """A5: prepared rows; a split filter prunes whole partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col(split_col) == split) if split else df


def round_numeric(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def write_result(df: DataFrame, path: str, digits: int | None = 4, fmt: str = "csv") -> None:
    """A result table as a folder of files (rounded unless digits is None)."""
    out = round_numeric(df, digits) if digits is not None else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def file_stamps(spark: SparkSession, path: str) -> tuple:
    """Name, length and time of change of the files under ``path``, asked of its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)))


def save_model(model, path: str) -> None:
    """Fitted pipeline or model, overwriting."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def best_params(table: DataFrame | None, defaults: dict, key_col: str = "params") -> dict:
    """First row's parameters (JSON) over the defaults, defaults if absent."""
    import json
    if table is None:
        return dict(defaults)
    row = table.select(key_col).limit(1).collect()
    if not row or row[0][0] is None:
        return dict(defaults)
    return {**defaults, **json.loads(row[0][0])}


def model_thresholds(metrics: DataFrame, model_col: str = "model",
                     threshold_col: str = "threshold") -> DataFrame:
    """(model, threshold) for a broadcast join."""
    return metrics.select(F.col(model_col).alias("model"), F.col(threshold_col).cast("double").alias("threshold"))


def model_threshold(metrics: DataFrame | None, model: str, default: float = 0.70,
                    model_col: str = "model", threshold_col: str = "threshold") -> float:
    """One model's threshold, ``default`` if absent."""
    if metrics is None:
        return default
    v = (metrics.where(F.col(model_col) == model)
         .agg(F.max(F.col(threshold_col).cast("double")).alias("t")).first()["t"])
    return default if v is None else float(v)


def scenario_row(spark: SparkSession, schema: T.StructType = RAW_CSV_SCHEMA, **values) -> DataFrame:
    """One input row (missing fields NULL); batches and streams use
    the same schema."""
    row = tuple(values.get(f.name) for f in schema.fields)
    return spark.createDataFrame([row], schema)
