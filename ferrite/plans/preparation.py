"""End-to-end preparation (A1 -> B1 -> F1 -> G1-G6 -> A6/A9)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrite.operators import prepare as G
from ferrite.operators.splits import stratified_split
from ferrite.schema import FEATURE_COLS, KEY, LEAKING_COLS, TARGET
from ferrite.session import work_dir
from ferrite.sources import files


@dataclass
class Prepared:
    rows: DataFrame            # key, split, label, features (+ raw features)
    preprocessor: PipelineModel
    feature_names: list[str]
    path: str

    def part(self, split: str) -> DataFrame:
        return self.rows.where(F.col("split") == split)


def select_features(df: DataFrame) -> DataFrame:
    """B1/B2: key, the nine features and the target; leaking columns never pass."""
    out = df.select(KEY, *FEATURE_COLS, TARGET)
    assert not set(LEAKING_COLS) & set(out.columns)
    return out


def run_preprocessing(readings: DataFrame, out_dir: str | None = None, test_fraction: float = 0.2,
                      seed: int = 42) -> Prepared:
    """Split, fit on train only, transform all rows, write partitioned by split.

    The written table cuts the lineage: every later fit reads Parquet.  A row
    group of Parquet is read by one task, so the rows are dealt by key before
    they are written: as many files as the input has row groups would leave
    most cores without work in each pass of each fit.
    """
    spark = readings.sparkSession
    out_dir = out_dir or work_dir(spark, "prepared")
    split = stratified_split(select_features(readings), TARGET, test_fraction, seed)
    split_path = f"{out_dir}/split"
    parts = 2 * spark.sparkContext.defaultParallelism
    files.write_prepared(split.repartition(parts, KEY), split_path)
    split = files.read_prepared(spark, split_path)
    model = G.build_preprocessor().fit(split.where(F.col("split") == "train"))
    names = G.feature_names(model)
    rows = model.transform(split).drop(*G.transform_columns(model))
    rows_path = f"{out_dir}/rows"
    files.write_prepared(rows.repartition(parts, KEY), rows_path)
    files.save_model(model, f"{out_dir}/preprocessor")
    return Prepared(files.read_prepared(spark, rows_path), model, names, rows_path)
