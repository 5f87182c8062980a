"""K5/K6: batch and streaming scoring of readings into risk tiers.

The same saved PipelineModel (preprocessing + classifier) serves both:
batch reads a table, streaming reads new files of the events source as
they arrive.  Scoring is stateless (no watermark or state needed); the
file sink plus the checkpoint location give exactly-once output, and
``availableNow`` processes everything present, then stops.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrite.functions import decide, risk_tier
from ferrite.operators.models import failure_probability
from ferrite.schema import KEY
from ferrite.sources.readings import readings_from_events


def score_readings(model: PipelineModel, rows: DataFrame, threshold: float) -> DataFrame:
    """K3/K5: probability, decision and tier for every reading."""
    p = failure_probability(model.transform(rows), "probability_failure")
    return p.select(KEY, "machine_id", "ts", F.round("probability_failure", 6).alias("probability_failure"),
                    decide(F.col("probability_failure"), threshold).alias("decision"),
                    risk_tier(F.col("probability_failure"), threshold).alias("tier"))


def score_scenario(spark: SparkSession, model: PipelineModel, threshold: float, **values) -> DataFrame:
    """One scenario row (raw sensor values) to probability, decision and tier."""
    from ferrite.schema import READINGS_SCHEMA
    from ferrite.sources.files import scenario_row
    values = {"reading_id": 0, "machine_id": 0, **values}
    row = scenario_row(spark, READINGS_SCHEMA, **values)
    return score_readings(model, row, threshold)


def stream_scores(spark: SparkSession, source_dir: str, model_path: str, threshold: float,
                  out_path: str, checkpoint_path: str, file_glob: str = "events*.parquet",
                  max_files_per_trigger: int = 8) -> None:
    """K6: score new event files of ``source_dir`` into a Parquet sink.

    ``availableNow`` processes every file present in bounded micro-batches
    and stops; rerunning with the same checkpoint only picks up new files.
    """
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(source_dir).schema
    events = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    model = PipelineModel.load(model_path)
    scored = score_readings(model, readings_from_events(events), threshold)
    q = (scored.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint_path).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
