"""The `readings` and `scored` views over the driver's `events` table.

The reference's raw sensor CSV is not in its checkout, so the readings
table is derived deterministically from `events` (FIXTURES.md F1).  All
columns are built-in expressions: Catalyst prunes the scan to the five
event columns used and keeps everything in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(x) -> Column:
    return F.lit(x).cast("double")


def _null_every(key: Column, n: int, value: Column) -> Column:
    return F.when(key % n == 0, F.lit(None).cast("double")).otherwise(value)


def readings_from_events(events: DataFrame) -> DataFrame:
    eid, uid = F.col("event_id"), F.col("user_id")
    m4 = (uid % 4).cast("double")
    k = F.regexp_extract(F.col("props"), r"([0-9]+)", 1).cast("int")
    r = events.select(
        eid.alias("reading_id"),
        F.col("ts"),
        (uid % 20 + 1).cast("bigint").alias("machine_id"),
        F.when(uid % 4 == 0, "CNC").when(uid % 4 == 1, "Pump")
         .when(uid % 4 == 2, "Compressor").otherwise("Robotic Arm").alias("machine_type"),
        F.when(F.col("event_type").isin("error", "purchase"), "peak")
         .when(F.col("event_type") == "signup", "idle").otherwise("normal").alias("operating_mode"),
        (_d(0.35) + (eid * 7919 % 1000).cast("double") / 250).alias("vib"),
        (_d(28) + F.least(F.col("value"), _d(268)) / 4).alias("temp"),
        (_d(2) + m4 * 4 + (eid * 104729 % 500).cast("double") / 50).alias("cur"),
        (_d(10) + m4 * 40 + (eid * 1299709 % 700).cast("double") / 20).alias("pres"),
        (_d(124) + m4 * 800 + k.cast("double") * 10).alias("rpm0"),
        ((eid * 31 % 5756).cast("double") / 10).alias("hours_since_maintenance"),
        (_d(8) + (k % 21).cast("double") / 2).alias("ambient_temp"),
    )
    rid = F.col("reading_id")
    risk = ((F.col("temp") - 28) / 67 * 3 + (F.col("vib") - 0.35) / 4 * 1.5
            + F.col("hours_since_maintenance") / 575.6
            + F.when(F.col("operating_mode") == "peak", _d(0.3)).otherwise(_d(0))
            + (rid * 15485863 % 1000).cast("double") / 1000 * 0.6)
    y = F.when(risk >= 3.0, F.lit(1)).otherwise(F.lit(0))
    r = r.withColumn("y", y)
    yc = F.col("y")
    return r.select(
        rid, "ts", "machine_id", "machine_type",
        _null_every(rid, 24, F.col("vib")).alias("vibration_rms"),
        _null_every(rid, 29, F.col("temp")).alias("temperature_motor"),
        _null_every(rid, 33, F.col("cur")).alias("current_phase_avg"),
        _null_every(rid, 26, F.col("pres")).alias("pressure_level"),
        _null_every(rid, 45, F.col("rpm0")).alias("rpm"),
        "operating_mode", "hours_since_maintenance", "ambient_temp",
        F.when(yc == 1, _d(0.5)).otherwise(_d(24) + (rid % 75).cast("double")).alias("rul_hours"),
        yc.alias("failure_within_24h"),
        F.when(yc == 0, "none").when(rid % 3 == 0, "bearing")
         .when(rid % 3 == 1, "overheat").otherwise("electrical").alias("failure_type"),
        F.when(yc == 1, (F.lit(1000) + rid % 7000).cast("bigint"))
         .otherwise(F.lit(0).cast("bigint")).alias("estimated_repair_cost"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"))


def fixed_score(r: DataFrame | None = None) -> Column:
    """Model-free failure score quantised to 1/1000 (FIXTURES.md F1s)."""
    s = ((F.coalesce(F.col("temperature_motor"), _d(62)) - 28) / 67 * 3
         + (F.coalesce(F.col("vibration_rms"), _d(2.35)) - 0.35) / 4 * 1.5
         + F.col("hours_since_maintenance") / 575.6) / 5
    return F.floor(F.least(F.greatest(s, _d(0)), _d(1)) * 1000).cast("double") / 1000


def _quantised(x: Column) -> Column:
    return F.floor(F.least(F.greatest(x, _d(0)), _d(1)) * 1000).cast("double") / 1000


# Three model-free scorers standing in for trained models in
# the oracle-checked comparison queries (same formulas as the SQL side).
SCORER_NAMES = ["composite", "temperature", "vibration"]


def scorer_columns() -> dict[str, Column]:
    return {
        "composite": fixed_score(),
        "temperature": _quantised((F.coalesce(F.col("temperature_motor"), _d(62)) - 28) / 67),
        "vibration": _quantised((F.coalesce(F.col("vibration_rms"), _d(2.35)) - 0.35) / 4),
    }


def model_scores(r: DataFrame, key_cols=("reading_id",)) -> DataFrame:
    """Long table (key, model, y, score): one row per reading and scorer."""
    cols = scorer_columns()
    wide = r.select(*key_cols, F.col("failure_within_24h").alias("y"),
                    *[c.alias(n) for n, c in cols.items()])
    return wide.unpivot([*key_cols, "y"], list(cols), "model", "score")


def scored_from_readings(r: DataFrame) -> DataFrame:
    return r.select("reading_id", F.col("failure_within_24h").alias("y"),
                    fixed_score().alias("s"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from_readings(readings(spark, sf_dir))
