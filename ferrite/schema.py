"""Column contracts and domain values of the readings table."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "reading_id"
TARGET = "failure_within_24h"

# The modelling contract (feature lists and their order).
NUMERIC_FEATURES = [
    "vibration_rms",
    "temperature_motor",
    "current_phase_avg",
    "pressure_level",
    "rpm",
    "hours_since_maintenance",
    "ambient_temp",
]
CATEGORICAL_FEATURES = ["machine_type", "operating_mode"]
FEATURE_COLS = [
    "machine_type",
    "vibration_rms",
    "temperature_motor",
    "current_phase_avg",
    "pressure_level",
    "rpm",
    "operating_mode",
    "hours_since_maintenance",
    "ambient_temp",
]
# Columns only known during or after a failure (leakage).
LEAKING_COLS = ["rul_hours", "failure_type", "estimated_repair_cost"]

# Accepted domain per column (the scenario form's ranges).
MACHINE_TYPES = ["CNC", "Pump", "Compressor", "Robotic Arm"]
OPERATING_MODES = ["idle", "normal", "peak"]
NUMERIC_DOMAIN = {
    "vibration_rms": (0.3, 10.0),
    "temperature_motor": (28.0, 95.0),
    "current_phase_avg": (2.0, 35.0),
    "pressure_level": (10.0, 207.0),
    "rpm": (124.0, 4100.0),
    "hours_since_maintenance": (0.0, 576.0),
    "ambient_temp": (8.0, 18.0),
}
CATEGORICAL_DOMAIN = {
    "machine_type": MACHINE_TYPES,
    "operating_mode": OPERATING_MODES,
}

# Moderate-risk floor of the three risk tiers.
MODERATE_RISK_FLOOR = 0.40

READINGS_SCHEMA = T.StructType([
    T.StructField("reading_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("machine_id", T.LongType(), True),
    T.StructField("machine_type", T.StringType(), True),
    T.StructField("vibration_rms", T.DoubleType(), True),
    T.StructField("temperature_motor", T.DoubleType(), True),
    T.StructField("current_phase_avg", T.DoubleType(), True),
    T.StructField("pressure_level", T.DoubleType(), True),
    T.StructField("rpm", T.DoubleType(), True),
    T.StructField("operating_mode", T.StringType(), True),
    T.StructField("hours_since_maintenance", T.DoubleType(), True),
    T.StructField("ambient_temp", T.DoubleType(), True),
    T.StructField("rul_hours", T.DoubleType(), True),
    T.StructField("failure_within_24h", T.IntegerType(), True),
    T.StructField("failure_type", T.StringType(), True),
    T.StructField("estimated_repair_cost", T.LongType(), True),
])

# Schema of the reference's raw CSV (a `timestamp` string, no reading_id).
RAW_CSV_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType(), True)]
    + [f for f in READINGS_SCHEMA.fields if f.name not in ("reading_id", "ts")]
)


def numeric_columns(schema: T.StructType, exclude=("machine_id",)) -> list[str]:
    """All numeric columns of a schema except identifiers."""
    return [f.name for f in schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


# Display labels of encoded features, worded here; the keys are fixed values
# (others fall back to the name without its num__/cat__ prefix).
FEATURE_LABELS = {
    "num__rpm": "Rotation speed (rpm)",
    "num__temperature_motor": "Motor temperature",
    "num__current_phase_avg": "Electric current",
    "num__vibration_rms": "Vibration",
    "num__pressure_level": "Pressure",
    "cat__operating_mode_peak": "Mode 'peak'",
    "cat__operating_mode_idle": "Mode 'idle'",
    "num__hours_since_maintenance": "Hours since maintenance",
    "num__ambient_temp": "Ambient temperature",
}
