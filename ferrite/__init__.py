"""ferrite: equipment-failure analytics on Spark.

Profiling, leakage-safe feature preparation, exact stratified splits,
class rebalancing, distributed training and tuning of four binary
classifiers, exact evaluation, explanation and batch/streaming scoring,
all expressed as DataFrame, SQL, Spark ML and Structured Streaming jobs.
"""

__version__ = "0.1.0"
