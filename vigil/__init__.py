"""vigil — Spark-native monitoring loop for a deployed binary classifier.

Every operator is a DataFrame / Spark SQL / Spark ML / Structured Streaming
job: profiling and missingness filtering, feature-contract validation and
quarantine, chronological splits, scoring into an append-only log, exact AUC
and cost-optimal thresholds, KS / chi-square drift with an aggregate alarm,
label-reveal corpus assembly, retrain triggers and a DeLong promotion gate.
"""

__version__ = "0.1.0"
