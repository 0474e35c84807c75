"""The operational event log as a union of change feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _feed(df: DataFrame, prefix: Column | str, state: str, severity: Column, kind: str, resource: str, **detail: str) -> DataFrame:
    return df.select(
        F.concat(F.lit(prefix) if isinstance(prefix, str) else prefix, F.col(state)).alias("event_type"), severity.alias("severity"), F.col("run_id").cast("string").alias("run_id"),
        F.lit(kind).alias("resource_type"), F.col(resource).cast("string").alias("resource_id"), F.to_json(F.struct(*(F.col(c).alias(k) for k, c in detail.items()))).alias("detail"),
    )


def capture_operational_events(runs: DataFrame, handoffs: DataFrame, quarantine: DataFrame, replays: DataFrame, issues: DataFrame) -> DataFrame:
    """(event_type, severity, run_id, resource_type, resource_id, detail) of five change feeds."""
    level = lambda *pairs: F.coalesce(*(F.when(c, s) for c, s in pairs), F.lit("INFO"))
    replays = replays.join(quarantine.select("quarantine_id", "run_id"), "quarantine_id", "left")
    drift = F.when(F.col("issue_code").startswith("ING_SCHEMA_"), "SCHEMA_DRIFT_").otherwise("ISSUE_")
    feeds = [
        _feed(runs, "RUN_", "state", level((F.col("state") == "FAILED", "ERROR")), "RUN", "run_id", phase="phase"),
        _feed(handoffs, "HANDOFF_", "state", level((F.col("state").startswith("FAILED"), "WARN")), "HANDOFF", "sequence_no", partition="partition_key"),
        _feed(quarantine, "QUARANTINE_", "lifecycle_state", level((F.col("lifecycle_state").isin("OPEN", "REPROCESSING"), "WARN")), "QUARANTINE", "quarantine_id", reason="reason_code"),
        _feed(replays, "REPLAY_", "state", level((F.col("state") == "FAILED", "ERROR"), (F.col("state") == "RETRY_WAIT", "WARN")), "REPLAY", "replay_id", mode="replay_mode"),
        _feed(issues, drift, "status", F.when(F.col("severity") == "ERROR", "ERROR").otherwise("WARN"), "ISSUE", "issue_id", code="issue_code"),
    ]
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f)
    return out
