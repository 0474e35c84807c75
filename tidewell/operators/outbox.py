"""Handoffs: idempotent staging, delivery order, receipts and the acknowledgement-complete watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["run_id", "partition_key"]


def ack_watermark(handoffs: DataFrame) -> DataFrame:
    """(run_id, partition_key, watermark): the highest sequence number whose whole prefix is ACKED; keys without one have no row."""
    first_open = handoffs.where("state <> 'ACKED'").groupBy(*KEY).agg(F.min("sequence_no").alias("open"))
    done = handoffs.where("state = 'ACKED'").join(first_open, KEY, "left").where("open is null or sequence_no < open")
    return done.groupBy(*KEY).agg(F.max("sequence_no").alias("watermark"))


def next_deliverable(handoffs: DataFrame, now: Column) -> DataFrame:
    """The first handoff of each key that is not ACKED, if it may be claimed (see due)."""
    head = handoffs.where("state <> 'ACKED'").groupBy(*KEY).agg(F.min("sequence_no").alias("sequence_no"))
    return handoffs.join(head, [*KEY, "sequence_no"], "left_semi").where(due(now))


def due(now: Column) -> Column:
    """READY or retryable and past its time, or in delivery under a lease that has run out."""
    return (F.col("state").isin("READY", "FAILED_RETRYABLE") & (F.col("next_attempt_at") <= now)) | ((F.col("state") == "DELIVERING") & (F.col("lease_until") < now))


def deliverable_handoffs(handoffs: DataFrame, now: Column) -> DataFrame:
    """Claimable handoffs with no earlier open one of their key: what is due is open itself, so that it is its key's first open one, a minimum."""
    return next_deliverable(handoffs, now)


def lease_expiry(handoffs: DataFrame, now: Column) -> DataFrame:
    return handoffs.where((F.col("state") == "DELIVERING") & (F.col("lease_until") < now))


def stage_handoffs(new: DataFrame, existing: DataFrame, order: str | None = None) -> DataFrame:
    """new(idempotency_key, payload) with outcome, error_code and staged_id against existing(idempotency_key, payload).

    INSERT: the key is new, and this is its first row by `order` (by the payload's hash without one). NOOP: the key is
    there, or earlier among these rows, with the same payload. CONFLICT: with another payload. staged_id is the
    handoff_id of the row that holds the key, old or new, where the frames have that column.
    """
    has_id = lambda df: F.col("handoff_id") if "handoff_id" in df.columns else F.lit(None).cast("string")
    known = existing.select("idempotency_key", F.sha2("payload", 256).alias("__known"), has_id(existing).cast("string").alias("__old"))
    rows = new.withColumn("__hash", F.sha2("payload", 256)).withColumn("__id", has_id(new).cast("string")).join(known, "idempotency_key", "left")
    w = Window.partitionBy("idempotency_key").orderBy(*([order] if order else []), "__hash")
    first = F.col("__known").isNull() & (F.row_number().over(w) == 1)
    rows = rows.withColumn("__first", first).withColumn("__held", F.coalesce("__known", F.first("__hash").over(w))).withColumn("staged_id", F.coalesce("__old", F.first("__id").over(w)))
    same = F.col("__held").eqNullSafe(F.col("__hash"))
    rows = rows.withColumn("outcome", F.when(F.col("__first"), "INSERT").when(same, "NOOP").otherwise("CONFLICT"))
    return rows.withColumn("error_code", F.when(F.col("outcome") == "CONFLICT", "ING_IDEMPOTENCY_CONFLICT")).drop("__known", "__old", "__hash", "__id", "__first", "__held")


def apply_receipts(handoffs: DataFrame, receipts: DataFrame, now: Column, wait: int = 30) -> DataFrame:
    """handoffs with new_state, receipt_ref, error_code, retry_at from receipts(handoff_id, durable, receipt_ref): one row for each handoff.

    A durable receipt acknowledges, and gives its reference; of several the least reference counts, so that reruns agree.
    What was ACKED before stays so and keeps the receipt_ref that it has (none where handoffs have no such column). A
    receipt that is not durable, or none, is retried after `wait` seconds. Where handoffs have expected_receipt_ref, a
    receipt of another reference counts as none.
    """
    r = receipts.select("handoff_id", F.coalesce("durable", F.lit(False)).alias("durable"), F.col("receipt_ref").alias("__ref"))
    if "expected_receipt_ref" in handoffs.columns:
        own = handoffs.select("handoff_id", "expected_receipt_ref").distinct().join(r, "handoff_id").where("expected_receipt_ref is null or expected_receipt_ref = __ref")
        r = own.select("handoff_id", "durable", "__ref")
    r = r.groupBy("handoff_id").agg(F.max("durable").alias("__durable"), F.min(F.when(F.col("durable"), F.col("__ref"))).alias("__ref"))
    held = F.col("receipt_ref") if "receipt_ref" in handoffs.columns else F.lit(None).cast("string")
    before, acks = F.coalesce(F.col("state") == "ACKED", F.lit(False)), F.coalesce("__durable", F.lit(False))
    code = F.when(~before & ~acks, F.when(F.col("__durable").isNotNull(), "ING_ACK_NOT_DURABLE").otherwise("ING_DOWNSTREAM_UNAVAILABLE"))
    ref = F.when(before, held).when(acks, F.col("__ref"))
    return (
        handoffs.join(r, "handoff_id", "left").withColumn("new_state", F.when(before | acks, "ACKED").otherwise("FAILED_RETRYABLE"))
        .withColumn("error_code", code).withColumn("retry_at", F.when(code.isNotNull(), now + F.make_dt_interval(secs=F.lit(wait)))).withColumn("receipt_ref", ref).drop("__durable", "__ref")
    )


def resume_from(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Records past their source's stored ordinal; error_code ING_CHECKPOINT_OUT_OF_RANGE on all rows of a source whose checkpoint lies beyond its end."""
    ends = records.groupBy("source_id").agg(F.max("ordinal").alias("__end"))
    cp = checkpoints.select("source_id", F.col("ordinal").alias("__at")).join(ends, "source_id")
    out = records.join(cp, "source_id", "left").withColumn("error_code", F.when(F.col("__at") > F.col("__end"), "ING_CHECKPOINT_OUT_OF_RANGE"))
    return out.where(F.col("error_code").isNotNull() | (F.col("ordinal") > F.coalesce("__at", F.lit(-1)))).drop("__at", "__end")


def batch_slice(records: DataFrame, checkpoints: DataFrame, n: int = 100) -> DataFrame:
    """The next n records of each source past its checkpoint."""
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("ordinal"))
    return resume_from(records, checkpoints).where("error_code is null").withColumn("__r", rank).where(F.col("__r") <= n).drop("__r", "error_code")


def run_order(runs: DataFrame) -> DataFrame:
    """Runs in the order of claiming: DELTA before the other phases, then age."""
    return runs.withColumn("claim_order", F.row_number().over(Window.partitionBy("source_id").orderBy(F.col("phase") != "DELTA", "updated_at", "run_id")))


def drained_runs(runs: DataFrame, handoffs: DataFrame, quarantine: DataFrame, partitions: DataFrame | None = None, issues: DataFrame | None = None) -> DataFrame:
    """Running runs without an open handoff, a blocking open quarantine or a partition that has not succeeded, and the state in which they end.

    Any quarantine that does not block, or open issue, makes it COMPLETED_WITH_WARNINGS.
    """
    if partitions is not None:
        runs = runs.join(partitions.where("state <> 'SUCCEEDED'").select("run_id").distinct(), "run_id", "left_anti")
    open_h = handoffs.where("state <> 'ACKED'").select("run_id").distinct()
    held = quarantine.where("lifecycle_state not in ('RESOLVED', 'DISMISSED')")
    blocked, warned = held.where("blocking").select("run_id").distinct(), held.where("not blocking").select("run_id")
    warned = (warned if issues is None else warned.unionByName(issues.where("status = 'OPEN'").select("run_id"))).distinct().withColumn("w", F.lit(True))
    done = runs.where("state = 'RUNNING'").join(open_h, "run_id", "left_anti").join(blocked, "run_id", "left_anti").join(warned, "run_id", "left")
    return done.select("run_id", F.when(F.col("w"), "COMPLETED_WITH_WARNINGS").otherwise("SUCCEEDED").alias("final_state"))


def resolved_by_ack(quarantine: DataFrame, handoffs: DataFrame) -> DataFrame:
    """Retry-ready quarantine whose object has a later attempt in the same run with an acknowledged handoff (run_id, source_object_id, attempt_no, state)."""
    acked = handoffs.where("state = 'ACKED'").groupBy("run_id", "source_object_id").agg(F.max("attempt_no").alias("done"))
    q = quarantine.where("lifecycle_state = 'RETRY_READY'")
    return q.join(acked, ["run_id", "source_object_id"]).where("attempt_no < done").select("quarantine_id", "run_id", "source_object_id", "attempt_no", "done")


def capacity(limits: dict[str, int], counts: DataFrame) -> DataFrame:
    """counts(scope, used) with what is left of each scope's limit, never below 0."""
    limit = F.coalesce(*(F.when(F.col("scope") == k, v) for k, v in limits.items()))
    return counts.withColumn("available", F.greatest(F.lit(0).cast("long"), limit - F.col("used")))
