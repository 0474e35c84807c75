"""Queries over handoffs, runs and schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import iso_micros
from ..operators import governance, outbox
from .registry import query

def now():
    return F.lit("2000-06-01").cast("timestamp_ntz")


NOW_SQL = "TIMESTAMP '2000-06-01 00:00:00'"
DUE_SQL = f"((state IN ('READY','FAILED_RETRYABLE') AND next_attempt_at <= {NOW_SQL}) OR (state = 'DELIVERING' AND lease_until < {NOW_SQL}))"
HEAD_SQL = "NOT EXISTS (SELECT 1 FROM handoffs e WHERE e.run_id = h.run_id AND e.sequence_no < h.sequence_no AND e.state <> 'ACKED')"


@query("""SELECT run_id, partition_key, max(sequence_no) AS watermark FROM (
  SELECT *, sum(CASE WHEN state <> 'ACKED' THEN 1 ELSE 0 END) OVER (PARTITION BY run_id, partition_key ORDER BY sequence_no) AS bad FROM handoffs
) WHERE bad = 0 GROUP BY run_id, partition_key""", "handoffs")
def ack_watermark(handoffs):
    return outbox.ack_watermark(handoffs)


@query(f"SELECT run_id, sequence_no, state FROM handoffs h WHERE state <> 'ACKED' AND {HEAD_SQL} AND {DUE_SQL}", "handoffs")
def next_deliverable(handoffs):
    return outbox.next_deliverable(handoffs, now()).select("run_id", "sequence_no", "state")


@query(f"SELECT run_id, partition_key, sequence_no, state FROM handoffs h WHERE {HEAD_SQL} AND {DUE_SQL}", "handoffs")
def deliverable_handoffs(handoffs):
    return outbox.deliverable_handoffs(handoffs, now()).select("run_id", "partition_key", "sequence_no", "state")


@query(f"SELECT run_id, sequence_no FROM handoffs WHERE state = 'DELIVERING' AND lease_until < {NOW_SQL}", "handoffs")
def lease_expiry(handoffs):
    return outbox.lease_expiry(handoffs, now()).select("run_id", "sequence_no")


@query(f"""SELECT run_id, sequence_no, CASE WHEN state = 'ACKED' OR durable THEN 'ACKED' ELSE 'FAILED_RETRYABLE' END AS new_state,
  CASE WHEN state = 'ACKED' THEN concat('held', CAST(payload_key AS STRING)) WHEN durable THEN concat('r', CAST(payload_key AS STRING)) END AS receipt_ref,
  CASE WHEN state = 'ACKED' OR durable THEN NULL WHEN durable IS NOT NULL THEN 'ING_ACK_NOT_DURABLE' ELSE 'ING_DOWNSTREAM_UNAVAILABLE' END AS error_code,
  CASE WHEN state = 'ACKED' OR durable THEN NULL ELSE strftime({NOW_SQL} + INTERVAL 30 SECOND, '%Y-%m-%dT%H:%M:%S.%fZ') END AS retry_at
FROM (SELECT *, CASE WHEN payload_key % 3 <> 2 THEN payload_key % 3 = 0 END AS durable FROM handoffs)""", "handoffs")
def apply_receipts(handoffs):
    """Receipts that come once, twice alike, and a second time without being durable; acknowledged handoffs have theirs."""
    h = handoffs.withColumn("handoff_id", F.concat_ws(":", "run_id", "sequence_no")).withColumn("receipt_ref", F.expr("case when state = 'ACKED' then concat('held', payload_key) end"))
    once = h.where("payload_key % 3 <> 2").select("handoff_id", F.expr("payload_key % 3 = 0").alias("durable"), F.expr("concat('r', payload_key)").alias("receipt_ref"), "payload_key")
    weak = once.where("payload_key % 6 = 0").select("handoff_id", F.lit(False).alias("durable"), F.lit("a-weak-one").alias("receipt_ref"))
    receipts = once.unionByName(once.where("payload_key % 4 = 0")).drop("payload_key").unionByName(weak)
    out = outbox.apply_receipts(h, receipts, now())
    return out.select("run_id", "sequence_no", "new_state", "receipt_ref", "error_code", iso_micros("retry_at").alias("retry_at"))


@query("""WITH n AS (SELECT concat('r', CAST(doc_id AS STRING)) AS idempotency_key, 1 AS place, text AS payload FROM documents
  UNION ALL SELECT concat('r', CAST(doc_id AS STRING)), 2, CASE WHEN doc_id % 10 = 0 THEN text ELSE concat(text, '?') END FROM documents WHERE doc_id % 5 = 0),
 e AS (SELECT concat('r', CAST(doc_id AS STRING)) AS k, CASE WHEN doc_id % 3 = 0 THEN text ELSE concat(text, '!') END AS held FROM documents WHERE doc_id % 2 = 0),
 b AS (SELECT n.*, coalesce(e.held, first_value(payload) OVER (PARTITION BY idempotency_key ORDER BY place)) AS held, e.k IS NULL AND place = 1 AS fresh FROM n LEFT JOIN e ON e.k = n.idempotency_key)
SELECT idempotency_key, place, CASE WHEN fresh THEN 'INSERT' WHEN payload = held THEN 'NOOP' ELSE 'CONFLICT' END AS outcome, CASE WHEN NOT fresh AND payload <> held THEN 'ING_IDEMPOTENCY_CONFLICT' END AS error_code FROM b""", "documents")
def stage_handoffs(documents):
    key = F.expr("concat('r', doc_id)").alias("idempotency_key")
    new = documents.select(key, F.lit(1).alias("place"), F.col("text").alias("payload"))
    new = new.unionByName(documents.where("doc_id % 5 = 0").select(key, F.lit(2).alias("place"), F.expr("if(doc_id % 10 = 0, text, concat(text, '?'))").alias("payload")))
    old = documents.where("doc_id % 2 = 0").select(key, F.expr("if(doc_id % 3 = 0, text, concat(text, '!'))").alias("payload"))
    return outbox.stage_handoffs(new, old, "place").select("idempotency_key", "place", "outcome", "error_code")


CHECKPOINTS = "SELECT source_id, CASE WHEN source_id = 'src-3' THEN 9000000 ELSE 700 END AS cp FROM (SELECT DISTINCT source_id FROM records)"


def _checkpoints(records: DataFrame) -> DataFrame:
    return records.select("source_id").distinct().withColumn("ordinal", F.expr("if(source_id = 'src-3', 9000000, 700)"))


@query(f"""SELECT r.source_id, ordinal, CASE WHEN cp > e THEN 'ING_CHECKPOINT_OUT_OF_RANGE' END AS error_code
FROM records r JOIN ({CHECKPOINTS}) c ON r.source_id = c.source_id JOIN (SELECT source_id, max(ordinal) AS e FROM records GROUP BY 1) x ON x.source_id = r.source_id WHERE cp > e OR ordinal > cp""", "records")
def resume_from(records):
    return outbox.resume_from(records, _checkpoints(records)).select("source_id", "ordinal", "error_code")


@query("""SELECT source_id, ordinal FROM (SELECT source_id, ordinal, row_number() OVER (PARTITION BY source_id ORDER BY ordinal) AS k FROM records
  WHERE source_id <> 'src-3' AND ordinal > 700) WHERE k <= 10""", "records")
def batch_slice(records):
    return outbox.batch_slice(records, _checkpoints(records), 10).select("source_id", "ordinal")


@query("""WITH held AS (SELECT * FROM quarantine WHERE lifecycle_state NOT IN ('RESOLVED','DISMISSED'))
SELECT run_id, CASE WHEN EXISTS (SELECT 1 FROM held q WHERE q.run_id = r.run_id AND NOT blocking) OR EXISTS (SELECT 1 FROM issues i WHERE i.run_id = r.run_id AND i.status = 'OPEN' AND i.severity = 'WARNING') THEN 'COMPLETED_WITH_WARNINGS' ELSE 'SUCCEEDED' END AS final_state
FROM runs r WHERE state = 'SUCCEEDED' AND run_id % 7 <> 0 AND NOT EXISTS (SELECT 1 FROM handoffs h WHERE h.run_id = r.run_id AND h.state <> 'ACKED') AND NOT EXISTS (SELECT 1 FROM held q WHERE q.run_id = r.run_id AND blocking)""", "runs handoffs quarantine issues")
def drained_runs(runs, handoffs, quarantine, issues):
    running = runs.withColumn("state", F.when(F.col("state") == "SUCCEEDED", "RUNNING").otherwise("PAUSED"))
    partitions = runs.select("run_id", F.when(F.col("run_id") % 7 == 0, "RUNNING").otherwise("SUCCEEDED").alias("state"))
    return outbox.drained_runs(running, handoffs, quarantine, partitions, issues.where("severity = 'WARNING'"))


@query("""SELECT quarantine_id, q.run_id, q.source_object_id, q.attempt_no, max(h.n) AS done FROM quarantine q
  JOIN (SELECT event_id % 1500 AS run_id, concat('obj-', CAST(user_id AS STRING)) AS o, event_id % 5 AS n FROM events WHERE event_type <> 'signup') h ON h.run_id = q.run_id AND h.o = q.source_object_id
  WHERE lifecycle_state = 'RETRY_READY' AND q.attempt_no < h.n GROUP BY ALL""", "quarantine events")
def resolved_by_ack(quarantine, events):
    acked = events.where("event_type <> 'signup'").selectExpr("event_id % 1500 run_id", "concat('obj-', user_id) source_object_id", "event_id % 5 attempt_no", "'ACKED' state")
    return outbox.resolved_by_ack(quarantine, acked)


@query("""SELECT source_id, run_id, row_number() OVER (PARTITION BY source_id ORDER BY phase <> 'DELTA', updated_at, run_id) AS claim_order FROM runs""", "runs")
def run_claim_order(runs):
    return outbox.run_order(runs).select("source_id", "run_id", "claim_order")


@query("""WITH heads AS (SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY CASE workload_class WHEN 'ORDINARY' THEN 0 WHEN 'RECOVERY' THEN 1 ELSE 2 END, next_run, schedule_id) AS k FROM schedules WHERE state = 'ENABLED')
SELECT tenant_id, schedule_id, row_number() OVER (ORDER BY CASE workload_class WHEN 'ORDINARY' THEN 0 WHEN 'RECOVERY' THEN 1 ELSE 2 END, last_dispatched NULLS FIRST, next_run, tenant_id) AS turn FROM heads WHERE k = 1""", "schedules")
def fair_tenant_head(schedules):
    return governance.fair_tenant_head(schedules)


@query("""SELECT schedule_id, source_id FROM schedules s WHERE state = 'ENABLED'
 AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT concat('src-', CAST(user_id AS STRING)) AS source_id FROM attempt_src WHERE outcome = 'TRANSIENT') h WHERE h.source_id = s.source_id)
 AND NOT EXISTS (SELECT 1 FROM runs r WHERE r.source_id = s.source_id AND r.state = 'RUNNING')
 AND NOT EXISTS (SELECT 1 FROM issues i WHERE i.source_id = s.source_id AND i.status = 'OPEN' AND i.issue_code = 'ING_RUN_RECOVERY_BUDGET_EXHAUSTED')""".replace("attempt_src WHERE outcome = 'TRANSIENT'", "(SELECT source_id AS user_id, outcome FROM attempt_log) WHERE outcome = 'TRANSIENT' AND user_id > 100"), "schedules runs issues attempt_log")
def eligible_sources(schedules, runs, issues, attempt_log):
    gated = attempt_log.where("outcome = 'TRANSIENT' and source_id > 100").select(F.expr("concat('src-', source_id)").alias("source_id"))
    return governance.eligible_sources(schedules, gated, runs, issues).select("schedule_id", "source_id")


@query("""SELECT tenant_id, count(*) AS sources, 3 AS admitted_limit, count(*) < 3 AS admits FROM (
 SELECT tenant_id, source_id FROM runs WHERE state IN ('RUNNING','PAUSED') UNION SELECT tenant_id, source_id FROM schedules WHERE state = 'ENABLED' AND last_dispatched > 300) GROUP BY tenant_id""", "runs schedules")
def admitted_sources(runs, schedules):
    return governance.admitted_sources(runs, schedules.where("last_dispatched > 300"), 6, "SOFT")


@query("""SELECT source_id, 'RUN' AS origin FROM runs WHERE state IN ('RUNNING','PAUSED') UNION ALL SELECT source_id, 'LEASE' FROM schedules WHERE state = 'ENABLED'""", "runs schedules")
def active_union(runs, schedules):
    return governance.active_union(runs, schedules).select("source_id", "origin")


@query("""SELECT schedule_id, slot, run_id FROM (SELECT schedule_id, strftime(updated_at, '%Y-%m-%d') AS slot, run_id, row_number() OVER (PARTITION BY schedule_id, updated_at ORDER BY run_id) AS k FROM runs) WHERE k = 1""", "runs")
def preflight_slots(runs):
    return governance.preflight_slots(runs, "updated_at").select("schedule_id", F.date_format("updated_at", "yyyy-MM-dd").alias("slot"), "run_id")


@query("""SELECT run_id, source_object_id, quarantine_id, row_number() OVER (PARTITION BY run_id, source_object_id ORDER BY created_at, quarantine_id) AS attempt_number FROM quarantine""", "quarantine")
def attempt_numbers(quarantine):
    return governance.attempt_numbers(quarantine, ["run_id", "source_object_id"], ["created_at", "quarantine_id"]).select("run_id", "source_object_id", "quarantine_id", F.col("attempt_number"))


@query("""SELECT run_id, source_object_id, CAST(max(attempt_no) + 1 AS BIGINT) AS next_attempt FROM quarantine GROUP BY ALL""", "quarantine")
def next_attempt(quarantine):
    return governance.next_attempt(quarantine)


@query("""SELECT replay_id, CASE WHEN state = 'SUCCEEDED' THEN 'RESOLVED' WHEN attempts < max_attempts THEN 'REPROCESSING' ELSE 'OPEN' END AS quarantine_state,
 CASE WHEN state = 'SUCCEEDED' THEN 'SUCCEEDED' WHEN attempts < max_attempts THEN 'RETRY_WAIT' ELSE 'FAILED' END AS outcome FROM replays WHERE state <> 'RUNNING'""", "replays")
def replay_outcomes(replays):
    return governance.replay_outcomes(replays.where("state <> 'RUNNING'")).select("replay_id", "quarantine_state", "outcome")


@query("""SELECT event_id, source_id, a AS attempt, CASE WHEN outcome = 'TRANSIENT' AND a <= 3 AND e + 60 <= 86400 THEN 'RETRY' ELSE 'BLOCKED' END AS decision FROM (
 SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY happened_at, event_id) AS a, CAST(epoch(happened_at) AS BIGINT) - CAST(epoch(first_value(happened_at) OVER (PARTITION BY source_id ORDER BY happened_at, event_id)) AS BIGINT) AS e FROM attempt_log WHERE outcome <> 'SUCCESS')""".replace("CAST(epoch(happened_at) AS BIGINT)", "CAST(floor(epoch(happened_at)) AS BIGINT)").replace("CAST(epoch(first_value(happened_at) OVER (PARTITION BY source_id ORDER BY happened_at, event_id)) AS BIGINT)", "CAST(floor(epoch(first_value(happened_at) OVER (PARTITION BY source_id ORDER BY happened_at, event_id))) AS BIGINT)"), "attempt_log")
def activation_retry(attempt_log):
    failures = attempt_log.where("outcome <> 'SUCCESS'")
    return governance.activation_retry(failures, 3, 60, 86400).select("event_id", "source_id", "attempt", "decision")


@query("""SELECT quarantine_id, run_id, k AS claim_no, CASE WHEN k <= 1 + run_id % 2 THEN 'ADMITTED' ELSE 'EXHAUSTED' END AS decision, k = 2 + run_id % 2 AS opens_incident FROM (
 SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY created_at, quarantine_id) AS k FROM quarantine)""", "quarantine")
def recovery_admission(quarantine):
    sessions = quarantine.select("run_id", F.expr("cast(1 + run_id % 2 as int)").alias("max_attempts")).distinct()
    claims = quarantine.select("quarantine_id", "run_id", F.col("created_at").alias("claimed_at"), F.col("quarantine_id").alias("claim_id"))
    return governance.recovery_admission(claims, sessions.withColumn("deadline_at", F.lit("2100-01-01").cast("timestamp_ntz"))).select("quarantine_id", "run_id", "claim_no", "decision", "opens_incident")


@query("""SELECT run_id, arg_max(epoch, epoch) AS latest_epoch, greatest(0, arg_max(max_attempts - attempts, epoch)) AS remaining, CAST(sum(attempts) AS BIGINT) AS total_attempts
 FROM (SELECT run_id, quarantine_id AS epoch, attempt_no AS attempts, 2 AS max_attempts FROM quarantine) GROUP BY run_id""", "quarantine")
def recovery_totals(quarantine):
    return governance.recovery_totals(quarantine.select("run_id", F.col("quarantine_id").alias("epoch"), F.col("attempt_no").alias("attempts"), F.lit(2).alias("max_attempts")))


@query("""SELECT source_id, event_id, previous, outcome FROM (SELECT *, lag(outcome) OVER (PARTITION BY source_id ORDER BY happened_at, event_id) AS previous FROM attempt_log)
 WHERE previous IS NOT NULL AND NOT ((previous, outcome) IN (('SUCCESS','TRANSIENT'), ('TRANSIENT','SUCCESS'), ('SUCCESS','SUCCESS'), ('SUCCESS','DATA')))""", "attempt_log")
def transition_audit(attempt_log):
    edges = [("SUCCESS", "TRANSIENT"), ("TRANSIENT", "SUCCESS"), ("SUCCESS", "SUCCESS"), ("SUCCESS", "DATA")]
    return governance.transition_audit(attempt_log, ["source_id"], ["happened_at", "event_id"], "outcome", edges).select("source_id", "event_id", "previous", "outcome")


@query("""WITH p AS (SELECT source_id, max(run_id) AS publication_id, arg_max(bundle_checksum, run_id) AS checksum FROM runs GROUP BY 1),
 s AS (SELECT source_id, CAST(replace(source_id, 'src-', '') AS INTEGER) AS n, publication_id AS top, checksum FROM p),
 o AS (SELECT *, CASE WHEN n % 4 = 3 OR n % 4 = 2 THEN 'ACCEPTED' WHEN n % 4 = 0 THEN 'REPEATED' ELSE 'REJECTED' END AS outcome FROM s)
SELECT source_id, outcome, CASE WHEN outcome = 'REJECTED' THEN top + 1 ELSE top END AS publication_id,
 CASE WHEN outcome = 'REJECTED' THEN 'PAUSED' WHEN top % 5 = 0 OR (top % 2 = 0 AND n % 4 = 0 AND n % 3 = 0) THEN 'DISABLED' WHEN n % 4 = 0 THEN 'PAUSED' WHEN n % 4 = 2 AND n % 3 <> 0 THEN 'PAUSED' ELSE 'ACTIVE' END AS state,
 CASE WHEN outcome = 'ACCEPTED' THEN 0 ELSE 77 END AS next_run, CASE WHEN outcome = 'ACCEPTED' THEN 0 ELSE 3 END AS activation_failures FROM o""", "runs")
def accept_publications(runs):
    """Publications of all runs against schedules that have the newest one already, one beyond it, the one before, or none."""
    p = runs.select("source_id", F.col("run_id").alias("publication_id"), F.col("run_id").alias("sequence"), F.col("bundle_checksum").alias("checksum"), (F.col("run_id") % 5 != 0).alias("enabled"), (F.col("run_id") % 2 == 0).alias("once"))
    n = F.regexp_replace("source_id", "src-", "").cast("int")
    top = p.groupBy("source_id").agg(F.max("sequence").alias("top"), F.max_by("checksum", "sequence").alias("checksum")).withColumn("n", n)
    has = F.when(F.col("n") % 4 == 0, F.col("top")).when(F.col("n") % 4 == 1, F.col("top") + 1).otherwise(F.col("top") - 1)
    consumed = F.when((F.col("n") % 4 == 0) & (F.col("n") % 3 == 0), F.col("top"))
    s = top.where("n % 4 <> 3").select(
        "source_id", has.alias("publication_id"), has.alias("sequence"), "checksum", F.lit("PAUSED").alias("state"), F.lit(77).alias("next_run"), F.lit(3).alias("activation_failures"), (F.col("n") % 3 == 0).alias("activation_blocked"),
        consumed.alias("consumed_publication_id"),
    )
    return governance.accept_publications(p, s).select("source_id", "outcome", "publication_id", "state", "next_run", "activation_failures")


@query("""SELECT schedule_id, strftime(updated_at, '%Y-%m-%d') AS slot, run_id, CASE WHEN NOT once THEN strftime(updated_at + INTERVAL 3600 SECOND, '%Y-%m-%dT%H:%M:%S.%fZ') END AS next_due, CASE WHEN once THEN 'DISABLED' ELSE 'ACTIVE' END AS state
 FROM (SELECT schedule_id, updated_at, min(run_id) AS run_id, CAST(replace(schedule_id, 'schedule-', '') AS INTEGER) % 2 = 1 AS once FROM runs GROUP BY 1, 2)""", "runs")
def next_due(runs):
    slots = governance.preflight_slots(runs, "updated_at").withColumnRenamed("updated_at", "due")
    intervals = runs.select("schedule_id").distinct().select("schedule_id", F.lit(3600).alias("interval_seconds"), (F.regexp_replace("schedule_id", "schedule-", "").cast("int") % 2 == 1).alias("once"))
    out = governance.next_due(slots, intervals)
    return out.select("schedule_id", F.date_format("due", "yyyy-MM-dd").alias("slot"), "run_id", iso_micros("next_due").alias("next_due"), "state")


@query("""SELECT tenant_id, state, count(*) FILTER (phase = 'CATCH_UP') AS "CATCH_UP", count(*) FILTER (phase = 'DELTA') AS "DELTA", count(*) FILTER (phase = 'FULL_SNAPSHOT') AS "FULL_SNAPSHOT" FROM runs GROUP BY tenant_id, state""", "runs")
def run_completion_counts(runs):
    return governance.completion_counts(runs)


@query("""SELECT run_id FROM runs r WHERE state = 'PAUSED' AND control_version = 4 AND NOT EXISTS (SELECT 1 FROM quarantine q WHERE q.run_id = r.run_id AND blocking AND lifecycle_state NOT IN ('RETRY_READY','RESOLVED','DISMISSED'))""", "runs quarantine")
def resume_gate(runs, quarantine):
    return governance.resume_gate(runs, quarantine, 4).select("run_id")


@query("""SELECT quarantine_id, mode AS replay_mode, CASE mode WHEN 'REPRODUCE' THEN ref WHEN 'REPROCESS_TARGET' THEN 'b9:1:c9' ELSE 'active' END AS target_ref,
 concat_ws(':', tenant_id, quarantine_id, mode, CASE mode WHEN 'REPRODUCE' THEN ref WHEN 'REPROCESS_TARGET' THEN 'b9:1:c9' ELSE 'active' END) AS idempotency_key
FROM (SELECT q.quarantine_id, tenant_id, concat_ws(':', bundle_id, bundle_version, bundle_checksum) AS ref, CASE q.quarantine_id % 3 WHEN 0 THEN 'REPRODUCE' WHEN 1 THEN 'REPROCESS_TARGET' ELSE 'REPROCESS_CURRENT' END AS mode
 FROM quarantine q JOIN runs USING (run_id) WHERE lifecycle_state = 'RETRY_READY')""", "quarantine runs")
def plan_replays(quarantine, runs):
    q = quarantine.withColumn("replay_mode", F.expr("case quarantine_id % 3 when 0 then 'REPRODUCE' when 1 then 'REPROCESS_TARGET' else 'REPROCESS_CURRENT' end"))
    return governance.plan_replays(q, runs, "b9:1:c9", "active")


@query("""SELECT run_id, source_object_id, quarantine_id FROM (SELECT *, coalesce(max(CASE WHEN blocking THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY quarantine_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM quarantine) WHERE stopped = 0""", "quarantine")
def stop_at_first_blocking(quarantine):
    return governance.stop_at_first_blocking(quarantine, ["run_id"], "quarantine_id").select("run_id", "source_object_id", "quarantine_id")
