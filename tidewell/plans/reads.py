"""Queries that operators ask: searches, status, counts, audits."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions.scalar import iso_micros
from ..operators import health
from ..operators import incidents as I
from ..operators import reports as R
from ..operators.policies import pinned_contract
from .operations import CIRCUITS
from .registry import query

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


@query(f"SELECT source_id, run_id, state, strftime(updated_at, {ISO}) AS updated_at FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY updated_at DESC, run_id DESC) AS k FROM runs WHERE tenant_id = 'tenant-1') WHERE k = 1 AND source_id IN (SELECT DISTINCT source_id FROM issues)", "runs issues")
def source_status(runs, issues):
    return R.source_status(issues.select("source_id").distinct(), runs, "tenant-1").select("source_id", "run_id", "state", iso_micros("updated_at").alias("updated_at"))


@query("SELECT run_id, state FROM runs WHERE tenant_id = 'tenant-2' AND source_id = 'src-7' ORDER BY updated_at DESC, run_id LIMIT 50", "runs")
def run_history(runs):
    return R.search(runs, [F.desc("updated_at"), F.col("run_id")], 50, tenant_id="tenant-2", source_id="src-7").select("run_id", "state")


@query("SELECT event_id, severity, count(*) OVER () = 20 AS truncated FROM (SELECT * FROM ops_events WHERE severity = 'ERROR' ORDER BY occurred_at DESC, event_id DESC LIMIT 20)", "ops_events")
def search_log(ops_events):
    return R.newest_events(ops_events, 20, severity="ERROR", run_id=None).select("event_id", "severity", "truncated")


@query("SELECT source_id AS key, count(*) AS n FROM ops_events WHERE correlation_id = 'corr-3' GROUP BY 1 ORDER BY n DESC, key LIMIT 15", "ops_events")
def aggregate_log(ops_events):
    return R.aggregate_log(ops_events, "source_id", 15, "corr-3")


@query("SELECT event_id FROM ops_events WHERE occurred_at >= TIMESTAMP '2024-01-05 00:00:00' AND occurred_at < TIMESTAMP '2024-01-05 12:00:00'", "ops_events")
def time_window(ops_events):
    return R.time_window(ops_events, "occurred_at", datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 5, 12)).select("event_id")


@query("SELECT issue_id FROM issues WHERE last_updated_at >= TIMESTAMP '2024-01-20 00:00:00'", "issues")
def changed_since(issues):
    return R.changed_since(issues, "last_updated_at", F.lit("2024-01-20").cast("timestamp_ntz")).select("issue_id")


@query("SELECT run_id, sequence_no FROM handoffs WHERE lease_until > TIMESTAMP '2001-01-01 00:00:00'", "handoffs")
def unexpired(handoffs):
    return R.unexpired(handoffs, "lease_until", F.lit("2001-01-01").cast("timestamp_ntz")).select("run_id", "sequence_no")


@query("SELECT quarantine_id FROM quarantine WHERE lifecycle_state NOT IN ('OPEN','RESOLVED','DISMISSED')", "quarantine")
def domain_check(quarantine):
    return R.domain_check(quarantine, "lifecycle_state", ["OPEN", "RESOLVED", "DISMISSED"]).select("quarantine_id")


@query("SELECT run_id FROM runs WHERE tenant_id = 'tenant-0' AND phase = 'DELTA'", "runs")
def optional_filters(runs):
    return R.optional_filters(runs, tenant_id="tenant-0", phase="DELTA", state=None).select("run_id")


@query("SELECT run_id FROM runs ORDER BY run_id DESC LIMIT 200", "runs")
def bounded(runs):
    return R.bounded(runs.orderBy(F.desc("run_id")), 5000).select("run_id")


@query("SELECT quarantine_id, lifecycle_state FROM quarantine WHERE lifecycle_state = 'OPEN' ORDER BY created_at DESC, quarantine_id LIMIT 100", "quarantine")
def quarantine_search(quarantine):
    return R.search(quarantine, [F.desc("created_at"), F.col("quarantine_id")], 100, lifecycle_state="OPEN").select("quarantine_id", "lifecycle_state")


@query("SELECT issue_id, severity FROM issues WHERE status = 'OPEN' AND severity = 'ERROR' AND run_id IN (SELECT run_id FROM runs WHERE tenant_id = 'tenant-3') ORDER BY created_at DESC, issue_id LIMIT 60", "issues runs")
def issue_search(issues, runs):
    return R.search(R.tenant_scope(issues, runs, "tenant-3"), [F.desc("created_at"), F.col("issue_id")], 60, status="OPEN", severity="ERROR").select("issue_id", "severity")


@query("SELECT source_id, segment, n FROM (SELECT source_id, segment, count(*) AS n, max(ordinal) AS last FROM records GROUP BY ALL) WHERE source_id = 'src-4' ORDER BY last DESC LIMIT 3", "records")
def observation_search(records):
    seen = records.groupBy("source_id", "segment").agg(F.count("*").alias("n"), F.max("ordinal").alias("last"))
    return R.search(seen, [F.desc("last")], 3, source_id="src-4").select("source_id", "segment", "n")


@query("SELECT quarantine_id FROM quarantine WHERE run_id IN (SELECT run_id FROM runs WHERE tenant_id = 'tenant-1')", "quarantine runs")
def tenant_scope(quarantine, runs):
    return R.tenant_scope(quarantine, runs, "tenant-1").select("quarantine_id")


@query("SELECT replay_id, replay_mode, quarantine_id, state, attempts FROM replays WHERE attempts > 0", "replays")
def replay_view(replays):
    return R.replay_view(replays.select("replay_id", "quarantine_id", "replay_mode"), replays.where("attempts > 0").select("replay_id", "state", "attempts"))


@query("SELECT p.replay_id, q.reason_code, r.source_id FROM replays p JOIN quarantine q USING (quarantine_id) JOIN runs r USING (run_id)", "replays quarantine runs")
def replay_lineage(replays, quarantine, runs):
    return R.replay_lineage(replays, quarantine, runs)


@query("SELECT quarantine_id, r.source_id, CASE WHEN r.run_id % 2 = 0 THEN concat('T', r.run_id % 4) ELSE 'UNKNOWN' END AS type_code, reason_code FROM quarantine q JOIN runs r ON r.run_id = q.run_id", "quarantine runs")
def quarantine_issue_rows(quarantine, runs):
    snaps = runs.where("run_id % 2 = 0").select("run_id", F.expr("concat('T', run_id % 4)").alias("type_code"))
    return R.quarantine_issue_rows(quarantine, runs, snaps)


@query("""WITH mine AS (SELECT issue_id FROM issues WHERE run_id IN (SELECT run_id FROM runs WHERE tenant_id = 'tenant-2')), items AS (SELECT transition_id % 50 AS session_id, transition_id AS issue_id FROM transitions)
SELECT session_id, issue_id, issue_id IN (SELECT issue_id FROM mine) AS visible, count(*) FILTER (issue_id NOT IN (SELECT issue_id FROM mine)) OVER (PARTITION BY session_id) > 0 AS partial FROM items""", "transitions issues runs")
def live_custody(transitions, issues, runs):
    items = transitions.select((F.col("transition_id") % 50).alias("session_id"), F.col("transition_id").alias("issue_id"))
    return R.live_custody(items, issues, runs, "tenant-2").select("session_id", "issue_id", "visible", "partial")


@query("""SELECT r.run_id FROM runs r JOIN (SELECT schedule_id, concat('c', CAST(activation_failures % 4 AS STRING)) AS checksum, state <> 'DISABLED' AS enabled, CASE WHEN last_dispatched % 2 = 1 THEN TIMESTAMP '2100-01-01' END AS lease FROM schedules) s ON s.schedule_id = r.schedule_id
WHERE r.state = 'PAUSED' AND (lease IS NULL OR lease <= TIMESTAMP '2030-01-01') AND (bundle_checksum <> checksum OR NOT enabled)""", "runs schedules")
def superseded_preflight(runs, schedules):
    waiting = runs.withColumn("state", F.when(F.col("state") == "PAUSED", "PREFLIGHT").otherwise(F.col("state")))
    published = schedules.select(
        "schedule_id", F.expr("concat('c', activation_failures % 4)").alias("publication_checksum"), (F.col("state") != "DISABLED").alias("publication_enabled"),
        F.when(F.col("last_dispatched") % 2 == 1, F.lit("2100-01-01").cast("timestamp_ntz")).alias("lease_until"),
    )
    return R.superseded_runs(waiting, published, F.lit("2030-01-01").cast("timestamp_ntz"))


@query("""WITH waiting AS (SELECT DISTINCT i.run_id FROM issues i JOIN transitions t ON t.transition_id = i.issue_id WHERE t.issue_version > 3)
SELECT tenant_id, source_id, count(*) FILTER (run_id IN (SELECT run_id FROM waiting)) > 0 AS lag FROM runs GROUP BY 1, 2""", "transitions issues runs")
def pending_publication(transitions, issues, runs):
    published = transitions.select(F.col("transition_id").alias("issue_id"), F.when(F.col("issue_version") <= 3, F.col("issue_version")).alias("revision"))
    return R.pending_publication(published, issues, runs)


@query("""WITH c AS (SELECT event_id AS token, user_id % 90 AS session_id, concat('tenant-', CAST(user_id % 3 AS STRING)) AS tenant_id, CASE WHEN user_id % 90 % 4 <> 0 THEN concat('src-', CAST(user_id % 90 % 20 AS STRING)) END AS source_id,
   CASE WHEN event_type <> 'view' THEN 'OPEN' END AS state, CASE WHEN event_id % 3 = 0 THEN event_id - event_id % 90 END AS parent_token FROM events),
 s AS (SELECT DISTINCT user_id % 90 AS session_id, concat('tenant-', CAST(user_id % 90 % 3 AS STRING)) AS tenant_id, CASE WHEN user_id % 90 % 4 <> 0 THEN concat('src-', CAST(user_id % 90 % 20 AS STRING)) END AS source_id, CASE WHEN user_id % 90 % 5 <> 0 THEN 'OPEN' END AS state FROM events),
 g AS (SELECT DISTINCT tenant_id, source_id, state FROM s WHERE session_id % 7 <> 0)
SELECT c.token, c.session_id, c.tenant_id, c.source_id, c.state, c.parent_token FROM c JOIN s ON c.session_id = s.session_id AND c.tenant_id = s.tenant_id AND c.source_id IS NOT DISTINCT FROM s.source_id AND c.state IS NOT DISTINCT FROM s.state
 JOIN g ON c.tenant_id = g.tenant_id AND c.source_id IS NOT DISTINCT FROM g.source_id AND c.state IS NOT DISTINCT FROM g.state LEFT JOIN c p ON p.token = c.parent_token WHERE c.parent_token IS NULL OR p.session_id = c.session_id""", "events")
def bookmark_scope_match(events):
    session = F.col("user_id") % 90
    source = F.when(session % 4 != 0, F.concat(F.lit("src-"), session % 20))
    cursors = events.select(
        F.col("event_id").alias("token"), session.alias("session_id"), F.expr("concat('tenant-', user_id % 3)").alias("tenant_id"), source.alias("source_id"),
        F.when(F.col("event_type") != "view", "OPEN").alias("state"), F.when(F.col("event_id") % 3 == 0, F.col("event_id") - F.col("event_id") % 90).alias("parent_token"),
    )
    sessions = events.select(session.alias("session_id"), F.concat(F.lit("tenant-"), session % 3).alias("tenant_id"), source.alias("source_id"), F.when(session % 5 != 0, "OPEN").alias("state")).distinct()
    return R.bookmark_scope_match(cursors, sessions, sessions.where("session_id % 7 <> 0"))


@query("""SELECT concat('r', CAST(q.quarantine_id AS STRING)) AS review_key, i.issue_code, i.status FROM quarantine q JOIN issues i ON i.issue_id = q.quarantine_id
 WHERE q.quarantine_id % 3 <> 0 AND q.created_at <= TIMESTAMP '2024-01-20' ORDER BY q.created_at, review_key LIMIT 100""", "quarantine issues")
def review_queue(quarantine, issues):
    state = F.when(F.col("quarantine_id") % 3 == 0, "ACKED").when(F.col("quarantine_id") % 3 == 1, "READY").otherwise("FAILED_RETRYABLE")
    reviews = quarantine.select(F.expr("concat('r', quarantine_id)").alias("review_key"), F.col("quarantine_id").alias("issue_id"), state.alias("state"), F.col("created_at").alias("next_attempt_at"), "created_at")
    return R.review_queue(reviews, issues, F.lit("2024-01-20").cast("timestamp_ntz")).select("review_key", "issue_code", "status")


@query("SELECT issue_id, CASE WHEN status = 'OPEN' AND issue_id IN (SELECT quarantine_id FROM quarantine WHERE quarantine_id % 3 = 0) THEN concat('ref-', CAST(issue_id AS STRING)) END AS review_ref FROM issues", "issues quarantine")
def acknowledged_reviews(issues, quarantine):
    reviews = quarantine.select(F.col("quarantine_id").alias("issue_id"), F.when(F.col("quarantine_id") % 3 == 0, "ACKED").otherwise("READY").alias("state"), F.expr("concat('ref-', quarantine_id)").alias("review_ref"))
    return R.acknowledged_reviews(issues, reviews).select("issue_id", "review_ref")


@query("SELECT count(*) FILTER (lifecycle = 'OPEN') AS open_incidents, CASE WHEN count(*) FILTER (lifecycle = 'OPEN') > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END AS health FROM (SELECT * FROM transitions ORDER BY lifecycle <> 'OPEN', severity <> 'ERROR', observed_at DESC, issue_id LIMIT 50)", "transitions")
def operational_summary(transitions):
    return R.operational_summary(I.top_incidents(transitions, 50))


LEVELS = """, days AS (SELECT floor(epoch(next_attempt_at) / 86400) AS d, count(*) AS n FROM handoffs WHERE state <> 'ACKED' GROUP BY 1), numbered AS (SELECT row_number() OVER (ORDER BY d) AS k, n FROM days),
 levels AS (SELECT CAST(0 AS BIGINT) AS k, 'NORMAL' AS s UNION ALL SELECT q.k, CASE WHEN q.n >= 40 THEN 'HARD' WHEN f.s IN ('HARD','RECOVERY') THEN CASE WHEN q.n <= 2 THEN 'NORMAL' ELSE 'RECOVERY' END WHEN q.n >= 5 THEN 'SOFT' WHEN f.s = 'SOFT' AND q.n > 2 THEN 'SOFT' ELSE 'NORMAL' END
  FROM levels f JOIN numbered q ON q.k = f.k + 1)
"""
GAUGES = CIRCUITS + LEVELS + """SELECT 'active_runs' AS gauge, count(*) AS value FROM runs WHERE state = 'RUNNING' UNION ALL SELECT 'due_schedules', count(*) FROM schedules WHERE state = 'ENABLED' AND next_run <= 500
 UNION ALL SELECT 'outbox_backlog', count(*) FROM handoffs WHERE state <> 'ACKED' UNION ALL SELECT 'open_quarantine', count(*) FROM quarantine WHERE lifecycle_state = 'OPEN'
 UNION ALL SELECT 'replay_backlog', count(*) FROM replays WHERE state IN ('RETRY_WAIT','RUNNING') UNION ALL SELECT 'retry_attempts', CAST(sum(attempts) AS BIGINT) FROM replays
 UNION ALL SELECT 'open_circuits', count(*) FROM (SELECT source_id, arg_max(status, k) AS status FROM fold GROUP BY 1) WHERE status = 'PAUSED'
 UNION ALL SELECT 'pressure_level', (SELECT max(CASE s WHEN 'NORMAL' THEN 0 WHEN 'SOFT' THEN 1 WHEN 'RECOVERY' THEN 2 ELSE 3 END) FROM (SELECT arg_max(s, k) AS s FROM levels))
 UNION ALL SELECT 'watermark_max_age', CAST(floor(epoch(TIMESTAMP '2030-01-01' - min(next_attempt_at))) AS BIGINT) FROM handoffs WHERE state = 'ACKED'"""


@query(GAUGES, "runs schedules handoffs quarantine replays attempt_log")
def operational_gauges(runs, schedules, handoffs, quarantine, replays, attempt_log):
    n = F.count_if
    circuits = health.circuit_states(attempt_log.select("source_id", F.unix_timestamp("happened_at").alias("at_seconds"), "event_id", "outcome"), window=86400)
    open_ = handoffs.where("state <> 'ACKED'").groupBy(F.expr("unix_timestamp(next_attempt_at) div 86400").alias("at")).agg(F.count("*").alias("backlog"))
    pressure = health.pressure_states(open_.withColumn("tenant_id", F.lit("all")), 5, 40, 2)
    committed = F.min(F.when(F.col("state") == "ACKED", F.unix_seconds(F.col("next_attempt_at").cast("timestamp"))))
    return R.gauges(
        active_runs=(runs, n(F.col("state") == "RUNNING")), due_schedules=(schedules, n((F.col("state") == "ENABLED") & (F.col("next_run") <= 500))), outbox_backlog=(handoffs, n(F.col("state") != "ACKED")),
        open_quarantine=(quarantine, n(F.col("lifecycle_state") == "OPEN")), replay_backlog=(replays, n(F.col("state").isin("RETRY_WAIT", "RUNNING"))), retry_attempts=(replays, F.sum("attempts")),
        open_circuits=(circuits, n(F.col("status") == "PAUSED")), pressure_level=(pressure, F.max(R.pressure_number(F.col("state")))), watermark_max_age=(handoffs, F.lit(1893456000) - committed),
    )


@query("SELECT event_id, t - min(t) OVER (PARTITION BY user_id % 5) >= 7200 AND min(value) OVER (PARTITION BY user_id % 5 ORDER BY t RANGE BETWEEN 7200 PRECEDING AND CURRENT ROW) > 1 AS firing FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events)", "events")
def alert_conditions(events):
    e = events.select("event_id", (F.col("user_id") % 5).alias("series"), F.unix_timestamp("ts").alias("t"), "value")
    return R.alert_conditions(e, "series", "t", "value", 1, 7200).select("event_id", "firing")


@query("SELECT ref, origin, count(*) AS n FROM (SELECT CAST(s_nationkey AS STRING) AS ref, 'supplier' AS origin FROM supplier UNION ALL SELECT CAST(c_nationkey AS STRING), 'customer' FROM customer UNION ALL SELECT CAST(n_regionkey AS STRING), 'nation' FROM nation) GROUP BY ALL", "supplier customer nation")
def reference_usage_union(supplier, customer, nation):
    return R.reference_usage(supplier=(supplier, "s_nationkey"), customer=(customer, "c_nationkey"), nation=(nation, "n_regionkey")).groupBy("ref", "origin").agg(F.count("*").alias("n"))


@query("SELECT coalesce(u.ref, h.ref) AS ref, coalesce(uses, 0) AS uses, coalesce(held, FALSE) AS held, coalesce(uses, 0) = 0 AND NOT coalesce(held, FALSE) AS removable FROM (SELECT CAST(s_nationkey AS STRING) AS ref, count(*) AS uses FROM supplier GROUP BY 1) u FULL OUTER JOIN (SELECT CAST(n_nationkey AS STRING) AS ref, n_nationkey % 3 = 0 AS held FROM nation) h ON u.ref = h.ref", "supplier nation")
def reference_dependencies(supplier, nation):
    holds = nation.select(F.col("n_nationkey").cast("string").alias("ref"), (F.col("n_nationkey") % 3 == 0).alias("held"))
    return R.reference_dependencies(R.reference_usage(supplier=(supplier, "s_nationkey")), holds)


@query("SELECT ref, arg_max(action, ts) = 'APPLY' AS held FROM (SELECT user_id % 40 AS ref, ts, CASE WHEN event_type IN ('error','view') THEN 'APPLY' ELSE 'RELEASE' END AS action FROM events) GROUP BY 1", "events")
def legal_hold_state(events):
    e = events.select((F.col("user_id") % 40).alias("ref"), F.when(F.col("event_type").isin("error", "view"), "APPLY").otherwise("RELEASE").alias("action"), F.col("ts").alias("created_at"), "event_id")
    return R.legal_hold_state(e)


@query("SELECT CASE WHEN grouping(tenant_id) = 1 THEN 'GLOBAL' WHEN grouping(principal) = 1 THEN 'TENANT' ELSE 'PRINCIPAL' END AS level, tenant_id, principal, count(*) AS used, greatest(0, CASE WHEN grouping(tenant_id) = 1 THEN 20000 WHEN grouping(principal) = 1 THEN 3000 ELSE 60 END - count(*)) AS available FROM (SELECT tenant_id, issue_id AS principal FROM transitions) GROUP BY ROLLUP (tenant_id, principal)", "transitions")
def capacity_usage(transitions):
    return R.capacity_usage(transitions.select("tenant_id", F.col("issue_id").alias("principal")), (20000, 3000, 60))


@query("""SELECT 'RUN_PAUSED' AS action, tenant_id AS actor, CAST(run_id AS STRING) AS resource, concat('{"phase":"', phase, '"}') AS detail, 'ALLOWED' AS outcome, NULL AS correlation_id, tenant_id, NULL AS decision_ref FROM runs WHERE state = 'PAUSED'
 UNION ALL SELECT 'QUARANTINE_RESOLVED', source_object_id, CAST(quarantine_id AS STRING), concat('{"reason_code":"', reason_code, '"}'), 'ALLOWED', NULL, NULL, evidence_ref FROM quarantine WHERE lifecycle_state = 'RESOLVED'
 UNION ALL SELECT 'LOG_READ', source_id, CAST(event_id AS STRING), concat('{"event_type":"', event_type, '"}'), CASE WHEN event_type = 'signup' THEN 'DENIED' ELSE 'ALLOWED' END, correlation_id, NULL, NULL FROM ops_events WHERE severity <> 'ERROR'""", "runs quarantine ops_events")
def audit_trail(runs, quarantine, ops_events):
    return R.audit_trail(
        RUN_PAUSED=(runs.where("state = 'PAUSED'"), "tenant_id", "run_id", ["phase"]),
        QUARANTINE_RESOLVED=(quarantine.where("lifecycle_state = 'RESOLVED'").withColumn("decision_ref", F.col("evidence_ref")), "source_object_id", "quarantine_id", ["reason_code"]),
        LOG_READ=(ops_events.where("severity <> 'ERROR'").withColumn("allowed", F.col("event_type") != "signup"), "source_id", "event_id", ["event_type"]),
    )


@query("SELECT concat_ws(':', 'ingestion-issue', issue_id, operational_version) AS review_key, issue_id, CASE WHEN issue_id % 2 = 0 THEN 'REPEATED' ELSE 'QUEUED' END AS outcome, issue_id % 2 = 0 AS had FROM issues WHERE status = 'OPEN' AND operational_version = 4", "issues")
def queue_reviews(issues):
    queued = issues.where("issue_id % 2 = 0").select(F.concat_ws(":", F.lit("ingestion-issue"), "issue_id", "operational_version").alias("review_key"), F.expr("concat('review-', issue_id)").alias("review_id"))
    return R.queue_reviews(issues, queued, 4).select("review_key", "issue_id", "outcome", F.col("review_id").startswith("review-").alias("had"))


@query("SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'DELETED' ELSE 'MUTATED' END AS violation FROM events WHERE event_id % 10 = 0 OR event_id % 7 = 0", "events")
def audit_append_only(events):
    after = events.where("event_id % 10 <> 0").withColumn("value", F.expr("if(event_id % 7 = 0, value + 1, value)"))
    return R.audit_append_only(events, after, "event_id", ["ts", "value", "event_type"])


@query("""WITH s AS (SELECT run_id AS session_id, CASE WHEN state = 'RUNNING' THEN 'ACTIVE' ELSE 'ENDED' END AS state, control_version AS attempts, tenant_id, updated_at FROM runs),
 n AS (SELECT session_id, CASE WHEN session_id % 7 = 3 THEN 'ENDED' ELSE state END AS state, attempts + CASE session_id % 7 WHEN 1 THEN -1 WHEN 2 THEN 1 ELSE 0 END AS attempts, CASE WHEN session_id % 7 = 4 THEN 'other' ELSE tenant_id END AS tenant_id FROM s WHERE session_id % 7 <> 5)
 SELECT session_id, violation FROM (SELECT s.session_id, CASE WHEN n.session_id IS NULL THEN 'DELETED' WHEN n.tenant_id <> s.tenant_id THEN 'CHANGED' WHEN n.attempts < s.attempts THEN 'LOWERED'
 WHEN s.state <> 'ACTIVE' AND (n.state <> s.state OR n.attempts <> s.attempts) THEN 'FROZEN' END AS violation FROM s LEFT JOIN n USING (session_id)) WHERE violation IS NOT NULL""", "runs")
def recovery_session_history(runs):
    before = runs.select(F.col("run_id").alias("session_id"), F.expr("if(state = 'RUNNING', 'ACTIVE', 'ENDED')").alias("state"), F.col("control_version").alias("attempts"), "tenant_id", "updated_at")
    kind = F.col("session_id") % 7
    after = before.where(kind != 5).withColumns({
        "state": F.when(kind == 3, "ENDED").otherwise(F.col("state")),
        "attempts": F.col("attempts") + F.when(kind == 1, -1).when(kind == 2, 1).otherwise(0),
        "tenant_id": F.when(kind == 4, "other").otherwise(F.col("tenant_id")),
    })
    return R.session_violations(before, after)


@query("""WITH t AS (SELECT transition_id, CASE WHEN issue_version % 2 = 0 THEN issue_version END AS rev, CASE WHEN issue_version % 2 = 0 THEN observed_at END AS at, transition_id % 8 AS k FROM transitions)
 SELECT transition_id, violation FROM (SELECT transition_id, CASE WHEN k = 5 THEN 'DELETED' WHEN k = 6 THEN 'REPEATED' WHEN k = 4 THEN 'CHANGED' WHEN k IN (1, 2) AND rev IS NOT NULL THEN 'REGAINED' WHEN k = 3 AND rev IS NULL THEN 'REGAINED' END AS violation FROM t) WHERE violation IS NOT NULL""", "transitions")
def transition_history(transitions):
    """Of eight: 1 gains a revision and its time, 2 both anew, 3 a revision without a time, 4 another severity, 5 is gone, 6 comes twice."""
    told = F.col("issue_version") % 2 == 0
    before = transitions.withColumns({"publication_revision": F.when(told, F.col("issue_version")), "published_at": F.when(told, F.col("observed_at"))})
    k = F.col("transition_id") % 8
    after = before.where(k != 5).withColumns({
        "publication_revision": F.when(k.isin(1, 2), F.lit(-1)).when((k == 3) & ~told, F.lit(-1)).otherwise(F.col("publication_revision")),
        "published_at": F.when(k.isin(1, 2), F.col("observed_at")).otherwise(F.col("published_at")),
        "severity": F.when(k == 4, F.concat("severity", F.lit("!"))).otherwise(F.col("severity")),
    })
    return R.transition_violations(before, after.unionByName(after.where(k == 6)))


@query("SELECT event_type, severity, count(*) AS n FROM (SELECT concat('RUN_', state) AS event_type, 'INFO' AS severity FROM runs UNION ALL SELECT concat('HANDOFF_', state), CASE WHEN state LIKE 'FAILED%' THEN 'WARN' ELSE 'INFO' END FROM handoffs UNION ALL SELECT concat('QUARANTINE_', lifecycle_state), CASE WHEN lifecycle_state IN ('OPEN','REPROCESSING') THEN 'WARN' ELSE 'INFO' END FROM quarantine UNION ALL SELECT concat('REPLAY_', state), CASE state WHEN 'FAILED' THEN 'ERROR' WHEN 'RETRY_WAIT' THEN 'WARN' ELSE 'INFO' END FROM replays UNION ALL SELECT concat(CASE WHEN issue_code LIKE 'ING_SCHEMA_%' THEN 'SCHEMA_DRIFT_' ELSE 'ISSUE_' END, status), CASE severity WHEN 'ERROR' THEN 'ERROR' ELSE 'WARN' END FROM issues) GROUP BY ALL", "runs handoffs quarantine replays issues")
def capture_operational_events(runs, handoffs, quarantine, replays, issues):
    from ..operators.oplog import capture_operational_events as capture

    return capture(runs, handoffs, quarantine, replays, issues).groupBy("event_type", "severity").agg(F.count("*").alias("n"))


@query("SELECT run_id, coalesce(a, b) AS contract FROM (SELECT run_id, CASE WHEN run_id % 2 = 0 THEN bundle_id END AS a, bundle_checksum AS b FROM runs)", "runs")
def pinned_contracts(runs):
    doc = F.to_json(F.struct(F.expr("if(run_id % 2 = 0, bundle_id, null)").alias("contract"), F.struct(F.col("bundle_checksum").alias("contract")).alias("published")))
    return runs.select("run_id", pinned_contract(doc, "$.contract", "$.published.contract").alias("contract"))


@query(f"""SELECT tenant_id, issue_id AS incident_id, 'INGESTION' AS module, issue_code AS event_type, CASE status WHEN 'OPEN' THEN 'OPEN' ELSE 'RESOLVED' END AS lifecycle_state, severity, strftime(created_at, {ISO}) AS first_seen_at, strftime(last_updated_at, {ISO}) AS last_seen_at,
 CASE WHEN status <> 'OPEN' THEN strftime(last_updated_at, {ISO}) END AS resolved_at, i.run_id AS job_ref, i.source_id AS source_ref, issue_code AS error_code, concat('corr-', CAST(i.run_id % 7 AS STRING)) AS correlation_id, status = 'OPEN' AS action_required,
 concat('Ingestion ', lower(status), ' issue ', issue_code) AS impact_summary, concat(i.source_id, ':', issue_code) AS dedup_key, 'TENANT_OPERATIONAL' AS visibility_class,
 CASE WHEN issue_code LIKE '%SCHEMA%' THEN 'REQUEST_ONBOARDING_REVIEW' WHEN issue_code LIKE '%QUARANTINE%' THEN 'INSPECT_QUARANTINE_AND_REPROCESS' ELSE 'INSPECT_RUN_EVIDENCE' END AS recommended_action, concat('EXPLAIN_', issue_code) AS explanation FROM issues i JOIN runs r ON r.run_id = i.run_id""", "issues runs")
def incident_projection(issues, runs):
    i = issues.withColumn("resolved_at", F.when(F.col("status") != "OPEN", F.col("last_updated_at"))).withColumn("correlation_id", F.expr("concat('corr-', run_id % 7)"))
    return I.incident_projection(i, runs).withColumns({c: iso_micros(c) for c in ("first_seen_at", "last_seen_at", "resolved_at")})


@query("SELECT issue_id, CASE WHEN issue_code LIKE '%SCHEMA%' THEN 'REQUEST_ONBOARDING_REVIEW' WHEN issue_code LIKE '%QUARANTINE%' THEN 'INSPECT_QUARANTINE_AND_REPROCESS' ELSE 'INSPECT_RUN_EVIDENCE' END AS action FROM issues", "issues")
def explain_issue(issues):
    return issues.select("issue_id", I.recommended_action().alias("action"))


@query("SELECT quarantine_id, sha256(source_object_id) AS object_fingerprint, reason_code, lifecycle_state FROM quarantine", "quarantine")
def quarantine_preview(quarantine):
    return R.quarantine_preview(quarantine).select("quarantine_id", "object_fingerprint", "reason_code", "lifecycle_state")


@query("WITH v AS (SELECT i.issue_id, r.tenant_id, i.source_id, i.source_id IN ('src-1','src-2','src-3') AS ok FROM issues i JOIN runs r ON r.run_id = i.run_id) SELECT issue_id, tenant_id, source_id, partial FROM v JOIN (SELECT tenant_id, count(*) FILTER (NOT ok) > 0 AS partial FROM v GROUP BY 1) USING (tenant_id) WHERE ok", "issues runs")
def redact_visible(issues, runs):
    rows = issues.join(runs.select("run_id", "tenant_id"), "run_id")
    grants = issues.where("source_id in ('src-1', 'src-2', 'src-3')").select("source_id").distinct()
    return I.redact_visible(rows, grants).select("issue_id", "tenant_id", "source_id", "partial")


@query("""WITH e AS (SELECT source_id, type_code, issue_code, concat('e', CAST(issue_id % 3000 AS STRING)) AS evidence_ref, issue_id, status, operational_version FROM issues)
SELECT source_id, type_code, issue_code, c.evidence_ref, min(issue_id) AS issue_id FROM e c WHERE operational_version >= 6
 AND NOT EXISTS (SELECT 1 FROM e o WHERE o.operational_version < 6 AND o.status = 'OPEN' AND o.source_id = c.source_id AND o.type_code = c.type_code AND o.issue_code = c.issue_code AND o.evidence_ref = c.evidence_ref) GROUP BY ALL""", "issues")
def open_issue_dedupe(issues):
    e = issues.withColumn("evidence_ref", F.expr("concat('e', issue_id % 3000)"))
    return I.open_issue_dedupe(e.where("operational_version >= 6"), e.where("operational_version < 6"))


@query("""SELECT source_id AS key, count(*) AS n FROM ops_events WHERE occurred_at >= TIMESTAMP '2024-01-05 00:00:00' AND occurred_at < TIMESTAMP '2024-01-06 00:00:00' GROUP BY 1 ORDER BY n DESC, key LIMIT 30""", "ops_events")
def aggregate_log_window(ops_events):
    return R.aggregate_log(ops_events, "source_id", 30, window=(datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 6)))


@query("""WITH i AS (SELECT tenant_id, issue_id AS principal FROM transitions), b AS (SELECT tenant_id, issue_id AS principal FROM transitions WHERE severity = 'ERROR'),
 a AS (SELECT tenant_id, principal, least(20000 - (SELECT count(*) FROM i), 9000 - (SELECT count(*) FROM i x WHERE x.tenant_id = i.tenant_id), 400 - count(*)) AS v FROM i GROUP BY 1, 2
  UNION ALL SELECT tenant_id, principal, least(8000 - (SELECT count(*) FROM b), 3000 - (SELECT count(*) FROM b x WHERE x.tenant_id = b.tenant_id), 90 - count(*)) FROM b GROUP BY 1, 2)
SELECT tenant_id, principal, greatest(0, min(v)) AS available FROM a GROUP BY 1, 2""", "transitions")
def capacity_left(transitions):
    t = transitions.select("tenant_id", F.col("issue_id").alias("principal"), "severity")
    return R.capacity_left({"items": (20000, 9000, 400), "bookmarks": (8000, 3000, 90)}, items=t.drop("severity"), bookmarks=t.where("severity = 'ERROR'").drop("severity"))


@query("""SELECT n_name AS ref, 'snapshot' AS origin, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
 UNION ALL SELECT n_name, 'lineage', count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 2 = 0 GROUP BY 1""", "customer nation")
def deep_references(customer, nation):
    c = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    docs = c.select(
        F.to_json(F.struct(F.struct(F.array(F.struct(F.col("n_name").alias("r"))).alias("list")).alias("deep"), F.lit(1).alias("n"))).alias("config"),
        F.to_json(F.struct(F.when(F.col("c_custkey") % 2 == 0, F.col("n_name")).otherwise("x").alias("a"))).alias("evidence"),
    )
    return R.deep_references(docs, nation.select(F.col("n_name").alias("ref")), snapshot="config", lineage="evidence").groupBy("ref", "origin").agg(F.count("*").alias("n"))
