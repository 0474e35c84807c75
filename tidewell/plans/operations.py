"""Queries over incident transitions, and the ordered folds of health and back-pressure."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import iso_micros
from ..operators import health, snapshots
from ..operators import incidents as I
from .registry import query
from .scratch import folder

ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
REVISED = "(SELECT *, CAST(row_number() OVER (PARTITION BY tenant_id ORDER BY issue_id, issue_version) + 10 AS BIGINT) AS revision FROM transitions)"


def revised(transitions):
    clock = transitions.select("tenant_id").distinct().withColumn("last_revision", F.lit(10))
    return I.allocate_revisions(transitions, clock)


@query(f"SELECT tenant_id, issue_id, issue_version, revision FROM {REVISED}", "transitions")
def allocate_revisions(transitions):
    return revised(transitions).select("tenant_id", "issue_id", "issue_version", "revision")


@query("""SELECT issue_id, transition_id, CAST(row_number() OVER (PARTITION BY issue_id ORDER BY transition_id) AS BIGINT) AS version FROM (
 SELECT *, lag(severity) OVER w AS s, lag(lifecycle) OVER w AS l, row_number() OVER w AS k FROM transitions WINDOW w AS (PARTITION BY issue_id ORDER BY transition_id)
) WHERE k = 1 OR s IS DISTINCT FROM severity OR l IS DISTINCT FROM lifecycle""", "transitions")
def incident_versions(transitions):
    return I.incident_versions(transitions, "issue_id", ["transition_id"], ["severity", "lifecycle"]).select("issue_id", "transition_id", "version")


@query(f"SELECT transition_id, strftime(max(observed_at) OVER (PARTITION BY issue_id ORDER BY transition_id % 97, transition_id), {ISO}) AS last_updated FROM transitions", "transitions")
def monotone_observation(transitions):
    t = transitions.withColumn("shuffled", F.col("transition_id") % 97)
    return I.monotone_observation(t, "issue_id", ["shuffled", "transition_id"], "observed_at").select("transition_id", iso_micros("last_updated").alias("last_updated"))


@query(f"SELECT tenant_id, issue_id, issue_version, revision, lifecycle FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, issue_id ORDER BY revision DESC) AS k FROM {REVISED} WHERE revision <= 2000) WHERE k = 1", "transitions")
def as_of_revision(transitions):
    return I.as_of_revision(revised(transitions), 2000).select("tenant_id", "issue_id", "issue_version", "revision", "lifecycle")


@query("SELECT issue_id, issue_version, severity, lifecycle FROM (SELECT *, row_number() OVER (PARTITION BY issue_id ORDER BY issue_version DESC) AS k FROM transitions) WHERE k = 1", "transitions")
def latest_transition(transitions):
    return I.latest_transition(transitions).select("issue_id", "issue_version", "severity", "lifecycle")


PRIORITY = "lifecycle <> 'OPEN', severity <> 'ERROR', observed_at DESC, issue_id"


@query(f"SELECT tenant_id, transition_id, row_number() OVER (PARTITION BY tenant_id ORDER BY {PRIORITY}) - 1 AS position FROM transitions", "transitions")
def prioritise_incidents(transitions):
    return I.prioritise_incidents(transitions).select("tenant_id", "transition_id", "position")


@query(f"SELECT transition_id, severity, lifecycle FROM transitions ORDER BY {PRIORITY} LIMIT 25", "transitions")
def top_incidents(transitions):
    return I.top_incidents(transitions, 25).select("transition_id", "severity", "lifecycle")


@query(f"SELECT tenant_id, transition_id, position, total > 250 AS has_next FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY {PRIORITY}) - 1 AS position, count(*) OVER (PARTITION BY tenant_id) AS total FROM transitions) WHERE position >= 200 AND position < 250", "transitions")
def snapshot_page(transitions):
    return I.snapshot_page(I.prioritise_incidents(transitions), 200, 50).select("tenant_id", "transition_id", "position", "has_next")


CURSORS = "SELECT tenant_id, t.c AS cursor, CAST(t.l AS BOOLEAN) AS late FROM (SELECT DISTINCT tenant_id FROM transitions UNION ALL SELECT 'nobody') CROSS JOIN (VALUES (0, 0), (100, 0), (150, 0), (200, 1), (900000000, 0)) t(c, l)"


@query(f"""WITH p AS (SELECT tenant_id, transition_id, severity, row_number() OVER (PARTITION BY tenant_id ORDER BY {PRIORITY}) - 1 AS position, count(*) OVER (PARTITION BY tenant_id) AS total FROM transitions),
 n AS (SELECT tenant_id, any_value(total) AS total FROM p GROUP BY 1),
 c AS (SELECT k.*, n.total, CASE WHEN n.total IS NULL OR cursor > n.total OR cursor % 50 <> 0 THEN 'ING_CURSOR_UNAVAILABLE' WHEN late THEN 'ING_CURSOR_EXPIRED' WHEN n.total > 10000 THEN 'ING_CURSOR_CAPACITY_UNAVAILABLE' END AS error_code FROM ({CURSORS}) k LEFT JOIN n ON n.tenant_id = k.tenant_id)
SELECT c.tenant_id, c.cursor, c.late, CASE WHEN error_code IS NULL THEN c.cursor + 50 < c.total END AS has_next, error_code, p.transition_id, p.severity, p.position
FROM c LEFT JOIN p ON p.tenant_id = c.tenant_id AND error_code IS NULL AND p.position >= c.cursor AND p.position < c.cursor + 50""", "transitions")
def captured_snapshot(transitions):
    """Pages of a capture, read after all incidents have changed and a repeat of the capture has altered nothing."""
    spark, now = transitions.sparkSession, F.lit("2000-06-01 00:00:00").cast("timestamp")
    path = folder(spark, "snapshot")
    kept = transitions.select("tenant_id", "transition_id", "issue_id", "severity", "lifecycle", "observed_at")
    sessions = snapshots.capture(kept, path, "s1", now, 50)
    changed = kept.withColumn("severity", F.lit("ERROR")).withColumn("lifecycle", F.lit("RESOLVED"))
    sessions = snapshots.capture(changed, path, "s1", now, 50, sessions)
    like = kept.select("*", F.lit(0).cast("long").alias("position"), F.lit(0).cast("long").alias("page"), F.lit("").alias("session"))
    cursors = transitions.select("tenant_id").distinct().unionByName(spark.range(1).select(F.lit("nobody").alias("tenant_id")))
    asked = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.lit(late).alias("late")) for c, late in ((0, False), (100, False), (150, False), (200, True), (900000000, False)))))
    cursors = cursors.withColumn("x", asked).select(F.lit("s1").alias("session"), "tenant_id", F.col("x.c").alias("position"), F.when(F.col("x.late"), now + F.expr("interval 31 minutes")).otherwise(now).alias("at"))
    out = snapshots.pages(snapshots.read_items(spark, path, like), sessions, cursors)
    return out.select("tenant_id", "cursor", (F.col("at") > now).alias("late"), "has_next", "error_code", "transition_id", "severity", "position")


#: Where three readers stopped: one with changes to read, one with none, one whose boundary the kept history no longer reaches.
BOOKMARKS = "(VALUES ('tenant-0', 100, 0), ('tenant-1', 900000000, 0), ('tenant-2', 10, 50)) b(tenant_id, after, floor)"


def bookmarks(transitions):
    t = F.col("tenant_id")
    after = F.when(t == "tenant-0", 100).when(t == "tenant-1", 900000000).otherwise(10)
    return transitions.select("tenant_id").distinct().withColumn("after", after).withColumn("floor", F.when(t == "tenant-2", 50).otherwise(0))


@query(f"SELECT tenant_id, issue_id, revision, 'DELTA' AS progress FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, issue_id ORDER BY revision DESC) AS k FROM {REVISED} WHERE tenant_id = 'tenant-0' AND revision > 100) WHERE k = 1", "transitions")
def resume_delta(transitions):
    return I.resume_delta(revised(transitions), bookmarks(transitions)).select("tenant_id", "issue_id", "revision", "progress")


@query(f"""SELECT b.tenant_id, after, high AS high_watermark, CASE WHEN floor > after THEN 'HISTORY_GAP' WHEN high <= after THEN 'NO_PROGRESS' ELSE 'DELTA' END AS progress
 FROM {BOOKMARKS} JOIN (SELECT tenant_id, max(revision) AS high FROM {REVISED} GROUP BY 1) h ON h.tenant_id = b.tenant_id""", "transitions")
def resume_status(transitions):
    return I.resume_status(revised(transitions), bookmarks(transitions)).select("tenant_id", "after", "high_watermark", "progress")


@query("SELECT session_id, greatest(1, CAST(ceil(n / 10.0) AS BIGINT)) AS needed, done, done >= greatest(1, CAST(ceil(n / 10.0) AS BIGINT)) AS may_bookmark FROM (SELECT user_id AS session_id, count(*) AS n, count(*) FILTER (event_type <> 'error' AND event_id % 5 = 0) AS done FROM events GROUP BY 1)", "events")
def page_coverage(events):
    pages = events.where("event_id % 5 = 0").select(F.col("user_id").alias("session_id"), F.col("event_id").alias("page"), (F.col("event_type") != "error").alias("complete"))
    sessions = events.groupBy(F.col("user_id").alias("session_id")).agg(F.count("*").alias("item_count")).withColumn("page_limit", F.lit(10))
    return I.page_coverage(pages, sessions)


@query("SELECT tenant_id, page, sha256(string_agg(body, chr(10) ORDER BY position)) AS digest FROM (SELECT tenant_id, (row_number() OVER (PARTITION BY tenant_id ORDER BY transition_id) - 1) // 100 AS page, row_number() OVER (PARTITION BY tenant_id ORDER BY transition_id) AS position, concat(transition_id, severity) AS body FROM transitions) GROUP BY 1, 2", "transitions")
def page_digest(transitions):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("tenant_id").orderBy("transition_id"))
    items = transitions.select("tenant_id", n.alias("position"), F.concat("transition_id", "severity").alias("body")).withColumn("page", F.expr("(position - 1) div 100"))
    return I.page_digest(items, ["tenant_id", "page"], "position", "body")


@query("""WITH RECURSIVE days AS (SELECT run_id % 5 AS tenant_id, CAST(floor(epoch(next_attempt_at) / 86400) AS BIGINT) AS d, count(*) AS n FROM handoffs WHERE state <> 'ACKED' GROUP BY 1, 2),
 seq AS (SELECT tenant_id, row_number() OVER (PARTITION BY tenant_id ORDER BY d) AS k, n FROM days),
 fold AS (SELECT tenant_id, CAST(0 AS BIGINT) AS k, 'NORMAL' AS s FROM (SELECT DISTINCT tenant_id FROM seq)
  UNION ALL SELECT f.tenant_id, q.k, CASE WHEN q.n >= 9 THEN 'HARD' WHEN f.s IN ('HARD','RECOVERY') THEN CASE WHEN q.n <= 2 THEN 'NORMAL' ELSE 'RECOVERY' END WHEN q.n >= 5 THEN 'SOFT' WHEN f.s = 'SOFT' AND q.n > 2 THEN 'SOFT' ELSE 'NORMAL' END
  FROM fold f JOIN seq q ON q.tenant_id = f.tenant_id AND q.k = f.k + 1)
SELECT tenant_id, arg_max(s, k) AS state FROM fold GROUP BY tenant_id""", "handoffs")
def pressure_states(handoffs):
    days = handoffs.where("state <> 'ACKED'").select((F.col("run_id") % 5).alias("tenant_id"), F.expr("unix_timestamp(next_attempt_at) div 86400").alias("at"))
    return health.pressure_states(days.groupBy("tenant_id", "at").agg(F.count("*").alias("backlog")), 5, 9, 2)


FRESH = "(f.began < 0 OR q.t - f.began >= 86400)"
#: The fold of circuit_states, row by row.
CIRCUITS = f"""WITH RECURSIVE seq AS (SELECT source_id, event_id, CAST(floor(epoch(happened_at)) AS BIGINT) AS t, outcome, row_number() OVER (PARTITION BY source_id ORDER BY floor(epoch(happened_at)), event_id) AS k FROM attempt_log),
 fold AS (SELECT DISTINCT source_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS event_id, 'HEALTHY' AS status, CAST(0 AS BIGINT) AS failures, CAST(-1 AS BIGINT) AS began, CAST(0 AS BIGINT) AS attempts, CAST(0 AS BIGINT) AS retry_at, CAST(0 AS BIGINT) AS open_until FROM seq
  UNION ALL SELECT f.source_id, q.k, q.event_id, CASE q.outcome WHEN 'SUCCESS' THEN 'HEALTHY' WHEN 'TRANSIENT' THEN CASE WHEN NOT {FRESH} AND f.attempts + 1 >= 5 THEN 'PAUSED' ELSE 'DEGRADED' END ELSE 'DEGRADED' END,
   CASE q.outcome WHEN 'TRANSIENT' THEN f.failures + 1 ELSE 0 END, CASE q.outcome WHEN 'SUCCESS' THEN -1 WHEN 'TRANSIENT' THEN CASE WHEN {FRESH} THEN q.t ELSE f.began END ELSE f.began END,
   CASE q.outcome WHEN 'SUCCESS' THEN 0 WHEN 'TRANSIENT' THEN CASE WHEN {FRESH} THEN 1 ELSE f.attempts + 1 END ELSE f.attempts END,
   CASE q.outcome WHEN 'TRANSIENT' THEN q.t + CAST(least(900, 5 * pow(2, least(CASE WHEN {FRESH} THEN 0 ELSE f.attempts END, 7))) AS BIGINT) ELSE 0 END,
   CASE WHEN q.outcome = 'TRANSIENT' AND NOT {FRESH} AND f.attempts + 1 >= 5 THEN q.t + 900 ELSE 0 END
  FROM fold f JOIN seq q ON q.source_id = f.source_id AND q.k = f.k + 1)"""


@query(CIRCUITS + " SELECT source_id, arg_max(status, k) AS status, arg_max(failures, k) AS failures, arg_max(began, k) AS began, arg_max(attempts, k) AS attempts, arg_max(retry_at, k) AS retry_at, arg_max(open_until, k) AS open_until FROM fold GROUP BY source_id", "attempt_log")
def circuit_states(attempt_log):
    log = attempt_log.select("source_id", F.unix_timestamp("happened_at").alias("at_seconds"), "event_id", "outcome")
    return health.circuit_states(log, window=86400)
