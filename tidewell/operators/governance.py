"""Runs, schedules, recovery and replay: who may go on, in which order, and what a history allows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def workload_rank(c: str = "workload_class") -> Column:
    return F.when(F.col(c) == "ORDINARY", 0).when(F.col(c) == "RECOVERY", 1).otherwise(2)


def fair_tenant_head(schedules: DataFrame) -> DataFrame:
    """One enabled schedule per tenant, and the tenants' turns: ordinary work first, then who waited longest."""
    first = F.min(F.struct(workload_rank().alias("c"), "next_run", "schedule_id", "last_dispatched")).alias("h")
    heads = schedules.where("state = 'ENABLED'").groupBy("tenant_id").agg(first).select("tenant_id", "h.*")
    turn = F.row_number().over(Window.orderBy("c", F.asc_nulls_first("last_dispatched"), "next_run", "tenant_id"))
    return heads.select("tenant_id", "schedule_id", turn.alias("turn"))


def eligible_sources(schedules: DataFrame, gated: DataFrame, runs: DataFrame, issues: DataFrame) -> DataFrame:
    """Enabled schedules whose source is not gated, has no running run and no open recovery incident."""
    busy = runs.where("state = 'RUNNING'")
    if "schedule_id" in runs.columns and "phase" in runs.columns:  # a schedule's own run that has not begun holds no other back
        own = runs.where("state = 'PREFLIGHT'").select("source_id", "schedule_id").distinct()
        other = own.join(schedules.select("source_id", F.col("schedule_id").alias("mine")), "source_id").where("mine <> schedule_id").select("source_id")
        busy = busy.select("source_id").unionByName(other)
    busy = busy.select("source_id")
    stuck = issues.where("status = 'OPEN' and issue_code = 'ING_RUN_RECOVERY_BUDGET_EXHAUSTED'").select("source_id")
    return schedules.where("state = 'ENABLED'").join(gated.select("source_id").unionByName(busy).unionByName(stuck).distinct(), "source_id", "left_anti")


def active_union(runs: DataFrame, leased: DataFrame) -> DataFrame:
    a = runs.where("state in ('RUNNING', 'PAUSED')").select("tenant_id", "source_id", F.lit("RUN").alias("origin"))
    return a.unionByName(leased.where("state = 'ENABLED'").select("tenant_id", "source_id", F.lit("LEASE").alias("origin")))


def admission_limit(limit: int, pressure: str) -> int:
    return max(1, limit // 2) if pressure == "SOFT" else 1 if pressure == "RECOVERY" else limit


def admitted_sources(runs: DataFrame, leased: DataFrame, limit: int, pressure: str) -> DataFrame:
    most = admission_limit(limit, pressure)
    counts = active_union(runs, leased).groupBy("tenant_id").agg(F.countDistinct("source_id").alias("sources"))
    return counts.withColumn("admitted_limit", F.lit(most)).withColumn("admits", F.col("sources") < most)


def preflight_slots(runs: DataFrame, due: str) -> DataFrame:
    """One run for each schedule and due time, the smallest run_id."""
    return runs.groupBy("schedule_id", due).agg(F.min("run_id").alias("run_id"))


def attempt_numbers(attempts: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return attempts.withColumn("attempt_number", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))


def next_attempt(attempts: DataFrame) -> DataFrame:
    return attempts.groupBy("run_id", "source_object_id").agg((F.max("attempt_no") + 1).cast("long").alias("next_attempt"))


def replay_outcomes(replays: DataFrame) -> DataFrame:
    again = F.col("attempts") < F.col("max_attempts")
    done = F.col("state") == "SUCCEEDED"
    return replays.withColumn("outcome", F.when(done, "SUCCEEDED").when(again, "RETRY_WAIT").otherwise("FAILED")).withColumn(
        "quarantine_state", F.when(done, "RESOLVED").when(again, "REPROCESSING").otherwise("OPEN")
    )


def activation_retry(failures: DataFrame, most: int, delay: int, max_elapsed: int) -> DataFrame:
    """Whether each failure of a source is retried: transient, within `most` attempts and `max_elapsed` seconds from the first.

    Where failures have publication_id, a new publication counts from its own first failure. A delay of 0 is never retried.
    """
    w = Window.partitionBy("source_id", *(["publication_id"] if "publication_id" in failures.columns else [])).orderBy("happened_at", "event_id")
    seconds = lambda c: F.unix_timestamp(c)
    out = failures.withColumn("attempt", F.row_number().over(w)).withColumn("__e", seconds(F.col("happened_at")) - seconds(F.first("happened_at").over(w)))
    ok = (F.col("outcome") == "TRANSIENT") & (F.col("attempt") <= most) & (F.col("__e") + delay <= max_elapsed) & F.lit(delay > 0)
    return out.withColumn("decision", F.when(ok, "RETRY").otherwise("BLOCKED")).drop("__e")


def recovery_admission(claims: DataFrame, sessions: DataFrame) -> DataFrame:
    """Claims (run_id, claim_id, claimed_at) in order against their run's session (max_attempts, deadline_at); runs without one are admitted.

    The first claim that is refused opens the run's incident.
    """
    n = F.row_number().over(Window.partitionBy("run_id").orderBy("claimed_at", "claim_id"))
    out = claims.join(sessions, "run_id", "left").withColumn("claim_no", n)
    ok = F.col("max_attempts").isNull() | ((F.col("claim_no") <= F.col("max_attempts")) & (F.col("claimed_at") < F.col("deadline_at")))
    out = out.withColumn("decision", F.when(ok, "ADMITTED").otherwise("EXHAUSTED"))
    first = F.min(F.when(~ok, F.col("claim_no"))).over(Window.partitionBy("run_id"))
    return out.withColumn("opens_incident", F.coalesce(F.col("claim_no") == first, F.lit(False)))


def recovery_totals(sessions: DataFrame) -> DataFrame:
    left = F.max_by(F.col("max_attempts") - F.col("attempts"), "epoch")
    return sessions.groupBy("run_id").agg(F.max("epoch").alias("latest_epoch"), F.greatest(F.lit(0), left).alias("remaining"), F.sum("attempts").cast("long").alias("total_attempts"))


def transition_audit(changes: DataFrame, key: list[str], order: list[str], state: str, allowed: list[tuple[str, str]]) -> DataFrame:
    """Changes whose step from the state before is not allowed."""
    edges = F.concat(F.col("previous"), F.lit(">"), F.col(state)).isin([f"{a}>{b}" for a, b in allowed])
    return changes.withColumn("previous", F.lag(state).over(Window.partitionBy(*key).orderBy(*order))).where(F.col("previous").isNotNull() & ~edges)


def accept_publications(publications: DataFrame, schedules: DataFrame) -> DataFrame:
    """The schedule that each source ends with: schedules(source_id, publication_id, sequence, checksum, state, next_run, activation_failures, activation_blocked,
    consumed_publication_id) after publications(source_id, publication_id, sequence, checksum, enabled, once), with outcome.

    ACCEPTED: the publication of the highest sequence, if that lies above the schedule's; REPEATED: the very one that it
    has (sequence, id and checksum); REJECTED: any other. A new publication is due at once and resets the failures. A
    publication that is not enabled, or is to run once and has, leaves DISABLED; a paused schedule stays paused, unless
    a new publication lifts the block of failed activations; others are ACTIVE.
    """
    top = publications.groupBy("source_id").agg(F.max(F.struct("sequence", "publication_id", "checksum", "enabled", "once")).alias("p")).select("source_id", "p")
    both = top.join(schedules.withColumn("__had", F.lit(True)), "source_id", "left")
    p = F.col("p")
    new = F.col("sequence").isNull() | (p["sequence"] > F.col("sequence"))
    same = (p["sequence"] == F.col("sequence")) & (p["publication_id"] == F.col("publication_id")) & (p["checksum"] == F.col("checksum"))
    outcome = F.when(new, "ACCEPTED").when(same, "REPEATED").otherwise("REJECTED")
    changed = ~F.col("publication_id").eqNullSafe(p["publication_id"])
    spent = p["once"] & F.col("consumed_publication_id").eqNullSafe(p["publication_id"])
    held = (F.col("state") == "PAUSED") & (~F.coalesce("activation_blocked", F.lit(False)) | ~changed)
    state = F.when(outcome == "REJECTED", F.col("state")).when(~p["enabled"] | spent, "DISABLED").when(F.coalesce(held, F.lit(False)), "PAUSED").otherwise("ACTIVE")
    taken = outcome != "REJECTED"
    return both.select(
        "source_id", outcome.alias("outcome"), F.when(taken, p["publication_id"]).otherwise(F.col("publication_id")).alias("publication_id"), F.when(taken, p["sequence"]).otherwise(F.col("sequence")).alias("sequence"), state.alias("state"),
        F.when(taken & changed, F.lit(0)).otherwise(F.col("next_run")).alias("next_run"), F.when(taken & changed, F.lit(0)).otherwise(F.col("activation_failures")).alias("activation_failures"),
    )


def next_due(slots: DataFrame, intervals: DataFrame) -> DataFrame:
    """slots(schedule_id, due) with next_due and state from intervals(schedule_id, interval_seconds, once): a schedule that runs once is DISABLED after its slot."""
    out = slots.join(intervals, "schedule_id")
    return out.withColumn("next_due", F.when(~F.col("once"), F.col("due") + F.make_dt_interval(secs=F.col("interval_seconds").cast("double")))).withColumn("state", F.when(F.col("once"), "DISABLED").otherwise("ACTIVE"))


def latest_publication(publications: DataFrame) -> DataFrame:
    """The publication that each source accepts: the one of the highest sequence."""
    return publications.groupBy("source_id").agg(F.max_by("run_id", "publication").alias("run_id"), F.max("publication").alias("publication"))


def completion_counts(runs: DataFrame) -> DataFrame:
    """Runs of each tenant by state, a column for each phase."""
    return runs.groupBy("tenant_id", "state").pivot("phase", ["CATCH_UP", "DELTA", "FULL_SNAPSHOT"]).count().na.fill(0)


def resume_gate(runs: DataFrame, quarantine: DataFrame, version: int) -> DataFrame:
    held = quarantine.where("blocking and lifecycle_state not in ('RETRY_READY', 'RESOLVED', 'DISMISSED')").select("run_id").distinct()
    return runs.where((F.col("state") == "PAUSED") & (F.col("control_version") == version)).join(held, "run_id", "left_anti")


def plan_replays(quarantine: DataFrame, runs: DataFrame, target: str, active: str) -> DataFrame:
    """Replays of retry-ready quarantine: which bundle each mode takes, and an idempotent key."""
    both = quarantine.where("lifecycle_state = 'RETRY_READY'").join(runs.select("run_id", "tenant_id", "bundle_id", "bundle_version", "bundle_checksum"), "run_id")
    ref = F.when(F.col("replay_mode") == "REPRODUCE", F.concat_ws(":", "bundle_id", "bundle_version", "bundle_checksum")).when(F.col("replay_mode") == "REPROCESS_TARGET", target).otherwise(active)
    out = both.withColumn("target_ref", ref)
    return out.select("quarantine_id", "replay_mode", "target_ref", F.concat_ws(":", "tenant_id", "quarantine_id", "replay_mode", "target_ref").alias("idempotency_key"))


def stop_at_first_blocking(results: DataFrame, key: list[str], order: str) -> DataFrame:
    """The results of each key up to its first blocking failure, that one included."""
    stop = results.where("blocking").groupBy(*key).agg(F.min(order).alias("__stop"))
    return results.join(stop, key, "left").where(F.col("__stop").isNull() | (F.col(order) <= F.col("__stop"))).drop("__stop")
