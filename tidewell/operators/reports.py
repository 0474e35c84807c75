"""Operational reads: filters, bounded searches, latest-of joins, counts and gauges."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import quoted, text_values


def optional_filters(df: DataFrame, **equal) -> DataFrame:
    """Filters on the given values; None means no filter."""
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def time_window(df: DataFrame, column: str, start: datetime.datetime, end: datetime.datetime, most_hours: int = 24) -> DataFrame:
    """start <= column < end, of at most `most_hours`."""
    if not start < end or end - start > datetime.timedelta(hours=most_hours):
        raise ValueError("ING_TIME_WINDOW_INVALID")
    stamp = lambda t: F.lit(t.isoformat(sep=" ")).cast(df.schema[column].dataType)
    return df.where((F.col(column) >= stamp(start)) & (F.col(column) < stamp(end)))


def changed_since(df: DataFrame, column: str, since: Column) -> DataFrame:
    return df.where(F.col(column) >= since)


def unexpired(df: DataFrame, column: str, now: Column) -> DataFrame:
    return df.where(F.col(column) > now)


def domain_check(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Rows whose value lies outside its domain; null counts as outside."""
    return df.where(~F.coalesce(F.col(column).isin(allowed), F.lit(False)))


def bounded(df: DataFrame, n: int, most: int = 200) -> DataFrame:
    return df.limit(max(1, min(n, most)))


def search(df: DataFrame, order: list[Column], limit: int, most: int = 200, **equal) -> DataFrame:
    return bounded(optional_filters(df, **equal).orderBy(*order), limit, most)


def log_window(events: DataFrame, start: datetime.datetime, end: datetime.datetime, purpose: str | None, severity: str | None = None) -> DataFrame:
    """Events of a window of at most a day, for a stated purpose; severity is only checked."""
    if not start < end or end - start > datetime.timedelta(hours=24):
        raise ValueError("ING_LOG_WINDOW_INVALID")
    if purpose is None or not purpose.strip() or len(purpose) > 500:
        raise ValueError("ING_LOG_PURPOSE_REQUIRED")
    if severity is not None and severity not in ("INFO", "WARN", "ERROR"):
        raise ValueError("ING_LOG_SEVERITY_INVALID")
    return time_window(events, "occurred_at", start, end)


def newest_events(events: DataFrame, limit: int, **equal) -> DataFrame:
    """Newest events first; truncated says that there are exactly as many as the limit."""
    rows = search(events, [F.desc("occurred_at"), F.desc("event_id")], limit, **equal)
    return rows.withColumn("truncated", F.count("*").over(Window.partitionBy()) == max(1, min(limit, 200)))


def search_log(events: DataFrame, limit: int, start: datetime.datetime, end: datetime.datetime, purpose: str | None, **equal) -> DataFrame:
    """newest_events() of a window. See log_window() for what is refused."""
    return newest_events(log_window(events, start, end, purpose, equal.get("severity")), limit, **equal)


def aggregate_log(events: DataFrame, dimension: str, limit: int = 200, correlation_id: str | None = None, window: tuple[datetime.datetime, datetime.datetime] | None = None) -> DataFrame:
    """Counts by one dimension within a window of occurred_at; of the search filters only the correlation applies."""
    rows = optional_filters(events if window is None else time_window(events, "occurred_at", *window), correlation_id=correlation_id)
    return bounded(rows.groupBy(F.col(dimension).alias("key")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key"), limit)


def source_status(sources: DataFrame, runs: DataFrame, tenant: str) -> DataFrame:
    """The latest run of each source in the tenant; sources without one drop out."""
    mine = runs.where(F.col("tenant_id") == tenant)
    top = mine.groupBy("source_id").agg(F.max(F.struct("updated_at", "run_id", "state")).alias("x")).select("source_id", "x.*")
    return sources.join(top, "source_id")


def tenant_scope(child: DataFrame, runs: DataFrame, tenant: str) -> DataFrame:
    return child.join(runs.where(F.col("tenant_id") == tenant).select("run_id"), "run_id", "left_semi")


def quarantine_issue_rows(quarantine: DataFrame, runs: DataFrame, snapshots: DataFrame) -> DataFrame:
    both = quarantine.join(runs.select("run_id", "source_id"), "run_id").join(snapshots, "run_id", "left")
    return both.select("quarantine_id", "source_id", F.coalesce("type_code", F.lit("UNKNOWN")).alias("type_code"), "reason_code")


def operational_summary(incidents: DataFrame, hidden: bool = False) -> DataFrame:
    """Counts over the rows that were returned: UNKNOWN if some are hidden, DEGRADED with open ones, else HEALTHY."""
    n = F.count_if(F.col("lifecycle") == "OPEN")
    return incidents.agg(n.alias("open_incidents"), F.when(F.lit(hidden), "UNKNOWN").when(n > 0, "DEGRADED").otherwise("HEALTHY").alias("health"))


def gauges(**frames: tuple[DataFrame, Column]) -> DataFrame:
    """(gauge, value): one aggregate per frame."""
    out = None
    for name, (df, value) in frames.items():
        row = df.agg(value.cast("long").alias("value")).select(F.lit(name).alias("gauge"), F.coalesce("value", F.lit(0)).alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def pressure_number(state: Column) -> Column:
    """What a gauge shows for a state of health.pressure_states()."""
    return F.when(state == "NORMAL", 0).when(state == "SOFT", 1).when(state == "RECOVERY", 2).otherwise(3)


def alert_conditions(samples: DataFrame, key: str, at_seconds: str, value: str, above: float, seconds: int) -> DataFrame:
    """Samples at which a series has stayed above a bound for at least so many seconds."""
    w = Window.partitionBy(key).orderBy(at_seconds).rangeBetween(-seconds, 0)
    whole = F.col(at_seconds) - F.min(at_seconds).over(Window.partitionBy(key)) >= seconds
    return samples.withColumn("firing", whole & (F.min(value).over(w) > above))


def reference_usage(**frames: tuple[DataFrame, str]) -> DataFrame:
    """(ref, origin): union of the references that each frame's column makes."""
    out = None
    for name, (df, column) in frames.items():
        part = df.select(F.col(column).cast("string").alias("ref"), F.lit(name).alias("origin"))
        out = part if out is None else out.unionByName(part)
    return out


def reference_dependencies(usage: DataFrame, holds: DataFrame) -> DataFrame:
    """Uses per reference; removable if there are none and no legal hold applies."""
    counts = usage.where("origin is not null").groupBy("ref").agg(F.count("*").alias("uses"))
    both = counts.join(holds, "ref", "full")
    uses, held = F.coalesce("uses", F.lit(0)), F.coalesce("held", F.lit(False))
    return both.select("ref", uses.alias("uses"), held.alias("held"), ((uses == 0) & ~held).alias("removable"))


def legal_hold_state(events: DataFrame) -> DataFrame:
    return events.groupBy("ref").agg((F.max_by("action", F.struct("created_at", "event_id")) == "APPLY").alias("held"))


def capacity_left(limits: dict[str, tuple[int, int, int]], **frames: DataFrame) -> DataFrame:
    """(tenant_id, principal, available): what a principal may still take, the least that any of the frames leaves at any of the three levels.

    limits: by frame name the most of all, of a tenant and of a principal.
    """
    out = None
    for name, df in frames.items():
        used = capacity_usage(df, limits[name])
        whole = used.where("level = 'GLOBAL'").select(F.col("available").alias("g"))
        tenant = used.where("level = 'TENANT'").select("tenant_id", F.col("available").alias("t"))
        own = used.where("level = 'PRINCIPAL'").select("tenant_id", "principal", F.col("available").alias("p"))
        part = own.join(tenant, "tenant_id").crossJoin(F.broadcast(whole)).select("tenant_id", "principal", F.least("g", "t", "p").alias("available"))  # whole is one row
        out = part if out is None else out.unionByName(part)
    return out.groupBy("tenant_id", "principal").agg(F.min("available").alias("available"))


def capacity_usage(items: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """Counts at the levels all, tenant and principal against their limits, in one rollup."""
    level = F.when(F.grouping("tenant_id") == 1, "GLOBAL").when(F.grouping("principal") == 1, "TENANT").otherwise("PRINCIPAL")
    most = F.when(F.col("level") == "GLOBAL", limits[0]).when(F.col("level") == "TENANT", limits[1]).otherwise(limits[2])
    out = items.rollup("tenant_id", "principal").agg(F.count("*").alias("used"), level.alias("level"))
    return out.select("level", "tenant_id", "principal", "used", F.greatest(F.lit(0).cast("long"), most - F.col("used")).alias("available"))


def replay_view(requests: DataFrame, executions: DataFrame) -> DataFrame:
    """Replay requests with their executions (replay_id, state, attempts, …); requests without one drop out."""
    return requests.join(executions, "replay_id")


def replay_lineage(replays: DataFrame, quarantine: DataFrame, runs: DataFrame) -> DataFrame:
    """Each replay with the reason of its quarantine and the source of that one's run."""
    held = quarantine.select("quarantine_id", "run_id", "reason_code")
    return replays.join(held, "quarantine_id").join(runs.select("run_id", "source_id"), "run_id").select("replay_id", "reason_code", "source_id")


def live_custody(items: DataFrame, issues: DataFrame, runs: DataFrame, tenant: str) -> DataFrame:
    """Captured items(session_id, issue_id) with visible: whether the issue still belongs to the tenant; partial: whether the session has any that does not."""
    mine = tenant_scope(issues, runs, tenant).select("issue_id").distinct().withColumn("__v", F.lit(True))
    shown = items.join(mine, "issue_id", "left").withColumn("visible", F.coalesce("__v", F.lit(False))).drop("__v")
    partial = shown.groupBy("session_id").agg((F.count_if(~F.col("visible")) > 0).alias("partial"))
    return shown.join(partial, "session_id")


def superseded_runs(runs: DataFrame, schedules: DataFrame, now: Column) -> DataFrame:
    """PREFLIGHT runs of schedules without a live lease whose publication is another one by now, or is switched off."""
    s = schedules.select("schedule_id", "publication_checksum", "publication_enabled", "lease_until")
    both = runs.where("state = 'PREFLIGHT'").join(s, "schedule_id").where(F.col("lease_until").isNull() | (F.col("lease_until") <= now))
    return both.where((F.col("bundle_checksum") != F.col("publication_checksum")) | ~F.col("publication_enabled")).select("run_id")


def pending_publication(transitions: DataFrame, issues: DataFrame, runs: DataFrame) -> DataFrame:
    """(tenant_id, source_id, lag) for every tenant and source with runs: whether a transition of one of their issues has no revision yet."""
    waiting = transitions.where("revision is null").select("issue_id").distinct()
    lagging = issues.join(waiting, "issue_id", "left_semi").select("run_id").distinct()
    scoped = runs.select("run_id", "tenant_id", "source_id")
    lag = scoped.join(lagging, "run_id", "left_semi").select("tenant_id", "source_id").distinct().withColumn("__lag", F.lit(True))
    every = scoped.select("tenant_id", "source_id").distinct()
    return every.join(lag, ["tenant_id", "source_id"], "left").select("tenant_id", "source_id", F.coalesce("__lag", F.lit(False)).alias("lag"))


def bookmark_scope_match(cursors: DataFrame, sessions: DataFrame, scopes: DataFrame) -> DataFrame:
    """cursors(token, session_id, tenant_id, source_id, state, parent_token) of a session of the same tenant and of a granted scope(tenant_id, source_id, state).

    A null source or state means all of them, and is equal to null only. A cursor with a parent must name a cursor of the same session.
    """
    s = sessions.select("session_id", F.col("tenant_id").alias("s_tenant"), F.col("source_id").alias("s_source"), F.col("state").alias("s_state"))
    g = scopes.select(F.col("tenant_id").alias("g_tenant"), F.col("source_id").alias("g_source"), F.col("state").alias("g_state")).distinct()
    parents = cursors.select(F.col("token").alias("p_token"), F.col("session_id").alias("p_session"))
    both = cursors.join(s, "session_id").where(F.expr("tenant_id = s_tenant and source_id <=> s_source and state <=> s_state"))
    both = both.join(g, F.expr("tenant_id = g_tenant and source_id <=> g_source and state <=> g_state"))
    both = both.join(parents, F.expr("parent_token = p_token"), "left").where("parent_token is null or p_session = session_id")
    return both.select("token", "session_id", "tenant_id", "source_id", "state", "parent_token")


def review_queue(reviews: DataFrame, issues: DataFrame, now: Column, limit: int = 100) -> DataFrame:
    """The oldest due reviews(review_key, issue_id, state, next_attempt_at, created_at) with their issue."""
    due = reviews.where(F.col("state").isin("READY", "FAILED_RETRYABLE") & (F.col("next_attempt_at") <= now))
    return due.join(issues.select("issue_id", "source_id", "issue_code", "status"), "issue_id").orderBy("created_at", "review_key").limit(limit)


def acknowledged_reviews(issues: DataFrame, reviews: DataFrame) -> DataFrame:
    """issues with review_ref: the reference of an ACKED review, on open issues only."""
    done = reviews.where("state = 'ACKED'").groupBy("issue_id").agg(F.max("review_ref").alias("__ref"))
    return issues.join(done, "issue_id", "left").withColumn("review_ref", F.when(F.col("status") == "OPEN", F.col("__ref"))).drop("__ref")


def quarantine_preview(quarantine: DataFrame) -> DataFrame:
    """quarantine with the object's fingerprint for its id, and without references to payload and decision."""
    return quarantine.withColumn("object_fingerprint", F.sha2("source_object_id", 256)).drop("source_object_id", "payload_ref", "decision_ref")


def deep_references(docs: DataFrame, refs: DataFrame, **columns: str) -> DataFrame:
    """(ref, origin): one row for each document of docs and reference of refs(ref) that stands as a text value anywhere in a JSON column; columns: origin = column.

    Every text value of a document is taken out once and joined with the references.
    """
    out = None
    for origin, column in columns.items():
        values = docs.select(F.explode(F.array_distinct(text_values(F.col(column)))).alias("__q"))
        part = values.join(refs.select("ref", quoted(F.col("ref")).alias("__q")).distinct(), "__q").select("ref", F.lit(origin).alias("origin"))
        out = part if out is None else out.unionByName(part)
    return out


def audit_trail(**feeds: tuple[DataFrame, str, str, list[str]]) -> DataFrame:
    """(action, actor, resource, detail, outcome, correlation_id, tenant_id, decision_ref): one row per governed action of each feed (frame, actor column, resource column, detail columns).

    outcome is DENIED where a frame's column `allowed` says no, else ALLOWED; the last three come from the columns of those names, if there.
    """
    out = None
    for action, (df, actor, resource, detail) in feeds.items():
        own = lambda c: (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c)  # noqa: B023, E731
        denied = ~F.col("allowed") if "allowed" in df.columns else F.lit(False)
        row = df.select(
            F.lit(action).alias("action"), F.col(actor).cast("string").alias("actor"), F.col(resource).cast("string").alias("resource"), F.to_json(F.struct(*detail)).alias("detail"),
            F.when(denied, "DENIED").otherwise("ALLOWED").alias("outcome"), own("correlation_id"), own("tenant_id"), own("decision_ref"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def queue_reviews(issues: DataFrame, queued: DataFrame, version: int) -> DataFrame:
    """(review_key, issue_id, review_id, outcome) of open issues at the expected version: QUEUED under a new id, or REPEATED with that of queued(review_key, review_id)."""
    key = F.concat_ws(":", F.lit("ingestion-issue"), "issue_id", "operational_version")
    rows = issues.where((F.col("status") == "OPEN") & (F.col("operational_version") == version)).select(key.alias("review_key"), "issue_id")
    had = queued.groupBy("review_key").agg(F.min("review_id").alias("__id"))
    out = rows.join(had, "review_key", "left")
    return out.select("review_key", "issue_id", F.coalesce("__id", F.sha2("review_key", 256)).alias("review_id"), F.when(F.col("__id").isNull(), "QUEUED").otherwise("REPEATED").alias("outcome"))


def audit_append_only(before: DataFrame, after: DataFrame, key: str, fixed: list[str]) -> DataFrame:
    """Rows that a history lost (DELETED) or changed (MUTATED); new rows are fine."""
    h = F.xxhash64(*fixed)
    both = before.select(key, h.alias("__a")).join(after.select(key, h.alias("__b")), key, "left")
    state = F.when(F.col("__b").isNull(), "DELETED").when(F.col("__a") != F.col("__b"), "MUTATED")
    return both.withColumn("violation", state).where("violation is not null").select(key, "violation")


def history_violations(before: DataFrame, after: DataFrame, key: str, free: tuple[str, ...] = (), rising: tuple[str, ...] = (), ended: Column | None = None, once: tuple[str, ...] = ()) -> DataFrame:
    """(key, violation) of the rows of a protected history that changed in a way that its rules forbid.

    All columns of `before` but those named in free, rising and once are fixed. The rules, of which a row's first counts:
    DELETED, the row is gone; REPEATED, its key came twice; CHANGED, a fixed column differs; LOWERED, a rising one fell
    or was lost; FROZEN, any column differs although `ended` (over the row before) holds; REGAINED, columns of `once`
    differ that were not all null before, or that are not all set now. Nulls are values. New rows are fine. One shuffle
    of both tables by the key; a row travels as its own columns, and what is fixed as a hash of them.
    """
    fixed = [c for c in before.columns if c not in {key, *free, *rising, *once}]
    digest = F.sha2(F.to_json(F.struct(*fixed), {"ignoreNullFields": "false"}), 256) if fixed else F.lit("")
    told = [*free, *rising, *once]
    old = before.select(key, digest.alias("__fixed"), F.struct(F.lit(1).alias("__is"), *told).alias("__old"), F.coalesce(ended if ended is not None else F.lit(False), F.lit(False)).alias("__ended"))
    new = after.groupBy(key).agg(F.count("*").alias("__n"), F.first(F.struct(digest.alias("__fixed"), F.struct(F.lit(1).alias("__is"), *told).alias("__told"))).alias("__new"))
    both = old.join(new, key, "left")
    was, now = lambda c: F.col(f"__old.{c}"), lambda c: F.col(f"__new.__told.{c}")
    any_of = lambda tests: F.exists(F.array(*tests), lambda x: x) if tests else F.lit(False)
    differs = [~was(c).eqNullSafe(now(c)) for c in told]
    lowered = any_of([F.coalesce(now(c) < was(c), was(c).isNotNull() & now(c).isNull()) for c in rising])
    regained = any_of([~was(c).eqNullSafe(now(c)) for c in once]) & any_of([was(c).isNotNull() | now(c).isNull() for c in once])
    state = (
        F.when(F.col("__new").isNull(), "DELETED").when(F.col("__n") > 1, "REPEATED").when(F.col("__fixed") != F.col("__new.__fixed"), "CHANGED")
        .when(lowered, "LOWERED").when(F.col("__ended") & any_of(differs), "FROZEN").when(regained, "REGAINED")
    )
    return both.select(key, state.alias("violation")).where("violation is not null")


def session_violations(before: DataFrame, after: DataFrame) -> DataFrame:
    """Recovery sessions (session_id, attempts, state, ...): attempts only rise, the state alone may change besides, and only of ACTIVE ones."""
    return history_violations(before, after, "session_id", free=("state",), rising=("attempts",), ended=~F.col("state").eqNullSafe(F.lit("ACTIVE")))


def transition_violations(before: DataFrame, after: DataFrame) -> DataFrame:
    """Transitions of incidents (transition_id, publication_revision, published_at, ...): a revision and its time are gained once and together, all else is fixed."""
    return history_violations(before, after, "transition_id", once=("publication_revision", "published_at"))


def lineage_page(lineage: DataFrame, runs: DataFrame, tenant: str, run_id: str, limit: int = 200) -> DataFrame:
    """The first lineage records (lineage_id, source_object_id, bundle_ref, evidence, created_at) of a tenant's run by creation and id, with the contracts that their evidence names."""
    own = runs.where((F.col("tenant_id") == tenant) & (F.col("run_id") == run_id)).select("run_id")
    rows = lineage.where(F.col("run_id") == run_id).join(own, "run_id", "left_semi").orderBy("created_at", "lineage_id")
    refs = F.to_json(F.try_variant_get(F.try_parse_json("evidence"), "$.contracts", "variant"))
    return bounded(rows, limit).select("lineage_id", "source_object_id", "bundle_ref", refs.alias("contract_refs"), "created_at")
