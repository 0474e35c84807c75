"""Incidents: versions, publication, snapshots, pages and deltas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import ranked, running


def incident_versions(changes: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Changes that really change a value, null-safe, with version from 1 per key; no-ops go."""
    w = Window.partitionBy(key).orderBy(*order)
    row = F.struct(*values)
    first = F.row_number().over(w) == 1
    kept = changes.withColumn("__new", first | ~row.eqNullSafe(F.lag(row).over(w))).where("__new").drop("__new")
    return kept.withColumn("version", F.row_number().over(w).cast("long"))


def monotone_observation(changes: DataFrame, key: str, order: list[str], *times: str) -> DataFrame:
    """last_updated: the latest of these times (the clock's, the resolution's) that the key's changes so far have seen; nulls are passed over."""
    at = F.greatest(*times) if len(times) > 1 else F.col(times[0])
    return running(changes, [key], order, {}, {"last_updated": at})


def allocate_revisions(pending: DataFrame, clock: DataFrame, batch: int | None = None) -> DataFrame:
    """pending with revision: dense per tenant after clock(tenant_id, last_revision), by issue_id and version; at most `batch` per tenant.

    Without a batch a tenant's rows are ranked over many tasks; a batch is the head of a window, which Spark cuts before the shuffle.
    """
    if batch is None:
        out = ranked(pending, ["tenant_id"], ["issue_id", "issue_version"], "__n")
    else:
        out = pending.withColumn("__n", F.row_number().over(Window.partitionBy("tenant_id").orderBy("issue_id", "issue_version"))).where(F.col("__n") <= batch)
    out = out.join(clock, "tenant_id", "left")
    return out.withColumn("revision", (F.col("__n") + F.coalesce("last_revision", F.lit(0))).cast("long")).drop("__n", "last_revision")


def as_of_revision(transitions: DataFrame, watermark: int, after: int = 0) -> DataFrame:
    """Of each issue the newest version with after < revision <= watermark."""
    rows = transitions.where((F.col("revision") > after) & (F.col("revision") <= watermark))
    top = rows.groupBy("tenant_id", "issue_id").agg(F.max(F.struct("revision", *[c for c in rows.columns if c not in ("tenant_id", "issue_id", "revision")])).alias("x"))
    return top.select("tenant_id", "issue_id", "x.*")


def latest_transition(transitions: DataFrame, order: str = "issue_version") -> DataFrame:
    return transitions.groupBy("issue_id").agg(F.max(order).alias(order)).join(transitions, ["issue_id", order])


def resume_status(transitions: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """One row for each of bookmarks(tenant_id, after, floor): high_watermark and progress.

    HISTORY_GAP: the kept history begins after the boundary, so that changes may be missing. NO_PROGRESS: nothing was
    published past it. DELTA: there are changes to read.
    """
    high = transitions.groupBy("tenant_id").agg(F.max("revision").alias("high_watermark"))
    out = bookmarks.join(high, "tenant_id", "left").withColumn("high_watermark", F.coalesce("high_watermark", F.lit(0)).cast("long"))
    state = F.when(F.col("floor") > F.col("after"), "HISTORY_GAP").when(F.col("high_watermark") <= F.col("after"), "NO_PROGRESS").otherwise("DELTA")
    return out.withColumn("progress", state)


def resume_delta(transitions: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """The newest versions past each tenant's boundary, for tenants whose resume_status is DELTA."""
    at = resume_status(transitions, bookmarks).where("progress = 'DELTA'").select("tenant_id", F.col("after").alias("__after"), "progress")
    rows = transitions.join(at, "tenant_id").where("revision > __after").drop("__after")
    return as_of_revision(rows, (1 << 63) - 1)


def priority() -> list[Column]:
    """Open before closed, errors first, newest first, then the id."""
    return [(F.col("lifecycle") != "OPEN").cast("int"), (F.col("severity") != "ERROR").cast("int"), F.col("observed_at").desc(), F.col("issue_id")]


def prioritise_incidents(incidents: DataFrame) -> DataFrame:
    """incidents with their position from 0 in their tenant's order of priority; a tenant's rows are ranked over many tasks."""
    return ranked(incidents, ["tenant_id"], priority(), "position").withColumn("position", F.col("position") - 1)


def top_incidents(incidents: DataFrame, limit: int) -> DataFrame:
    """The first by priority: the limit comes after the order, so that the oldest open error survives."""
    return incidents.orderBy(*priority()).limit(limit)


def snapshot_page(snapshot: DataFrame, position: int, limit: int) -> DataFrame:
    """Rows of positions [position, position + limit) per tenant, and whether a next page exists."""
    total = snapshot.groupBy("tenant_id").agg(F.count("*").alias("total"))
    page = snapshot.where(F.col("position").between(position, position + min(limit, 100) - 1))
    return page.join(total, "tenant_id").withColumn("has_next", F.col("total") > position + min(limit, 100)).drop("total")


def page_coverage(pages: DataFrame, sessions: DataFrame) -> DataFrame:
    """Whether all pages of each session(session_id, item_count, page_limit) were read: pages(session_id, page, complete)."""
    read = pages.groupBy("session_id").agg(F.count_if("complete").alias("done"))
    need = F.greatest(F.lit(1), F.ceil(F.col("item_count") / F.col("page_limit"))).cast("long")
    out = sessions.join(read, "session_id", "left").withColumn("needed", need).withColumn("done", F.coalesce("done", F.lit(0)))
    return out.select("session_id", "needed", "done", (F.col("done") >= F.col("needed")).alias("may_bookmark"))


def page_digest(items: DataFrame, key: list[str], order: str, body: str) -> DataFrame:
    """sha256 over the bodies of each page in order; a page is bounded by its limit."""
    rows = F.array_sort(F.collect_list(F.struct(order, body)))
    return items.groupBy(*key).agg(F.sha2(F.array_join(F.transform(rows, lambda x: x[body]), "\n"), 256).alias("digest"))


def incident_projection(issues: DataFrame, runs: DataFrame) -> DataFrame:
    """The sixteen fields of an issue that its tenant may see, with tenant_id of its run and what is to be done."""
    open_ = F.col("status") == "OPEN"
    own = lambda c, kind: F.col(c) if c in issues.columns else F.lit(None).cast(kind)
    rows = issues.join(runs.select("run_id", "tenant_id"), "run_id")
    return rows.select(
        "tenant_id", F.col("issue_id").alias("incident_id"), F.lit("INGESTION").alias("module"), F.col("issue_code").alias("event_type"), F.when(open_, "OPEN").otherwise("RESOLVED").alias("lifecycle_state"), "severity",
        F.col("created_at").alias("first_seen_at"), F.col("last_updated_at").alias("last_seen_at"), own("resolved_at", "timestamp").alias("resolved_at"), F.col("run_id").alias("job_ref"), F.col("source_id").alias("source_ref"),
        F.col("issue_code").alias("error_code"), own("correlation_id", "string").alias("correlation_id"), open_.alias("action_required"), F.concat(F.lit("Ingestion "), F.lower("status"), F.lit(" issue "), F.col("issue_code")).alias("impact_summary"),
        F.concat_ws(":", "source_id", "issue_code").alias("dedup_key"), F.lit("TENANT_OPERATIONAL").alias("visibility_class"), recommended_action().alias("recommended_action"), F.concat(F.lit("EXPLAIN_"), F.col("issue_code")).alias("explanation"),
    )


def recommended_action() -> Column:
    code = F.col("issue_code")
    return F.when(code.contains("SCHEMA"), "REQUEST_ONBOARDING_REVIEW").when(code.contains("QUARANTINE"), "INSPECT_QUARANTINE_AND_REPROCESS").otherwise("INSPECT_RUN_EVIDENCE")


def redact_visible(incidents: DataFrame, grants: DataFrame) -> DataFrame:
    """Rows of granted sources without their evidence, and partial: whether the tenant has rows that are hidden."""
    shown = incidents.join(grants.select("source_id", F.lit(True).alias("__ok")).distinct(), "source_id", "left")
    hidden = shown.groupBy("tenant_id").agg((F.count_if(F.col("__ok").isNull()) > 0).alias("partial"))
    return shown.where("__ok").drop("__ok", "evidence_ref").join(hidden, "tenant_id")


def open_issue_dedupe(candidates: DataFrame, issues: DataFrame) -> DataFrame:
    """The first candidate of each (source, type, code, evidence) without an open issue."""
    key = ["source_id", "type_code", "issue_code", "evidence_ref"]
    first = candidates.groupBy(*key).agg(F.min("issue_id").alias("issue_id"))
    return first.join(issues.where("status = 'OPEN'").select(*key).distinct(), key, "left_anti")
