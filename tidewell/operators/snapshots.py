"""Snapshots of incidents that are captured once and read page by page: what changes later changes no page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import content_hash
from .incidents import prioritise_incidents

#: Items a session, pages a session, items a page, minutes that a session lives.
MAX_ITEMS, MAX_PAGES, MAX_LIMIT, MINUTES = 20_000, 200, 100, 30
SESSION = "session string, tenant_id string, page_limit int, item_count long, digest string, created_at timestamp, expires_at timestamp, error_code string"


def digest_of(items: DataFrame) -> DataFrame:
    """(session, tenant_id, digest): over the hashes of all items with their positions, folded as sums, so that no task holds a session."""
    body = F.to_json(F.struct("position", *sorted(c for c in items.columns if c not in ("session", "tenant_id", "page", "position"))))
    part = F.conv(F.substring(F.sha2(body, 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return items.groupBy("session", "tenant_id").agg(content_hash(F.sum(part).cast("string")).alias("digest"))


def capture(incidents: DataFrame, path: str, session: str, now: Column, limit: int = MAX_LIMIT, held: DataFrame | None = None) -> DataFrame:
    """Capture each tenant's incidents in order of priority below path, and return SESSION rows, one a tenant.

    Positions, count, digest and expiry are fixed here. A tenant with more items than pages of `limit` or a session can
    hold has ING_CURSOR_CAPACITY_UNAVAILABLE and no items. held: sessions that there are; a session that is among them
    is returned as it is and not captured again, so that a repeat alters nothing. Items lie by session, sorted by tenant
    and position, so that a page reads the files and row groups that hold it.
    """
    spark = incidents.sparkSession
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError("ING_OPERATIONAL_QUERY_INVALID")
    if held is not None and held.where(F.col("session") == session).limit(1).count():
        return held.where(F.col("session") == session)
    most = min(MAX_ITEMS, limit * MAX_PAGES)
    sizes = incidents.groupBy("tenant_id").agg(F.count("*").alias("item_count"))
    fit = sizes.where(F.col("item_count") <= most).select("tenant_id")
    items = prioritise_incidents(incidents.join(fit, "tenant_id", "left_semi")).withColumn("session", F.lit(session)).withColumn("page", F.expr(f"position div {limit}"))
    items.repartitionByRange("tenant_id", "position").sortWithinPartitions("tenant_id", "position").write.mode("append").partitionBy("session").parquet(f"{path}/items")
    items = read_items(spark, path, items).where(F.col("session") == session)
    out = sizes.withColumn("session", F.lit(session)).join(digest_of(items), ["session", "tenant_id"], "left")
    code = F.when(F.col("item_count") > most, "ING_CURSOR_CAPACITY_UNAVAILABLE")
    out = out.select("session", "tenant_id", F.lit(limit).alias("page_limit"), "item_count", "digest", now.cast("timestamp").alias("created_at"), (now.cast("timestamp") + F.make_dt_interval(mins=F.lit(MINUTES))).alias("expires_at"), code.alias("error_code"))
    out.write.mode("append").partitionBy("session").parquet(f"{path}/sessions")
    return spark.read.schema(SESSION).parquet(f"{path}/sessions").where(F.col("session") == session)


def read_items(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The captured items; like: a frame with their columns, session and page included."""
    return spark.read.schema(like.schema).parquet(f"{path}/items")


def pages(items: DataFrame, sessions: DataFrame, cursors: DataFrame) -> DataFrame:
    """cursors(session, tenant_id, position, at) with their page's items, has_next, and error_code: one row an item, and one for a cursor with a code or an empty page.

    ING_CURSOR_UNAVAILABLE: no such session of the tenant, or no page begins at the position. ING_CURSOR_EXPIRED: the
    session has ended at `at`. A cursor read again gives the same rows.
    """
    met = cursors.join(sessions, ["session", "tenant_id"], "left")
    lost = F.col("item_count").isNull() | (F.col("position") > F.col("item_count")) | (F.col("position") % F.col("page_limit") != 0) | (F.col("position") < 0)
    met = met.withColumn("error_code", F.when(lost, "ING_CURSOR_UNAVAILABLE").when(F.col("expires_at") <= F.col("at"), "ING_CURSOR_EXPIRED").otherwise(F.col("error_code")))
    met = met.withColumn("has_next", F.when(F.col("error_code").isNull(), F.col("position") + F.col("page_limit") < F.col("item_count")))
    met = met.withColumn("page", F.when(F.col("error_code").isNull(), F.expr("position div page_limit"))).withColumnRenamed("position", "cursor")
    return met.select("session", "tenant_id", "cursor", "page", "has_next", "error_code", "at").join(items, ["session", "tenant_id", "page"], "left").drop("page")


def altered(items: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions whose items are not those that were captured: ING_CURSOR_EVIDENCE_INVALID."""
    now = digest_of(items).withColumnRenamed("digest", "found")
    both = sessions.where("error_code is null and item_count > 0").join(now, ["session", "tenant_id"], "left")
    return both.where(~F.col("digest").eqNullSafe(F.col("found"))).select("session", "tenant_id", F.lit("ING_CURSOR_EVIDENCE_INVALID").alias("error_code"))
