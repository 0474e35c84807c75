"""State tables of an intake runtime, derived from the given tables by SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (base tables, other views, SQL); {x} stands for a table or view.
VIEWS: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "runs": (("orders",), (), """
        SELECT o_orderkey AS run_id, concat('src-', CAST(o_custkey % 20 AS STRING)) AS source_id, concat('tenant-', CAST(o_custkey % 5 AS STRING)) AS tenant_id,
          CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'RUNNING' ELSE 'PAUSED' END AS state,
          CASE WHEN o_orderkey % 3 = 0 THEN 'FULL_SNAPSHOT' WHEN o_orderkey % 3 = 1 THEN 'CATCH_UP' ELSE 'DELTA' END AS phase,
          concat('b', CAST(o_custkey % 7 AS STRING)) AS bundle_id, CAST(o_custkey % 3 AS STRING) AS bundle_version, concat('c', CAST(o_custkey % 4 AS STRING)) AS bundle_checksum,
          concat('schedule-', CAST(o_custkey % 40 AS STRING)) AS schedule_id, o_orderpriority AS priority, o_orderdate AS updated_at, o_orderkey % 11 AS control_version
        FROM {orders}"""),
    "handoffs": (("lineitem",), (), """
        SELECT l_orderkey AS run_id, 'default' AS partition_key, concat(CAST(l_orderkey AS STRING), ':', CAST(l_partkey AS STRING)) AS source_object_id,
          CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_tax, l_discount) AS BIGINT) AS sequence_no,
          CASE WHEN l_linestatus = 'F' THEN 'ACKED' WHEN l_returnflag = 'R' THEN 'FAILED_RETRYABLE' WHEN l_returnflag = 'A' THEN 'DELIVERING' ELSE 'READY' END AS state,
          l_shipdate AS next_attempt_at, l_shipdate + INTERVAL '30' MINUTE AS lease_until, l_partkey AS payload_key, l_suppkey % 10 AS attempts
        FROM {lineitem}"""),
    "ops_events": (("events",), (), """
        SELECT event_id, ts AS occurred_at, concat('user-', CAST(user_id AS STRING)) AS source_id, event_type,
          CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END AS severity,
          concat('corr-', CAST(user_id % 7 AS STRING)) AS correlation_id, event_id % 1500 AS run_id, value
        FROM {events}"""),
    "transitions": (("events",), (), """
        SELECT event_id AS transition_id, user_id % 60 AS issue_id, concat('tenant-', CAST(user_id % 3 AS STRING)) AS tenant_id,
          CAST(row_number() OVER (PARTITION BY user_id % 60 ORDER BY event_id) AS BIGINT) AS issue_version,
          CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'WARNING' END AS severity, CASE event_type WHEN 'signup' THEN 'RESOLVED' ELSE 'OPEN' END AS lifecycle,
          ts AS observed_at, concat('src-', CAST(user_id % 20 AS STRING)) AS source_id
        FROM {events}"""),
    "attempt_log": (("events",), (), """
        SELECT event_id, user_id AS source_id, ts AS happened_at, CASE event_type WHEN 'error' THEN 'TRANSIENT' WHEN 'click' THEN 'DATA' ELSE 'SUCCESS' END AS outcome
        FROM {events} WHERE event_type IN ('error', 'click', 'view')"""),
    "quarantine": (("events",), (), """
        SELECT event_id AS quarantine_id, event_id % 1500 AS run_id, concat('obj-', CAST(user_id AS STRING)) AS source_object_id,
          CASE user_id % 3 WHEN 0 THEN 'ING_SCHEMA_INCOMPATIBLE' WHEN 1 THEN 'ING_VALID_TIME_INVALID' ELSE 'ING_MAPPING_SOURCE_FIELD_MISSING' END AS reason_code,
          concat('lake://raw/', CAST(event_id AS STRING)) AS payload_ref, concat('evidence-', CAST(event_id AS STRING)) AS evidence_ref,
          CASE event_id % 6 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'UNDER_REVIEW' WHEN 2 THEN 'RETRY_READY' WHEN 3 THEN 'REPROCESSING' WHEN 4 THEN 'RESOLVED' ELSE 'DISMISSED' END AS lifecycle_state,
          event_id % 4 <> 0 AS blocking, ts AS created_at, event_id % 3 + 1 AS attempt_no
        FROM {events} WHERE event_type = 'error'"""),
    "issues": (("events",), (), """
        SELECT event_id AS issue_id, event_id % 1500 AS run_id, concat('src-', CAST(user_id % 20 AS STRING)) AS source_id,
          CASE user_id % 2 WHEN 0 THEN 'TYPE_A' ELSE 'TYPE_B' END AS type_code, CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'WARNING' END AS severity,
          CASE user_id % 4 WHEN 0 THEN 'ING_SCHEMA_UNKNOWN_VERSION' WHEN 1 THEN 'ING_RECORD_QUARANTINED' WHEN 2 THEN 'ING_RUN_RECOVERY_BUDGET_EXHAUSTED' ELSE 'ING_DOWNSTREAM_UNAVAILABLE' END AS issue_code,
          CASE event_id % 5 WHEN 0 THEN 'RESOLVED' WHEN 1 THEN 'DISMISSED' ELSE 'OPEN' END AS status, event_id % 9 AS operational_version, ts AS created_at, ts AS last_updated_at,
          concat('evidence-', CAST(event_id AS STRING)) AS evidence_ref
        FROM {events} WHERE event_type IN ('error', 'purchase')"""),
    "schedules": (("customer",), (), """
        SELECT concat('schedule-', CAST(c_custkey AS STRING)) AS schedule_id, concat('tenant-', CAST(c_custkey % 50 AS STRING)) AS tenant_id, concat('src-', CAST(c_custkey AS STRING)) AS source_id,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'BOOTSTRAP' WHEN 'MACHINERY' THEN 'RECOVERY' ELSE 'ORDINARY' END AS workload_class,
          c_custkey * 37 % 1000 AS next_run, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey * 53 % 700 END AS last_dispatched,
          CASE WHEN c_custkey % 9 = 0 THEN 'PAUSED' WHEN c_custkey % 13 = 0 THEN 'DISABLED' ELSE 'ENABLED' END AS state, c_nationkey AS activation_failures
        FROM {customer}"""),
    "replays": (("events",), (), """
        SELECT event_id AS replay_id, event_id AS quarantine_id, CASE event_id % 3 WHEN 0 THEN 'REPRODUCE' WHEN 1 THEN 'REPROCESS_CURRENT' ELSE 'REPROCESS_TARGET' END AS replay_mode,
          CASE event_id % 4 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'RETRY_WAIT' ELSE 'RUNNING' END AS state, user_id % 7 AS attempts, 5 AS max_attempts, ts AS created_at
        FROM {events} WHERE event_type = 'error'"""),
    "records": (("customer",), (), """
        SELECT c_custkey AS ordinal, concat('src-', CAST(c_custkey % 20 AS STRING)) AS source_id, CAST(c_custkey AS STRING) AS id, c_name AS name, c_mktsegment AS segment,
          CAST(c_nationkey AS STRING) AS nation, c_nationkey AS variant
        FROM {customer}"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bases, others, sql = VIEWS[name]
    frames = {b: spark.read.parquet(f"{sf_dir}/{b}.parquet") for b in bases} | {o: view(spark, sf_dir, o) for o in others}
    return spark.sql(sql, **frames)


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL that sees the named views."""
    parts = [f"{n} AS ({VIEWS[n][2].format(**{b: b for b in VIEWS[n][0] + VIEWS[n][1]})})" for n in names]
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return "WITH RECURSIVE " + ", ".join(parts) + ", " + body[15:]
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join(parts) + ", " + body[5:]
    return "WITH " + ", ".join(parts) + " " + body
