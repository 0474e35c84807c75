"""Ranks, running totals and states of keys that hold most rows: against plain loops, and without a task that takes them all."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidewell.operators import health, incidents, ordered, outbox


def circuit(rows, window=900, most=5, pause=900):
    status, failures, began, attempts, retry, until = "HEALTHY", 0, -1, 0, 0, 0
    for t, _, outcome, after in sorted(rows, key=lambda r: (r[0], r[1])):
        if outcome == "SUCCESS":
            status, failures, began, attempts, retry, until = "HEALTHY", 0, -1, 0, 0, 0
        elif outcome == "TRANSIENT":
            fresh = began < 0 or t - began >= window
            began, attempts, failures = (t, 1, failures + 1) if fresh else (began, attempts + 1, failures + 1)
            retry = t + max(min(900, 5 * 2 ** min(attempts - 1, 7)), after or 0)
            status, until = ("PAUSED", t + pause) if attempts >= most else ("DEGRADED", 0)
        else:
            status, failures, retry, until = "DEGRADED", 0, 0, 0
    return status, failures, began, attempts, retry, until


@pytest.mark.parametrize("window", [1, 7, 60, 100_000])
def test_circuits(spark, window):
    rng = random.Random(window)
    rows = []
    for source in range(40):
        kinds = ["TRANSIENT"] * rng.choice([1, 5, 400]) + ["DATA", None] + ["SUCCESS"] * rng.choice([0, 1, 3])
        n = 3000 if source == 7 else rng.choice([1, 2, 30, 200])
        rows += [(source, rng.randrange(rng.choice([5, 500, 20_000])), i, rng.choice(kinds), rng.choice([None, None, 3, 2000])) for i in range(n)]
    log = spark.createDataFrame(rows, "source_id long, at_seconds long, event_id long, outcome string, retry_after long")
    got = {r[0]: tuple(r)[1:] for r in health.circuit_states(log, window=window).collect()}
    assert got == {s: circuit([r[1:] for r in rows if r[0] == s], window) for s in {r[0] for r in rows}}


def test_segments_compose():
    """Runs cut anywhere give the window that one run gives."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    for _ in range(200):
        t = np.unique(rng.integers(0, 400, rng.integers(1, 120)))
        n = rng.integers(1, 4, len(t))
        window = int(rng.integers(1, 80))
        cuts = np.unique([0, *rng.integers(0, len(t), 4), len(t)])
        runs = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            one = pa.RecordBatch.from_arrays([pa.array([1] * (b - a), pa.int64()), pa.array(t[a:b]), pa.array(n[a:b])], ["k", "at_seconds", "n"])
            runs += list(health._segments(iter([one]), "k", window))
        [out] = health._chained(iter(runs), "k", window)
        began, count = health.window_chain(t, n, window)
        assert out.to_pylist() == [{"k": 1, "began": began[0], "attempts": count[0]}]


def test_pressure_is_a_fold(spark):
    rng, rows = random.Random(1), []
    for tenant in range(200):
        rows += [(tenant, i, rng.choice([0, 5, 6, 7, 9, 10, 11, 20, None])) for i in range(rng.choice([1, 2, 3, 9, 40]))]
    got = {r.tenant_id: r.state for r in health.pressure_states(spark.createDataFrame(rows, "tenant_id long, at long, backlog long"), 10, 20, 5).collect()}
    want = {}
    for tenant, _, b in rows:
        if b is None:
            continue
        s = want.get(tenant, "NORMAL")
        low = "NORMAL" if b <= 5 else "RECOVERY"
        want[tenant] = "HARD" if b >= 20 else low if s in ("HARD", "RECOVERY") else "SOFT" if b >= 10 or s == "SOFT" and b > 5 else "NORMAL"
    assert got == want
    with pytest.raises(ValueError, match="ING_PRESSURE_POLICY_INVALID"):
        health.pressure_states(spark.range(1).selectExpr("id tenant_id", "id at", "id backlog"), 10, 20, 10)


def hot(spark, n):
    """A key with most rows, the null key, and keys of one row."""
    return spark.range(n).select(F.when(F.col("id") % 50 == 1, F.col("id")).when(F.col("id") % 50 != 2, 0).alias("k"), (F.xxhash64("id") % 10_000).alias("x"), "id")


@pytest.mark.parametrize("bits", [4, 16])
def test_ranks_and_running_totals(spark, monkeypatch, bits):
    monkeypatch.setattr(ordered, "BLOCK_BITS", bits)
    df = hot(spark, 5000)
    rows = [tuple(r) for r in df.collect()]
    ranked = ordered.ranked(df, ["k"], [F.desc("x"), "id"])
    totals = ordered.running(df, ["k"], ["x", "id"], {"s": F.when(F.col("x") > 0, F.col("x"))}, {"top": F.when(F.col("id") % 7 == 0, F.col("id"))})
    want_rank, want_sum = [], []
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))
        want_rank += [(*r, i + 1) for i, r in enumerate(mine)]
        s, top = 0, None
        for r in sorted(mine, key=lambda r: (r[1], r[2])):
            s += max(r[1], 0)
            top = r[2] if r[2] % 7 == 0 and (top is None or r[2] > top) else top
            want_sum.append((*r, s, top))
    assert sorted(map(tuple, ranked.collect()), key=repr) == sorted(want_rank, key=repr)
    assert sorted(map(tuple, totals.collect()), key=repr) == sorted(want_sum, key=repr)
    assert ordered.ranked(df.limit(0), ["k"], ["x"]).count() == 0 and ordered.running(df.limit(0), [], ["x"], {"s": F.col("x")}).count() == 0


def test_one_key_is_spread(spark):
    """A table of one key lies in all partitions alike, none with twice the mean."""
    laid = ordered.laid_out(spark.range(200_000).select(F.lit("t").alias("k"), F.xxhash64("id").alias("x")), ["k"], ["x"])
    sizes = [r["count"] for r in laid.groupBy(F.shiftright("__at", 33)).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_receipts(spark):
    now = F.lit("2000-01-01").cast("timestamp")
    h = spark.createDataFrame([(1, "ACKED", "kept"), (2, "DELIVERING", None), (3, "DELIVERING", None), (4, "READY", None), (5, "DELIVERING", None)], "handoff_id long, state string, receipt_ref string")
    r = spark.createDataFrame([(1, False, "x"), (1, True, "y"), (2, True, "r2"), (2, True, "r2"), (2, False, "a"), (3, False, "r3"), (5, None, "r5")], "handoff_id long, durable boolean, receipt_ref string")
    got = [tuple(x) for x in outbox.apply_receipts(h, r, now).select("handoff_id", "new_state", "receipt_ref", "error_code").orderBy("handoff_id").collect()]
    assert got == [(1, "ACKED", "kept", None), (2, "ACKED", "r2", None), (3, "FAILED_RETRYABLE", None, "ING_ACK_NOT_DURABLE"), (4, "FAILED_RETRYABLE", None, "ING_DOWNSTREAM_UNAVAILABLE"), (5, "FAILED_RETRYABLE", None, "ING_ACK_NOT_DURABLE")]


def test_revisions_of_one_tenant(spark):
    pending = spark.range(3000).select(F.lit("t").alias("tenant_id"), (F.col("id") % 10).alias("issue_id"), F.col("id").alias("issue_version"))
    clock = spark.createDataFrame([("t", 7)], "tenant_id string, last_revision long")
    rows = incidents.allocate_revisions(pending, clock).orderBy("issue_id", "issue_version").collect()
    assert [r.revision for r in rows] == list(range(8, 3008))
    assert [r.revision for r in incidents.allocate_revisions(pending, clock, 3).orderBy("revision").collect()] == [8, 9, 10]


def test_a_batch_reads_its_buckets(spark, tmp_path):
    """The second batch prunes the other buckets and does not shuffle the table; a repeat adds nothing."""
    from tidewell.operators import buckets

    path, schema = str(tmp_path / "t"), "k string, v long"
    rows = spark.range(2000).selectExpr("concat('k', id) k", "id v")
    assert buckets.held_rows(rows, path, schema, "k").count() == 0
    buckets.append(rows, path, "k")
    few = rows.where("v in (3, 5)")
    held = buckets.held_rows(few, path, schema, "k")
    assert {tuple(r) for r in held.collect()} == {("k3", 3), ("k5", 5)}
    plan = held._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan parquet") :]
    assert "PartitionFilters: [bucket" in plan and "BroadcastHashJoin" in plan and "hashpartitioning(k" not in plan.split("BroadcastExchange")[0]
    assert scan


def test_records_of_one_file_are_judged_by_all_cores(spark, tmp_path):
    """A scan of few bytes is one task; the costly steps after it are not."""
    from tidewell.operators import pipeline
    from tidewell.plans import intake, registry

    spark.range(400).selectExpr("id AS c_custkey", "concat('n', id) AS c_name", "'A' AS c_mktsegment", "cast(id % 25 AS int) AS c_nationkey").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    records = spark.read.parquet(f"{tmp_path}/customer.parquet").selectExpr("c_custkey AS ordinal", "'src-1' AS source_id", "cast(c_custkey AS string) AS id", "c_name AS name", "c_mktsegment AS segment", "cast(c_nationkey AS string) AS nation", "c_nationkey AS variant")
    assert records.rdd.getNumPartitions() == 1
    for df in (pipeline.judged(intake.commands(records), intake.config()), registry.queries()["activation_errors"](spark, str(tmp_path))):
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 1
