"""Stateful streams: histories as initial state, probes by timer, state that ends."""

from pyspark.sql import functions as F
from tidewell.operators import health
from tidewell.plans.scratch import drained, drained_by_clock, streamed
from tidewell.streaming import jobs, timed


def test_a_circuit_goes_on_from_its_history(spark):
    rows = [(1, t, t, "TRANSIENT") for t in (0, 10, 20, 30)] + [(1, 40, 40, "TRANSIENT"), (2, 41, 41, "SUCCESS"), (2, 2000, 2000, "SUCCESS")]
    log = spark.createDataFrame(rows, "source_id long, at_seconds long, event_id long, outcome string")
    before, after = log.where("event_id <= 30"), log.where("event_id > 30")
    history = health.circuit_states(before).join(before.groupBy("source_id").agg(F.max("at_seconds").alias("at_seconds")), "source_id")
    out = drained(timed.circuit_breaker(streamed(after, "later"), initial=history), "circuit")
    got = sorted(tuple(r) for r in out.select("source_id", "at", "action", "status", "failures", "attempts", "open_until").collect())
    assert got == [
        (1, 40, "OUTCOME", "PAUSED", 5, 5, 940), (1, 940, "PROBE", "PROBING", 5, 5, 0), (2, 41, "OUTCOME", "HEALTHY", 0, 0, 0), (2, 2000, "OUTCOME", "HEALTHY", 0, 0, 0),
    ]


def test_a_success_takes_the_probe_away(spark):
    rows = [(1, t, t, "TRANSIENT") for t in range(5)] + [(1, 100, 100, "SUCCESS"), (2, 5000, 5000, "SUCCESS")]
    log = spark.createDataFrame(rows, "source_id long, at_seconds long, event_id long, outcome string")
    assert drained(timed.circuit_breaker(streamed(log, "log")), "circuit").where("action = 'PROBE'").count() == 0


def test_watermarks_of_many_small_keys(spark, tmp_path):
    """Keys by the thousand cost a call a group, not a key; a later batch meets the same groups, old keys and new ones, and null keys."""
    schema = "run_id long, partition_key string, sequence_no long, state string"

    def run(n, rows):
        rows.coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        source = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
        jobs.ack_watermark_stream(source, groups=4).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        return {(r.run_id, r.partition_key): r.m for r in spark.read.parquet(f"{tmp_path}/out").groupBy("run_id", "partition_key").agg(F.max("watermark").alias("m")).collect()}

    ids = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("run_id"), F.when(F.col("id") % 2 == 0, "p").alias("partition_key"))
    one = ids.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"), F.lit(2).cast("long"))).alias("sequence_no")).select("*", F.when(F.col("sequence_no") == 1, "ACKED").otherwise("READY").alias("state"))
    assert run(1, one) == {(r.run_id, r.partition_key): 1 for r in ids.collect()}
    two = ids.where("run_id is null or run_id % 5 = 0").select("*", F.lit(3).cast("long").alias("sequence_no"), F.lit("ACKED").alias("state"))
    got = run(2, two)
    assert got == {(r.run_id, r.partition_key): 3 if r.run_id is None or r.run_id % 5 == 0 else 1 for r in ids.collect()}


def test_leases_of_many_handoffs(spark):
    """A group's handoffs share a row of state and a timer: each ends by its own lease and last attempt."""
    h = spark.range(20_000).select(F.concat(F.lit("h"), F.col("id") % 10_000).alias("handoff_id"), F.when(F.col("id") < 10_000, 1).otherwise(2).cast("long").alias("attempt"), "id")
    late = (F.col("id") >= 10_000) & (F.col("id") % 4 == 0)
    state = F.when((F.col("id") >= 10_000) & (F.col("id") % 4 == 1), "ACKED").otherwise("DELIVERING").alias("state")
    until = F.when(late, F.lit("2100-01-01").cast("timestamp")).otherwise(F.timestamp_seconds(F.col("id") + 1)).alias("lease_until")
    got = drained_by_clock(timed.lease_expiry(streamed(h.select("handoff_id", "attempt", state, until), "leases"), groups=3), "expired")
    got = sorted((r.handoff_id, r.attempt, r.at) for r in got.select("*", F.unix_seconds("lease_until").alias("at")).collect())
    assert got == sorted((f"h{i}", 2, i + 10_001) for i in range(10_000) if i % 4 > 1)
