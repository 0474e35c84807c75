"""Structured Streaming jobs over the same operators: stateful ones keep their state per key, others work per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import buckets, outbox


def dedupe_handoffs(stream: DataFrame, at: str, late: str = "1 day") -> DataFrame:
    """Each idempotency key once, as long as its repeats come within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(["idempotency_key"])


def _stateful(stream: DataFrame, key: str | list[str], output: str, state: str, step) -> DataFrame:
    """applyInPandasWithState in append mode: step(state tuple or None, rows) -> (state tuple, frame of output rows)."""
    keys = [key] if isinstance(key, str) else key

    def run(k, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        new, out = step(tuple(held.get) if held.exists else None, rows)
        held.update(new)
        for i, name in enumerate(keys):
            out.insert(i, name, k[i])
        yield out

    return stream.groupBy(*keys).applyInPandasWithState(run, output, state, "append", "NoTimeout")


def pressure_monitor(stream: DataFrame, soft: int = 1000, hard: int = 5000, recovery: int = 500) -> DataFrame:
    """(tenant_id, at, state) after each measurement (tenant_id, at, backlog)."""

    def step(held, rows):
        state, out = held[0] if held else "NORMAL", []
        for r in rows.sort_values("at").itertuples():
            if r.backlog >= hard:
                state = "HARD"
            elif state in ("HARD", "RECOVERY"):
                state = "NORMAL" if r.backlog <= recovery else "RECOVERY"
            else:
                state = "SOFT" if r.backlog >= soft or state == "SOFT" and r.backlog > recovery else "NORMAL"
            out.append((r.at, state))
        return (state,), pd.DataFrame(out, columns=["at", "state"])

    return _stateful(stream, "tenant_id", "tenant_id long, at long, state string", "state string", step)


#: Groups of keys of a stream whose keys are many and small: a group is one call of Python and one row of state.
GROUPS = 1024


def ack_watermark_stream(stream: DataFrame, groups: int = GROUPS) -> DataFrame:
    """(run_id, partition_key, watermark) whenever changes (run_id, partition_key, sequence_no, state) move a key's acknowledged prefix on.

    Numbers may have gaps: a handoff is known once a change of any state told of it, and the watermark is the highest
    acknowledged number below the first known one that is open. The state holds the open numbers, and the acknowledged
    ones above the first of them; both are bounded by what is out for delivery. Keys are dealt by their hash to `groups`
    groups (fixed for a checkpoint), whose keys are judged together; a batch writes the state of the groups that it meets.
    """
    key = ["run_id", "partition_key"]

    def step(_, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:
        told = pd.concat(list(batches))
        runs, parts, marks, sizes, numbers, done = held.get if held.exists else ([], [], [], [], [], [])
        own = np.repeat(np.arange(len(sizes)), np.array(sizes, dtype="int64"))
        keys = pd.DataFrame({"run_id": pd.concat([pd.Series(runs, dtype="Int64"), told["run_id"].astype("Int64")]), "partition_key": pd.concat([pd.Series(parts, dtype=object), told["partition_key"]])})
        at = keys.groupby(key, sort=False, dropna=False).ngroup().to_numpy()
        keys = keys[~keys.duplicated()]
        marks = np.concatenate([np.array(marks, dtype="int64"), np.full(len(keys) - len(marks), -1)])
        # a number is done once any change said so
        rows = pd.DataFrame({
            "k": np.concatenate([own, at[len(sizes) :]]), "number": np.concatenate([np.array(numbers, dtype="int64"), told["sequence_no"].to_numpy()]),
            "done": np.concatenate([np.array(done, dtype=bool), (told["state"] == "ACKED").to_numpy(dtype=bool)]),
        })
        rows = rows.groupby(["k", "number"], as_index=False)["done"].max()
        first = np.full(len(keys), np.iinfo("int64").max)
        is_open = rows[~rows["done"]].groupby("k")["number"].min()
        first[is_open.index] = is_open
        below = rows[rows["done"] & (rows["number"].to_numpy() < first[rows["k"]])].groupby("k")["number"].max()
        new = marks.copy()
        new[below.index] = np.maximum(marks[below.index], below)
        # in the order of keys; what lies at or below a key's mark is settled
        left = rows[rows["number"].to_numpy() > new[rows["k"]]]
        sizes = np.bincount(left["k"], minlength=len(keys))
        held.update((keys["run_id"].astype(object).where(keys["run_id"].notna(), None).tolist(), keys["partition_key"].tolist(), new.tolist(), sizes.tolist(), left["number"].tolist(), left["done"].tolist()))
        moved = new > marks
        yield keys[moved].assign(watermark=new[moved])

    rows = stream.select(F.pmod(F.xxhash64(*key), F.lit(groups)).cast("int").alias("group"), *key, "sequence_no", "state")
    state = "runs array<long>, parts array<string>, marks array<long>, sizes array<long>, numbers array<long>, done array<boolean>"
    return rows.groupBy("group").applyInPandasWithState(step, "run_id long, partition_key string, watermark long", state, "append", "NoTimeout")


def open_issue_stream(stream: DataFrame) -> DataFrame:
    """(issue_key, event_id) of the events (issue_key, event_id, action) that open an issue: OPEN while none is open; CLOSE lets it open again."""

    def step(held, rows):
        is_open, out = bool(held[0]) if held else False, []
        for r in rows.sort_values("event_id").itertuples():
            if r.action == "OPEN" and not is_open:
                out.append(r.event_id)
            is_open = r.action == "OPEN"
        return (is_open,), pd.DataFrame({"event_id": out})

    return _stateful(stream, "issue_key", "issue_key string, event_id long", "is_open boolean", step)


def publish_late_safe(batch: DataFrame, published: DataFrame) -> DataFrame:
    """Rows of a micro-batch that are not published yet, with the next revisions of their tenants: late ones get a later revision."""
    from ..operators.incidents import allocate_revisions

    clock = published.groupBy("tenant_id").agg(F.max("revision").alias("last_revision"))
    return allocate_revisions(batch.join(published.select("transition_id"), "transition_id", "left_anti"), clock)


def stage_batches(stream: DataFrame, target: str, checkpoint: str):
    """A query that appends new handoffs (idempotency_key, payload) to a folder of Parquet once each, batch by batch; a batch reads the buckets of its own keys."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)

    def run(batch: DataFrame, epoch: int) -> None:
        staged = outbox.stage_handoffs(batch, buckets.held_rows(batch, target, schema, "idempotency_key"))
        buckets.append(staged.where("outcome = 'INSERT'").select(*batch.columns), target, "idempotency_key")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What takes the rows of a micro-batch: the frame and the batch's number. A sink must take a batch that it has had before as done.
Sink = Callable[[DataFrame, int], None]


def parquet_sink(path: str) -> Sink:
    """A sink that writes each batch to a folder of its own, so that a batch that is run again replaces itself."""
    return lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def receipt_port(deliver: Callable[[DataFrame], DataFrame], handoffs: DataFrame, now) -> DataFrame:
    """handoffs after delivery: deliver gives receipts(handoff_id, durable, receipt_ref), which apply_receipts() judges."""
    return outbox.apply_receipts(handoffs, deliver(handoffs), now)


def stream_pipeline(stream: DataFrame, cfg, sinks: dict[str, Sink], checkpoint: str):
    """A query that runs the record pipeline on each micro-batch and gives zones, lineage, handoffs, attempts, quarantine and issues to their sinks.

    The query's checkpoint is where a restart goes on; what was acknowledged downstream is another matter, see ack_watermark_stream().
    """
    from ..operators.pipeline import process

    def run(batch: DataFrame, number: int) -> None:
        held = []
        outcomes = process(batch, cfg, lambda df: held.append(df.persist()) or held[0])
        for name, sink in sinks.items():
            sink(getattr(outcomes, name), number)
        held[0].unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
