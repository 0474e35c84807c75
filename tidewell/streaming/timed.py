"""Streams with several state variables, timers and state that ends: circuits with their probes, incident versions, delivery leases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .jobs import GROUPS

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400


def with_state_store(spark: SparkSession) -> None:
    """State variables and timers need this state store; it holds for queries that start later in the session."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


CIRCUIT = "source_id long, at long, event_id long, action string, status string, failures int, attempts int, retry_at long, open_until long"


class _Circuit(StatefulProcessor):
    """circuits: the sources of a group, each with its failures in a row, the retry window's beginning and attempts, the last outcome's time, and the times of the next retry and of the probe; timer: the earliest probe or end."""

    def __init__(self, window: int, most: int, pause: int, idle: int):
        self.window, self.most, self.pause, self.idle = window, most, pause, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.circuits = handle.getValueState("circuits", "sources array<long>, failures array<int>, began array<long>, attempts array<int>, at array<long>, status array<string>, retry_at array<long>, open_until array<long>, timer long")

    def _held(self) -> tuple[dict, int]:
        if not self.circuits.exists():
            return {}, 0
        sources, *columns, timer = self.circuits.get()
        return dict(zip(sources, zip(*columns, strict=True), strict=True)), timer

    def _due(self, circuit: tuple) -> int:
        return 1000 * (circuit[6] or circuit[3] + self.idle)

    def _keep(self, held: dict, timer: int) -> None:
        first = min(map(self._due, held.values()), default=0)
        if timer and timer != first:
            self.handle.deleteTimer(timer)
        if first and timer != first:
            self.handle.registerTimer(first)
        columns = zip(*held.values(), strict=True) if held else ((),) * 7
        self.circuits.update((list(held), *map(list, columns), first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, timer = self._held()
        out = []
        told = pd.concat(list(rows)).sort_values(["at_seconds", "event_id"])
        told = told.assign(source_id=told["source_id"].astype(object).where(told["source_id"].notna(), None))
        for r in told.itertuples():
            source, at = None if r.source_id is None else int(r.source_id), int(r.at_seconds)
            failures, began, attempts, _, status, retry, until = held.get(source, (0, -1, 0, -1, "HEALTHY", 0, 0))
            if until and at >= until:  # its timer would have fired before this outcome
                out.append((source, until, None, "PROBE", "PROBING", failures, attempts, retry, 0))
                until = 0
            if r.outcome == "SUCCESS":
                failures, began, attempts, status, retry, until = 0, -1, 0, "HEALTHY", 0, 0
            elif r.outcome == "TRANSIENT":
                fresh = began < 0 or at - began >= self.window
                began, attempts, failures = (at, 1, failures + 1) if fresh else (began, attempts + 1, failures + 1)
                asked = 0 if pd.isna(r.retry_after) else int(r.retry_after)
                retry = at + max(min(900, 5 * 2 ** min(attempts - 1, 7)), asked)
                status, until = ("PAUSED", at + self.pause) if attempts >= self.most else ("DEGRADED", 0)
            else:
                failures, status, retry, until = 0, "DEGRADED", 0, 0
            out.append((source, at, int(r.event_id), "OUTCOME", status, failures, attempts, retry, until))
            held[source] = (failures, began, attempts, at, status, retry, until)
        self._keep(held, timer)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._held()
        out = []
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        for source, circuit in list(held.items()):
            if self._due(circuit) > now:
                continue
            failures, began, attempts, _, _, retry, until = circuit
            if until:
                held[source] = (failures, began, attempts, until, "PROBING", retry, 0)
                out.append((source, until, None, "PROBE", "PROBING", failures, attempts, retry, 0))
            else:
                del held[source]
        self._keep(held, 0)  # this timer is gone
        yield self._frame(out)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held, timer = self._held()
        for r in initialState.itertuples():
            held[int(r.source_id)] = (int(r.failures), int(r.began), int(r.attempts), int(r.at_seconds), r.status, int(r.retry_at), int(r.open_until))
        self._keep(held, timer)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(out) -> pd.DataFrame:
        names = ["source_id", "at", "event_id", "action", "status", "failures", "attempts", "retry_at", "open_until"]
        return pd.DataFrame(out, columns=names).astype({"source_id": "Int64", "event_id": "Int64"})


def circuit_breaker(stream: DataFrame, window: int = 900, most: int = 5, pause: int = 900, idle: int = 30 * DAY, initial: DataFrame | None = None, groups: int = GROUPS // 8) -> DataFrame:
    """CIRCUIT of outcomes (source_id, event_id, at_seconds, outcome, retry_after): a row after each outcome, and one PROBE when a paused source's time is up.

    The same rules as operators.health.circuit_states(). A timer on the watermark of at_seconds lets one probe go
    `pause` seconds after the source was paused, unless an outcome came before; what follows is an outcome like others.
    A source without outcomes for `idle` seconds is forgotten. initial: what circuit_states() gave for the history,
    with at_seconds, the time of each source's last outcome. Sources are dealt by their hash to `groups` groups (fixed
    for a checkpoint) with a row of state and a timer each.
    """
    with_state_store(stream.sparkSession)
    rows = stream if "retry_after" in stream.columns else stream.withColumn("retry_after", F.lit(None).cast("long"))
    group = F.pmod(F.xxhash64(F.col("source_id").cast("long")), F.lit(groups)).cast("int").alias("group")
    rows = rows.select(group, "source_id", "event_id", "at_seconds", "outcome", F.col("retry_after").cast("long").alias("retry_after"), F.timestamp_seconds("at_seconds").alias("seen_at")).withWatermark("seen_at", "0 seconds")
    start = None if initial is None else initial.select(group, "*").groupBy("group")
    return rows.groupBy("group").transformWithStateInPandas(_Circuit(window, most, pause, idle), CIRCUIT, "append", "eventTime", initialState=start)


VERSION = "issue_id long, transition_id long, version long, last_updated long"


class _Versions(StatefulProcessor):
    """version counts real changes; row is the last one; newest is the latest time that the issue's changes have shown."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.version = handle.getValueState("version", "version long", self.keep_ms)
        self.row = handle.getValueState("row", "severity string, lifecycle string", self.keep_ms)
        self.newest = handle.getValueState("newest", "at long", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        version = self.version.get()[0] if self.version.exists() else 0
        held = tuple(self.row.get()) if self.row.exists() else None
        newest = self.newest.get()[0] if self.newest.exists() else None
        out = []
        for r in pd.concat(list(rows)).sort_values("transition_id").itertuples():
            if not pd.isna(r.at):
                newest = int(r.at) if newest is None else max(newest, int(r.at))
            now = tuple(None if pd.isna(x) else x for x in (r.severity, r.lifecycle))
            if now != held:
                version, held = version + 1, now
                out.append((key[0], int(r.transition_id), version, newest))
        self.version.update((int(version),))
        self.row.update(held)
        if newest is not None:
            self.newest.update((int(newest),))
        yield pd.DataFrame(out, columns=["issue_id", "transition_id", "version", "last_updated"]).astype({"last_updated": "Int64"})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        r = initialState.iloc[0]
        self.version.update((int(r.version),))
        self.row.update((r.severity, r.lifecycle))
        self.newest.update((int(r.last_updated),))

    def close(self) -> None:
        pass


def incident_versioning(stream: DataFrame, keep_days: int = 400, initial: DataFrame | None = None) -> DataFrame:
    """VERSION of changes (issue_id, transition_id, severity, lifecycle, at in microseconds) that really change something; last_updated never falls.

    An issue's state ends `keep_days` after its last change. initial: (issue_id, version, severity, lifecycle,
    last_updated) of the issues that a table holds already.
    """
    with_state_store(stream.sparkSession)
    start = None if initial is None else initial.groupBy("issue_id")
    return stream.groupBy("issue_id").transformWithStateInPandas(_Versions(keep_days * DAY * 1000), VERSION, "append", "processingTime", initialState=start)


LEASE = "handoff_id string, attempt long, lease_until timestamp"


class _Leases(StatefulProcessor):
    """leases: the handoffs of a group, with the latest attempt that a change told of and when its lease ends, 0 while it is not out for delivery; timer: the earliest end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.leases = handle.getValueState("leases", "handoffs array<string>, attempts array<long>, until_us array<long>, timer long")

    def _held(self) -> tuple[pd.DataFrame, int]:
        handoffs, attempts, until, timer = self.leases.get() if self.leases.exists() else ([], [], [], 0)
        return pd.DataFrame({"handoff_id": pd.Series(handoffs, dtype=object), "attempt": np.array(attempts, dtype="int64"), "until_us": np.array(until, dtype="int64")}), timer

    def _keep(self, leases: pd.DataFrame, timer: int) -> None:
        out = leases["until_us"][leases["until_us"] > 0]
        first = int(out.min()) // 1000 if len(out) else 0
        if timer and timer != first:
            self.handle.deleteTimer(timer)
        if first and timer != first:
            self.handle.registerTimer(first)
        self.leases.update((leases["handoff_id"].tolist(), leases["attempt"].tolist(), leases["until_us"].tolist(), first))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, timer = self._held()
        told = pd.concat(list(rows))
        until = told["until_us"].astype("Int64").where(told["state"] == "DELIVERING").fillna(0).astype("int64")
        told = pd.DataFrame({"handoff_id": told["handoff_id"], "attempt": told["attempt"].astype("int64"), "until_us": until})
        # the last change of the latest attempt counts; one that a later attempt has overtaken does not
        both = pd.concat([held, told], ignore_index=True).sort_values("attempt", kind="stable")
        self._keep(both.drop_duplicates("handoff_id", keep="last"), timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self._held()
        due = (held["until_us"] > 0) & (held["until_us"] // 1000 <= max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()))
        self._keep(held.assign(until_us=held["until_us"].where(~due, 0)), 0)  # this timer is gone
        out = held[due]
        yield pd.DataFrame({"handoff_id": out["handoff_id"], "attempt": out["attempt"], "lease_until": out["until_us"].astype("datetime64[us]")})

    def close(self) -> None:
        pass


def lease_expiry(stream: DataFrame, groups: int = GROUPS) -> DataFrame:
    """LEASE of changes (handoff_id, attempt, state, lease_until): a row when a delivery's lease has run out by the clock, and no change of the same or a later attempt came.

    The handoff may then be claimed again. The state holds one lease a handoff, and its last attempt. Handoffs are dealt
    by their hash to `groups` groups (fixed for a checkpoint) with a row of state and a timer each.
    """
    with_state_store(stream.sparkSession)
    group = F.pmod(F.xxhash64("handoff_id"), F.lit(groups)).cast("int").alias("group")
    rows = stream.select(group, "handoff_id", "attempt", "state", F.unix_micros(F.col("lease_until").cast("timestamp")).alias("until_us"))
    return rows.groupBy("group").transformWithStateInPandas(_Leases(), LEASE, "append", "processingTime")
