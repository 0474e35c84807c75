"""Source health and back-pressure as states after a history, and the classes of responses."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import retry_after_seconds


def classify_response(df: DataFrame, most_bytes: int, now: Column | None = None) -> DataFrame:
    """df(status, body_bytes, retry_after) with error_class and, for 429, the seconds that Retry-After gives: a number, or a date less `now`."""
    s = F.col("status")
    kind = (
        F.when(F.col("body_bytes") > most_bytes, "DATA").when(s.between(200, 299), "OK").when((s == 429) | (s == 408) | (s >= 500), "TRANSIENT")
        .when(s.isin(401, 403), "AUTH_ROUTE").otherwise("CONFIGURATION")
    )
    seconds = F.when(s == 429, retry_after_seconds(F.col("retry_after"), F.current_timestamp() if now is None else now))
    return df.withColumn("error_class", kind).withColumn("retry_after_seconds", seconds)


def pressure_states(backlog: DataFrame, soft: int = 1000, hard: int = 5000, recovery: int = 500) -> DataFrame:
    """(tenant_id, state): hysteresis over (tenant_id, at, backlog), after each tenant's last measurement. Rows without a backlog are no measurements.

    HARD from `hard` on, SOFT from `soft` on; HARD or RECOVERY goes to RECOVERY until `recovery` is reached, then NORMAL.

    As recovery < soft < hard, a measurement from `hard` on or down to `recovery` leads to one state from wherever it is;
    between them the state goes from HARD to RECOVERY, and from NORMAL to SOFT only by a measurement from `soft` on. So
    the last of each kind decide, and these are maxima that partial aggregation takes in any order.
    """
    if not recovery < soft < hard:
        raise ValueError("ING_PRESSURE_POLICY_INVALID")
    b, at = F.col("backlog"), F.struct("at", "backlog")
    lasts = backlog.where("backlog is not null").groupBy("tenant_id").agg(
        F.max(at).alias("end"), F.max(F.when((b >= hard) | (b <= recovery), at)).alias("reset"), F.max(F.when((b >= soft) & (b < hard), at)).alias("raised"))
    high = F.coalesce(F.col("reset.backlog") >= hard, F.lit(False))
    later = F.col("raised").isNotNull() & (F.col("reset").isNull() | (F.col("raised") > F.col("reset")))
    state = F.when(high, F.when(F.col("end") == F.col("reset"), "HARD").otherwise("RECOVERY")).when(later, "SOFT").otherwise("NORMAL")
    return lasts.select("tenant_id", state.alias("state"))


def window_chain(times: np.ndarray, counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For ascending times: the beginning of the last window, and the count since then, if a first window begins at each of them. A window begins at the first time that is `window` past the last beginning."""
    n = len(times)
    after = np.searchsorted(times, times + window)
    last = np.arange(n)
    jump = np.where(after < n, after, last)
    while (jump != last).any():
        last, jump = jump, jump[jump]
    return times[last], np.cumsum(counts[::-1])[::-1][last]


def _segments(batches: Iterator[pa.RecordBatch], key: str, window: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of one key among rows (key, at_seconds, n) in order, each as what it does to a window that is open before it.

    The window's beginning tells the first time here that begins another one, and that lies at most `window` after the
    first time, so that a run is as many entries at most, however many rows it has.
    """

    def told(k, t, n):
        began, count = window_chain(t, n, window)
        # all times up to the first one that surely begins a window; of entries with the same end the last stands for all
        use = min(len(t), int(np.searchsorted(t, t[0] + window)) + 1)
        keep = np.flatnonzero(np.append(began[1:use] != began[: use - 1], True))
        entry = [pa.array([x[:use][keep].tolist()], pa.list_(pa.int64())) for x in (t, began, count)]
        return pa.RecordBatch.from_arrays([pa.array([k], types[0]), pa.array([int(t[0])]), pa.array([int(t[-1])]), pa.array([int(n.sum())]), *entry], [key, "first", "last", "total", "times", "began", "counts"])

    now, held, types, size = None, [], [None], 0
    for b in batches:
        types[0] = b.schema.field(0).type
        keys, t, n = b.column(0).to_pylist(), b.column(1).to_numpy(), b.column(2).to_numpy()
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if i == j:
                continue
            if held and (keys[i] != now or size >= most):
                yield told(now, *(np.concatenate(x) for x in zip(*held, strict=True)))
                held, size = [], 0
            now = keys[i]
            held.append((t[i:j], n[i:j]))
            size += j - i
    if held:
        yield told(now, *(np.concatenate(x) for x in zip(*held, strict=True)))


def _chained(batches: Iterator[pa.RecordBatch], key: str, window: int) -> Iterator[pa.RecordBatch]:
    """The window that each key ends in, from its runs in order; of a key only the open window is held."""
    now, began, count, done = None, -1, 0, []
    for b in batches:
        kind = b.schema.field(0).type
        for r in b.to_pylist():
            if now is not None and r[key] != now[0]:
                done.append((now[0], began, count))
            if now is None or r[key] != now[0]:
                now, began, count = (r[key],), -1, 0
            due = r["first"] if began < 0 else began + window
            i = bisect_left(r["times"], due)
            if i < len(r["times"]):
                began, count = r["began"][i], r["counts"][i]
            else:
                count += r["total"]
    if now is not None:
        done.append((now[0], began, count))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], [key, "began", "attempts"])


def retry_windows(failures: DataFrame, key: str, window: int) -> DataFrame:
    """(key, began, attempts): the window that each key's last failure (key, at_seconds) lies in, and the failures in it. Windows run `window` seconds from their first failure.

    Failures of one second are one row; rows are dealt by ranges of key and time, so that a key with most rows fills
    several partitions, each run of a key is summed up where it lies, and only the summaries meet.
    """
    kind = failures.schema[key].dataType.simpleString()
    each = failures.groupBy(key, F.col("at_seconds").cast("long").alias("at_seconds")).agg(F.count("*").alias("n"))
    laid = each.repartitionByRange(key, "at_seconds").sortWithinPartitions(key, "at_seconds")
    runs = laid.mapInArrow(lambda it: _segments(it, key, window), f"`{key}` {kind}, first long, last long, total long, times array<long>, began array<long>, counts array<long>")
    return runs.repartition(key).sortWithinPartitions(key, "first").mapInArrow(lambda it: _chained(it, key, window), f"`{key}` {kind}, began long, attempts long")


def circuit_states(log: DataFrame, window: int = 900, most: int = 5, pause: int = 900) -> DataFrame:
    """Per source the state after its outcomes (source_id, at_seconds, event_id, outcome; retry_after in seconds, if any) in order: status, failures, retry attempts in the window, gates.

    A transient failure counts up; the window runs `window` seconds from its first failure, the delay doubles from 5
    seconds to 900 at most; from `most` failures in the window on the source pauses. Another failure degrades it and clears the
    gates but not the window; a success clears all, so that only what came after a source's last one counts. A retry
    waits at least as long as the source asked for. Rows without source_id or time are left out; an outcome that is null
    is another failure.

    The last row, the last success and the last other failure of a source are maxima, the failures since then a count,
    and the window comes from retry_windows(); no source's rows are gathered.
    """
    log = log if "retry_after" in log.columns else log.withColumn("retry_after", F.lit(None).cast("long"))
    log = log.where("source_id is not null and at_seconds is not null").select("source_id", "at_seconds", "event_id", "outcome", F.col("retry_after").cast("long").alias("retry_after"))
    at = F.struct("at_seconds", "event_id")
    is_ = lambda kind: F.coalesce(F.col("outcome") == kind, F.lit(False))
    marks = log.groupBy("source_id").agg(
        F.max(F.struct("at_seconds", "event_id", "outcome", "retry_after")).alias("end"), F.max(F.when(is_("SUCCESS"), at)).alias("success"), F.max(F.when(~is_("SUCCESS") & ~is_("TRANSIENT"), at)).alias("other"))
    past = lambda mark: F.col(mark).isNull() | (at > F.col(mark))
    since = log.where(is_("TRANSIENT")).join(marks.select("source_id", "success", "other"), "source_id").where(past("success"))
    failures = since.where(past("other")).groupBy("source_id").agg(F.count("*").cast("int").alias("failures"))
    out = marks.join(retry_windows(since, "source_id", window), "source_id", "left").join(failures, "source_id", "left")
    zero, t = F.lit(0), F.col("end.at_seconds")
    failing = F.coalesce(F.col("end.outcome") == "TRANSIENT", F.lit(False))
    failures, attempts = (F.when(failing, F.coalesce("failures", zero)).otherwise(zero), F.coalesce(F.col("attempts").cast("int"), zero))
    delay = F.least(F.lit(900), F.lit(5) * F.pow(F.lit(2), F.least(attempts - 1, F.lit(7))).cast("int"))
    delay = F.greatest(delay, F.coalesce("end.retry_after", zero))
    paused = failing & (attempts >= most)
    status = F.when(F.coalesce(F.col("end.outcome") == "SUCCESS", F.lit(False)), "HEALTHY").when(paused, "PAUSED").otherwise("DEGRADED")
    return out.select(
        "source_id", status.alias("status"), failures.alias("failures"), F.coalesce("began", F.lit(-1).cast("long")).alias("began"), attempts.alias("attempts"),
        F.when(failing, t + delay).otherwise(zero).cast("long").alias("retry_at"), F.when(paused, t + pause).otherwise(zero).cast("long").alias("open_until"))
