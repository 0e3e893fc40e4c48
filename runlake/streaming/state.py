"""Runs as keyed state, with timers that act when nothing arrives.

Runs are rows in the state store, in groups, put there from the start table before the first batch and
never read from it again; a batch reads and writes the groups of the runs that it names or that fall due. Events are folded under the same guards as ``state_fold``. With
``timers`` two things happen by themselves: a RUNNING run whose last heartbeat is more than ``stale_after`` old
is requeued, or failed where its retries are used up, and a retry whose backoff is over is queued afresh. Both
take effect at the moment they fall due, before any later event, so the result does not depend on
how the input is cut into batches as long as events come in order.
"""

import json
from collections import namedtuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from runlake.config import DEFAULT_POLICY, Policy
from runlake.operators.lookup import with_job
from runlake.schema import FAILED, QUEUED, RUNNING, RUNS, SUCCEEDED
from runlake.streaming.batches import state_store
from runlake.streaming.groups import GROUPS, as_json, by_key, framed, group_of, loads, unframed

TIMES = [c for c, kind in RUNS.items() if kind == "timestamp"]
# A run in the state store: times in microseconds, its job's retries, event counts.
FIELDS = {c: "bigint" if c in TIMES else kind for c, kind in RUNS.items() if c != "id"} | {
    "max_retries": "int", "accepted": "bigint", "rejected": "bigint"}
OUTPUT = [c for c in FIELDS if c != "max_retries"]
ORDER = ("at_us", "tiebreak", "kind", "worker_id", "attempt", "message")
Event = namedtuple("Event", ORDER)
SECOND = 1_000_000


def apply_event(s: dict, e: Event, policy: Policy) -> bool:
    """Change the run ``s`` as the event says if its guard holds."""
    own = s["status"] == RUNNING and e.worker_id is not None and s["worker_id"] == e.worker_id and s["attempt"] == e.attempt
    if e.kind == "claim" and s["status"] == QUEUED and (s["next_attempt_at"] is None or s["next_attempt_at"] <= e.at_us):
        s.update(status=RUNNING, worker_id=e.worker_id, started_at=e.at_us, last_heartbeat_at=e.at_us, finished_at=None, next_attempt_at=None)
    elif e.kind == "heartbeat" and own:
        s["last_heartbeat_at"] = e.at_us
    elif e.kind == "finish" and own:
        s.update(status=SUCCEEDED, output=e.message, error=None, finished_at=e.at_us)
    elif e.kind == "release" and own:
        requeue(s, e.at_us, e.message)
    elif e.kind == "fail" and own and s["max_retries"] is not None:
        if s["attempt"] > s["max_retries"]:
            s.update(status=FAILED, finished_at=e.at_us, next_attempt_at=None, error=e.message)
        else:
            wait = min(policy.retry_base * 2 ** min(s["attempt"] - 1, 30), policy.retry_cap)
            requeue(s, e.at_us, e.message)
            s.update(finished_at=None, next_attempt_at=e.at_us + wait * SECOND)
    elif e.kind == "fail_queued" and s["status"] == QUEUED:
        s.update(status=FAILED, finished_at=e.at_us, error=e.message)
    else:
        return False
    return True


def requeue(s: dict, at_us: int, error: str | None) -> None:
    s.update(status=QUEUED, attempt=s["attempt"] + 1, worker_id=None, queued_at=at_us, started_at=None, last_heartbeat_at=None, error=error)


def due(s: dict, policy: Policy) -> int | None:
    """The microsecond at which the run changes by itself, if it does."""
    if s["max_retries"] is None:
        return None
    if s["status"] == RUNNING and s["last_heartbeat_at"] is not None:
        return s["last_heartbeat_at"] + policy.stale_after * SECOND + 1  # a gap equal to the limit is alive
    return s["next_attempt_at"] if s["status"] == QUEUED else None


def pass_time(s: dict, until_us: int, policy: Policy) -> bool:
    """Let everything happen that falls due up to ``until_us``."""
    changed = False
    while (at := due(s, policy)) is not None and at <= until_us:
        changed = True
        if s["status"] == QUEUED:
            s.update(next_attempt_at=None, queued_at=at)
            continue
        lost = f"attempt {s['attempt']} lost worker {s['worker_id'] or ''}"
        if s["attempt"] > s["max_retries"]:
            s.update(status=FAILED, finished_at=at, error=lost)
        else:
            requeue(s, at, lost)
            s["finished_at"] = None
    return changed


class GroupKeeper(StatefulProcessor):
    """A group of runs: their rows, and a timer for the next moment at which one of them changes by itself."""

    def __init__(self, policy: Policy, timers: bool):
        self.policy, self.timers = policy, timers

    def init(self, handle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "runs string, timer_ms bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.keep({r["run_id"]: {c: r[c] for c in FIELDS} for text in initialState["runs"] for r in loads(text)}, None)

    def handleInputRows(self, key, rows, timerValues):
        arrived = by_key(rows, "run_id")
        runs, timer_ms = self.known()
        touched = [run_id for run_id in arrived if run_id in runs]
        for run_id in touched:
            s = runs[run_id]
            events = [Event(*[r[c] for c in ORDER]) for r in arrived[run_id]]
            for e in sorted(events, key=lambda e: [(x is not None, x) for x in e]):
                if self.timers and e.at_us is not None:
                    pass_time(s, e.at_us, self.policy)
                s["accepted" if apply_event(s, e, self.policy) else "rejected"] += 1
        if touched:
            self.keep(runs, timer_ms)
        yield from self.rows(runs, touched)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        runs, _ = self.known()
        now = timerValues.getCurrentWatermarkInMs() * 1000
        changed = [run_id for run_id, s in runs.items() if pass_time(s, now, self.policy)]
        self.keep(runs, None)
        yield from self.rows(runs, changed)

    def known(self) -> tuple[dict, int | None]:
        text, timer_ms = self.runs.get() or ("[]", None)
        return {run_id: dict(zip(FIELDS, values)) for run_id, values in loads(text)}, timer_ms

    def keep(self, runs: dict, timer_ms: int | None) -> None:
        """Store the runs; ``timer_ms`` is the timer that is armed."""
        if self.timers:
            at = min((at for s in runs.values() if (at := due(s, self.policy)) is not None), default=None)
            # The first millisecond at which it is due: Spark drops a timer that is set again for the moment it fires.
            ms = None if at is None else max(-(-at // 1000), 0)
            if ms != timer_ms:
                if timer_ms is not None:
                    self.handle.deleteTimer(timer_ms)
                if ms is not None:
                    self.handle.registerTimer(ms)
                timer_ms = ms
        self.runs.update((json.dumps([(run_id, list(s.values())) for run_id, s in runs.items()]), timer_ms))

    def rows(self, runs: dict, ids: list):
        return framed(((run_id, *[runs[run_id][c] for c in OUTPUT]) for run_id in ids), ["id", *OUTPUT])

    def close(self) -> None:
        pass


def _micros(df: DataFrame) -> list[Column]:
    return [F.unix_micros(c).alias(c) if c in TIMES else F.col(c).cast(kind).alias(c) for c, kind in FIELDS.items()]


def kept_runs(events: DataFrame, runs: DataFrame, jobs: DataFrame, lateness: str, policy: Policy = DEFAULT_POLICY,
              timers: bool = True, groups: int = GROUPS) -> DataFrame:
    """Stream of the runs that each batch of ``events`` or a timer changes: the columns of runs, ``accepted``, ``rejected``.

    ``runs`` is the table before the first event. Timers follow the time of the events, ``lateness`` behind the latest.
    """
    state_store(events.sparkSession)
    zero = F.lit(0).cast("bigint")
    start = with_job(runs, jobs, "left").withColumn("accepted", zero).withColumn("rejected", zero)
    start = start.select(F.col("id").cast("string").alias("run_id"), *_micros(start)).select(group_of("run_id", groups), F.struct("run_id", *FIELDS).alias("run"))
    start = start.groupBy("group").agg(F.to_json(F.collect_list("run"), {"ignoreNullFields": "false"}).alias("runs")).groupBy("group")
    for name in ("tiebreak", "message"):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("string"))
    # JSON would cut a time to milliseconds.
    tiebreak = F.unix_micros("tiebreak") if dict(events.dtypes)["tiebreak"] == "timestamp" else F.col("tiebreak")
    columns = F.col("run_id").cast("string").alias("run_id"), F.unix_micros("at").alias("at_us"), tiebreak.alias("tiebreak"), *map(F.col, ORDER[2:])
    rows = events.withWatermark("at", lateness).select("at", F.col("run_id").cast("string").alias("run_id"), as_json(*columns).alias("row"))
    rows = rows.select("at", group_of("run_id", groups), "row")
    kinds = "id string, " + ", ".join(f"{c} {FIELDS[c]}" for c in OUTPUT)
    changed = unframed(rows.groupBy("group").transformWithStateInPandas(
        GroupKeeper(policy, timers), "row string", "Update", "EventTime", initialState=start), kinds)
    ids = dict(runs.dtypes)
    return changed.select(*[F.timestamp_micros(c).alias(c) if c in TIMES else F.col(c).cast(ids[c]).alias(c) if c in ("id", "job_id") else F.col(c)
                            for c in RUNS], "accepted", "rejected")
