"""Liveness with timers, for silence that no later heartbeat reveals.

``closed_sessions`` in ``runlake.streaming.jobs`` does the same with built-in
operators and is the form to use while heartbeats of any run keep arriving. Here
each owner's timer fires by itself, in event time or on the clock.
"""

import datetime as dt

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from runlake.streaming.batches import state_store

OWNER = ("run_id", "worker_id", "attempt")


class SilenceTimer(StatefulProcessor):
    """Keeps one owner's last heartbeat and one timer; emits the owner when the timer fires."""

    def __init__(self, keys, stale_after: int, by_clock: bool):
        self.keys, self.stale_ms, self.by_clock = tuple(keys), stale_after * 1000, by_clock

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at_us bigint, due_ms bigint")

    def handleInputRows(self, key, rows, timerValues):
        known = self.last.get()
        newest = known[0] if known else None
        # Heartbeats within a slot as wide as the limit hide no silence: only the ends of slots are kept and put in order.
        slots, width = {}, self.stale_ms * 1000
        for row in rows:
            us = row["_us"]
            low, high = slots.get(us // width, (us, us))
            slots[us // width] = min(low, us), max(high, us)
        for _, (low, high) in sorted(slots.items()):
            if newest is not None and not self.by_clock and low - newest > width:
                yield self.report(key, newest)  # the silence ended before its timer came up
            newest = high if newest is None else max(newest, high)
        if newest is None:
            return
        if known and known[0] == newest:
            return
        if known:
            self.handle.deleteTimer(known[1])
        # A gap equal to the limit is still alive, so the timer waits for the next millisecond.
        start_ms = timerValues.getCurrentProcessingTimeInMs() if self.by_clock else newest // 1000
        due = start_ms + self.stale_ms + 1
        self.last.update((newest, due))
        self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last = self.last.get()[0]
        self.last.clear()
        yield self.report(key, last)

    def report(self, key, us: int) -> Row:
        at = dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=us)
        return Row(**dict(zip(self.keys, key)), last_heartbeat=at, reap_at=at + dt.timedelta(milliseconds=self.stale_ms))

    def close(self) -> None:
        pass


def stale_owners(heartbeats: DataFrame, stale_after: int, lateness: str | None = None, keys=OWNER) -> DataFrame:
    """Stream of (keys, last_heartbeat, reap_at) of owners silent for longer than ``stale_after`` seconds.

    With ``lateness`` the timers follow event time (column ``ts``), otherwise the clock. Heartbeats without a time say
    nothing. State is one small row per owner, and within a batch an owner is held as one pair of times for every
    ``stale_after`` seconds, so one with most heartbeats costs its task arrivals, not memory.
    """
    state_store(heartbeats.sparkSession)
    kinds = dict(heartbeats.dtypes)
    df = heartbeats.filter("ts IS NOT NULL").select(*keys, "ts", F.unix_micros("ts").alias("_us"))
    if lateness:
        df = df.withWatermark("ts", lateness)
    return df.groupBy(*keys).transformWithState(
        SilenceTimer(keys, stale_after, by_clock=not lateness),
        ", ".join(f"{k} {kinds[k]}" for k in keys) + ", last_heartbeat timestamp, reap_at timestamp", "Append",
        "EventTime" if lateness else "ProcessingTime")
