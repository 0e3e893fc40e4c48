"""Log events as their lines arrive, from a cursor per run.

The state of a run is small: how far it is known to be, up to which attempt its markers are out,
whether its ``end`` is, and which lines have been seen, as ranges of ``seq`` by attempt (one range where
lines come in order). Nothing that was stored or sent is read again, so a batch costs what arrives in it,
however old the stream or hot the run. Lines of an attempt that the run is not yet known to have reached wait in
the state; an ``end`` waits until the lines of its own batch are out. Runs are kept in groups, as
Python is called for each group: a batch reads and writes the cursors of the groups that it names, not one by one.
"""

import json
from bisect import bisect_right

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from runlake.operators.events import END, LINE, MARKER, event_json
from runlake.schema import FINAL_STATUSES, LOGS, RUNS
from runlake.streaming.batches import schema_of, state_store
from runlake.streaming.groups import GROUPS, as_json, by_key, framed, group_of, loads, unframed

CURSOR = "attempt int, status string, error string, ended boolean, waiting bigint, seen array<array<bigint>>"
ROW = "run_id {}, attempt int, kind int, seq bigint, ts bigint, level string, line string, status string, error string"
COLUMNS = [field.split()[0] for field in ROW.split(", ")]


def tail_input(runs: DataFrame, lines: DataFrame) -> DataFrame:
    """One stream of changed runs and of new log lines, for ``tail``."""
    run, line = (F.struct(*[F.col(c) for c in columns]) for columns in (RUNS, LOGS))
    run_type, line_type = (f"struct<{schema_of(df.select(*columns)).replace('` ', '`:')}>"
                           for df, columns in ((runs, RUNS), (lines, LOGS)))
    return runs.select(run.alias("run"), F.lit(None).cast(line_type).alias("line")).unionByName(
        lines.select(F.lit(None).cast(run_type).alias("run"), line.alias("line")))


def add_seen(ranges: list[int], seq: int) -> bool:
    """Add ``seq`` to flat, sorted, disjoint ranges [low, high, low, high ...]; False if it is in one."""
    at = bisect_right(ranges, seq)
    if at % 2 or at and ranges[at - 1] == seq:
        return False
    before, after = at > 0 and ranges[at - 1] == seq - 1, at < len(ranges) and ranges[at] == seq + 1
    if before and after:
        del ranges[at - 1:at + 1]
    elif before:
        ranges[at - 1] = seq
    elif after:
        ranges[at] = seq
    else:
        ranges[at:at] = [seq, seq]
    return True


class TailKeeper(StatefulProcessor):
    """One run's cursor, and the lines that wait for their attempt."""

    def init(self, handle) -> None:
        self.cursor = handle.getValueState("cursor", CURSOR)
        self.waiting = handle.getMapState("waiting", "attempt int, seq bigint", "ts timestamp, level string, line string")

    def handleInputRows(self, key, rows, timerValues):
        attempt, status, error, ended, waiting, seen = self.cursor.get() or (0, None, None, False, 0, [])
        seen = {of: list(ranges) for of, *ranges in seen}
        shown, lines = attempt, {}
        for r in rows:
            if r["is_run"]:
                # A run's row counts if none is further on; of one attempt the final status does.
                if r["attempt"] is not None and (r["attempt"], r["status"] in FINAL_STATUSES) >= (attempt, status in FINAL_STATUSES):
                    attempt, status, error = r["attempt"], r["status"], r["error"]
            elif r["attempt"] is not None and r["seq"] is not None:
                place, line = (r["attempt"], r["seq"]), (r["ts"], r["line"], r["level"])
                if place not in lines or _first(line) < _first(lines[place]):
                    lines[place] = line

        def event(of, kind, seq=0, ts=None, level=None, line=None):
            return Row(run_id=key[0], attempt=of, kind=kind, seq=seq, ts=ts, level=level, line=line,
                       status=status if kind == END else None, error=error if kind == END else None)
        for of in range(max(shown + 1, 1), attempt + 1):
            yield event(of, MARKER)
        if waiting and attempt > shown:
            due = [(place, line) for place, line in self.waiting.iterator() if place[0] <= attempt]
            for (of, seq), line in due:
                self.waiting.removeKey((of, seq))
                yield event(of, LINE, seq, *line)
            waiting -= len(due)
        for (of, seq), (ts, text, level) in sorted(lines.items()):
            if of < 1 or not add_seen(seen.setdefault(of, []), seq):
                continue
            if of <= attempt:
                yield event(of, LINE, seq, ts, level, text)
            else:
                self.waiting.updateValue((of, seq), (ts, level, text))
                waiting += 1
        if status in FINAL_STATUSES and not ended:
            ended = True
            yield event(attempt, END)
        self.cursor.update((attempt, status, error, ended, waiting, [[of, *ranges] for of, ranges in sorted(seen.items())]))

    def close(self) -> None:
        pass


class Cursor:
    """A run's value as its group has it."""

    def __init__(self, now):
        self.now = now

    def get(self):
        return self.now

    def update(self, value) -> None:
        self.now = value


class Waiting:
    """The waiting lines of a group, read only if a run reaches some; lines that come to wait are appended."""

    def __init__(self, stored):
        self.stored, self.read, self.kept, self.added, self.changed = stored, False, {}, {}, False

    def of(self, run_id) -> "RunWaiting":
        return RunWaiting(self, run_id)

    def lines(self, run_id) -> dict:
        if not self.read:
            self.read = True
            for (text,) in self.stored.get():
                for run, place, line in loads(text):
                    self.kept.setdefault(run, {})[tuple(place)] = line
        return self.kept.setdefault(run_id, {})

    def save(self) -> None:
        rows = [(run, place, line) for by_place in ([self.kept] if self.changed else []) + [self.added]
                for run, lines in by_place.items() for place, line in lines.items()]
        text = (json.dumps(rows),)
        if self.changed:
            self.stored.put([text])
        elif rows:
            self.stored.appendValue(text)


class RunWaiting:
    """A run's part of them."""

    def __init__(self, group: Waiting, run_id):
        self.group, self.run_id = group, run_id

    def iterator(self):
        return iter(self.group.lines(self.run_id).items())

    def removeKey(self, place) -> None:
        del self.group.lines(self.run_id)[place]
        self.group.changed = True

    def updateValue(self, place, line) -> None:
        self.group.added.setdefault(self.run_id, {})[place] = line


class GroupKeeper(StatefulProcessor):
    """The cursors of a group of runs and the lines that wait, each run handled by ``TailKeeper``."""

    def init(self, handle) -> None:
        self.cursors = handle.getValueState("cursors", "runs string")
        self.lines = handle.getListState("lines", "lines string")

    def handleInputRows(self, key, rows, timerValues):
        arrived, stored = by_key(rows, "run_id"), self.cursors.get()
        cursors = dict(loads(stored[0])) if stored else {}
        waiting, keeper = Waiting(self.lines), TailKeeper()

        def events():
            for run_id, of_run in arrived.items():
                keeper.cursor, keeper.waiting = Cursor(cursors.get(run_id)), waiting.of(run_id)
                yield from keeper.handleInputRows((run_id,), of_run, timerValues)
                cursors[run_id] = keeper.cursor.now
        yield from framed(events(), COLUMNS)
        self.cursors.update((json.dumps(list(cursors.items())),))
        waiting.save()

    def close(self) -> None:
        pass


def _first(line: tuple) -> list:
    return [(x is not None, x) for x in line]


def tail(rows: DataFrame, groups: int = GROUPS) -> DataFrame:
    """Stream of the events (run_id, attempt, kind, seq, event, data) that each batch of ``tail_input`` makes known.

    All that was emitted up to a moment is ``event_rows`` of the runs and lines received by then. A re-sent line is ignored;
    of copies in one batch the earliest counts. Lines without attempt or ``seq`` are none. A worker stores its lines before its status, so where inputs keep that order an
    ``end`` never precedes its lines.
    """
    state_store(rows.sparkSession)
    either = {"is_run": F.col("run").isNotNull(), "run_id": F.coalesce("run.id", "line.run_id"), "attempt": F.coalesce("run.attempt", "line.attempt"), "seq": F.col("line.seq"),
              "ts": F.col("line.ts"), "level": F.col("line.level"), "line": F.col("line.line"), "status": F.col("run.status"), "error": F.col("run.error")}
    flat = rows.select(*[c.alias(name) for name, c in either.items()]).filter("run_id IS NOT NULL")
    kind = dict(flat.dtypes)["run_id"]
    flat = flat.withColumn("ts", F.unix_micros("ts")).select(group_of("run_id", groups), as_json(*map(F.col, either)).alias("row"))
    found = flat.groupBy("group").transformWithStateInPandas(GroupKeeper(), "row string", "Append", "None")
    name, data = event_json()
    return unframed(found, ROW.format(kind)).withColumn("ts", F.timestamp_micros("ts")).select(
        "run_id", "attempt", "kind", "seq", name.alias("event"), data.alias("data"))
