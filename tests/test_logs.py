import random

import pytest
from helpers import NOW, ago, as_of, jobs, logs, row, runs
from pyspark.sql import functions as F

from runlake.operators import audit, changes, events, inserts, keys, lookup, sessions
from runlake.sources import dispatch, logs as source, outputs


def lines_of(df):
    return [(r.attempt, r.seq, r.line) for r in sorted(df.collect(), key=lambda r: (r.attempt, r.seq))]


def test_append_ignores_what_is_stored_and_keeps_the_first_copy(spark):
    stored = logs(spark, dict(seq=1, line="a"), dict(seq=2, line="b"))
    sent = logs(spark, dict(seq=1, line="A"), dict(seq=2, line="B"), dict(seq=3, line="late", ts=ago(1)), dict(seq=3, line="c", ts=ago(2)),
                dict(seq=1, attempt=2, line="retry"))
    assert lines_of(source.append(stored, sent)) == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "retry")]


def test_batches_hold_at_most_their_size_and_unnest_to_the_same_lines(spark):
    table = logs(spark, *[dict(seq=i, line=f"l{i}") for i in range(1, 451)])
    batches = source.to_batches(table)
    assert sorted(len(r.seqs) for r in batches.collect()) == [50, 200, 200]
    assert lines_of(source.unnest(batches)) == lines_of(table)


# Attempt 3 holds lines 1 to 7 and 9 to 12; the run is in attempt 4, whose lines start at 2.
@pytest.fixture(scope="module")
def paged(spark):
    table = logs(spark, *[dict(attempt=3, seq=s, line=f"step {s}") for s in range(1, 13) if s != 8],
                 *[dict(attempt=4, seq=s, line=f"again {s}") for s in (2, 3)], dict(attempt=5, seq=1, line="ahead"))
    return table, runs(spark, dict(status="RUNNING", attempt=4))


# Pages by what bounds them: the limit, the end, a missing line, a start behind the end, an attempt without lines.
@pytest.mark.parametrize("attempt,start,limit,at,want,after", [
    (3, 1, 4, 3, [1, 2, 3, 4], 5), (3, 10, 50, 3, [10, 11, 12], 13), (3, 7, 2, 3, [7, 9], 10), (3, 8, 1, 3, [9], 10),
    (3, 40, 5, 3, [], 40), (None, 1, 9, 4, [2, 3], 4), (None, 6, 5, 4, [], 6)])
def test_log_page_cursor(spark, paged, attempt, start, limit, at, want, after):
    asked = spark.createDataFrame([("r1", attempt, start)], "run_id string, attempt int, from_seq bigint")
    got = row(lookup.log_page_cursors(*paged, asked, limit))
    assert (got.attempt, [x.seq for x in got.lines], got.next_seq, got.status) == (at, want, after, "RUNNING")


@pytest.mark.parametrize("run,attempt,start", [("r1", 5, 1), ("r1", 0, 1), ("r9", None, 1), ("r1", None, 0)])
def test_refused_pages_give_no_row(spark, paged, run, attempt, start):
    asked = spark.createDataFrame([(run, attempt, start)], "run_id string, attempt int, from_seq bigint")
    assert lookup.log_page_cursors(*paged, asked).count() == 0


def test_single_page_and_limits(spark, paged):
    assert [r.line for r in lookup.log_page(paged[0], "r1", 3, 8, 1).collect()] == ["step 9"]
    assert sorted(r.line for r in lookup.current_attempt_lines(*paged).collect()) == ["again 2", "again 3"]
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            lookup.log_page(paged[0], "r1", 2, 1, bad)
    with pytest.raises(ValueError):
        lookup.list_runs(paged[1], limit=201)


def told(df):
    return [f"{r.event} {r.data}" if r.event != "line" else "line " + r.data.split('"line":"')[1].split('"')[0]
            for r in sorted(df.collect(), key=lambda r: r.ord)]


@pytest.mark.parametrize("block", [1, 2, 65_536])
def test_events_follow_every_attempt(spark, paged, block):
    done = runs(spark, dict(status="CANCELLED", error="stopped", attempt=4))
    got = events.number_in_order(events.event_rows(done, paged[0]), block)
    steps = [f"line step {s}" for s in range(1, 13) if s != 8]
    assert told(got) == [*(f'attempt {{"attempt":{a}}}' for a in (1, 2, 3)), *steps, 'attempt {"attempt":4}', "line again 2", "line again 3",
                         'end {"attempt":4,"error":"stopped","status":"CANCELLED"}']
    assert sorted(r.ord for r in got.collect()) == list(range(1, len(steps) + 8))


def test_from_seq_cuts_only_the_first_attempt_shown(spark, paged):
    starts = spark.createDataFrame([("r1", 3, 11)], "run_id string, attempt int, from_seq bigint")
    assert told(events.log_events(paged[1], paged[0], starts)) == [
        'attempt {"attempt":3}', "line step 11", "line step 12", 'attempt {"attempt":4}', "line again 2", "line again 3"]


def test_sse_round_trip(spark):
    rows = spark.createDataFrame([(i, f"e{i}", f"d {i}") for i in range(5)], "i int, event string, data string")
    text = rows.select(F.col("i").alias("stream_id"), events.sse_encode(F.col("event"), F.col("data")).alias("text"))
    back = events.sse_decode(text).select(F.col("stream_id").alias("i"), "event", "data")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def python_decode(text):
    out, event, data = [], "", []
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    for line in lines:
        line = line[:-1] if line.endswith("\r") else line
        if line == "":
            if event or data:
                out.append((event, "\n".join(data)))
            event, data = "", []
        elif line.startswith("event:"):
            event = line[6:].strip()
        elif line.startswith("data:"):
            data.append(line[5:].removeprefix(" "))
    return out


def test_sse_decode_against_line_by_line_reading(spark):
    rng = random.Random(5)
    pieces = ["event: a", "event:b ", "event:", "data: x", "data:  y", "data:", ": ping", "id: 4", "\n", "\n", "\r\n", "\r", "\n\n"]
    texts = ["".join(rng.choice(pieces) + rng.choice(["\n", "\n", "\r\n", ""]) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    texts += ["data: only\n\n: nothing\n\n\n\nevent: two\nretry: 9\ndata: 1\ndata: 2\n\nevent: bare\n\n", "event: left open\ndata: never"]
    df = spark.createDataFrame(list(enumerate(texts)), "stream_id int, text string")
    got = {}
    for r in sorted(events.sse_decode(df).collect(), key=lambda r: (r.stream_id, r.position)):
        got.setdefault(r.stream_id, []).append((r.event, r.data))
    for i, text in enumerate(texts):
        assert got.get(i, []) == python_decode(text), repr(text)


def test_follow_result(spark):
    table = runs(spark, dict(id="ok", status="SUCCEEDED"), dict(id="bad", status="FAILED", error="boom", scheduled_time=ago(1)),
                 dict(id="open", status="RUNNING", scheduled_time=ago(2)), dict(id="gone", status="CANCELLED", scheduled_time=ago(3)))
    got = {r.run_id: (r.ok, r.message) for r in events.follow_result(table, events.event_rows(table, logs(spark))).collect()}
    assert got == {"ok": (True, None), "bad": (False, "run FAILED: boom"), "gone": (False, "run CANCELLED"),
                   "open": (False, "stream closed before the run finished")}


def test_dispatch_messages(spark):
    bodies = ["run 5, please", '{"run_id": null}', '{"attempt": 4}', '{"run_id": "r-77"}', '{"run_id": 7}', '{"run_id": "a", "extra": [1]}',
              '{"run_id": "a"} x', "null", '{"run_id": "a", "attempt": "2"}', '{"run_id": "a"}, "z": 1, "y": {"q": 1}']
    df = dispatch.decode(spark.createDataFrame(list(enumerate(bodies)), "offset_no int, value string"))
    good, dead = dispatch.split(df)
    assert {r.offset_no: (r.run_id, r.attempt) for r in good.collect()} == {3: ("r-77", 0), 5: ("a", 0)}
    assert {r.offset_no for r in dead.filter("reject_reason LIKE '%missing run_id'").collect()} == {1, 2, 7}
    sent = spark.createDataFrame([("r-20", "j-4", "generate_text", 2)], "run_id string, job_id string, job_type string, attempt int")
    message = dispatch.encode(sent)
    assert row(message).key == "r-20"
    assert tuple(row(dispatch.split(dispatch.decode(message))[0]))[2:] == ("r-20", "j-4", "generate_text", 2)


def test_cascade_audits_and_counts(spark):
    j = jobs(spark, dict(id="j1"), dict(id="j2"))
    r = runs(spark, dict(id="r1", job_id="j1"), dict(id="r2", job_id="j2"), dict(id="r3", job_id="j2"))
    l = logs(spark, dict(run_id="r1", seq=1, line="x"), dict(run_id="r2", seq=1, line="y"), dict(run_id="r2", seq=1, line="z"))
    left = inserts.cascade_delete(j, r, l, j.filter("id = 'j2'"))
    assert [[x[0] for x in d.collect()] for d in left] == [["j1"], ["r1"], ["r1"]]
    assert {(x.rule, x.key, x.orphans) for x in audit.fk_audit(left.jobs, r, l).collect()} == {("job_runs.job_id", "j2", 2)}
    assert {(x.rule, x.copies) for x in audit.unique_audit(r, l).collect()} == {("job_runs.occurrence", 2), ("job_logs.line", 2)}
    assert {(x.parent, x.id): x.children for x in audit.child_counts(j, r, l).collect()} == {
        ("job", "j1"): 1, ("job", "j2"): 2, ("run", "r1"): 1, ("run", "r2"): 2, ("run", "r3"): 0}


def test_occurrences_and_manual_runs_are_inserted_once(spark):
    j, r = jobs(spark, dict(id="j1")), runs(spark, {})
    wanted = spark.createDataFrame([("j1", ago(500)), ("j1", ago(1)), ("j1", ago(1))], "job_id string, scheduled_time timestamp")
    new = row(inserts.insert_occurrences(r, wanted, as_of()))
    assert (new.scheduled_time, new.trigger, new.queued_at) == (ago(1), "schedule", NOW) and len(new.id) == 36
    calls = spark.createDataFrame([("j1", ago(2)), ("none", ago(2))], "job_id string, called_at timestamp")
    done = inserts.insert_manual(r, j, calls)
    assert row(done.queued).trigger == "manual" and row(done.rejected).job_id == "none"


def test_run_changes_ignore_heartbeats(spark):
    old = runs(spark, dict(id="same", last_heartbeat_at=ago(9)), dict(id="moved"), dict(id="gone"))
    new = runs(spark, dict(id="same", last_heartbeat_at=ago(1)), dict(id="moved", attempt=2), dict(id="new"))
    assert {(x.id, x.change) for x in changes.run_changes(old, new).collect()} == {("moved", "changed"), ("gone", "removed"), ("new", "added")}


def test_sessions_against_a_gap_scan(spark):
    rng = random.Random(3)
    beats = [("a", NOW.timestamp() + t) for t in (0, 15, 30, 45.000001, 61, 100)] + [
        (run, -40 + rng.choice([rng.uniform(0, 900), rng.randint(0, 60) * 15.0])) for run in "bcd" for _ in range(80)]
    df = spark.createDataFrame(beats, "run_id string, s double").select("run_id", F.expr("timestamp_micros(CAST(round(s * 1e6) AS BIGINT))").alias("ts"))
    got = sorted((r.run_id, r.session_start.timestamp(), r.last_heartbeat.timestamp(), r.beats) for r in sessions.heartbeat_sessions(df, 15).collect())
    want = []
    stamps = sorted((r.run_id, r.ts.timestamp()) for r in df.collect())
    for run, t in stamps:
        if want and want[-1][0] == run and round((t - want[-1][2]) * 1e6) <= 15_000_000:
            want[-1] = (run, want[-1][1], t, want[-1][3] + 1)
        else:
            want.append((run, t, t, 1))
    assert got == want


def test_update_from_and_outputs(spark, tmp_path):
    table = runs(spark, dict(id="a"), dict(id="b", status="SUCCEEDED", output="x\n"))
    picked = spark.createDataFrame([("a", "why")], "id string, why string")
    got = {r.id: r.error for r in keys.update_from(table, picked, "id", {"error": F.col("why")}).collect()}
    assert got == {"a": "why", "b": None}
    outputs.write_outputs(outputs.succeeded_outputs(table), f"{tmp_path}/o")
    assert tuple(row(spark.read.parquet(f"{tmp_path}/o"))) == ("b", "x\n")
