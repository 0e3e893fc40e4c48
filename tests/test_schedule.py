import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from helpers import NOW, ago, as_of, jobs, row, runs
from pyspark.sql import functions as F

from runlake.functions import cron, durations
from runlake.operators import schedule

UTC = dt.timezone.utc
AT = "2026-09-17 10:30:00.5"


def next_runs(spark, pairs, at=AT):
    df = spark.createDataFrame(pairs, "cron_expr string, timezone string")
    got = cron.with_next(df, F.lit(at).cast("timestamp")).collect()
    return {(r.cron_expr, r.timezone): (r.next_run_at, r.next_error) for r in got}


# The first three and the bad ones are the pinned cases; the rest follow the published cron rules.
@pytest.fixture(scope="module")
def answers(spark):
    return next_runs(spark, [(e, z) for e, z, _ in GOOD] + [(e, z) for e, z, _ in BAD])


GOOD = [
    ("*/15 * * * *", "UTC", "2026-09-17 10:45:00"),
    ("0 9 * * *", "America/New_York", "2026-09-17 13:00:00"),
    ("@every 10s", "UTC", "2026-09-17 10:30:10"),
    ("0 */6 * * *", "UTC", "2026-09-17 12:00:00"),
    ("@hourly", "UTC", "2026-09-17 11:00:00"),
    ("@weekly", "Asia/Kolkata", "2026-09-19 18:30:00"),
    ("@monthly", "UTC", "2026-10-01 00:00:00"),
    ("@yearly", "UTC", "2027-01-01 00:00:00"),
    ("0 0 29 2 *", "UTC", "2028-02-29 00:00:00"),
    ("0 0 1 JAN mon", "UTC", "2027-01-01 00:00:00"),
    ("0 0 20 * fri", "UTC", "2026-09-18 00:00:00"),
    ("0 0 20 * */2", "UTC", "2026-09-19 00:00:00"),
    ("0 0 20 * *", "UTC", "2026-09-20 00:00:00"),
    ("1,,2 * * * ?", "UTC", "2026-09-17 11:01:00"),
    ("5/20 * * * *", "UTC", "2026-09-17 10:45:00"),
    ("TZ=Asia/Tokyo 0 5 * * *", "UTC", "2026-09-17 20:00:00"),
    ("@every 1h30m", "UTC", "2026-09-17 12:00:00"),
    ("@every 10ms", "UTC", "2026-09-17 10:30:01"),
    ("30 2 8 3 *", "America/New_York", "2027-03-08 07:30:00"),
]
BAD = [
    ("twice a day", "UTC", "expected exactly 5 fields"), ("* * * * *", "Europe/Atlantis", "unknown timezone"),
    ("* * * * *", "Local", "unknown timezone"), ("0 0 30 2 *", "UTC", "never fires"), ("0 0 * * 7", "UTC", "dow"),
    ("60 * * * *", "UTC", "minute"), ("5-1 * * * *", "UTC", "minute"), ("*/0 * * * *", "UTC", "minute"),
    ("1-2-3 * * * *", "UTC", "minute"), ("@often", "UTC", "unrecognized"), ("@every x", "UTC", "duration"),
    ("", "UTC", "empty"), ("CRON_TZ=Nowhere 0 0 * * *", "UTC", "bad location"),
]


@pytest.mark.parametrize("expr,zone,want", GOOD)
def test_next_run(answers, expr, zone, want):
    assert answers[(expr, zone)] == (dt.datetime.fromisoformat(want), None)


@pytest.mark.parametrize("expr,zone,want", BAD)
def test_bad_schedules(answers, expr, zone, want):
    at, error = answers[(expr, zone)]
    assert at is None and want in error


def local_fires(zone, start, end, matches):
    """Brute force over UTC minutes."""
    out, t = [], start
    while t < end:
        if matches(t.replace(tzinfo=UTC).astimezone(ZoneInfo(zone))):
            out.append(t)
        t += dt.timedelta(minutes=1)
    return out


@pytest.mark.parametrize("zone,start", [
    ("America/New_York", "2026-03-07 12:00:00"), ("America/New_York", "2026-10-31 12:00:00"),
    ("Europe/London", "2026-03-28 12:00:00"), ("Europe/London", "2026-10-24 12:00:00"),
    ("Australia/Lord_Howe", "2026-04-04 06:00:00"), ("Australia/Lord_Howe", "2026-10-03 06:00:00"),
    ("America/Sao_Paulo", "2018-11-03 12:00:00"), ("Asia/Kolkata", "2026-05-01 00:00:00")])
def test_clock_changes_against_brute_force(spark, zone, start):
    t0 = dt.datetime.fromisoformat(start)
    t1 = t0 + dt.timedelta(hours=36)
    exprs = {"*/7 * * * *": lambda l: l.minute % 7 == 0, "30 0-3 * * *": lambda l: l.minute == 30 and l.hour <= 3,
             "0 0 * * 0": lambda l: l.minute == 0 and l.hour == 0 and l.weekday() == 6}
    df = spark.createDataFrame([(e, e, zone) for e in exprs], "id string, cron_expr string, timezone string")
    lit = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp")
    got = schedule.occurrences(df, lit(t0), lit(t1)).collect()
    for expr, matches in exprs.items():
        want = local_fires(zone, t0, t1, matches)
        assert sorted(r.scheduled_time for r in got if r.job_id == expr) == want
        after = local_fires(zone, t0 + dt.timedelta(minutes=1), t0 + dt.timedelta(days=9), matches)
        assert next_runs(spark, [(expr, zone)], start)[(expr, zone)][0] == after[0]


def test_occurrences_of_steps_and_bad_schedules(spark):
    df = spark.createDataFrame([("a", "@every 50h", "UTC"), ("b", "nope", "UTC"), ("c", "@every 7h", "Mars/X"), ("d", "@every 11h", "UTC")],
                               "id string, cron_expr string, timezone string")
    got = schedule.occurrences(df, as_of(), as_of() + F.expr("INTERVAL '5' DAY")).collect()
    hours = {j: sorted((r.scheduled_time - NOW).total_seconds() / 3600 for r in got if r.job_id == j) for j in "abcd"}
    assert hours == {"a": [50, 100], "b": [], "c": [], "d": list(range(11, 120, 11))}


@pytest.mark.parametrize("text,want", [
    ("30s", 30), ("5m", 300), ("1h30m", 5400), ("1.5h", 5400), ("250ms", 0.25), ("-5s", -5), ("0", 0), (".5s", 0.5),
    ("90", None), ("abc", None), ("", None), ("1h-3m", None), ("5 s", None), (".s", None)])
def test_durations(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(F.expr(durations.seconds("t")).alias("s"))
    assert row(df).s == want


def scheduled(**extra):
    return dict(cron_expr="@every 10s", next_run_at=ago(60), max_retries=3) | extra


def test_fire_due_jobs(spark):
    table = jobs(spark, scheduled(id="due"), scheduled(id="edge", next_run_at=ago(0)), scheduled(id="later", next_run_at=ago(-1)),
                 scheduled(id="paused", enabled=False), scheduled(id="broken", cron_expr="nope"), scheduled(id="seen"), dict(id="manual"))
    stored = runs(spark, dict(job_id="seen", scheduled_time=ago(60)))
    fired = schedule.fire_due_jobs(table, stored, as_of())
    assert sorted(r.job_id for r in fired.dispatches.collect()) == ["broken", "due", "edge"]
    new = {r.job_id: r for r in fired.runs.collect() if r.job_id == "due"}["due"]
    assert (new.scheduled_time, new.status, new.attempt, new.trigger, new.queued_at) == (ago(60), "QUEUED", 1, "schedule", NOW)
    after = {r.id: r.next_run_at for r in fired.jobs.collect()}
    moved = NOW + dt.timedelta(seconds=10)
    assert after == {"due": moved, "edge": moved, "seen": moved, "broken": None, "later": ago(-1), "paused": ago(60), "manual": None}
    assert "5 fields" in row(fired.errors).error
    again = schedule.fire_due_jobs(table, fired.runs, as_of())
    assert again.dispatches.count() == 0


def test_due_jobs_limit_takes_the_longest_due(spark):
    table = jobs(spark, *[scheduled(id=f"j{n}", next_run_at=ago(n)) for n in (1, 3, 2)])
    assert [r.id for r in schedule.due_jobs(table, as_of(), 2).collect()] == ["j3", "j2"]


def test_pause_and_resume(spark):
    table = jobs(spark, scheduled(id="stop"), scheduled(id="go", enabled=False, next_run_at=None), dict(id="manual", enabled=False),
                 scheduled(id="bad", cron_expr="nope", enabled=False, next_run_at=None), scheduled(id="other"))
    asked = spark.createDataFrame([("stop", False), ("go", True), ("manual", True), ("bad", True)], "job_id string, enabled boolean")
    done, errors = schedule.pause_resume(table, asked, as_of())
    got = {r.id: (r.enabled, r.next_run_at) for r in done.collect()}
    assert got == {"stop": (False, None), "go": (True, NOW + dt.timedelta(seconds=10)), "manual": (True, None),
                   "bad": (False, None), "other": (True, ago(60))}
    assert row(errors).job_id == "bad"
