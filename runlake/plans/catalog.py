"""Every operator as a named query over the benchmark tables.

A query takes (spark, sf_dir), reads whole tables through the fixture views and
returns a DataFrame of scalar columns.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlake.functions import durations, ids, payload, retry, text
from runlake.operators import (audit, changes, events, fold, generate, inserts, keys, lookup, schedule, sessions,
                               transitions, validate)
from runlake.plans.maintenance import maintenance_pass
from runlake.schema import JOBS, LOGS, RUNS, SUCCEEDED
from runlake.session import configure, shared_dir
from runlake.sources import dispatch, fixtures, logs as log_source, outputs
from runlake.streaming import jobs as streams, liveness, state, tail
from runlake.streaming.batches import latest, read_batches, run_available, schema_of, write_changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SESSION_GAP = 21_600
STREAM_LATENESS = "1 day"


class Views:
    """The fixture views of one data folder, and the common ``as_of``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return fixtures.view(self.spark, self.sf_dir, name)

    def stream(self, name: str) -> DataFrame:
        return fixtures.view_stream(self.spark, self.sf_dir, name)

    @property
    def runs(self) -> DataFrame:
        return self.job_runs

    @property
    def logs(self) -> DataFrame:
        return self.job_logs

    @property
    def lines(self) -> DataFrame:
        return log_source.first_copies(self.job_logs)

    @property
    def as_of(self) -> Column:
        return F.expr(fixtures.AS_OF)

    @property
    def run_payloads(self) -> DataFrame:
        return generate.with_run_payload(self.runs, self.jobs)

    @property
    def claims(self) -> DataFrame:
        good, _ = dispatch.split(dispatch.decode(self.dispatch_raw))
        return claim_requests(good)

    def reports_as(self, name: str) -> DataFrame:
        return self.reports.withColumnRenamed("note", name)


def claim_requests(good: DataFrame) -> DataFrame:
    """Each message offered by the worker reading its partition; an id that is no number names no run."""
    return good.select(F.col("run_id").try_cast("bigint").alias("run_id"), "arrived_at", "offset_no",
                       F.concat(F.lit("w"), F.col("partition_no").cast("string")).alias("worker_id"))


def query(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
    return fn


# Sources and sinks ------------------------------------------------------------

@query
def scan_jobs(v: Views) -> DataFrame:
    return v.jobs.select(*JOBS)


@query
def scan_runs(v: Views) -> DataFrame:
    return v.runs.select(*RUNS)


@query
def scan_logs(v: Views) -> DataFrame:
    return v.logs.select(*LOGS)


@query
def dispatch_decode(v: Views) -> DataFrame:
    return dispatch.decode(v.dispatch_raw).select(
        "offset_no", "partition_no", "run_id", "job_id", "job_type",
        F.coalesce("attempt", F.lit(0)).alias("attempt"), "reject_reason")


@query
def dispatch_encode(v: Views) -> DataFrame:
    queued = lookup.with_job(v.runs, v.jobs).filter(F.col("status") == "QUEUED")
    return dispatch.encode(queued.withColumnRenamed("id", "run_id"))


@query
def unknown_run_events(v: Views) -> DataFrame:
    return fold.unknown_events(v.runs.filter(F.col("id") % 9 != 0), v.run_events)


@query
def lost_reports(v: Views) -> DataFrame:
    return transitions.lost_reports(v.runs, v.reports).select("run_id", "worker_id", "attempt", "note")


@query
def reap_stale_limited(v: Views) -> DataFrame:
    return transitions.reap_stale(v.runs, v.jobs, v.as_of, limit=100).changed


@query
def maintenance_snapshot(v: Views) -> DataFrame:
    return maintenance_pass(v.runs, v.jobs, v.as_of).snapshot


@query
def log_append(v: Views) -> DataFrame:
    return log_source.append(log_source.first_copies(v.logs.filter(F.col("level") == "error")), v.logs)


@query
def log_unnest(v: Views) -> DataFrame:
    return log_source.unnest(log_source.to_batches(v.logs))


@query
def run_output_sink(v: Views) -> DataFrame:
    path = shared_dir(v.spark, "outputs")
    done = generate.generate_output(v.run_payloads.filter(F.col("status") == SUCCEEDED))
    outputs.write_outputs(done, path)
    return v.spark.read.schema(done.schema).parquet(path)


def _checked(v: Views) -> DataFrame:
    return validate.check_requests(v.job_requests, v.as_of)


@query
def create_jobs(v: Views) -> DataFrame:
    return inserts.create_jobs(validate.split_requests(_checked(v)).valid, v.as_of)


# Projections, filters, lookups, top-k -----------------------------------------

@query
def get_job(v: Views) -> DataFrame:
    return lookup.get_many(v.jobs, v.reports.select(F.col("run_id").alias("id"))).select(
        "id", "found", "name", "type", "timezone", "next_run_at")


@query
def get_run(v: Views) -> DataFrame:
    return lookup.get_many(v.runs, v.reports.select((F.col("run_id") * 2).alias("id"))).select(
        "id", "found", "status", "worker_id", "scheduled_time", "output")


@query
def list_jobs(v: Views) -> DataFrame:
    return lookup.list_jobs(v.jobs)


@query
def list_runs(v: Views) -> DataFrame:
    return lookup.list_runs(v.runs)


@query
def list_runs_per_job(v: Views) -> DataFrame:
    return lookup.list_runs_per_job(v.runs, 5)


@query
def log_page(v: Views) -> DataFrame:
    asked = v.runs.select(F.col("id").alias("run_id"), "attempt", (F.col("id") % 2 + 1).alias("from_seq"))
    return lookup.log_pages(v.lines, asked, 3).select("run_id", "attempt", "from_seq", "seq", "ts", "level", "line")


@query
def log_page_cursor(v: Views) -> DataFrame:
    asked = v.runs.select(F.col("id").alias("run_id"), F.when(F.col("id") % 2 == 1, F.lit(1)).alias("attempt"),
                          (F.col("id") % 3 + 1).alias("from_seq"))
    pages = lookup.log_page_cursors(v.lines, v.runs, asked, 2)
    shown = F.transform("lines", lambda x: F.concat(x["seq"].cast("string"), F.lit(" "), x["line"]))
    return pages.withColumn("lines", F.array_join(shown, "|"))


@query
def log_current_attempt(v: Views) -> DataFrame:
    return lookup.current_attempt_lines(v.lines, v.runs)


@query
def status_detail(v: Views) -> DataFrame:
    return lookup.status_detail(v.runs)


@query
def is_final(v: Views) -> DataFrame:
    return v.runs.select("id", "status", lookup.is_final(F.col("status")).alias("is_final"))


# Joins --------------------------------------------------------------------------

@query
def runs_with_job(v: Views) -> DataFrame:
    return lookup.with_job(v.runs, v.jobs).select("id", "job_id", "status", "attempt", "job_type", "max_retries")


@query
def update_from(v: Views) -> DataFrame:
    picked = v.heartbeats.groupBy(F.col("run_id").alias("id")).agg(F.max("ts").alias("_seen"))
    return keys.update_from(v.runs, picked, "id", {"queued_at": F.col("_seen"), "error": F.lit("picked")})


@query
def occurrence_insert(v: Views) -> DataFrame:
    existing = inserts.first_occurrences(v.runs.filter(F.col("status") != "QUEUED"))
    wanted = v.runs.select("job_id", "scheduled_time").unionByName(
        v.jobs.filter(F.col("next_run_at").isNotNull()).select(
            F.col("id").alias("job_id"), F.col("next_run_at").alias("scheduled_time")))
    return inserts.insert_occurrences(existing, wanted, v.as_of)


@query
def manual_run_insert(v: Views) -> DataFrame:
    calls = v.heartbeats.select((F.col("run_id") * 20).alias("job_id"), F.col("ts").alias("called_at"))
    done = inserts.insert_manual(v.runs, v.jobs, calls)
    return done.queued.select("id", "job_id", "scheduled_time", "trigger", "status").unionByName(
        done.rejected.select(F.lit(0).cast("bigint").alias("id"), "job_id",
                             F.col("called_at").alias("scheduled_time"), F.lit("manual").alias("trigger"),
                             F.lit("not found").alias("status")))


def _without_paused(v: Views) -> inserts.Cascade:
    return inserts.cascade_delete(v.jobs, v.runs, v.logs, v.jobs.filter(~F.col("enabled")))


@query
def cascade_delete(v: Views) -> DataFrame:
    left = _without_paused(v)
    def kept(df: DataFrame, table: str, key: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(table).alias("table_name"), "key", "n")
    return kept(left.jobs, "jobs", "id").unionByName(kept(left.runs, "job_runs", "id")).unionByName(
        kept(left.logs, "job_logs", "run_id"))


@query
def job_name_lookup(v: Views) -> DataFrame:
    return lookup.job_names(v.runs, v.jobs.filter("enabled")).select("id", "job_id", "job_name")


# Transitions -----------------------------------------------------------------------

@query
def claim(v: Views) -> DataFrame:
    return transitions.claim(v.runs, v.claims, v.as_of).changed


@query
def heartbeat(v: Views) -> DataFrame:
    return transitions.heartbeat(v.runs, v.reports.select("run_id", "worker_id", "attempt"), v.as_of).changed


@query
def finish(v: Views) -> DataFrame:
    return transitions.finish(v.runs, v.reports_as("output"), v.as_of).changed


@query
def release(v: Views) -> DataFrame:
    return transitions.release(v.runs, v.reports_as("reason"), v.as_of).changed


@query
def fail_or_retry(v: Views) -> DataFrame:
    return transitions.fail_or_retry(v.runs, v.jobs, v.reports_as("error"), v.as_of).changed


@query
def fail_queued(v: Views) -> DataFrame:
    return transitions.fail_queued(v.runs, v.reports_as("reason"), v.as_of).changed


@query
def reap_stale(v: Views) -> DataFrame:
    return transitions.reap_stale(v.runs, v.jobs, v.as_of).changed


@query
def sweep_queued(v: Views) -> DataFrame:
    return transitions.sweep_queued(v.runs, v.jobs, v.as_of).changed


@query
def due_retries(v: Views) -> DataFrame:
    return transitions.due_retries(v.runs, v.jobs, v.as_of).changed


@query
def maintenance_dispatches(v: Views) -> DataFrame:
    return maintenance_pass(v.runs, v.jobs, v.as_of).dispatches


@query
def maintenance_pass_limited(v: Views) -> DataFrame:
    return maintenance_pass(v.runs, v.jobs, v.as_of, limit=100).dispatches


QUERIES["maintenance_pass"] = QUERIES.pop("maintenance_dispatches")


@query
def state_fold(v: Views) -> DataFrame:
    return fold.state_fold(v.runs, v.jobs, v.run_events)


@query
def retry_delay(v: Views) -> DataFrame:
    attempt = (F.col("tiebreak") % 40 + 1).cast("int")
    return v.run_events.select("run_id", "tiebreak", attempt.alias("attempt"),
                               retry.delay_seconds(attempt).alias("delay_sec"))


@query
def attempt_outcome(v: Views) -> DataFrame:
    kind = F.col("tiebreak") % 4
    cause = F.when(kind == 0, "lost").when(kind == 1, "shutdown").when(kind == 2, "timeout").otherwise("")
    error = F.when(F.col("kind") != "finish", F.col("message"))
    return v.run_events.select("run_id", "tiebreak", "kind",
                               F.inline(F.array(retry.outcome(error, cause, F.col("attempt") * 60))))


# Schedules ----------------------------------------------------------------------------

@query
def cron_parse(v: Views) -> DataFrame:
    sets = [F.coalesce(F.array_join(f"cron.{f}", ","), F.lit("")).alias(f)
            for f in ("minute", "hour", "dom", "month", "dow")]
    return schedule.parse_pairs(v.jobs).select(
        "cron_expr", "timezone", *sets, "cron.dom_star", "cron.dow_star",
        F.coalesce("cron.every_sec", F.lit(0).cast("bigint")).alias("every_sec"), "cron.error")


@query
def duration_seconds(v: Views) -> DataFrame:
    secs = F.expr(durations.seconds("duration"))
    return v.durations.select("id", "duration", secs.isNotNull().alias("valid"),
                              F.coalesce(secs, F.lit(0.0)).alias("seconds"))


@query
def next_run(v: Views) -> DataFrame:
    return schedule.next_run(v.jobs, v.as_of)


@query
def occurrences(v: Views) -> DataFrame:
    return schedule.occurrences(v.jobs, v.as_of, v.as_of + F.expr("INTERVAL '6' HOUR"))


@query
def due_jobs(v: Views) -> DataFrame:
    return schedule.due_jobs(v.jobs, v.as_of)


@query
def fire_due_jobs(v: Views) -> DataFrame:
    return schedule.fire_due_jobs(v.jobs, v.runs, v.as_of).dispatches


@query
def fire_due_jobs_schedules(v: Views) -> DataFrame:
    return schedule.fire_due_jobs(v.jobs, v.runs, v.as_of).jobs.select("id", "next_run_at", "updated_at")


@query
def pause_resume(v: Views) -> DataFrame:
    asked = v.heartbeats.select(F.col("run_id").alias("job_id")).distinct().withColumn(
        "enabled", F.col("job_id") % 2 == 0)
    return schedule.pause_resume(v.jobs, asked, v.as_of)[0].select("id", "enabled", "next_run_at", "updated_at")


# Generation ----------------------------------------------------------------------------

@query
def generate_lines(v: Views) -> DataFrame:
    return generate.generate_lines(v.run_payloads.filter(F.col("status") == SUCCEEDED))


@query
def generate_output(v: Views) -> DataFrame:
    return generate.generate_output(v.run_payloads)


@query
def progress_log(v: Views) -> DataFrame:
    return generate.progress_log(v.run_payloads)


@query
def expected_outcome(v: Views) -> DataFrame:
    return generate.expected_outcome(v.run_payloads)


@query
def attempt_timeline(v: Views) -> DataFrame:
    return generate.attempt_timeline(v.run_payloads)


# Log events --------------------------------------------------------------------------

@query
def log_events(v: Views) -> DataFrame:
    return events.log_events(v.runs, v.logs)


@query
def log_events_resumed(v: Views) -> DataFrame:
    starts = v.runs.filter(F.col("id") % 3 == 0).select(
        F.col("id").alias("run_id"), F.greatest(F.lit(1), F.col("attempt") - 1).alias("attempt"),
        (F.col("id") % 5 + 1).alias("from_seq"))
    return events.log_events(v.runs, v.logs, starts)


def _broken(v: Views) -> DataFrame:
    """Jobs of which every eleventh has a schedule that can't be read."""
    return v.jobs.withColumn("cron_expr", F.when(F.col("id") % 11 == 0, "now and then").otherwise(F.col("cron_expr")))


@query
def fire_errors(v: Views) -> DataFrame:
    return schedule.fire_due_jobs(_broken(v), v.runs, v.as_of).errors


@query
def resume_errors(v: Views) -> DataFrame:
    asked = v.jobs.select(F.col("id").alias("job_id"), (F.col("id") % 3 > 0).alias("enabled"))
    return schedule.pause_resume(_broken(v), asked, v.as_of)[1]


@query
def sse_encode(v: Views) -> DataFrame:
    rows = events.event_rows(v.runs, v.logs)
    return rows.select("run_id", "attempt", "kind", "seq",
                       events.sse_encode(F.col("event"), F.col("data")).alias("frame"))


@query
def sse_decode(v: Views) -> DataFrame:
    return events.sse_decode(v.sse_texts, "text", ("conv_id", "turn"))


@query
def sse_decode_rows(v: Views) -> DataFrame:
    """The same texts, cut into rows of seven characters."""
    cut = v.sse_texts.select("conv_id", "turn", F.posexplode(F.expr(
        "transform(sequence(0, length(text) div 7), i -> substring(text, 7 * i + 1, 7))")).alias("pos", "text"))
    return events.sse_decode_rows(cut, "text", ("conv_id", "turn"))


@query
def follow_result(v: Views) -> DataFrame:
    return events.follow_result(v.runs, events.event_rows(v.runs, v.logs))


# Presentation --------------------------------------------------------------------------

@query
def relative_time(v: Views) -> DataFrame:
    return v.runs.select("id", *[text.relative_time(F.col(c), v.as_of).alias(c) for c in (
        "scheduled_time", "queued_at", "started_at", "next_attempt_at")])


@query
def took(v: Views) -> DataFrame:
    return v.runs.select("id", text.took(F.col("started_at"), F.col("finished_at"), v.as_of).alias("took"))


@query
def schedule_label(v: Views) -> DataFrame:
    expr, zone = F.col("cron_expr"), F.col("timezone")
    return v.jobs.select(
        "id", text.schedule_label(expr, zone).alias("label"),
        text.schedule_label(expr, zone, hide_utc=True).alias("web_label"),
        text.next_label(expr, F.col("enabled"), F.col("next_run_at"), v.as_of).alias("next_label"))


@query
def output_preview(v: Views) -> DataFrame:
    docs = fixtures.base(v.spark, v.sf_dir, "documents")
    return docs.select("doc_id", text.line_count(F.col("text")).alias("line_count"),
                       text.output_preview(F.col("text"), 5).alias("preview"))


@query
def run_changes(v: Views) -> DataFrame:
    after = maintenance_pass(v.runs, v.jobs, v.as_of).snapshot
    kept = after.join(v.jobs.filter(~F.col("enabled")).select(F.col("id").alias("job_id")), "job_id", "left_anti")
    return changes.run_changes(v.runs, kept)


# Validation and audit ---------------------------------------------------------------------

@query
def job_request_validate(v: Views) -> DataFrame:
    return _checked(v).select("id", "reason")


@query
def payload_validate(v: Views) -> DataFrame:
    zero = F.lit(0)
    return payload.with_payload(v.jobs).select(
        "id", "payload_error", "prefix", *[F.coalesce(c, zero).alias(c) for c in (
            "lines", "delay_ms", "fail_at", "fail_attempts")])


@query
def uuid_normalize(v: Views) -> DataFrame:
    return v.uuids.select("id", ids.normalize_uuid(F.col("raw")).alias("uuid"))


@query
def check_audit(v: Views) -> DataFrame:
    jobs = v.jobs.withColumn("max_retries", F.col("max_retries") - 1).withColumn(
        "timeout_sec", F.col("timeout_sec") - 60)
    runs = (v.runs.withColumn("status", F.when(F.col("id") % 13 == 0, "DONE").otherwise(F.col("status")))
            .withColumn("trigger", F.when(F.col("id") % 17 == 0, "cron").otherwise(F.col("trigger")))
            .withColumn("attempt", F.col("attempt") - 1))
    logs = v.logs.withColumn("level", F.when(F.col("seq") == 3, "fatal").otherwise(F.col("level")))
    return audit.check_audit(jobs, runs, logs)


@query
def unique_audit(v: Views) -> DataFrame:
    return audit.unique_audit(v.runs, v.logs)


@query
def fk_audit(v: Views) -> DataFrame:
    left = _without_paused(v)
    return audit.fk_audit(left.jobs, v.runs, v.logs.unionByName(left.logs)).unionByName(
        audit.fk_audit(v.jobs, left.runs, v.logs).withColumn("rule", F.concat("rule", F.lit(" after delete"))))


@query
def child_counts(v: Views) -> DataFrame:
    return audit.child_counts(v.jobs, v.runs, v.logs)


# Streaming ---------------------------------------------------------------------------------

@query
def heartbeat_sessions(v: Views) -> DataFrame:
    return sessions.heartbeat_sessions(v.heartbeats, SESSION_GAP)


@query
def stream_dispatch(v: Views) -> DataFrame:
    good, dead = shared_dir(v.spark, "good"), shared_dir(v.spark, "dead")
    run_available(v.stream("dispatch_raw"), streams.dispatch_writer(good, dead), "dispatch")
    kept, lost = dispatch.split(dispatch.decode(v.dispatch_raw))
    accepted = read_batches(v.spark, good, schema_of(kept))
    dropped = read_batches(v.spark, dead, schema_of(lost))
    return accepted.select("offset_no", "run_id", F.lit("").alias("reject_reason")).unionByName(
        dropped.select("offset_no", F.lit("").alias("run_id"), "reject_reason"))


@query
def stream_claim(v: Views) -> DataFrame:
    target = shared_dir(v.spark, "claims")
    run_available(v.stream("dispatch_raw"),
                  streams.claim_writer(v.runs, target, claim_requests, v.as_of), "claim")
    return latest(v.runs, target)


@query
def stream_log_append(v: Views) -> DataFrame:
    target = shared_dir(v.spark, "log-lines")
    existing = log_source.first_copies(v.logs.filter(F.col("level") == "error"))
    run_available(v.stream("job_logs"), streams.log_writer(target, existing), "log-append")
    added = read_batches(v.spark, target, schema_of(existing)).select(*LOGS)
    return existing.select(*LOGS).unionByName(added)


@query
def stream_liveness(v: Views) -> DataFrame:
    target = shared_dir(v.spark, "sessions")
    closed = streams.closed_sessions(v.stream("heartbeats"), SESSION_GAP, STREAM_LATENESS)
    run_available(closed, streams.append_writer(target), "liveness")
    return read_batches(v.spark, target, schema_of(closed)).drop("batch")


@query
def stream_liveness_timers(v: Views) -> DataFrame:
    """Silences by timers instead of windows; one that a later heartbeat ends needs no timer."""
    target = shared_dir(v.spark, "silences")
    silent = liveness.stale_owners(v.stream("heartbeats"), SESSION_GAP, STREAM_LATENESS, ("run_id",))
    run_available(silent, streams.append_writer(target), "liveness-timers")
    return read_batches(v.spark, target, schema_of(silent)).drop("batch")


@query
def stream_state(v: Views) -> DataFrame:
    target = shared_dir(v.spark, "states")
    run_available(v.stream("run_events"), streams.state_writer(v.runs, v.jobs, target), "state")
    return latest(streams.with_counts(v.runs), target)


@query
def stream_state_timers(v: Views) -> DataFrame:
    """The runs as of the latest event, with what fell due before and after each."""
    target = shared_dir(v.spark, "kept-runs")
    changed = state.kept_runs(v.stream("run_events"), v.runs, v.jobs, "0 seconds")
    run_available(changed, lambda rows, n: write_changes(rows, target, n), "kept-runs")
    return latest(streams.with_counts(v.runs), target)


@query
def stream_log_tail(v: Views) -> DataFrame:
    runs, lines, sent = (shared_dir(v.spark, f"tail-{x}") for x in ("runs", "lines", "events"))
    run_available(tail.tail_input(v.stream("job_runs"), v.stream("job_logs")), streams.tail_writer(runs, lines, sent), "tail")
    rows = events.event_rows(v.runs, v.logs)
    return read_batches(v.spark, sent, schema_of(rows)).drop("batch")


@query
def stream_log_tail_cursor(v: Views) -> DataFrame:
    target = shared_dir(v.spark, "tail-events")
    sent = tail.tail(tail.tail_input(v.stream("job_runs"), v.stream("job_logs")))
    run_available(sent, streams.append_writer(target), "tail")
    return read_batches(v.spark, target, schema_of(sent)).drop("batch")
