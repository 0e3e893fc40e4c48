"""For each catalog query, DuckDB SQL over the base tables giving the same rows.

Only the fixture view texts are shared with the library; the SQL is written on
its own, often by brute force, so that the two sides check each other.
"""

from runlake.sources.fixtures import VIEWS, WHERE

AS_OF = "TIMESTAMP '2000-01-01 00:00:00'"
RUN_COLS = ("id", "job_id", "scheduled_time", "trigger", "status", "attempt", "worker_id", "queued_at", "started_at",
            "finished_at", "last_heartbeat_at", "next_attempt_at", "error", "output")


def _view(name: str) -> str:
    table, exprs = VIEWS[name]
    where = f" WHERE {WHERE[name]}" if name in WHERE else ""
    return f"{name} AS (SELECT {', '.join(exprs)} FROM {table}{where})".replace("AS STRING", "AS VARCHAR")


def _q(views: str, body: str, *ctes: str, recursive: bool = False) -> str:
    parts = [_view(v) for v in views.split()] + list(ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


def _run_cols(prefix: str = "", **values: str) -> str:
    return ", ".join(f"{values[c]} AS {c}" if c in values else f"{prefix}{c}" for c in RUN_COLS)


def _text_null() -> str:
    return "CAST(NULL AS VARCHAR)"


TS_NULL = "CAST(NULL AS TIMESTAMP)"
LINES = """lines AS (SELECT run_id, attempt, seq, ts, level, line FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, attempt, seq ORDER BY ts, line, level) AS rn FROM job_logs) WHERE rn = 1)"""
REQUEUE = dict(status="'QUEUED'", attempt="CAST(attempt + 1 AS INTEGER)", worker_id=_text_null(), queued_at=AS_OF,
               started_at=TS_NULL, last_heartbeat_at=TS_NULL)
# The sum 5 * 2^(attempt-1), at most 300.
DELAY = "CAST(LEAST(5 * POW(2, LEAST({a} - 1, 30)), 300) AS INTEGER)"


def _exhaust(cond: str, **extra: str) -> dict[str, str]:
    def pick(final: str, retry: str) -> str:
        return f"CASE WHEN {cond} THEN {final} ELSE {retry} END"
    return dict(
        status=pick("'FAILED'", "'QUEUED'"), attempt=f"CAST({pick('attempt', 'attempt + 1')} AS INTEGER)",
        worker_id=pick("worker_id", "NULL"), queued_at=pick("queued_at", AS_OF), started_at=pick("started_at", "NULL"),
        finished_at=pick(AS_OF, "NULL"), last_heartbeat_at=pick("last_heartbeat_at", "NULL")) | extra


JOINED = """j AS (SELECT r.*, jb.type AS job_type, jb.max_retries FROM job_runs r JOIN jobs jb ON jb.id = r.job_id)"""
STALE = f"status = 'RUNNING' AND last_heartbeat_at < {AS_OF} - INTERVAL 15 SECOND"
RETRY_DUE = f"status = 'QUEUED' AND next_attempt_at <= {AS_OF}"
SWEEP_DUE = f"status = 'QUEUED' AND queued_at < {AS_OF} - INTERVAL 60 SECOND AND (next_attempt_at IS NULL OR next_attempt_at <= {AS_OF})"
LOST = "concat('attempt ', CAST(attempt AS VARCHAR), ' lost worker ', coalesce(worker_id, ''))"

OWNED = """owned AS (SELECT r.*, w.note FROM job_runs r JOIN (
  SELECT run_id, worker_id, attempt, min(note) AS note FROM reports GROUP BY ALL) w
  ON w.run_id = r.id AND w.worker_id = r.worker_id AND w.attempt = r.attempt WHERE r.status = 'RUNNING')"""

DECODED = """decoded AS (SELECT *, CASE WHEN NOT json_valid(value) THEN 'decode dispatch: invalid message'
    WHEN coalesce(json_extract_string(value, '$.run_id'), '') = '' THEN 'decode dispatch: missing run_id' END AS reject_reason
  FROM dispatch_raw)"""
WINNERS = """winners AS (SELECT run_id, arg_min(worker_id, (arrived_at, offset_no)) AS claimant FROM (
  SELECT TRY_CAST(json_extract_string(value, '$.run_id') AS BIGINT) AS run_id, arrived_at, offset_no,
    concat('w', CAST(partition_no AS VARCHAR)) AS worker_id FROM decoded WHERE reject_reason IS NULL) GROUP BY run_id)"""
CLAIMABLE = f"r.status = 'QUEUED' AND (r.next_attempt_at IS NULL OR r.next_attempt_at <= {AS_OF})"

# Brute force: every minute of 40 days, tested field by field on the local clock.
OFFSET = """CASE timezone WHEN 'UTC' THEN 0 WHEN 'America/New_York' THEN -18000 WHEN 'Asia/Kolkata' THEN 19800 END"""
FIRES = """CASE cron_expr WHEN '*/15 * * * *' THEN minute(lt) % 15 = 0 WHEN '0 9 * * *' THEN hour(lt) = 9 AND minute(lt) = 0
    WHEN '@hourly' THEN minute(lt) = 0 WHEN '0 */6 * * *' THEN hour(lt) % 6 = 0 AND minute(lt) = 0
    WHEN '0 0 1 * *' THEN day(lt) = 1 AND hour(lt) = 0 AND minute(lt) = 0
    WHEN '30 8 * * 1-5' THEN dayofweek(lt) BETWEEN 1 AND 5 AND hour(lt) = 8 AND minute(lt) = 30 END"""


def _minute_scan(first: str, last: str) -> tuple[str, ...]:
    return (f"pairs AS (SELECT DISTINCT cron_expr, timezone FROM jobs WHERE cron_expr IS NOT NULL)",
            f"ticks AS (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 MINUTE)) AS tick)",
            f"""fires AS (SELECT cron_expr, timezone, tick FROM (
  SELECT cron_expr, timezone, tick, tick + ({OFFSET}) * INTERVAL 1 SECOND AS lt FROM pairs, ticks WHERE cron_expr NOT LIKE '@every%')
  WHERE {FIRES})""")


NEXT = _minute_scan(f"{AS_OF} + INTERVAL 1 MINUTE", f"{AS_OF} + INTERVAL 40 DAY") + (
    f"""nexts AS (SELECT cron_expr, timezone, min(tick) AS next_at FROM fires GROUP BY ALL
  UNION ALL SELECT cron_expr, timezone, {AS_OF} + INTERVAL 30 SECOND FROM pairs WHERE cron_expr = '@every 30s')""",)
DUE = f"enabled AND cron_expr IS NOT NULL AND next_run_at <= {AS_OF}"


def _md5_id(job: str, ts: str) -> str:
    return f"CAST(concat('0x', substr(md5(concat(CAST({job} AS VARCHAR), '|', CAST(epoch_us({ts}) AS VARCHAR))), 1, 15)) AS BIGINT)"


def _uuid(hex32: str) -> str:
    return "concat(" + ", '-', ".join(f"substr({hex32}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"


PAYLOADS = """parsed AS (SELECT id AS job_id, max_retries, timeout_sec, CASE
    WHEN NOT json_valid(payload) THEN 'invalid payload: not a JSON object of the expected types'
    WHEN json_type(payload, '$.lines') NOT IN ('UBIGINT', 'BIGINT') THEN 'invalid payload: not a JSON object of the expected types'
    WHEN json_exists(payload, '$.wrap_at') THEN 'invalid payload: unknown field "wrap_at"'
    WHEN CAST(json_extract_string(payload, '$.lines') AS INTEGER) NOT BETWEEN 1 AND 100000
      THEN 'payload.lines must be between 1 and 100000' END AS payload_error,
    CASE WHEN json_valid(payload) THEN TRY_CAST(json_extract_string(payload, '$.lines') AS INTEGER) END AS n,
    CASE WHEN json_valid(payload) THEN coalesce(CAST(json_extract_string(payload, '$.fail_attempts') AS INTEGER), 0) END AS fa
  FROM jobs)"""
RUN_PAYLOADS = """rp AS (SELECT r.id AS run_id, r.status, r.attempt, p.* FROM job_runs r JOIN parsed p USING (job_id))"""


def _fail_text(attempt: str) -> str:
    return f"""CASE WHEN payload_error IS NOT NULL THEN payload_error WHEN {attempt} <= fa THEN
    concat('deliberate failure of attempt ', CAST({attempt} AS VARCHAR), ' (fail_attempts=', CAST(fa AS VARCHAR), ')') END"""


STAMP = r"""concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
    CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE concat('.', rtrim(lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0'), '0')) END, 'Z')"""
EVENT_ROWS = f"""ev AS (
  SELECT id AS run_id, CAST(a AS INTEGER) AS attempt, 0 AS kind, CAST(0 AS BIGINT) AS seq, 'attempt' AS event,
    concat('{{"attempt":', CAST(a AS VARCHAR), '}}') AS data
  FROM (SELECT id, unnest(generate_series(1, attempt)) AS a FROM job_runs)
  UNION ALL
  SELECT l.run_id, l.attempt, 1, l.seq, 'line', concat('{{"attempt":', CAST(l.attempt AS VARCHAR), ',"seq":', CAST(l.seq AS VARCHAR),
    ',"ts":"', {STAMP}, '","level":"', level, '","line":"', line, '"}}')
  FROM lines l JOIN job_runs r ON r.id = l.run_id WHERE l.attempt <= r.attempt
  UNION ALL
  SELECT id, attempt, 2, 0, 'end', concat('{{"attempt":', CAST(attempt AS VARCHAR), ',"error":null,"status":"', status, '"}}')
  FROM job_runs WHERE status IN ('SUCCEEDED', 'FAILED', 'CANCELLED'))"""

SESSIONS = """sessions AS (SELECT run_id, min(ts) AS session_start, max(ts) AS last_heartbeat, count(*) AS beats,
    max(ts) + INTERVAL 6 HOUR AS reap_at FROM (
  SELECT run_id, ts, sum(CASE WHEN gap > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY ts, offset_no) AS island FROM (
    SELECT run_id, ts, offset_no, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY ts, offset_no) AS gap FROM heartbeats))
  GROUP BY run_id, island)"""


def _reltime(ts: str) -> str:
    s = f"CAST(floor(epoch_us({ts} - {AS_OF}) / 1000000.0 + 0.5) AS BIGINT)"
    unit = lambda n, u: f"concat(CAST(CAST(floor(abs({s}) / {n}.0 + 0.5) AS BIGINT) AS VARCHAR), '{u}')"
    amount = f"""CASE WHEN abs({s}) < 60 THEN {unit(1, 's')} WHEN abs({s}) < 3600 THEN {unit(60, 'm')}
      WHEN abs({s}) < 86400 THEN {unit(3600, 'h')} ELSE {unit(86400, 'd')} END"""
    return f"CASE WHEN {ts} IS NULL THEN '–' WHEN {s} > 0 THEN concat('in ', {amount}) ELSE concat({amount}, ' ago') END"


def _fold(timed: bool) -> tuple[str, ...]:
    """One event per step and run: the guards and effects of each kind, row by row.

    ``timed``: what falls due up to the next event, or up to the last event of all, is a step of its own before it.
    """
    due = "CASE s.status WHEN 'RUNNING' THEN s.last_heartbeat_at + INTERVAL 15 SECOND + INTERVAL 1 MICROSECOND WHEN 'QUEUED' THEN s.next_attempt_at END"
    own = f"coalesce({due} <= coalesce(e.\"at\", (SELECT mark FROM clock)), false)" if timed else "false"
    return (
        'numbered AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY "at", tiebreak, kind, worker_id, attempt, message) AS n FROM run_events)',
        """clock AS (SELECT date_trunc('millisecond', max("at")) AS mark FROM run_events)""",
        f"""st AS (
  SELECT r.id, r.status, r.attempt, r.worker_id, r.queued_at, r.started_at, r.finished_at, r.last_heartbeat_at, r.next_attempt_at,
    r.error, r.output, r.job_id, r.scheduled_time, r.trigger, j.max_retries, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS accepted
  FROM job_runs r JOIN jobs j ON j.id = r.job_id
  UNION ALL
  SELECT id,
    CASE WHEN act = 'claim' THEN 'RUNNING' WHEN act = 'finish' THEN 'SUCCEEDED' WHEN act IN ('final', 'lost') THEN 'FAILED'
      WHEN act IN ('release', 'again', 'reap') THEN 'QUEUED' ELSE status END,
    CASE WHEN act IN ('release', 'again', 'reap') THEN attempt + 1 ELSE attempt END,
    CASE WHEN act = 'claim' THEN ew WHEN act IN ('release', 'again', 'reap') THEN NULL ELSE worker_id END,
    CASE WHEN act IN ('release', 'again', 'reap', 'due') THEN "at" ELSE queued_at END,
    CASE WHEN act = 'claim' THEN "at" WHEN act IN ('release', 'again', 'reap') THEN NULL ELSE started_at END,
    CASE WHEN act IN ('finish', 'final', 'lost') THEN "at" WHEN act IN ('claim', 'again', 'reap') THEN NULL ELSE finished_at END,
    CASE WHEN act IN ('claim', 'heartbeat') THEN "at" WHEN act IN ('release', 'again', 'reap') THEN NULL ELSE last_heartbeat_at END,
    CASE WHEN act = 'again' THEN "at" + ({DELAY.format(a='attempt')}) * INTERVAL 1 SECOND WHEN act IN ('claim', 'final', 'due') THEN NULL ELSE next_attempt_at END,
    CASE WHEN act = 'finish' THEN NULL WHEN act IN ('release', 'again', 'final') THEN message WHEN act IN ('reap', 'lost') THEN {LOST} ELSE error END,
    CASE WHEN act = 'finish' THEN message ELSE output END,
    job_id, scheduled_time, trigger, max_retries, en, accepted + CASE WHEN act IS NULL OR own THEN 0 ELSE 1 END
  FROM (SELECT s.*, CASE WHEN {own} THEN {due} ELSE e."at" END AS "at", e.worker_id AS ew, e.message, {own} AS own,
      CASE WHEN {own} THEN s.n ELSE e.n END AS en, CASE
      WHEN {own} THEN CASE WHEN s.status = 'QUEUED' THEN 'due' WHEN s.attempt > s.max_retries THEN 'lost' ELSE 'reap' END
      WHEN e.kind = 'claim' THEN CASE WHEN s.status = 'QUEUED' AND (s.next_attempt_at IS NULL OR s.next_attempt_at <= e."at") THEN 'claim' END
      WHEN s.status = 'RUNNING' AND s.worker_id = e.worker_id AND s.attempt = e.attempt THEN
        CASE WHEN e.kind <> 'fail' THEN e.kind WHEN s.attempt > s.max_retries THEN 'final' ELSE 'again' END END AS act
    FROM st s LEFT JOIN numbered e ON e.run_id = s.id AND e.n = s.n + 1 WHERE e.n IS NOT NULL OR {own}))""",
        "totals AS (SELECT run_id, count(*) AS total FROM run_events GROUP BY run_id)",
        f"""ended AS (SELECT s.*, coalesce(e.total, 0) AS total, {own.replace('e."at"', 'NULL')} AS own
  FROM st s LEFT JOIN totals e ON e.run_id = s.id)""")


FOLD, TIMED = _fold(False), _fold(True)
FOLD_BODY = f"""SELECT {_run_cols()}, accepted, total - accepted AS rejected FROM ended WHERE n = total AND NOT own"""
EXISTING_ERRORS = """existing AS (SELECT * EXCLUDE rn FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, attempt, seq ORDER BY ts, line, level) AS rn FROM job_logs WHERE level = 'error') WHERE rn = 1)"""
APPENDED = """SELECT run_id, attempt, seq, ts, level, line FROM existing UNION ALL
SELECT l.run_id, l.attempt, l.seq, l.ts, l.level, l.line FROM lines l ANTI JOIN existing e USING (run_id, attempt, seq)"""
CLAIM_VALUES = dict(status="'RUNNING'", worker_id="w.claimant", started_at=AS_OF, last_heartbeat_at=AS_OF,
                    finished_at=TS_NULL, next_attempt_at=TS_NULL)
CHECKED = ("""req AS (SELECT id, body, json_valid(body) AS sound,
    CASE WHEN json_valid(body) THEN trim(coalesce(json_extract_string(body, '$.name'), '')) END AS name,
    CASE WHEN json_valid(body) THEN coalesce(json_extract_string(body, '$.type'), '') END AS type,
    CASE WHEN json_valid(body) THEN coalesce(CAST(json_extract(body, '$.payload') AS VARCHAR), '{}') END AS payload,
    CASE WHEN json_valid(body) THEN coalesce(json_extract_string(body, '$.timezone'), 'UTC') END AS timezone,
    CASE WHEN json_valid(body) THEN json_extract_string(body, '$.cron_expr') END AS cron_expr,
    CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.max_retries') AS INTEGER) END AS max_retries,
    CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.timeout_sec') AS INTEGER) END AS timeout_sec
  FROM job_requests)""",
           """checked AS (SELECT *, CASE
    WHEN NOT sound THEN 'invalid JSON body: not one JSON object of the expected types'
    WHEN json_exists(body, '$.owner') THEN 'invalid JSON body: unknown field "owner"'
    WHEN name = '' THEN 'name is required'
    WHEN type = '' THEN 'type is required'
    WHEN type <> 'generate_text' THEN concat('unknown job type "', type, '"')
    WHEN json_type(payload) <> 'OBJECT' OR json_type(payload, '$.lines') NOT IN ('UBIGINT', 'BIGINT')
      THEN 'invalid payload: not a JSON object of the expected types'
    WHEN json_exists(payload, '$.wrap_at') THEN 'invalid payload: unknown field "wrap_at"'
    WHEN coalesce(CAST(json_extract_string(payload, '$.lines') AS INTEGER), 0) NOT BETWEEN 1 AND 100000
      THEN 'payload.lines must be between 1 and 100000'
    WHEN timezone IN ('Europe/Atlantis', 'Local') THEN concat('unknown timezone "', timezone, '"')
    WHEN max_retries NOT BETWEEN 0 AND 10 THEN 'max_retries must be between 0 and 10'
    WHEN timeout_sec NOT BETWEEN 1 AND 86400 THEN 'timeout_sec must be between 1 and 86400' END AS reason FROM req)""")
MD5_4 = "md5(CAST(o_orderkey AS VARCHAR))"

SQL: dict[str, str] = {
    "scan_jobs": _q("jobs", "SELECT * FROM jobs"),
    "scan_runs": _q("job_runs", "SELECT * FROM job_runs"),
    "scan_logs": _q("job_logs", "SELECT * FROM job_logs"),
    "dispatch_decode": _q("dispatch_raw", """SELECT offset_no, partition_no,
  CASE WHEN reject_reason IS NULL THEN json_extract_string(value, '$.run_id') END AS run_id,
  CASE WHEN reject_reason IS NULL THEN json_extract_string(value, '$.job_id') END AS job_id,
  CASE WHEN reject_reason IS NULL THEN json_extract_string(value, '$.job_type') END AS job_type,
  CASE WHEN reject_reason IS NULL THEN CAST(json_extract_string(value, '$.attempt') AS BIGINT) ELSE 0 END AS attempt,
  reject_reason FROM decoded""", DECODED),
    "dispatch_encode": _q("jobs job_runs", """SELECT CAST(id AS VARCHAR) AS key, concat('{"run_id":"', CAST(id AS VARCHAR),
  '","job_id":"', CAST(job_id AS VARCHAR), '","job_type":"', job_type, '","attempt":', CAST(attempt AS VARCHAR), '}') AS value
FROM j WHERE status = 'QUEUED'""", JOINED),
    "log_append": _q("job_logs", APPENDED, LINES, EXISTING_ERRORS),
    "log_unnest": _q("job_logs", "SELECT * FROM lines", LINES),
    "run_output_sink": _q("jobs job_runs", """SELECT run_id, concat(array_to_string(list_transform(generate_series(1, n),
  lambda i: concat('line ', CAST(i AS VARCHAR))), chr(10)), chr(10)) AS output
FROM rp WHERE payload_error IS NULL AND status = 'SUCCEEDED'""", PAYLOADS, RUN_PAYLOADS),
    "create_jobs": _q("jobs job_requests", f"""SELECT c.id, c.name, c.type,
  concat('{{"lines":', json_extract_string(c.payload, '$.lines'), ',"fail_attempts":', json_extract_string(c.payload, '$.fail_attempts'), '}}') AS payload, c.cron_expr, c.timezone, n.next_at AS next_run_at,
  true AS enabled, coalesce(c.max_retries, 3) AS max_retries, coalesce(c.timeout_sec, 300) AS timeout_sec,
  {AS_OF} AS created_at, {AS_OF} AS updated_at
FROM checked c LEFT JOIN nexts n ON n.cron_expr = c.cron_expr AND n.timezone = c.timezone WHERE c.reason IS NULL""",
                      *CHECKED, *NEXT),
    "get_job": _q("jobs reports", """SELECT w.id, j.id IS NOT NULL AS found, j.name, j.type, j.timezone, j.next_run_at
FROM (SELECT DISTINCT run_id AS id FROM reports) w LEFT JOIN jobs j ON j.id = w.id"""),
    "get_run": _q("job_runs reports", """SELECT w.id, r.id IS NOT NULL AS found, r.status, r.worker_id, r.scheduled_time, r.output
FROM (SELECT DISTINCT run_id * 2 AS id FROM reports) w LEFT JOIN job_runs r ON r.id = w.id"""),
    "list_jobs": _q("jobs", "SELECT * FROM jobs ORDER BY created_at DESC, id LIMIT 50"),
    "list_runs": _q("job_runs", "SELECT * FROM job_runs ORDER BY scheduled_time DESC, id LIMIT 50"),
    "list_runs_per_job": _q("job_runs", """SELECT * FROM (SELECT *, CAST(row_number() OVER (
  PARTITION BY job_id ORDER BY scheduled_time DESC, id) AS INTEGER) AS rank FROM job_runs) WHERE rank <= 5"""),
    "log_page": _q("job_runs job_logs", """SELECT run_id, attempt, from_seq, seq, ts, level, line FROM (
  SELECT l.*, r.id % 2 + 1 AS from_seq, row_number() OVER (PARTITION BY l.run_id ORDER BY l.seq) AS rn
  FROM lines l JOIN job_runs r ON r.id = l.run_id AND r.attempt = l.attempt WHERE l.seq >= r.id % 2 + 1) WHERE rn <= 3""", LINES),
    "log_page_cursor": _q("job_runs job_logs", """SELECT a.run_id, a.attempt, a.status, a.from_seq,
  coalesce(string_agg(concat(CAST(p.seq AS VARCHAR), ' ', p.line), '|' ORDER BY p.seq) FILTER (WHERE p.seq IS NOT NULL), '') AS lines,
  coalesce(max(p.seq) + 1, a.from_seq) AS next_seq
FROM asked a LEFT JOIN (SELECT l.*, row_number() OVER (PARTITION BY l.run_id ORDER BY l.seq) AS rn
  FROM lines l JOIN asked q ON q.run_id = l.run_id AND q.attempt = l.attempt AND l.seq >= q.from_seq) p
  ON p.run_id = a.run_id AND p.rn <= 2 GROUP BY a.run_id, a.attempt, a.status, a.from_seq""", LINES,
                          """asked AS (SELECT id AS run_id, CASE WHEN id % 2 = 1 THEN 1 ELSE attempt END AS attempt, status,
  id % 3 + 1 AS from_seq FROM job_runs)"""),
    "log_current_attempt": _q("job_runs job_logs", """SELECT l.* FROM lines l JOIN job_runs r
  ON r.id = l.run_id AND r.attempt = l.attempt""", LINES),
    "status_detail": _q("job_runs", """SELECT run_id, CAST(u.position AS INTEGER) AS position, u.key AS key, u.value AS value FROM (
  SELECT id AS run_id, unnest([
    {'position': 1, 'key': 'run', 'value': CAST(id AS VARCHAR)}, {'position': 2, 'key': 'job', 'value': CAST(job_id AS VARCHAR)},
    {'position': 3, 'key': 'status', 'value': status}, {'position': 4, 'key': 'attempt', 'value': CAST(attempt AS VARCHAR)},
    {'position': 5, 'key': 'trigger', 'value': trigger},
    {'position': 6, 'key': 'scheduled', 'value': strftime(scheduled_time, '%Y-%m-%d %H:%M:%S')},
    {'position': 7, 'key': 'worker', 'value': worker_id}, {'position': 8, 'key': 'started', 'value': strftime(started_at, '%Y-%m-%d %H:%M:%S')},
    {'position': 9, 'key': 'finished', 'value': strftime(finished_at, '%Y-%m-%d %H:%M:%S')},
    {'position': 10, 'key': 'retry at', 'value': strftime(next_attempt_at, '%Y-%m-%d %H:%M:%S')}]) AS u FROM job_runs)
WHERE u.value IS NOT NULL"""),
    "is_final": _q("job_runs", "SELECT id, status, status NOT IN ('QUEUED', 'RUNNING') AS is_final FROM job_runs"),
    "runs_with_job": _q("jobs job_runs", "SELECT id, job_id, status, attempt, job_type, max_retries FROM j", JOINED),
    "update_from": _q("job_runs heartbeats", "SELECT " + _run_cols(
        "r.", queued_at="coalesce(h.seen, r.queued_at)", error="CASE WHEN h.seen IS NOT NULL THEN 'picked' ELSE r.error END")
        + " FROM job_runs r LEFT JOIN (SELECT run_id, max(ts) AS seen FROM heartbeats GROUP BY run_id) h ON h.run_id = r.id"),
    "occurrence_insert": _q("jobs job_runs", "SELECT " + _run_cols(
        id=_md5_id("job_id", "scheduled_time"), trigger="'schedule'", status="'QUEUED'", attempt="CAST(1 AS INTEGER)",
        worker_id=_text_null(), queued_at=AS_OF, started_at=TS_NULL, finished_at=TS_NULL, last_heartbeat_at=TS_NULL,
        next_attempt_at=TS_NULL, error=_text_null(), output=_text_null()) + """ FROM (
  SELECT job_id, scheduled_time FROM job_runs UNION
  SELECT id, next_run_at FROM jobs WHERE next_run_at IS NOT NULL) w
WHERE NOT EXISTS (SELECT 1 FROM job_runs e WHERE e.status <> 'QUEUED' AND e.job_id = w.job_id AND e.scheduled_time = w.scheduled_time)"""),
    "manual_run_insert": _q("jobs job_runs heartbeats", f"""SELECT {_md5_id('job_id', 'scheduled_time')} AS id, job_id, scheduled_time,
  'manual' AS trigger, 'QUEUED' AS status FROM (SELECT DISTINCT run_id * 20 AS job_id, ts AS scheduled_time FROM heartbeats) c
WHERE EXISTS (SELECT 1 FROM jobs j WHERE j.id = c.job_id)
  AND NOT EXISTS (SELECT 1 FROM job_runs r WHERE r.job_id = c.job_id AND r.scheduled_time = c.scheduled_time)
UNION ALL SELECT 0, run_id * 20, ts, 'manual', 'not found' FROM heartbeats
WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.id = run_id * 20)"""),
    "cascade_delete": _q("jobs job_runs job_logs", """SELECT 'jobs' AS table_name, id AS key, count(*) AS n FROM jobs WHERE enabled GROUP BY id
UNION ALL SELECT 'job_runs', id, count(*) FROM kept GROUP BY id
UNION ALL SELECT 'job_logs', run_id, count(*) FROM job_logs WHERE run_id NOT IN (SELECT id FROM gone) GROUP BY run_id""",
                         "gone AS (SELECT r.id FROM job_runs r JOIN jobs j ON j.id = r.job_id WHERE NOT j.enabled)",
                         "kept AS (SELECT id FROM job_runs WHERE id NOT IN (SELECT id FROM gone))"),
    "job_name_lookup": _q("jobs job_runs", """SELECT r.id, r.job_id, coalesce(j.name, left(CAST(r.job_id AS VARCHAR), 8)) AS job_name
FROM job_runs r LEFT JOIN jobs j ON j.id = r.job_id AND j.enabled"""),
    "claim": _q("job_runs dispatch_raw", "SELECT " + _run_cols("r.", **CLAIM_VALUES)
                + f" FROM job_runs r JOIN winners w ON w.run_id = r.id WHERE {CLAIMABLE}", DECODED, WINNERS),
    "heartbeat": _q("job_runs reports", "SELECT " + _run_cols(last_heartbeat_at=AS_OF) + " FROM owned", OWNED),
    "finish": _q("job_runs reports", "SELECT " + _run_cols(
        status="'SUCCEEDED'", output="note", error=_text_null(), finished_at=AS_OF) + " FROM owned", OWNED),
    "release": _q("job_runs reports", "SELECT " + _run_cols(**REQUEUE, error="note") + " FROM owned", OWNED),
    "fail_or_retry": _q("jobs job_runs reports", "SELECT " + _run_cols(**_exhaust(
        "attempt > max_retries", error="note",
        next_attempt_at=f"CASE WHEN attempt > max_retries THEN NULL ELSE {AS_OF} + ({DELAY.format(a='attempt')}) * INTERVAL 1 SECOND END"))
        + " FROM (SELECT o.*, jb.max_retries FROM owned o JOIN jobs jb ON jb.id = o.job_id)", OWNED),
    "fail_queued": _q("job_runs reports", "SELECT " + _run_cols("r.", status="'FAILED'", error="w.note", finished_at=AS_OF)
                      + """ FROM job_runs r JOIN (SELECT run_id, min(note) AS note FROM reports GROUP BY run_id) w
  ON w.run_id = r.id WHERE r.status = 'QUEUED'"""),
    "reap_stale": _q("jobs job_runs", "SELECT " + _run_cols(**_exhaust("attempt > max_retries", error=LOST))
                     + f" FROM j WHERE {STALE}", JOINED),
    "reap_stale_limited": _q("jobs job_runs", "SELECT " + _run_cols(**_exhaust("attempt > max_retries", error=LOST))
                             + f" FROM (SELECT * FROM j WHERE {STALE} ORDER BY last_heartbeat_at, id LIMIT 100)", JOINED),
    "maintenance_snapshot": _q("jobs job_runs", "SELECT " + _run_cols(**_exhaust("attempt > max_retries", error=LOST)) + f" FROM j WHERE {STALE} UNION ALL SELECT "
                               + _run_cols(queued_at=f"CASE WHEN ({RETRY_DUE}) OR ({SWEEP_DUE}) THEN {AS_OF} ELSE queued_at END",
                                           next_attempt_at=f"CASE WHEN {RETRY_DUE} THEN NULL ELSE next_attempt_at END")
                               + f" FROM j WHERE NOT coalesce({STALE}, false)", JOINED),
    "lost_reports": _q("job_runs reports", """SELECT run_id, worker_id, attempt, note FROM reports w WHERE NOT EXISTS (
  SELECT 1 FROM job_runs r WHERE r.id = w.run_id AND r.worker_id = w.worker_id AND r.attempt = w.attempt AND r.status = 'RUNNING')"""),
    "unknown_run_events": _q("run_events", "SELECT run_id, count(*) AS n_events FROM run_events WHERE run_id % 9 = 0 GROUP BY run_id"),
    "fire_errors": _q("jobs", f"""SELECT id AS job_id, 'invalid cron_expr: expected exactly 5 fields, found 3: [now and then]' AS error
FROM jobs WHERE id % 11 = 0 AND enabled AND next_run_at <= {AS_OF}"""),
    "resume_errors": _q("jobs", """SELECT id AS job_id, 'compute next run: invalid cron_expr: expected exactly 5 fields, found 3: [now and then]' AS error
FROM jobs WHERE id % 11 = 0 AND id % 3 > 0"""),
    "sweep_queued": _q("jobs job_runs", "SELECT " + _run_cols(queued_at=AS_OF) + f" FROM j WHERE {SWEEP_DUE}", JOINED),
    "due_retries": _q("jobs job_runs", "SELECT " + _run_cols(queued_at=AS_OF, next_attempt_at=TS_NULL)
                      + f" FROM j WHERE {RETRY_DUE}", JOINED),
    "maintenance_pass": _q("jobs job_runs", f"""SELECT id AS run_id, job_id, job_type, 'QUEUED' AS status,
  CAST(attempt + 1 AS INTEGER) AS attempt, 'reaped' AS source FROM j WHERE {STALE} AND attempt <= max_retries
UNION ALL SELECT id, job_id, job_type, status, attempt, 'retry' FROM j WHERE {RETRY_DUE}
UNION ALL SELECT id, job_id, job_type, status, attempt, 'swept' FROM j WHERE {SWEEP_DUE} AND next_attempt_at IS NULL""", JOINED),
    "maintenance_pass_limited": _q("jobs job_runs", """SELECT id AS run_id, job_id, job_type, 'QUEUED' AS status,
  CAST(attempt + 1 AS INTEGER) AS attempt, 'reaped' AS source FROM reaped WHERE attempt <= max_retries
UNION ALL SELECT id, job_id, job_type, status, attempt, 'retry' FROM retried
UNION ALL SELECT id, job_id, job_type, status, attempt, 'swept' FROM swept""", JOINED,
        f"reaped AS (SELECT * FROM j WHERE {STALE} ORDER BY last_heartbeat_at, id LIMIT 100)",
        f"retried AS (SELECT * FROM j WHERE {RETRY_DUE} ORDER BY next_attempt_at, id LIMIT 100)",
        f"swept AS (SELECT * FROM j WHERE {SWEEP_DUE} AND id NOT IN (SELECT id FROM retried) ORDER BY queued_at, id LIMIT 100)"),
    "state_fold": _q("jobs job_runs run_events", FOLD_BODY, *FOLD, recursive=True),
    "retry_delay": _q("run_events", f"""SELECT run_id, tiebreak, CAST(tiebreak % 40 + 1 AS INTEGER) AS attempt,
  {DELAY.format(a='(tiebreak % 40 + 1)')} AS delay_sec FROM run_events"""),
    "attempt_outcome": _q("run_events", """SELECT run_id, tiebreak, kind,
  CASE WHEN kind = 'finish' THEN 'success' ELSE CASE tiebreak % 4 WHEN 0 THEN 'lost' WHEN 1 THEN 'released' WHEN 2 THEN 'timeout' ELSE 'error' END END AS outcome,
  CASE WHEN kind = 'finish' OR tiebreak % 4 < 2 THEN NULL WHEN tiebreak % 4 = 2 THEN concat('timed out after ', CAST(attempt * 60 AS VARCHAR), 's') ELSE message END AS message
FROM run_events"""),
    "cron_parse": _q("jobs", """SELECT DISTINCT cron_expr, timezone,
  CASE WHEN e THEN '' WHEN cron_expr LIKE '*/15%' THEN '0,15,30,45' WHEN cron_expr LIKE '30 %' THEN '30' ELSE '0' END AS minute,
  CASE WHEN e THEN '' WHEN cron_expr LIKE '0 9%' THEN '9' WHEN cron_expr LIKE '30 8%' THEN '8' WHEN cron_expr LIKE '0 */6%' THEN '0,6,12,18'
    WHEN cron_expr LIKE '0 0%' THEN '0' ELSE array_to_string(generate_series(0, 23), ',') END AS hour,
  CASE WHEN e THEN '' WHEN cron_expr LIKE '0 0 1%' THEN '1' ELSE array_to_string(generate_series(1, 31), ',') END AS dom,
  CASE WHEN e THEN '' ELSE array_to_string(generate_series(1, 12), ',') END AS month,
  CASE WHEN e THEN '' WHEN cron_expr LIKE '%1-5' THEN '1,2,3,4,5' ELSE array_to_string(generate_series(0, 6), ',') END AS dow,
  NOT e AND cron_expr NOT LIKE '0 0 1%' AS dom_star, NOT e AND cron_expr NOT LIKE '%1-5' AS dow_star,
  CAST(CASE WHEN e THEN 30 ELSE 0 END AS BIGINT) AS every_sec, CAST(NULL AS VARCHAR) AS error
FROM (SELECT *, cron_expr LIKE '@every%' AS e FROM jobs WHERE cron_expr IS NOT NULL)"""),
    "duration_seconds": _q("durations", """SELECT id, duration, id % 6 < 4 AS valid, CAST(CASE id % 6 WHEN 0 THEN id % 90
  WHEN 1 THEN (id % 7) * 3600 + (id % 60) * 60 WHEN 2 THEN id / 1000.0 WHEN 3 THEN -((id % 10) * 3600 + 1800) ELSE 0 END AS DOUBLE) AS seconds FROM durations"""),
    "next_run": _q("jobs", "SELECT cron_expr, timezone, next_at AS next_run_at, CAST(NULL AS VARCHAR) AS next_error FROM nexts", *NEXT),
    "occurrences": _q("jobs", f"""SELECT j.id AS job_id, f.tick AS scheduled_time FROM jobs j JOIN fires f USING (cron_expr, timezone)
UNION ALL SELECT id, unnest(generate_series({AS_OF} + INTERVAL 30 SECOND, {AS_OF} + INTERVAL 6 HOUR - INTERVAL 30 SECOND, INTERVAL 30 SECOND))
FROM jobs WHERE cron_expr = '@every 30s'""", *_minute_scan(AS_OF, f"{AS_OF} + INTERVAL 6 HOUR - INTERVAL 1 MINUTE")),
    "due_jobs": _q("jobs", f"SELECT id, type, cron_expr, timezone, next_run_at FROM jobs WHERE {DUE}"),
    "fire_due_jobs": _q("jobs job_runs", f"""SELECT {_md5_id('id', 'next_run_at')} AS run_id, id AS job_id, type AS job_type,
  'QUEUED' AS status, CAST(1 AS INTEGER) AS attempt FROM jobs j WHERE {DUE}
  AND NOT EXISTS (SELECT 1 FROM job_runs r WHERE r.job_id = j.id AND r.scheduled_time = j.next_run_at)"""),
    "fire_due_jobs_schedules": _q("jobs", f"""SELECT id, CASE WHEN {DUE} THEN n.next_at ELSE next_run_at END AS next_run_at,
  CASE WHEN {DUE} THEN {AS_OF} ELSE updated_at END AS updated_at FROM jobs LEFT JOIN nexts n USING (cron_expr, timezone)""", *NEXT),
    "pause_resume": _q("jobs heartbeats", f"""SELECT j.id, CASE WHEN h.run_id IS NULL THEN j.enabled ELSE h.run_id % 2 = 0 END AS enabled,
  CASE WHEN h.run_id IS NULL THEN j.next_run_at WHEN h.run_id % 2 = 0 THEN n.next_at END AS next_run_at,
  CASE WHEN h.run_id IS NULL THEN j.updated_at ELSE {AS_OF} END AS updated_at
FROM jobs j LEFT JOIN (SELECT DISTINCT run_id FROM heartbeats) h ON h.run_id = j.id LEFT JOIN nexts n USING (cron_expr, timezone)""", *NEXT),
    "generate_lines": _q("jobs job_runs", """SELECT run_id, CAST(i AS INTEGER) AS i, concat('line ', CAST(i AS VARCHAR)) AS line FROM (
  SELECT run_id, unnest(generate_series(1, n)) AS i FROM rp WHERE payload_error IS NULL AND status = 'SUCCEEDED')""", PAYLOADS, RUN_PAYLOADS),
    "generate_output": _q("jobs job_runs", """SELECT run_id, concat(array_to_string(list_transform(generate_series(1, n),
  lambda i: concat('line ', CAST(i AS VARCHAR))), chr(10)), chr(10)) AS output FROM rp WHERE payload_error IS NULL""", PAYLOADS, RUN_PAYLOADS),
    "progress_log": _q("jobs job_runs", """SELECT run_id, attempt, row_number() OVER (PARTITION BY run_id ORDER BY step, i) AS seq, level, line FROM (
  SELECT run_id, attempt, 0 AS step, 0 AS i, 'info' AS level, concat('generating ', CAST(n AS VARCHAR), ' lines') AS line FROM rp WHERE payload_error IS NULL
  UNION ALL SELECT run_id, attempt, 1, i, 'info', concat('wrote ', CAST(i AS VARCHAR), '/', CAST(n AS VARCHAR), ' lines')
  FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM rp WHERE payload_error IS NULL) WHERE i % greatest(1, n // 20) = 0 OR i = n
  UNION ALL SELECT run_id, attempt, 2, 0, 'error', concat('failing attempt ', CAST(attempt AS VARCHAR), ' on purpose (fail_attempts=', CAST(fa AS VARCHAR), ')')
  FROM rp WHERE payload_error IS NULL AND attempt <= fa)""", PAYLOADS, RUN_PAYLOADS),
    "expected_outcome": _q("jobs job_runs", f"""SELECT run_id, attempt, error IS NULL AS succeeds, error FROM (
  SELECT run_id, attempt, {_fail_text('attempt')} AS error FROM rp)""", PAYLOADS, RUN_PAYLOADS),
    "attempt_timeline": _q("jobs job_runs", f"""SELECT run_id, a AS attempt, error IS NULL AS succeeds, error, backoff_sec,
  CAST(sum(backoff_sec) OVER (PARTITION BY run_id ORDER BY a) AS INTEGER) AS waited_sec,
  CASE WHEN error IS NULL THEN 'SUCCEEDED' WHEN a = max_retries + 1 THEN 'FAILED' ELSE 'QUEUED' END AS status_after FROM (
  SELECT *, {_fail_text('a')} AS error, CASE WHEN a = 1 THEN 0 ELSE {DELAY.format(a='(a - 1)')} END AS backoff_sec
  FROM (SELECT * EXCLUDE (attempt), CAST(unnest(generate_series(1, max_retries + 1)) AS INTEGER) AS a FROM rp))
WHERE payload_error IS NOT NULL OR a <= fa + 1""", PAYLOADS, RUN_PAYLOADS),
    "log_events": _q("job_runs job_logs", """SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY attempt, kind, seq) AS ord, event, data FROM ev""",
                     LINES, EVENT_ROWS),
    "log_events_resumed": _q("job_runs job_logs", """SELECT ev.run_id, row_number() OVER (PARTITION BY ev.run_id ORDER BY ev.attempt, kind, ev.seq) AS ord, event, data
FROM ev JOIN job_runs r ON r.id = ev.run_id WHERE r.id % 3 = 0 AND ev.attempt >= greatest(1, r.attempt - 1)
  AND (kind <> 1 OR ev.attempt > greatest(1, r.attempt - 1) OR ev.seq >= r.id % 5 + 1)""", LINES, EVENT_ROWS),
    "sse_encode": _q("job_runs job_logs", "SELECT run_id, attempt, kind, seq, concat('event: ', event, chr(10), 'data: ', data, chr(10), chr(10)) AS frame FROM ev",
                     LINES, EVENT_ROWS),
    # Line by line: blank lines seen so far number the blocks.
    "sse_decode": _q("sse_texts", """SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY block) AS INTEGER) AS position, event, data FROM (
  SELECT conv_id, turn, block,
    coalesce(trim(substr(arg_max(line, i) FILTER (WHERE starts_with(line, 'event:')), 7)), '') AS event,
    coalesce(string_agg(regexp_replace(line, '^data: ?', ''), chr(10) ORDER BY i) FILTER (WHERE starts_with(line, 'data:')), '') AS data,
    count(*) FILTER (WHERE starts_with(line, 'data:')) AS n_data, count(*) FILTER (WHERE line = '') AS closed FROM (
    SELECT *, coalesce(sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block
    FROM (SELECT conv_id, turn, generate_subscripts(parts, 1) AS i, unnest(parts) AS line FROM (
      SELECT conv_id, turn, list_transform(string_split(CASE WHEN text LIKE concat('%', chr(10)) THEN left(text, length(text) - 1) ELSE text END, chr(10)),
        lambda x: CASE WHEN x LIKE concat('%', chr(13)) THEN left(x, length(x) - 1) ELSE x END) AS parts FROM sse_texts)))
  GROUP BY conv_id, turn, block) WHERE closed > 0 AND (event <> '' OR n_data > 0)"""),
    "follow_result": _q("job_runs", """SELECT id AS run_id, status = 'SUCCEEDED' AS ok, CASE status WHEN 'SUCCEEDED' THEN NULL
  WHEN 'FAILED' THEN 'run FAILED' ELSE 'stream closed before the run finished' END AS message FROM job_runs"""),
    "relative_time": _q("job_runs", "SELECT id, " + ", ".join(
        f"{_reltime(c)} AS {c}" for c in ("scheduled_time", "queued_at", "started_at", "next_attempt_at")) + " FROM job_runs"),
    "took": _q("job_runs", f"""SELECT id, CASE WHEN started_at IS NULL THEN '–' WHEN s < 60 THEN concat(CAST(s AS VARCHAR), '.0s')
  ELSE concat(CAST(s // 60 AS VARCHAR), 'm ', CAST(s % 60 AS VARCHAR), 's') END AS took
FROM (SELECT *, epoch_us(coalesce(finished_at, {AS_OF}) - started_at) // 1000000 AS s FROM job_runs)"""),
    "schedule_label": _q("jobs", f"""SELECT id, CASE WHEN cron_expr IS NULL THEN 'manual' ELSE concat(cron_expr, ' (', timezone, ')') END AS label,
  CASE WHEN cron_expr IS NULL THEN 'manual' WHEN timezone = 'UTC' THEN cron_expr ELSE concat(cron_expr, ' (', timezone, ')') END AS web_label,
  CASE WHEN cron_expr IS NOT NULL AND NOT enabled THEN 'paused' ELSE {_reltime('next_run_at')} END AS next_label FROM jobs"""),
    "output_preview": """SELECT doc_id, CAST(n AS INTEGER) AS line_count, CASE WHEN n + 1 - 6 > 0 THEN
  concat(array_to_string(string_split(text, chr(10))[1:5], chr(10)), chr(10), '… ', CAST(n - 5 AS VARCHAR), ' more lines') ELSE text END AS preview
FROM (SELECT *, len(string_split(text, chr(10))) - 1 AS n FROM documents)""",
    "run_changes": _q("jobs job_runs", f"""SELECT id, CASE WHEN NOT enabled THEN 'removed' ELSE 'changed' END AS change FROM (
  SELECT r.*, jb.enabled FROM job_runs r JOIN jobs jb ON jb.id = r.job_id) WHERE NOT enabled OR ({STALE})"""),
    "job_request_validate": _q("job_requests", "SELECT id, reason FROM checked", *CHECKED),
    "payload_validate": _q("jobs", """SELECT job_id AS id, payload_error, CASE WHEN payload_error IS NULL THEN 'line' END AS prefix,
  CASE WHEN payload_error IS NULL THEN n ELSE 0 END AS lines, CAST(0 AS INTEGER) AS delay_ms, CAST(0 AS INTEGER) AS fail_at,
  CASE WHEN payload_error IS NULL THEN fa ELSE 0 END AS fail_attempts FROM parsed""", PAYLOADS),
    "uuid_normalize": f"""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 < 2 THEN {_uuid(MD5_4)}
  WHEN o_orderkey % 6 = 2 THEN concat(substr({MD5_4}, 1, 8), '-1234-5678-9abc-', substr({MD5_4}, 1, 12))
  WHEN o_orderkey % 6 < 5 THEN concat(substr({MD5_4}, 1, 8), '-abcd-5678-9abc-', substr({MD5_4}, 1, 12)) END AS uuid FROM orders""",
    "check_audit": _q("jobs job_runs job_logs", """SELECT 'jobs.max_retries' AS rule, CAST(id AS VARCHAR) AS key FROM jobs WHERE max_retries - 1 < 0
UNION ALL SELECT 'jobs.timeout_sec', CAST(id AS VARCHAR) FROM jobs WHERE timeout_sec - 60 <= 0
UNION ALL SELECT 'job_runs.status', CAST(id AS VARCHAR) FROM job_runs WHERE id % 13 = 0
UNION ALL SELECT 'job_runs.trigger', CAST(id AS VARCHAR) FROM job_runs WHERE id % 17 = 0
UNION ALL SELECT 'job_runs.attempt', CAST(id AS VARCHAR) FROM job_runs WHERE attempt - 1 < 1
UNION ALL SELECT 'job_logs.level', concat(run_id, '/', attempt, '/', seq) FROM job_logs WHERE seq = 3"""),
    "unique_audit": _q("job_runs job_logs", """SELECT 'job_runs.occurrence' AS rule,
  concat(CAST(job_id AS VARCHAR), '/', strftime(scheduled_time, '%Y-%m-%d %H:%M:%S.%f')) AS key, count(*) AS copies
FROM job_runs GROUP BY job_id, scheduled_time HAVING count(*) > 1
UNION ALL SELECT 'job_logs.line', concat(run_id, '/', attempt, '/', seq), count(*) FROM job_logs GROUP BY run_id, attempt, seq HAVING count(*) > 1"""),
    "fk_audit": _q("jobs job_runs job_logs", """SELECT 'job_runs.job_id' AS rule, CAST(job_id AS VARCHAR) AS key, count(*) AS orphans
FROM job_runs WHERE job_id NOT IN (SELECT id FROM jobs WHERE enabled) GROUP BY job_id
UNION ALL SELECT 'job_logs.run_id after delete', CAST(run_id AS VARCHAR), count(*) FROM job_logs
WHERE run_id IN (SELECT r.id FROM job_runs r JOIN jobs j ON j.id = r.job_id WHERE NOT j.enabled) GROUP BY run_id"""),
    "child_counts": _q("jobs job_runs job_logs", """SELECT 'job' AS parent, j.id, count(r.id) AS children FROM jobs j LEFT JOIN job_runs r ON r.job_id = j.id GROUP BY j.id
UNION ALL SELECT 'run', r.id, count(l.run_id) FROM job_runs r LEFT JOIN job_logs l ON l.run_id = r.id GROUP BY r.id"""),
    "heartbeat_sessions": _q("heartbeats", "SELECT * FROM sessions", SESSIONS),
    "stream_dispatch": _q("dispatch_raw", """SELECT offset_no, CASE WHEN reject_reason IS NULL THEN json_extract_string(value, '$.run_id') ELSE '' END AS run_id,
  coalesce(reject_reason, '') AS reject_reason FROM decoded""", DECODED),
    "stream_claim": _q("job_runs dispatch_raw", "SELECT " + _run_cols("r.", **{
        c: f"CASE WHEN w.run_id IS NOT NULL AND {CLAIMABLE} THEN {v} ELSE r.{c} END" for c, v in CLAIM_VALUES.items()})
        + " FROM job_runs r LEFT JOIN winners w ON w.run_id = r.id", DECODED, WINNERS),
    "stream_log_append": _q("job_logs", APPENDED, LINES, EXISTING_ERRORS),
    # The watermark counts milliseconds and trails the latest heartbeat by a day.
    "stream_liveness": _q("heartbeats", """SELECT * FROM sessions WHERE reap_at <= (
  SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM heartbeats)""", SESSIONS),
    "stream_liveness_timers": _q("heartbeats", """SELECT run_id, last_heartbeat, reap_at FROM (
  SELECT *, lead(session_start) OVER (PARTITION BY run_id ORDER BY session_start) AS following FROM sessions)
WHERE following IS NOT NULL OR date_trunc('millisecond', reap_at) < (
  SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM heartbeats)""", SESSIONS),
    "stream_state": _q("jobs job_runs run_events", FOLD_BODY, *FOLD, recursive=True),
    "stream_state_timers": _q("jobs job_runs run_events", FOLD_BODY, *TIMED, recursive=True),
    "stream_log_tail": _q("job_runs job_logs", "SELECT run_id, attempt, kind, seq, event, data FROM ev",
                          LINES, EVENT_ROWS),
    "stream_log_tail_cursor": _q("job_runs job_logs", "SELECT run_id, attempt, kind, seq, event, data FROM ev",
                          LINES, EVENT_ROWS),
}
SQL["sse_decode_rows"] = SQL["sse_decode"]
