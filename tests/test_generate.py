import json

import pytest
from helpers import as_of, jobs, row, runs
from pyspark.sql import functions as F

from runlake import config
from runlake.functions import payload
from runlake.operators import generate, inserts, validate
from runlake.operators.lookup import status_detail
from runlake.schema import GENERATE_TEXT

def around(low, high):
    """(value, allowed) on and beside both limits."""
    return [(low - 1, False), (low, True), (high, True), (high + 1, False)]


def payload_cases():
    """(type, payload, accepted): every member around its limits, then wrong shapes."""
    kind = GENERATE_TEXT
    yield from ((kind, json.dumps({"lines": n}), ok) for n, ok in around(1, config.MAX_LINES))
    yield from ((kind, json.dumps({"lines": 7, "delay_ms": n}), ok) for n, ok in around(0, config.MAX_DELAY_MS))
    yield from ((kind, json.dumps({"lines": 7, "fail_at": n}), ok) for n, ok in around(0, 7))
    yield from ((kind, json.dumps({"lines": 7, "fail_attempts": n}), ok) for n, ok in around(0, config.MAX_FAIL_ATTEMPTS))
    yield kind, json.dumps({"lines": 2**40}), False
    for body in ("", "{", "null", "17", "[]", '"{\\"lines\\": 7}"', "{}", "{'lines': 7}", '{"lines": 7.0}', '{"lines": "7"}', '{"lines": 07}',
                 '{"lines": 7, "colour": 1}', '{"lines": 7, "prefix": []}'):
        yield kind, body, False
    # What follows the payload's object isn't read.
    for body in ('{"lines": 7} 7', '{"lines": 7, "prefix": null}', '{"lines": 0, "lines": 7}', ' {"lines": 7, "prefix": "é"} '):
        yield kind, body, True
    for other in ("", kind.upper(), "print_text"):
        yield other, '{"lines": 7}', False


CASES = list(payload_cases())


@pytest.fixture(scope="module")
def verdicts(spark):
    df = spark.createDataFrame([(i, t, p) for i, (t, p, _) in enumerate(CASES)], "i int, type string, payload string")
    return {r.i: r for r in payload.with_payload(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_payloads(verdicts, i):
    assert (verdicts[i].payload_error is None) == CASES[i][2], (CASES[i], verdicts[i].payload_error)


def made(spark, attempt=1, max_retries=3, **body):
    return generate.with_run_payload(runs(spark, dict(attempt=attempt)), jobs(spark, dict(payload=json.dumps(body), max_retries=max_retries)))


@pytest.mark.parametrize("body,want", [
    (dict(lines=3, prefix="row"), "row 1\nrow 2\nrow 3\n"), (dict(lines=2), "line 1\nline 2\n"),
    (dict(lines=2, prefix="行"), "行 1\n行 2\n"), (dict(lines=1, prefix=""), "line 1\n")])
def test_output_and_lines(spark, body, want):
    assert row(generate.generate_output(made(spark, **body))).output == want
    lines = sorted((r.i, r.line) for r in generate.generate_lines(made(spark, **body)).collect())
    assert [l for _, l in lines] == want.splitlines() and [i for i, _ in lines] == list(range(1, len(lines) + 1))


# Written out by hand.
LOGS = [
    (dict(lines=3), 1, ["generating 3 lines", "wrote 1/3 lines", "wrote 2/3 lines", "wrote 3/3 lines"]),
    (dict(lines=4, fail_at=2), 1, ["generating 4 lines", "wrote 1/4 lines", "failing on purpose after 2 lines"]),
    (dict(lines=2, fail_at=1), 3, ["generating 2 lines", "failing on purpose after 1 lines"]),
    (dict(lines=1, fail_attempts=2), 2, ["generating 1 lines", "wrote 1/1 lines", "failing attempt 2 on purpose (fail_attempts=2)"]),
    (dict(lines=1, fail_attempts=2), 3, ["generating 1 lines", "wrote 1/1 lines"]),
    (dict(lines=2, fail_attempts=1, fail_at=2), 1, ["generating 2 lines", "wrote 1/2 lines", "failing on purpose after 2 lines"]),
    (dict(lines=45), 1, ["generating 45 lines", "wrote 2/45 lines", "wrote 4/45 lines", "wrote 6/45 lines", "wrote 8/45 lines", "wrote 10/45 lines",
                         "wrote 12/45 lines", "wrote 14/45 lines", "wrote 16/45 lines", "wrote 18/45 lines", "wrote 20/45 lines", "wrote 22/45 lines",
                         "wrote 24/45 lines", "wrote 26/45 lines", "wrote 28/45 lines", "wrote 30/45 lines", "wrote 32/45 lines", "wrote 34/45 lines",
                         "wrote 36/45 lines", "wrote 38/45 lines", "wrote 40/45 lines", "wrote 42/45 lines", "wrote 44/45 lines", "wrote 45/45 lines"])]


@pytest.mark.parametrize("body,attempt,want", LOGS)
def test_progress_log(spark, body, attempt, want):
    got = sorted((r.seq, r.line) for r in generate.progress_log(made(spark, attempt, **body)).collect())
    assert got == list(enumerate(want, 1))


@pytest.mark.parametrize("body,attempt,want", [
    (dict(lines=3, fail_at=3), 1, "after 3 lines"), (dict(lines=5, fail_at=2), 1, "after 2 lines"), (dict(lines=2, fail_attempts=2), 1, "attempt 1"),
    (dict(lines=2, fail_attempts=2), 2, "attempt 2"), (dict(lines=2, fail_attempts=2), 3, None), (dict(lines=0), 1, "payload.lines")])
def test_expected_outcome(spark, body, attempt, want):
    got = row(generate.expected_outcome(made(spark, attempt, **body)))
    assert got.succeeds == (want is None) and (want is None or want in got.error)


def test_attempt_timeline(spark):
    rows = lambda **b: [(r.attempt, r.succeeds, r.backoff_sec, r.waited_sec, r.status_after)
                        for r in sorted(generate.attempt_timeline(made(spark, **b)).collect(), key=lambda r: r.attempt)]
    assert rows(lines=1, fail_attempts=2) == [(1, False, 0, 0, "QUEUED"), (2, False, 5, 5, "QUEUED"), (3, True, 10, 15, "SUCCEEDED")]
    assert rows(lines=1, fail_at=1, max_retries=1) == [(1, False, 0, 0, "QUEUED"), (2, False, 5, 5, "FAILED")]
    assert rows(lines=1) == [(1, True, 0, 0, "SUCCEEDED")]


def request(**members):
    """A request body; a member given as None is left out."""
    body = dict(name="nightly", type=GENERATE_TEXT, payload={"lines": 2}) | members
    return json.dumps({k: v for k, v in body.items() if v is not None})


# Bodies to refuse, and a word of the reason.
REFUSED = [
    (request()[:-1], "body"), (request() + "[]", "body"), ("[]", "body"), (request(owner="me"), "owner"),
    *[(request(name=n), "name") for n in (None, "", "\t ", 17)], *[(request(type=t), "type") for t in (None, "", 17)],
    (request(type="print_text"), "print_text"), (request(payload=None), "lines"), (request(payload=[2]), "payload"),
    (request(payload='{"lines": 2}'), "payload"), (request(payload={"lines": 2, "colour": 1}), "colour"),
    *[(request(payload={"lines": n}), "lines") for n, ok in around(1, config.MAX_LINES) if not ok],
    *[(request(payload={"lines": 2, "delay_ms": n}), "delay_ms") for n, ok in around(0, config.MAX_DELAY_MS) if not ok],
    (request().replace("2}", "2.0}"), "payload"), (request(cron_expr="often"), "cron_expr"),
    *[(request(timezone=z), "timezone") for z in ("Moon/Crater", "Local")],
    *[(request(max_retries=n), "max_retries") for n, ok in around(0, config.MAX_MAX_RETRIES) if not ok],
    *[(request(timeout_sec=n), "timeout_sec") for n, ok in around(1, config.MAX_TIMEOUT_SEC) if not ok],
    (request(max_retries=99_999_999_999), "max_retries"), (request(timeout_sec=-99_999_999_999), "timeout_sec"),
    (request(payload={"lines": 2, "prefix": "p" * config.MAX_BODY_BYTES}), "too large"),
]
ACCEPTED = [("max_retries", n) for n, ok in around(0, config.MAX_MAX_RETRIES) if ok] + [
    ("timeout_sec", n) for n, ok in around(1, config.MAX_TIMEOUT_SEC) if ok]


@pytest.fixture(scope="module")
def checked(spark):
    bodies = [b for b, _ in REFUSED] + [request(**{k: v}) for k, v in ACCEPTED] + [
        request(cron_expr=" 0 */6 * * * ").replace('"lines": 2', '"lines": 0, "lines": 2')]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    return validate.check_requests(df, as_of()).cache()


@pytest.mark.parametrize("i", range(len(REFUSED)))
def test_refused_requests(checked, i):
    reason = row(checked.filter(F.col("id") == i)).reason
    assert reason and REFUSED[i][1] in reason


def test_refused_requests_can_be_kept_with_all_their_columns(checked):
    rejected = validate.split_requests(checked).rejected.collect()
    assert len(rejected) == len(REFUSED) and {r.max_retries for r in rejected if "max_retries" in r.reason} == {-1, config.MAX_MAX_RETRIES + 1, None}


def test_accepted_requests_get_their_defaults(checked):
    made_jobs = {r.id: r for r in inserts.create_jobs(validate.split_requests(checked).valid, as_of()).collect()}
    assert set(made_jobs) == set(range(len(REFUSED), len(REFUSED) + 5))
    for n, (key, value) in enumerate(ACCEPTED):
        r = made_jobs[len(REFUSED) + n]
        assert r[key] == value and (r.timezone, r.enabled, r.cron_expr, r.next_run_at) == ("UTC", True, None, None)
        assert (r.max_retries, r.timeout_sec) == (value if key == "max_retries" else 3, value if key == "timeout_sec" else 300)
    r = made_jobs[len(REFUSED) + 4]
    assert r.cron_expr == "0 */6 * * *" and str(r.next_run_at) == "2026-09-17 12:00:00"


def test_status_detail_leaves_out_absent_values(spark):
    got = {r.key: r.value for r in status_detail(runs(spark, dict(output="a\nb\n", status="SUCCEEDED"))).collect()}
    assert got["output"] == "2 lines" and "worker" not in got and "error" not in got
