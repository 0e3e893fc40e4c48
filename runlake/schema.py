"""Columns and value sets of the three tables and the two record streams."""

# Statuses, triggers and levels.
QUEUED, RUNNING, SUCCEEDED, FAILED, CANCELLED = (
    "QUEUED", "RUNNING", "SUCCEEDED", "FAILED", "CANCELLED")
STATUSES = (QUEUED, RUNNING, SUCCEEDED, FAILED, CANCELLED)
FINAL_STATUSES = (SUCCEEDED, FAILED, CANCELLED)
TRIGGERS = ("schedule", "manual")
LEVELS = ("debug", "info", "warn", "error")
GENERATE_TEXT = "generate_text"

JOBS = {
    "id": "string", "name": "string", "type": "string", "payload": "string",
    "cron_expr": "string", "timezone": "string", "next_run_at": "timestamp",
    "enabled": "boolean", "max_retries": "int", "timeout_sec": "int",
    "created_at": "timestamp", "updated_at": "timestamp",
}
RUNS = {
    "id": "string", "job_id": "string", "scheduled_time": "timestamp",
    "trigger": "string", "status": "string", "attempt": "int",
    "worker_id": "string", "queued_at": "timestamp", "started_at": "timestamp",
    "finished_at": "timestamp", "last_heartbeat_at": "timestamp",
    "next_attempt_at": "timestamp", "error": "string", "output": "string",
}
LOGS = {
    "run_id": "string", "attempt": "int", "seq": "bigint", "ts": "timestamp",
    "level": "string", "line": "string",
}
DISPATCH = {"run_id": "string", "job_id": "string", "job_type": "string", "attempt": "int"}
LOG_KEY = ("run_id", "attempt", "seq")
OCCURRENCE_KEY = ("job_id", "scheduled_time")


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())
