"""Policy limits. Every operator takes the values it needs from here or as an argument."""

from dataclasses import dataclass

# Limits and defaults that results depend on.
MAX_LINES = 100_000
MAX_DELAY_MS = 10_000
MAX_FAIL_ATTEMPTS = 10
DEFAULT_MAX_RETRIES = 3
MAX_MAX_RETRIES = 10
DEFAULT_TIMEOUT_SEC = 300
MAX_TIMEOUT_SEC = 86_400
MAX_BODY_BYTES = 1_048_576
LIST_LIMIT, LIST_LIMIT_MAX = 50, 200
LOG_PAGE_LIMIT, LOG_PAGE_LIMIT_MAX = 500, 1000
LOG_BATCH_LINES = 200
PREVIEW_LINES = 200
DISPATCH_TOPIC = "job-dispatch"


@dataclass(frozen=True)
class Policy:
    """Time limits, in seconds."""

    stale_after: int = 15
    sweep_after: int = 60
    retry_base: int = 5
    retry_cap: int = 300


DEFAULT_POLICY = Policy()
