"""The ``generate_text`` payload: strict parsing, range rules and expected results."""

from pyspark.sql import Column, DataFrame, functions as F

from runlake import config
from runlake.functions import strict_json
from runlake.operators.keys import pinned
from runlake.schema import GENERATE_TEXT

# Payload members.
MEMBERS = {"lines": "bigint", "prefix": "variant", "delay_ms": "bigint",
           "fail_at": "bigint", "fail_attempts": "bigint"}
PARSED = ("lines", "prefix", "delay_ms", "fail_at", "fail_attempts")


def with_payload(df: DataFrame, job_type: str = "type", payload: str = "payload") -> DataFrame:
    """Add the typed members and ``payload_error``, the first rule that fails or NULL.

    Members are NULL wherever ``payload_error`` is set.
    """
    text = F.col(payload)
    df = df.withColumn("_p", strict_json.read(text, ", ".join(f"{k} {v}" for k, v in MEMBERS.items())))
    df = df.withColumn("_extra", strict_json.unknown_key(text, list(MEMBERS)))
    p = F.col("_p")
    # A JSON null decodes to a payload with nothing set.
    is_null = F.trim(text) == "null"
    number = {k: F.coalesce(p[k], F.lit(0)) for k in MEMBERS if k != "prefix"}

    def outside(name: str, high) -> Column:
        return (number[name] < 0) | (number[name] > high)

    error = F.coalesce(
        F.when(F.col(job_type) == "", F.lit("type is required")),
        F.when(F.col(job_type) != GENERATE_TEXT,
               F.concat(F.lit('unknown job type "'), F.col(job_type), F.lit('"'))),
        F.when(~is_null & (p["_bad"].isNotNull() | p.isNull()),
               F.lit("invalid payload: not a JSON object of the expected types")),
        F.when(F.col("_extra").isNotNull(),
               F.concat(F.lit('invalid payload: unknown field "'), F.col("_extra"), F.lit('"'))),
        F.when(~strict_json.is_text(p["prefix"]), F.lit("invalid payload: prefix must be a string")),
        F.when((number["lines"] < 1) | (number["lines"] > config.MAX_LINES),
               F.lit(f"payload.lines must be between 1 and {config.MAX_LINES}")),
        F.when(outside("delay_ms", config.MAX_DELAY_MS),
               F.lit(f"payload.delay_ms must be between 0 and {config.MAX_DELAY_MS}")),
        F.when(outside("fail_at", number["lines"]), F.concat(
            F.lit("payload.fail_at must be between 0 and lines ("),
            number["lines"].cast("string"), F.lit(")"))),
        F.when(outside("fail_attempts", config.MAX_FAIL_ATTEMPTS),
               F.lit(f"payload.fail_attempts must be between 0 and {config.MAX_FAIL_ATTEMPTS}")))
    df = df.withColumn("payload_error", error)
    ok = F.col("payload_error").isNull()
    for name in PARSED:
        value = (F.coalesce(F.nullif(strict_json.text_of(p["prefix"]), F.lit("")), F.lit("line"))
                 if name == "prefix" else number[name].cast("int"))
        df = df.withColumn(name, F.when(ok, value))
    return pinned(df.drop("_p", "_extra"), ["payload_error", *PARSED])


def expected_error(attempt: Column) -> Column:
    """The error attempt number ``attempt`` must end with, or NULL for success."""
    return F.coalesce(
        F.col("payload_error"),
        F.when(F.col("fail_at") > 0, F.concat(
            F.lit("deliberate failure after "), F.col("fail_at").cast("string"), F.lit(" lines (fail_at)"))),
        F.when(attempt <= F.col("fail_attempts"), F.concat(
            F.lit("deliberate failure of attempt "), attempt.cast("string"),
            F.lit(" (fail_attempts="), F.col("fail_attempts").cast("string"), F.lit(")"))))
