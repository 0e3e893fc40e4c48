"""Validation of job requests."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from runlake import config
from runlake.functions import cron, payload, strict_json, zones
from runlake.operators.keys import pinned
from runlake.operators.schedule import join_pairs

# Request members.
MEMBERS = {"name": "variant", "type": "variant", "payload": "string", "cron_expr": "variant",
           "timezone": "variant", "max_retries": "bigint", "timeout_sec": "bigint"}


class Requests(NamedTuple):
    valid: DataFrame
    rejected: DataFrame


def _text(v: Column) -> Column:
    return F.coalesce(strict_json.text_of(v), F.lit(""))


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def check_requests(requests: DataFrame, as_of: Column, body: str = "body") -> DataFrame:
    """Add the job columns a request asks for, ``next_run_at`` and ``reason``, the first
    rule it breaks or NULL.

    ``requests`` need a unique ``id``. A payload given as null counts as one with
    nothing set. max_retries and timeout_sec stay NULL where not given.
    """
    raw = F.col(body)
    df = requests.withColumn("_m", strict_json.read_whole(raw, ", ".join(f"{k} {v}" for k, v in MEMBERS.items())))
    d = F.col("_m.d")
    shape = F.coalesce(
        F.when(F.octet_length(raw) > config.MAX_BODY_BYTES, F.lit("request body too large")),
        F.when(~F.coalesce(strict_json.is_whole(raw, F.col("_m")) & (d.isNotNull() | (F.trim(raw) == "null")),
                           F.lit(False)), F.lit("not one JSON object of the expected types")),
        F.concat(F.lit('unknown field "'), strict_json.unknown_key(raw, list(MEMBERS)), F.lit('"')),
        *[F.when(~strict_json.is_text(d[k]), F.lit(f"{k} must be a string"))
          for k in ("name", "type", "cron_expr", "timezone")])
    df = df.withColumn("_shape", F.concat(F.lit("invalid JSON body: "), shape))
    # The payload's own text is checked, as ``5.0`` and repeated members must be seen. Reading it as text strips
    # a JSON string of its quotes; what then looks like an object but reads as none was quoted.
    kind = strict_json.read(raw, "payload struct<_none: string>")
    quoted = F.coalesce(kind["_bad"].isNotNull() & F.ltrim(d["payload"]).startswith("{"), F.lit(False))
    # Safe values in every row, so that later rules see no broken member.
    ok = F.col("_shape").isNull()
    df = (df.withColumn("name", F.when(ok, _trim(_text(d["name"]))))
          .withColumn("type", F.when(ok, _text(d["type"])))
          .withColumn("payload", F.when(ok, F.when(quoted, F.lit('""')).otherwise(F.coalesce(d["payload"], F.lit("{}")))))
          .withColumn("timezone", F.when(ok, F.coalesce(F.nullif(_text(d["timezone"]), F.lit("")), F.lit("UTC"))))
          .withColumn("cron_expr", F.when(ok, F.nullif(_trim(_text(d["cron_expr"])), F.lit(""))))
          .withColumn("max_retries", F.when(ok, d["max_retries"]))
          .withColumn("timeout_sec", F.when(ok, d["timeout_sec"])).drop("_m"))
    df = payload.with_payload(df).drop(*payload.PARSED)
    df = df.withColumn("_zone", F.when(~F.expr(zones.is_known("timezone")), F.concat(
        F.lit('unknown timezone "'), F.col("timezone"), F.lit('"'))))
    # The next fire, the dearest rule, is found once per distinct schedule; requests are parsed
    # a second time for that, which costs far less than a search per request.
    df = pinned(df, [c for c in df.columns if c in MEMBERS or c not in requests.columns])
    usable = F.col("cron_expr").isNotNull() & F.col("_zone").isNull()
    pairs = cron.with_next(df.select(F.when(usable, F.col("cron_expr")).alias("cron_expr"),
                                     F.when(usable, F.col("timezone")).alias("timezone")).distinct(), as_of)
    df = join_pairs(df, pairs)

    def outside(name: str, low: int, high: int) -> Column:
        return F.when((F.col(name) < low) | (F.col(name) > high),
                      F.lit(f"{name} must be between {low} and {high}"))

    df = df.withColumn("reason", F.coalesce(
        "_shape", F.when(F.col("name") == "", F.lit("name is required")), "payload_error", "_zone", "next_error",
        outside("max_retries", 0, config.MAX_MAX_RETRIES), outside("timeout_sec", 1, config.MAX_TIMEOUT_SEC)))
    # A rejected number may be beyond INT.
    df = (df.withColumn("max_retries", F.col("max_retries").try_cast("int"))
          .withColumn("timeout_sec", F.col("timeout_sec").try_cast("int")))
    return df.drop("_shape", "payload_error", "_zone", "next_error")


def split_requests(checked: DataFrame) -> Requests:
    return Requests(checked.filter(F.col("reason").isNull()).drop("reason"),
                    checked.filter(F.col("reason").isNotNull()))
