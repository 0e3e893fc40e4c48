"""Retry backoff and how an attempt ends."""

from pyspark.sql import Column, functions as F

from runlake.config import DEFAULT_POLICY, Policy


def delay_seconds(attempt: Column, policy: Policy = DEFAULT_POLICY) -> Column:
    """Backoff after failed attempt ``attempt``: the base, doubled per earlier attempt, capped."""
    doublings = F.greatest(F.lit(0), F.least(attempt - 1, F.lit(30)))
    grown = F.lit(policy.retry_base).cast("bigint") * F.pow(F.lit(2.0), doublings).cast("bigint")
    return F.least(grown, F.lit(policy.retry_cap).cast("bigint")).cast("int")


def plus_seconds(ts: Column, secs: Column) -> Column:
    return ts + F.make_dt_interval(secs=secs.cast("decimal(18,6)"))


def outcome(error: Column, cause: Column, timeout_sec: Column) -> Column:
    """Struct(outcome, message) from an attempt's error and the reason it was stopped."""
    kind = (F.when(error.isNull(), F.lit("success"))
            .when(cause == "lost", F.lit("lost"))
            .when(cause == "shutdown", F.lit("released"))
            .when(cause == "timeout", F.lit("timeout"))
            .otherwise(F.lit("error")))
    message = (F.when(error.isNull() | cause.isin("lost", "shutdown"), F.lit(None).cast("string"))
               .when(cause == "timeout", F.concat(F.lit("timed out after "), timeout_sec.cast("string"), F.lit("s")))
               .otherwise(error))
    return F.struct(kind.alias("outcome"), message.alias("message"))
