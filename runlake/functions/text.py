"""Text columns shown to people."""

from pyspark.sql import Column, functions as F

DASH = "–"


def _half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def _millis(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(1000)).cast("bigint")


def relative_time(ts: Column, as_of: Column) -> Column:
    """``in 5m`` or ``5m ago``; a dash where ``ts`` is NULL."""
    secs = _half_up((_millis(ts) - _millis(as_of)) / F.lit(1000.0))
    size = F.abs(secs)
    amount = (F.when(size < 60, F.concat(size.cast("string"), F.lit("s")))
              .when(size < 3600, F.concat(_half_up(size / 60.0).cast("string"), F.lit("m")))
              .when(size < 86400, F.concat(_half_up(size / 3600.0).cast("string"), F.lit("h")))
              .otherwise(F.concat(_half_up(size / 86400.0).cast("string"), F.lit("d"))))
    return (F.when(ts.isNull(), F.lit(DASH))
            .when(secs > 0, F.concat(F.lit("in "), amount))
            .otherwise(F.concat(amount, F.lit(" ago"))))


def _tenths(ms: Column) -> Column:
    """Tenths of a second nearest to the double ``ms / 1000`` (``ms`` >= 0).

    A tie between two tenths goes by which side of the tie the double lies on:
    splitting it in two halves makes its product with 1000 exact.
    """
    d = ms / F.lit(1000.0)
    scaled = d * 134217729.0
    head = scaled - (scaled - d)
    error = (head * 1000.0 - d * 1000.0) + (d - head) * 1000.0
    above = (d * 1000.0 - ms) + error >= 0
    low = F.floor(ms / F.lit(100)).cast("bigint")
    rest = ms % 100
    return low + F.when(rest > 50, 1).when((rest == 50) & above, 1).otherwise(0)


def took(started: Column, finished: Column, as_of: Column) -> Column:
    """Run time as ``12.3s`` or ``2m 5s``; seconds of a minute may round up to 60."""
    ms = _millis(F.coalesce(finished, as_of)) - _millis(started)
    tenths = _tenths(F.abs(ms))
    short = F.concat(F.when(ms < 0, F.lit("-")).otherwise(F.lit("")),
                     F.floor(tenths / F.lit(10)).cast("string"), F.lit("."),
                     (tenths % 10).cast("string"), F.lit("s"))
    secs = ms / F.lit(1000.0)
    long = F.concat(F.floor(secs / 60.0).cast("string"), F.lit("m "),
                    _half_up(secs % 60.0).cast("string"), F.lit("s"))
    return F.when(started.isNull(), F.lit(DASH)).when(secs < 60, short).otherwise(long)


def schedule_label(cron_expr: Column, timezone: Column, hide_utc: bool = False) -> Column:
    zone = F.concat(F.lit(" ("), timezone, F.lit(")"))
    if hide_utc:
        zone = F.when((timezone != "UTC") & (timezone != ""), zone).otherwise(F.lit(""))
    return F.when(cron_expr.isNull(), F.lit("manual")).otherwise(F.concat(cron_expr, zone))


def next_label(cron_expr: Column, enabled: Column, next_run_at: Column, as_of: Column) -> Column:
    return (F.when(cron_expr.isNotNull() & ~enabled, F.lit("paused"))
            .otherwise(relative_time(next_run_at, as_of)))


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def output_preview(text: Column, keep: int) -> Column:
    """The first ``keep`` lines and how many more there are (a final newline is not a line)."""
    more = line_count(text) + 1 - (keep + 1)
    head = F.substring_index(text, "\n", keep)
    return F.when(more > 0, F.concat(
        head, F.lit("\n… "), more.cast("string"), F.lit(" more lines"))).otherwise(text)
