"""Time zone names and UTC offsets, as SQL text."""

from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def known_zones() -> str:
    """IANA names the engine can evaluate, as one comma-separated text: a fixed set of about 600."""
    ids = SparkSession.active()._jvm.java.time.ZoneId.getAvailableZoneIds()
    return ",".join(sorted({z for z in ids if not z.startswith("SystemV/")} | {"EST", "MST", "HST"}))


def is_known(zone: str) -> str:
    return f"coalesce({zone} != '' AND find_in_set({zone}, '{known_zones()}') > 0, false)"


def offset_seconds(utc_seconds: str, zone: str) -> str:
    """Local minus UTC, in seconds, at an instant given in epoch seconds."""
    return f"unix_seconds(from_utc_timestamp(timestamp_seconds({utc_seconds}), {zone})) - ({utc_seconds})"
