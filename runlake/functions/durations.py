"""Durations written like ``30s``, ``1h30m`` or ``1.5h``. Arguments and results are SQL text."""

# Units in nanoseconds.
UNIT_NANOS = {
    "ns": 1, "us": 1_000, "µs": 1_000, "μs": 1_000, "ms": 1_000_000,
    "s": 1_000_000_000, "m": 60_000_000_000, "h": 3_600_000_000_000,
}
_PART = f"([0-9]+[.]?[0-9]*|[.][0-9]+)({'|'.join(UNIT_NANOS)})"


def nanos(text: str) -> str:
    """BIGINT nanoseconds, or NULL when ``text`` is not a duration."""
    scale = " ".join(f"WHEN '{unit}' THEN {n}BD" for unit, n in UNIT_NANOS.items())
    terms = (f"zip_with(regexp_extract_all({text}, '{_PART}', 1), regexp_extract_all({text}, '{_PART}', 2), "
             f"(n, u) -> CAST(try_cast(n AS DECIMAL(28, 9)) * CASE u {scale} END AS DECIMAL(38, 0)))")
    total = f"aggregate({terms}, CAST(0 AS DECIMAL(38, 0)), (acc, x) -> CAST(acc + x AS DECIMAL(38, 0)))"
    return (f"CASE WHEN {text} IN ('0', '+0', '-0') THEN 0L WHEN {text} RLIKE '^[+-]?({_PART})+$' "
            f"THEN try_cast({total} * IF({text} LIKE '-%', -1, 1) AS BIGINT) END")


def seconds(text: str) -> str:
    """DOUBLE seconds, or NULL when ``text`` is not a duration."""
    return f"({nanos(text)}) / 1e9D"


def every_seconds(text: str) -> str:
    """Whole seconds of an ``@every`` step: floored, at least one."""
    return f"transform(array({nanos(text)}), n -> IF(n IS NULL, n, greatest(1L, n div 1000000000)))[0]"
