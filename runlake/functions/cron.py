"""Cron expressions as data.

``parse`` turns expression text into typed field sets, ``fires_on`` lists the
fires of one local day and ``next_fire`` finds the first after an instant. Each
is one SQL expression over built-in functions, evaluated on rows of distinct
(expression, zone) pairs. Intermediate values are bound with ``let``: named
columns would be copied into every filter the optimizer pushes below them.
"""

from pyspark.sql import Column, DataFrame, functions as F

from runlake.functions import durations, zones

# Bounds and names of the five fields, and the descriptors.
FIELDS = (
    ("minute", 0, 59, ()),
    ("hour", 0, 23, ()),
    ("dom", 1, 31, ()),
    ("month", 1, 12, ("jan", "feb", "mar", "apr", "may", "jun",
                      "jul", "aug", "sep", "oct", "nov", "dec")),
    ("dow", 0, 6, ("sun", "mon", "tue", "wed", "thu", "fri", "sat")),
)
DESCRIPTORS = {
    "@yearly": "0 0 1 1 *", "@annually": "0 0 1 1 *", "@monthly": "0 0 1 * *",
    "@weekly": "0 0 * * 0", "@daily": "0 0 * * *", "@midnight": "0 0 * * *",
    "@hourly": "0 * * * *",
}
SEARCH_YEARS = 5
# Search windows in days: by tomorrow, within a week, within a month. Tomorrow is always
# searched with today, as a clock set back just after midnight mixes the two.
NEAR_DAYS = (1, 8, 40)
DAY = 86_400


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def struct(**members: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in members.items()) + ")"


def _number(token: str, low: int, names: tuple[str, ...]) -> str:
    plain = f"IF({token} RLIKE '^[+]?[0-9]+$', try_cast({token} AS INT), NULL)"
    if not names:
        return plain
    position = f"find_in_set(lower({token}), '{','.join(names)}')"
    return f"IF({position} > 0, {position} + {low - 1}, {plain})"


def _elements(field: str, low: int, high: int, names: tuple[str, ...]) -> str:
    """Array of struct(start, end, step, star, ok), one per element of a field's list.

    An element is a value, a range or a star, with an optional step; a stepped
    single value runs to the field's upper bound.
    """
    parts = struct(bounds="split(split(t, '/')[0], '-')", slashed="split(t, '/')")
    numbers = struct(
        star="p.bounds[0] IN ('*', '?')", n="size(p.bounds)", m="size(p.slashed)",
        start=f"IF(p.bounds[0] IN ('*', '?'), {low}, {_number('p.bounds[0]', low, names)})",
        last=_number("get(p.bounds, 1)", low, names), step=_number("get(p.slashed, 1)", 0, ()))
    span = struct(
        start="x.start", star="x.star",
        end=f"CASE WHEN x.star OR (x.m = 2 AND x.n = 1) THEN {high} WHEN x.n = 1 THEN x.start WHEN x.n = 2 THEN x.last END",
        step="CASE x.m WHEN 1 THEN 1 WHEN 2 THEN x.step END")
    checked = struct(
        start="e.start", end="e.end", step="e.step", star="e.star AND e.step <= 1",
        ok=f"coalesce(e.step >= 1 AND e.start >= {low} AND e.end <= {high} AND e.start <= e.end, false)")
    steps = f"filter(split({field}, ','), t -> t != '')"
    for name, body in (("t", parts), ("p", numbers), ("x", span), ("e", checked)):
        steps = f"transform({steps}, {name} -> {body})"
    return steps


def parse(text: str) -> str:
    """Struct of the field arrays, dom_star, dow_star, every_sec, zone and error."""
    split_zone = struct(
        zone=f"IF({text} RLIKE '^(CRON_)?TZ=', regexp_extract({text}, '^(?:CRON_)?TZ=([^ ]*)', 1), NULL)",
        body=f"regexp_replace(regexp_replace({text}, '^(CRON_)?TZ=[^ ]*', ''), '^[ \\\\t\\\\n\\\\r]+|[ \\\\t\\\\n\\\\r]+$', '')")
    expanded = struct(zone="a.zone", body="CASE a.body " + " ".join(
        f"WHEN '{k}' THEN '{v}'" for k, v in DESCRIPTORS.items()) + " ELSE a.body END")
    cut = struct(zone="b.zone", body="b.body", named="b.body LIKE '@%'", stepped="b.body LIKE '@every %'",
                 every=f"IF(b.body LIKE '@every %', {durations.every_seconds('substring(b.body, 8)')}, NULL)",
                 parts="IF(b.body LIKE '@%', NULL, split(b.body, '[ \\\\t\\\\n\\\\r]+'))")
    read = struct(zone="c.zone", body="c.body", named="c.named", stepped="c.stepped", every="c.every", parts="c.parts",
                  **{name: _elements(f"get(c.parts, {i})", low, high, names)
                     for i, (name, low, high, names) in enumerate(FIELDS)})
    error = f"""CASE
      WHEN d.zone IS NOT NULL AND d.zone NOT IN ('', 'Local') AND NOT {zones.is_known('d.zone')} THEN concat('provided bad location ', d.zone)
      WHEN d.body = '' THEN 'empty spec string'
      WHEN d.stepped AND d.every IS NULL THEN concat('failed to parse duration ', d.body)
      WHEN d.named AND NOT d.stepped THEN concat('unrecognized descriptor: ', d.body)
      WHEN size(d.parts) != 5 THEN concat('expected exactly 5 fields, found ', size(d.parts), ': [', array_join(d.parts, ' '), ']')
      {' '.join(f"WHEN exists(d.{name}, e -> NOT e.ok) THEN concat('bad {name} field: ', get(d.parts, {i}))"
                for i, (name, *_) in enumerate(FIELDS))} END"""
    sets = {name: f"IF(f.error IS NULL, array_sort(array_distinct(flatten(transform(f.d.{name}, e -> sequence(e.start, e.end, e.step))))), NULL)"
            for name, *_ in FIELDS}
    result = struct(**sets, dom_star="coalesce(exists(f.d.dom, e -> e.star), false)",
                    dow_star="coalesce(exists(f.d.dow, e -> e.star), false)", every_sec="f.d.every",
                    zone="IF(f.error IS NULL, nullif(nullif(f.d.zone, ''), 'Local'), NULL)", error="f.error")
    return let("a", split_zone, let("b", expanded, let("c", cut, let("d", read, let(
        "f", struct(d="d", error=error), result)))))


def minutes_of_day(cron: str) -> str:
    return f"flatten(transform({cron}.hour, h -> transform({cron}.minute, m -> h * 60 + m)))"


def day_matches(day: str, cron: str) -> str:
    by_date = f"array_contains({cron}.dom, dayofmonth({day}))"
    by_weekday = f"array_contains({cron}.dow, dayofweek({day}) - 1)"
    return (f"(array_contains({cron}.month, month({day})) AND IF({cron}.dom_star OR {cron}.dow_star, "
            f"{by_date} AND {by_weekday}, {by_date} OR {by_weekday}))")


def fires_on(day: str, minutes: str, zone: str) -> str:
    """Epoch seconds (an array) at which the local clock of ``zone`` shows ``day`` at ``minutes``.

    The UTC offsets in force around the day are sampled; with one offset every
    local minute happens once. With two, an instant counts only if the zone maps
    it back to the same local time, which drops skipped minutes and keeps both
    passes of repeated ones.
    """
    samples = f"transform(array({-DAY}L, 0L, {DAY}L, {2 * DAY}L), x -> {zones.offset_seconds('s0 + x', zone)})"
    instants = (f"flatten(transform(s.offsets, off -> filter(transform({minutes}, m -> s.start + m * 60 - off), "
                f"inst -> size(s.offsets) = 1 OR {zones.offset_seconds('inst', zone)} = off)))")
    return let("s0", f"unix_date({day}) * {DAY}L", let(
        "s", struct(start="s0", offsets=f"array_distinct({samples})"), instants))


def next_fire(cron: str, expr: str, tz: str, after: str) -> str:
    """Struct(at, error): the first fire strictly after the timestamp ``after``, or why there is none."""
    # A safe zone in every row: an unknown name would fail the whole query.
    known = zones.is_known(f"IF({tz} = '', 'UTC', {tz})")
    place = struct(cron=cron, known=known, after=after)
    local = struct(cron="a.cron", known="a.known", after="a.after",
                   tz=f"IF(a.known, coalesce(a.cron.zone, IF({tz} = '', 'UTC', {tz})), 'UTC')",
                   usable="a.known AND a.cron.error IS NULL AND a.cron.every_sec IS NULL")
    start = struct(b="b", day="to_date(from_utc_timestamp(b.after, b.tz))",
                   minutes=f"IF(b.usable, {minutes_of_day('b.cron')}, NULL)")

    def first(days: str) -> str:
        return (f"array_min(filter(flatten(transform({days}, d -> {fires_on('d', 'c.minutes', 'c.b.tz')})), "
                f"c1 -> c1 * 1000000 > unix_micros(c.b.after)))")

    def matching(last: str) -> str:
        return f"filter(sequence(c.day, {last}), d -> {day_matches('d', 'c.b.cron')})"

    near = ", ".join(first(f"slice({matching(f'date_add(c.day, {n})')}, 1, 3)") for n in NEAR_DAYS)
    far = first(matching(f"make_date(year(c.day) + {SEARCH_YEARS}, 12, 31)"))
    by_step = "date_trunc('second', c.b.after) + make_dt_interval(0, 0, 0, CAST(c.b.cron.every_sec AS DECIMAL(18, 6)))"
    found = struct(c="c", at=f"""CASE WHEN c.b.cron.every_sec IS NOT NULL THEN {by_step}
      WHEN c.b.usable THEN timestamp_seconds(coalesce({near}, {far})) END""")
    error = f"""CASE WHEN NOT g.c.b.known THEN concat('unknown timezone "', {tz}, '"')
      WHEN g.c.b.cron.error IS NOT NULL THEN concat('invalid cron_expr: ', g.c.b.cron.error)
      WHEN g.at IS NULL AND {expr} IS NOT NULL THEN concat('cron_expr "', {expr}, '" never fires') END"""
    return let("a", place, let("b", local, let("c", start, let("g", found, let(
        "h", struct(at="g.at", error=error), struct(at="IF(h.error IS NULL, h.at, NULL)", error="h.error"))))))


def with_next(df: DataFrame, after: Column, expr: str = "cron_expr", tz: str = "timezone") -> DataFrame:
    """Add ``next_run_at`` (first fire strictly after ``after``) and ``next_error`` to each row."""
    fire = F.expr(next_fire(parse(expr), expr, tz, "_after"))
    return (df.withColumn("_after", after).withColumn("_next", fire)
            .withColumn("next_run_at", F.col("_next.at")).withColumn("next_error", F.col("_next.error"))
            .drop("_after", "_next"))
