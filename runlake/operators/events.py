"""The log of a run as an ordered stream of events, and its text encoding."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from runlake.operators.lookup import is_final
from runlake.sources.logs import first_copies

# Rows of one ranking task: lines of one attempt whose seq falls in one block.
BLOCK = 65_536
# Least number of tasks that ranking is dealt to. Their number is given, as adaptive execution judges by compressed bytes
# and would put rows of many times that size into one task's sort.
TASKS = 256
MARKER, LINE, END = 0, 1, 2


def event_json() -> tuple[Column, Column]:
    """Name and JSON of an event by its ``kind``, from ``attempt``, a line's columns, or ``error`` and ``status``."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                     F.regexp_replace(F.regexp_replace(F.date_format("ts", ".SSSSSS"), "0+$", ""), r"^\.$", ""),
                     F.lit("Z"))
    kind = F.col("kind")
    name = F.when(kind == MARKER, "attempt").when(kind == LINE, "line").otherwise("end")
    data = (F.when(kind == MARKER, F.to_json(F.struct("attempt")))
            .when(kind == LINE, F.to_json(F.struct("attempt", "seq", stamp.alias("ts"), "level", "line")))
            .otherwise(F.to_json(F.struct("attempt", "error", "status"), {"ignoreNullFields": "false"})))
    return name, data


def event_rows(runs: DataFrame, logs: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Unordered events (run_id, attempt, kind, seq, event, data).

    ``starts`` (run_id, attempt, from_seq) begins a run at a later point; without
    it a run begins at attempt 1, line 1. ``from_seq`` cuts only the first attempt
    shown. Starts must name an attempt the run has reached.
    """
    state = runs.select(F.col("id").alias("run_id"), F.col("attempt").alias("_current"), "status", "error")
    if starts is not None:
        state = state.join(starts.select("run_id", F.col("attempt").alias("_first"), "from_seq"), "run_id") \
            .filter(F.col("_first").between(1, F.col("_current")) & (F.col("from_seq") >= 1))
    else:
        state = state.withColumn("_first", F.lit(1)).withColumn("from_seq", F.lit(1))
    none = F.lit(0).cast("bigint")
    markers = state.select("run_id", F.explode(F.sequence("_first", "_current")).alias("attempt")).select(
        "run_id", "attempt", F.lit(MARKER).alias("kind"), none.alias("seq"), F.lit("attempt").alias("event"),
        F.to_json(F.struct("attempt")).alias("data"))
    shown = first_copies(logs).join(state.select("run_id", "_first", "from_seq", "_current"), "run_id").filter(
        F.col("attempt").between(F.col("_first"), F.col("_current"))
        & ((F.col("attempt") > F.col("_first")) | (F.col("seq") >= F.col("from_seq"))))
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
                     F.regexp_replace(F.regexp_replace(F.date_format("ts", ".SSSSSS"), "0+$", ""), r"^\.$", ""),
                     F.lit("Z"))
    lines = shown.select(
        "run_id", "attempt", F.lit(LINE).alias("kind"), "seq", F.lit("line").alias("event"),
        F.to_json(F.struct("attempt", "seq", stamp.alias("ts"), "level", "line")).alias("data"))
    ends = state.filter(is_final(F.col("status"))).select(
        "run_id", F.col("_current").alias("attempt"), F.lit(END).alias("kind"), none.alias("seq"),
        F.lit("end").alias("event"),
        F.to_json(F.struct(F.col("_current").alias("attempt"), "error", "status"),
                  {"ignoreNullFields": "false"}).alias("data"))
    return markers.unionByName(lines).unionByName(ends)


def number_in_order(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Add ``ord``, 1.. within each run by (attempt, kind, seq).

    A run may hold most of the lines, so no task ranks a whole run: rows are
    ranked within blocks of bounded size, and the sizes of earlier blocks, a far
    smaller table, are summed up per run and added.
    """
    rows = rows.withColumn("_block", F.floor(F.col("seq") / F.lit(block)))
    place = ["run_id", "attempt", "kind", "_block"]
    tasks = max(TASKS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, *place)
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*place).orderBy("seq")))
    earlier = Window.partitionBy("run_id").orderBy("attempt", "kind", "_block").rowsBetween(
        Window.unboundedPreceding, -1)
    # The last rank of a block is its size; taken from the ranked rows, their exchange is used twice.
    sizes = (ranked.groupBy(*place).agg(F.max("_rank").alias("_n")).repartition(tasks, "run_id")
             .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0).cast("bigint"))))
    return (ranked.join(sizes.drop("_n"), place)
            .withColumn("ord", F.col("_before") + F.col("_rank")).drop("_block", "_rank", "_before"))


def log_events(runs: DataFrame, logs: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(run_id, ord, event, data): attempt markers, each with its lines, then the end of finished runs."""
    return number_in_order(event_rows(runs, logs, starts)).select("run_id", "ord", "event", "data")


def sse_encode(event: Column, data: Column) -> Column:
    return F.concat(F.lit("event: "), event, F.lit("\ndata: "), data, F.lit("\n\n"))


def sse_blocks(text: Column) -> Column:
    """Array of struct(event, data) from event-stream text.

    A blank line closes a block. What follows the last one is incomplete and
    dropped, as are comments, unknown fields and blocks that say nothing.
    """
    lines = F.regexp_replace(text, r"\r(\n|\z)", "\n")
    pieces = F.split(lines, "\n\n+")
    closed = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def block(piece: Column) -> Column:
        rows = F.split(piece, "\n")
        names = F.filter(rows, lambda r: r.startswith("event:"))
        values = F.filter(rows, lambda r: r.startswith("data:"))
        name = F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit(""))
        return F.struct(
            F.regexp_replace(F.substring(name, 7, 2**31 - 1), r"(?U)^\s+|\s+$", "").alias("event"),
            F.array_join(F.transform(values, lambda r: F.regexp_replace(r, "^data: ?", "")), "\n").alias("data"),
            (F.size(values) > 0).alias("has_data"))

    return F.filter(F.transform(closed, block), lambda b: (b["event"] != "") | b["has_data"])


def sse_decode(streams: DataFrame, text: str = "text", keys=("stream_id",)) -> DataFrame:
    """(keys, position, event, data) of each stream text; one row's text is decoded where it is."""
    return (streams.select(*keys, F.posexplode(sse_blocks(F.col(text))).alias("_i", "_b"))
            .select(*keys, (F.col("_i") + 1).alias("position"), "_b.event", "_b.data"))


# Lines and blocks whose running numbers one task makes.
STRETCH = 4096


def _running(df: DataFrame, keys: list[str], at: str, value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the same keys by ``at``, a number from 0 without large gaps.

    Rows are summed within stretches; the stretches' sums, a far smaller table, are added up per key.
    """
    here = [*keys, "_stretch"]
    df = df.withColumn("_stretch", F.floor(F.col(at) / STRETCH)).withColumn("_value", value.cast("bigint"))
    inside = Window.partitionBy(*here).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("_inside", F.sum("_value").over(inside) - F.col("_value"))
    sums = df.groupBy(*here).agg(F.sum("_value").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return (summed.join(sums.drop("_n"), here)
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_stretch", "_value", "_inside", "_before"))


def sse_decode_rows(pieces: DataFrame, text: str = "text", keys=("stream_id",), order: str = "pos") -> DataFrame:
    """(keys, position, event, data) of streams whose text is cut anywhere into rows, numbered 0, 1, 2 ... by ``order``.

    However a text is cut, it decodes as ``sse_decode`` does the whole. Lines are put together from what rows hold of
    them and numbered by the line ends before them; the blank lines before a line number its block. No task
    holds a stream, only a line or a block.
    """
    keys = list(keys)
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    counted = _running(pieces.select(*keys, F.col(order).cast("bigint").alias("_pos"), parts.alias("_parts")), keys, "_pos",
                       F.size("_parts") - 1, "_first")
    cut = counted.select(*keys, "_pos", "_first", (F.size("_parts") - 1).alias("_ends"), F.posexplode("_parts").alias("_i", "_part"))
    lines = cut.groupBy(*keys, (F.col("_first") + F.col("_i")).alias("_line")).agg(
        F.array_sort(F.collect_list(F.struct("_pos", "_part"))).alias("_p"), F.max(F.col("_i") < F.col("_ends")).alias("_ended"))
    lines = lines.select(*keys, "_line", "_ended", F.regexp_replace(
        F.array_join(F.transform("_p", lambda p: p["_part"]), ""), r"\r\z", "").alias("_text"))
    # The last line has no end: it closes no block, and what it says belongs to none.
    lines = _running(lines.filter("_ended"), keys, "_line", F.col("_text") == "", "_block")
    name = F.when(F.col("_text").startswith("event:"), F.struct("_line", F.regexp_replace(
        F.substring("_text", 7, 2**31 - 1), r"(?U)^\s+|\s+$", "").alias("v")))
    value = F.when(F.col("_text").startswith("data:"), F.struct("_line", F.regexp_replace("_text", "^data: ?", "").alias("v")))
    blocks = lines.groupBy(*keys, "_block").agg(
        F.coalesce(F.max(name)["v"], F.lit("")).alias("event"), F.array_sort(F.collect_list(value)).alias("_data"),
        F.max(F.col("_text") == "").alias("_closed"))
    said = F.col("_closed") & ((F.col("event") != "") | (F.size("_data") > 0))
    numbered = _running(blocks.withColumn("_said", said), keys, "_block", F.col("_said"), "_earlier")
    return numbered.filter("_said").select(
        *keys, (F.col("_earlier") + 1).cast("int").alias("position"), "event", F.array_join(F.transform("_data", lambda d: d["v"]), "\n").alias("data"))


def follow_result(runs: DataFrame, events: DataFrame) -> DataFrame:
    """(run_id, ok, message) a follower of each run ends with."""
    fields = F.from_json("data", "attempt int, error string, status string")
    ends = (events.filter(F.col("event") == "end").select("run_id", fields.alias("_end"))
            .groupBy("run_id").agg(F.first("_end").alias("_end")))
    df = runs.select(F.col("id").alias("run_id")).join(ends, "run_id", "left")
    status, error = F.col("_end.status"), F.col("_end.error")
    message = (F.when(F.col("_end").isNull(), F.lit("stream closed before the run finished"))
               .when(status != "SUCCEEDED", F.concat(
                   F.lit("run "), status, F.coalesce(F.concat(F.lit(": "), error), F.lit("")))))
    return df.select("run_id", message.isNull().alias("ok"), message.alias("message"))
