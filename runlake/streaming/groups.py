"""Many keys of a stream as one group of its state.

Spark calls a Python processor once for every group of a batch, with an exchange for each value that it reads or
writes. A group of many keys takes its rows and its state at once, as JSON, so a call costs little for a key. A batch reads
and writes the groups of the keys that it names: choose their number so that a group has some thousand keys. It is
part of the stored state and can't change while a checkpoint is used.
"""

import json
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

GROUPS = 2048
FRAME_ROWS = 10_000


def group_of(key: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("group")


def as_json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


# Made once: ``json.loads`` makes a decoder for every call that names ``parse_float``.
loads = json.JSONDecoder(parse_float=Decimal).decode


def by_key(frames: Iterable[pd.DataFrame], key: str) -> dict:
    """The rows of a group, given as JSON in column ``row``, by key."""
    found = {}
    for frame in frames:
        for text in frame["row"]:
            row = loads(text)
            found.setdefault(row[key], []).append(row)
    return found


def framed(rows: Iterable[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as JSON in column ``row``: a frame of one column costs a group far less than one of many."""
    kept = []
    for row in rows:
        kept.append(json.dumps(dict(zip(columns, row))))
        if len(kept) == FRAME_ROWS:
            yield pd.DataFrame({"row": kept})
            kept = []
    if kept:
        yield pd.DataFrame({"row": kept})


def unframed(found: DataFrame, schema: str) -> DataFrame:
    return found.select(F.from_json("row", schema).alias("r")).select("r.*")
