"""Identifiers."""

from pyspark.sql import Column, functions as F

_DASHED = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
_GROUPS = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"


def dashed(hex32: Column) -> Column:
    return F.regexp_replace(hex32, _GROUPS, "$1-$2-$3-$4-$5")


def normalize_uuid(text: Column) -> Column:
    """Lower-case dashed UUID, or NULL. Accepts the plain, ``urn:uuid:``, wrapped and undashed forms."""
    inner = F.coalesce(
        F.nullif(F.regexp_extract(text, f"^(?:[uU][rR][nN]:[uU][uU][iI][dD]:)?({_DASHED})$", 1), F.lit("")),
        F.nullif(F.regexp_extract(text, rf"^[\x00-\x7F]({_DASHED})[\x00-\x7F]$", 1), F.lit("")),
        F.when(text.rlike("^[0-9a-fA-F]{32}$"), dashed(text)))
    return F.lower(inner)


def occurrence_id(job_id: Column, scheduled_time: Column, kind: str) -> Column:
    """A run's id derived from its unique key, so writing an occurrence twice gives one id.

    ``kind`` is the id column's type: ``string`` gives a UUID text, ``bigint`` 60 bits.
    """
    digest = F.md5(F.concat_ws("|", job_id.cast("string"), F.unix_micros(scheduled_time).cast("string")))
    if kind == "bigint":
        return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return dashed(digest)
