"""JSON reading that refuses what a strict decoder refuses.

``from_json`` alone ignores keys outside the schema and anything after the first
value. Both are checked here with built-in expressions.
"""

from pyspark.sql import Column, functions as F

_OPTIONS = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false",
            "allowNumericLeadingZeros": "false"}


def read(text: Column, fields: str) -> Column:
    """Struct of ``fields`` plus ``_bad`` (not NULL when types or syntax are wrong)."""
    return F.from_json(text, f"{fields}, _bad string", _OPTIONS)


def wrap(text: Column) -> Column:
    """The text as member ``d`` of an object closed by a sentinel member ``z``."""
    return F.concat(F.lit('{"d":'), text, F.lit(',"z":1}'))


def read_whole(text: Column, fields: str) -> Column:
    """As ``read``, for a text that must hold one object and nothing after it.

    The result has members ``d``, ``z`` and ``_bad``; test it with ``is_whole``.
    """
    return read(wrap(text), f"d struct<{fields}>, z int")


def is_whole(text: Column, parsed: Column) -> Column:
    return (parsed["_bad"].isNull() & parsed["z"].eqNullSafe(1)
            & F.json_object_keys(wrap(text)).eqNullSafe(F.array(F.lit("d"), F.lit("z"))))


def unknown_key(text: Column, known: list[str]) -> Column:
    """The first key not in ``known``, or NULL."""
    extra = F.filter(F.json_object_keys(text), lambda k: ~k.isin(known))
    return F.try_element_at(extra, F.lit(1))


def is_text(variant: Column) -> Column:
    """True where a VARIANT member is absent, null or a string."""
    kind = F.schema_of_variant(variant)
    return variant.isNull() | kind.isin("STRING", "VOID")


def text_of(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "string")
