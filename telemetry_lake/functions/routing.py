"""Which table a landing file or a landing line belongs to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File name patterns, group 1 is the table.
NAME_PATTERN = r"^(.+)_\d+_\d+\.json"
NAME_PATTERN_NO_DIGITS = r"^(\D+)_\d+_\d+\.json"

# Fixed value: key of a line without a readable table name.
NO_TABLE = "no_table_name_error"


def table_of_name(name: Column, pattern: str = NAME_PATTERN) -> Column:
    """Table part of a landing file name; NULL when the name cannot be routed.

    The pattern is anchored at the start only and its table part is greedy, so
    ``t_1_2_3.json`` goes to ``t_1``.
    """
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))


def file_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def decoded_name(metadata_name: Column) -> Column:
    """Plain file name from ``_metadata.file_name``, which is percent-encoded."""
    return F.url_decode(F.replace(metadata_name, F.lit("+"), F.lit("%2B")))


def table_field(line: Column, field: str) -> Column:
    """Value of ``field`` in a line holding exactly one JSON object, else NULL.

    Reading the line as the only element of an array makes trailing text, a second
    object or a cut-off object count as malformed, which a plain path lookup does not.
    """
    key = field.replace("`", "``")
    parsed = F.from_json(
        F.concat(F.lit("["), line, F.lit("]")),
        f"array<struct<`{key}`:string>>",
        {"allowSingleQuotes": "false"},
    )
    # Inside transform the parsed line has a name, so it is parsed once for both uses.
    found = F.transform(
        F.array(parsed),
        lambda objects: F.when(F.size(objects) == 1, F.get(objects, F.lit(0)).getField(field)),
    )
    return F.get(found, F.lit(0))


def table_or_line(line: Column, field: str) -> Column:
    """Table name of a line; a line without one stands for itself."""
    return F.coalesce(table_field(line, field), line)


def table_key(line: Column, field: str) -> Column:
    """Table name of a line; lines without one share the key ``NO_TABLE``."""
    return F.coalesce(table_field(line, field), F.lit(NO_TABLE))


def is_line_of(line: Column, field: str, table: str) -> Column:
    """True for the lines of ``table``; false for others and for malformed lines."""
    return F.coalesce(table_field(line, field) == F.lit(table), F.lit(False))
