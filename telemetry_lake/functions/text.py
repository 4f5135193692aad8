"""Text and JSON-text operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from telemetry_lake.operators.quality import number_from_text, quoted, whole_from_text


def explode_json_array(df: DataFrame, text: str, element: DataType | str) -> DataFrame:
    """One row per element of the JSON array in ``text``; struct fields become columns.

    The other columns are kept.
    """
    ddl = element if isinstance(element, str) else element.simpleString()
    kept = [c for c in df.columns if c != text]
    items = df.select(*kept, F.explode(F.from_json(text, f"array<{ddl}>")).alias("element"))
    if ddl.startswith("struct"):
        return items.select(*kept, "element.*")
    return items


def explode_any_array(
    df: DataFrame, text: str, element: str = "element", position: str = "position"
) -> DataFrame:
    """One row per element of the JSON array in ``text``, whatever its elements are: each one
    is a VARIANT of its own, with its place in the array from 0.

    A text that is null, malformed or no array gives no row; a null element is a row. The other
    columns are kept.
    """
    kept = [quoted(c) for c in df.columns if c != text]
    value = F.try_parse_json(F.col(quoted(text)))
    items = F.try_variant_get(value, "$", "array<variant>")
    return df.select(*kept, F.posexplode(items).alias(position, element))


def with_fields(df: DataFrame, variant: str, fields: Mapping[str, str]) -> DataFrame:
    """Add fields of the objects in a VARIANT column, by name and type. A value that is no object,
    lacks the field or holds something that the type would change gives NULL."""
    columns = {}
    for name, wanted in fields.items():
        path = "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        value = F.try_variant_get(variant, path, wanted)
        text = F.try_variant_get(variant, path, "string")
        columns[name] = value if wanted == "string" else F.when(exact_text(text, wanted), value)
    return df.withColumns(columns)


def exact_text(text: Column, wanted: str) -> Column:
    """Whether a type keeps what a text says; any text fits a type that is no number."""
    if wanted in ("tinyint", "smallint", "int", "bigint"):
        return ~whole_from_text(text, wanted)[1]
    if wanted in ("float", "double") or wanted.startswith("decimal"):
        return ~number_from_text(text, wanted)[1]
    return F.lit(True)


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each piece of ``text`` between single spaces."""
    return (
        df.select(F.explode(F.split(text, " ")).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def to_json_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON text, in a column ``value`` that a text sink accepts."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
