"""Schemas: discovery, registry merge, type repair, table statistics."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DayTimeIntervalType,
    FractionalType,
    StringType,
    StructField,
    StructType,
)

from telemetry_lake.session import small_frame

REGISTRY_SCHEMA = "table_name string, column_name string, data_type string"

# The type names a stored schema file may use. All others mean string.
LEGACY_TYPES = {
    "int": "int",
    "timestamp": "timestamp",
    "DateType": "date",
    "LongType": "bigint",
    "StringType": "string",
}
LEGACY_NAMES = {"bigint": "LongType", "string": "StringType", "date": "DateType"}
# Spark's own type texts, which a stored schema file may use as well.
TYPE_TEXT = r"^(bigint|boolean|date|double|float|smallint|tinyint|binary|timestamp_ntz|(decimal[(]|array<|map<|struct<).*)$"


def quoted(name: str) -> str:
    """Column reference for a name that may hold dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def type_text(data_type: DataType) -> str:
    """Short type text that reads back as the same type; unusual field names are quoted."""
    if isinstance(data_type, ArrayType):
        return f"array<{type_text(data_type.elementType)}>"
    if isinstance(data_type, StructType):
        plain = re.compile(r"[A-Za-z_]\w*", re.ASCII)
        fields = [
            (f.name if plain.fullmatch(f.name) else quoted(f.name)) + ":" + type_text(f.dataType)
            for f in data_type.fields
        ]
        return f"struct<{','.join(fields)}>"
    return data_type.simpleString()


def schema_rows(table: str, schema: StructType) -> list[tuple[str, str, str]]:
    return [(table, f.name, type_text(f.dataType)) for f in schema.fields]


def discover(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column, type) of tables. Reads footers only, no rows."""
    rows = [row for name, df in tables.items() for row in schema_rows(name, df.schema)]
    return small_frame(spark, rows, REGISTRY_SCHEMA)


def registry_from_json(df: DataFrame, table: str, text: str) -> DataFrame:
    """Registry rows from stored schema files, ``{"column": "type name"}`` per table. A name
    that is neither a known one nor a type text of Spark means string."""
    pairs = F.explode(F.from_json(text, "map<string,string>")).alias("column_name", "type_name")
    known = F.create_map(*[F.lit(v) for pair in LEGACY_TYPES.items() for v in pair])
    named = df.select(F.col(table).alias("table_name"), pairs)
    type_name = F.col("type_name")
    own = F.when(type_name.rlike(TYPE_TEXT), type_name)
    return named.select(
        "table_name",
        "column_name",
        F.coalesce(F.try_element_at(known, type_name), own, F.lit("string")).alias("data_type"),
    )


def registry_to_json(registry: DataFrame) -> DataFrame:
    """One stored schema file's text per table, as ``registry_from_json`` reads it."""
    names = F.create_map(*[F.lit(v) for pair in LEGACY_NAMES.items() for v in pair])
    type_name = F.coalesce(F.try_element_at(names, F.col("data_type")), F.col("data_type"))
    columns = F.collect_list(F.struct("column_name", type_name.alias("type_name")))
    text = F.to_json(F.map_from_entries(F.array_sort(columns)))
    return registry.groupBy("table_name").agg(text.alias("value"))


def type_from_name(name: str) -> DataType:
    """Type for a registry entry: a legacy name, or a Spark type text."""
    try:
        return DataType.fromDDL(LEGACY_TYPES.get(name, name))
    except ParseException:
        return StringType()


def struct_from_registry(columns: Mapping[str, str]) -> StructType:
    """Nullable fields in the registry's order."""
    return StructType([StructField(n, type_from_name(t), True) for n, t in columns.items()])


def widened(old: DataType, new: DataType) -> DataType | None:
    """The old type with the new nested fields added; None if a shared part differs."""
    if old == new:
        return old
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        item = widened(old.elementType, new.elementType)
        return item and ArrayType(item)
    if not (isinstance(old, StructType) and isinstance(new, StructType)):
        return None
    fields = {f.name: f.dataType for f in old.fields}
    for field in new.fields:
        fields[field.name] = widened(fields.get(field.name, field.dataType), field.dataType)
    if None in fields.values() or len({name.lower() for name in fields}) < len(fields):
        return None
    return StructType([StructField(name, t, True) for name, t in fields.items()])


def grown(old: DataType, new: DataType) -> DataType:
    """The old type with all nested fields of the new one that it lacks. A part that both have
    keeps its old type, and a field that differs from another one only in case is left out."""
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(grown(old.elementType, new.elementType))
    if not (isinstance(old, StructType) and isinstance(new, StructType)):
        return old
    fields: dict[str, DataType] = {}
    spelled: set[str] = set()
    for field in [*old.fields, *new.fields]:
        if field.name in fields:
            fields[field.name] = grown(fields[field.name], field.dataType)
        elif field.name.lower() not in spelled:
            fields[field.name] = grown(field.dataType, field.dataType)
        spelled.add(field.name.lower())
    return StructType([StructField(name, t, True) for name, t in fields.items()])


def type_of_variant(text: str) -> DataType:
    """The type of values with this variant schema: a fraction is a double, as is a whole number of up
    to 20 digits among them; whole numbers of more digits are exact decimals."""
    names = {"OBJECT<>": "STRING", "OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}

    def renamed(match: re.Match) -> str:
        token = match[0]
        if not token.startswith("DECIMAL"):
            return names.get(token, token)
        digits, scale = (int(n) for n in re.findall(r"\d+", token))
        return "DECIMAL(38,0)" if scale == 0 and digits > 20 else "DOUBLE"

    tokens = r"`(?:[^`]|``)*`|OBJECT<>?|(?:VARIANT|VOID|DECIMAL\(\d+, ?\d+\))(?!:)"
    return type_from_name(re.sub(tokens, renamed, text))


def fields_of_variant(text: str) -> list[StructField]:
    """The fields of an object's variant schema that have some value in them."""
    # A field that holds nothing but nulls or empty objects gets a type that no JSON value has.
    marked = re.sub(r"`(?:[^`]|``)*`|(?<=: )(?:VOID|OBJECT<>)", lambda m: m[0] if m[0][0] == "`" else "INTERVAL DAY", text)
    empty = {f.name for f in _object_fields(marked) if isinstance(f.dataType, DayTimeIntervalType)}
    return [f for f in _object_fields(text) if f.name not in empty]


def _object_fields(text: str) -> list[StructField]:
    found = type_of_variant(text)
    return found.fields if isinstance(found, StructType) else []


def merge_schema(registry: DataFrame, discovered: DataFrame) -> DataFrame:
    """Registry and discovered schema side by side, and the type to keep.

    ``added``: new column. ``conflict``: other type found, the old one stays.
    ``kept``: column not found this time, never dropped. ``same``: no change.
    """
    keys = ["table_name", "column_name"]
    old = registry.select(*keys, F.col("data_type").alias("old_type"))
    new = discovered.select(*keys, F.col("data_type").alias("new_type"))
    status = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "kept")
        .when(F.col("old_type") != F.col("new_type"), "conflict")
        .otherwise("same")
    )
    return old.join(new, keys, "full_outer").select(
        *keys,
        "old_type",
        "new_type",
        status.alias("status"),
        F.coalesce("old_type", "new_type").alias("data_type"),
    )


def drift(merged: DataFrame) -> DataFrame:
    """The type conflicts of a merge."""
    return merged.where("status = 'conflict'").select(
        "table_name", "column_name", "old_type", "new_type"
    )


def repaired(value: Column, found: str, wanted: str) -> tuple[Column, Column]:
    """A value cast to the wanted type, and a flag for values the cast would lose.

    A number that changes when cast there and back counts as lost, so a fraction is
    never cut off to fit an integer column.
    """
    result = value.try_cast(wanted)
    lost = value.isNotNull() & result.isNull()
    if found in ("bigint", "int", "double", "float") or found.startswith("decimal"):
        if wanted != "string":
            lost = lost | F.coalesce(result.try_cast(found) != value, F.lit(False))
    return result, lost


def whole_from_text(text: Column, wanted: str) -> tuple[Column, Column]:
    """An integer from a number's text, and a flag for texts that are none; ``2.0`` is one."""
    number = text.try_cast("decimal(38,18)")
    result = number.try_cast(wanted)
    return result, text.isNotNull() & F.coalesce(result != number, F.lit(True))


def number_from_text(text: Column, wanted: str) -> tuple[Column, Column]:
    """A number of a type with fractions from its text, and a flag for texts that are none or that the
    type would round: a number has to read back from the result as it was written."""
    result = text.try_cast(wanted)
    whole = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    back = result.cast("string")
    exact = F.when(whole, text.try_cast("decimal(38,0)") == back.try_cast("decimal(38,0)")).when(
        ~text.rlike("[eE]"), text.try_cast("decimal(38,18)") == back.try_cast("decimal(38,18)")
    )
    # With an exponent the text is a double already.
    exact = F.coalesce(exact, text.rlike("[eE]") & ~F.isnan(result.cast("double")))
    return result, text.isNotNull() & (result.isNull() | ~exact)


def nested_in_text(text: Column, wanted: DataType) -> tuple[Column, Column]:
    """A nested value read from JSON text, and whether all it shares with the type fits."""
    corrupt = "_corrupt_record"
    wrapped = StructType([StructField("v", wanted), StructField(corrupt, StringType())])
    # With options given, Spark does not cut the parse down to the field that is used, which
    # would leave the faults of the others unseen.
    parsed = F.from_json(
        F.concat(F.lit('{"v":'), text, F.lit("}")), wrapped, {"mode": "PERMISSIVE"}
    )
    values = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")
    value = parsed.getField("v")
    fits = (F.size(values) == 1) & parsed.getField(corrupt).isNull() & value.isNotNull()
    if has_fractions(wanted):
        rounded = rounded_parts(F.from_json(text, _fractions_as_text(wanted)), wanted)
        fits = fits & ~F.coalesce(rounded, F.lit(False))
    return value, F.coalesce(fits, F.lit(False))


def has_fractions(data_type: DataType) -> bool:
    """Whether a type has a part that may round a number."""
    if isinstance(data_type, ArrayType):
        return has_fractions(data_type.elementType)
    if isinstance(data_type, StructType):
        return any(has_fractions(f.dataType) for f in data_type.fields)
    return isinstance(data_type, FractionalType)


def _fractions_as_text(data_type: DataType) -> DataType:
    if isinstance(data_type, ArrayType):
        return ArrayType(_fractions_as_text(data_type.elementType))
    if isinstance(data_type, StructType):
        return StructType([StructField(f.name, _fractions_as_text(f.dataType), True) for f in data_type.fields])
    return StringType() if isinstance(data_type, FractionalType) else data_type


def rounded_parts(value: Column, wanted: DataType) -> Column:
    """Whether a type would round a number somewhere in a nested value, which has the texts of such
    numbers in their place."""
    if isinstance(wanted, ArrayType) and has_fractions(wanted):
        return F.coalesce(F.exists(value, lambda item: rounded_parts(item, wanted.elementType)), F.lit(False))
    if isinstance(wanted, StructType):
        parts = [rounded_parts(value.getField(f.name), f.dataType) for f in wanted.fields if has_fractions(f.dataType)]
        return reduce(operator.or_, parts, F.lit(False))
    return number_from_text(value, type_text(wanted))[1] if has_fractions(wanted) else F.lit(False)


def _keys(json: Column) -> Column:
    """Number of keys with a value in a compact JSON text."""
    strings = F.regexp_extract_all(json, F.lit(r'"(?:\\.|[^"\\])*+"(:(?!null[,}]))?'), F.lit(1))
    return F.size(F.filter(strings, lambda colon: colon == ":"))


def nested_from_text(text: Column, wanted: DataType) -> tuple[Column, Column]:
    """A nested value from JSON text, and a flag for texts that do not fit as a whole: one
    part has another type or would be rounded, or there is a field that the type does not have."""
    value, fits = nested_in_text(text, wanted)
    whole = _keys(F.to_json(F.try_parse_json(text))) == _keys(F.to_json(value))
    return value, text.isNotNull() & ~(fits & F.coalesce(whole, F.lit(False)))


def repair_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Columns cast to the given types; a value that does not fit becomes NULL."""
    return df.withColumns({n: F.col(quoted(n)).try_cast(t) for n, t in types.items()})


def castable(spark: SparkSession, found: str, wanted: str) -> bool:
    """Whether Spark has a cast between two types at all."""
    probe = spark.range(0).select(F.lit(None).cast(found).alias("v"))
    try:
        probe.select(F.col("v").try_cast(wanted))
    except AnalysisException:
        return False
    return True


def table_stats(spark: SparkSession, paths: Mapping[str, str], at_once: int = 8) -> DataFrame:
    """Row count and column list per table; -1, no columns and the reason if it can't be read.

    Every table is a job of its own, so one that fails does not end the others; up to
    ``at_once`` of them run side by side.
    """

    def stats(name: str) -> tuple[str, int, list[str], str | None]:
        try:
            df = spark.read.parquet(paths[name])
            return name, df.count(), df.columns, None
        except Exception as error:  # whatever keeps a table from being read is its reason
            condition = getattr(error, "getCondition", lambda: None)()
            return name, -1, [], condition or type(error).__name__

    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(stats, paths))
    return small_frame(
        spark, rows, "table_name string, count bigint, columns array<string>, reason string"
    )
