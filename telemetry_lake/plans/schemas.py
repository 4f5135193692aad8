"""Schema checks against a lake's registry."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, replace
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators.quality import (
    grown,
    registry_from_json,
    registry_to_json,
    schema_rows,
    type_from_name,
    type_text,
    widened,
)
from telemetry_lake.plans.lake import DRIFT_SCHEMA, ENTRY_SCHEMA, Lake
from telemetry_lake.session import literal_path


@dataclass(frozen=True)
class ColumnCheck:
    """One column of the registry next to what was found; ``data_type`` is the type to keep."""

    table_name: str
    column_name: str
    old_type: str | None
    new_type: str | None
    status: str
    data_type: str


def record_schemas(
    spark: SparkSession,
    lake: Lake,
    batch: str,
    found: list[tuple[str, str, str]],
    known: list[tuple[str, str, str]] | None = None,
    mixed: Mapping[tuple[str, str], str] = MappingProxyType({}),
) -> list[ColumnCheck]:
    """Merge found (table, column, type) rows into the registry.

    New columns and type conflicts are logged under the batch key; doing it again under
    the same key changes nothing. A nested type that only gained or lacks fields is no
    conflict: the registry's type grows by the new fields (``widened``) or stays as it is
    (``same``). ``mixed`` gives, for (table, column) pairs with values that do not fit, the type
    seen over all values; that is their conflict, and what was found is the type of the values to keep. Registry
    entries are only ever added, because another batch may have stored rows that count on
    them.
    """
    if known is None:
        known = known_columns(spark, lake, {table for table, _, _ in found})
    old = {(table, name): data_type for table, name, data_type in known}
    new = {(table, name): data_type for table, name, data_type in found}
    checks = [_check(*key, old.get(key), new.get(key)) for key in sorted({*old, *new})]
    checks = [
        replace(c, status="conflict", new_type=mixed[c.table_name, c.column_name])
        if (c.table_name, c.column_name) in mixed
        else c
        for c in checks
    ]
    now = time.time()
    added = [
        (c.table_name, c.column_name, c.data_type, now) for c in checks if c.data_type != c.old_type
    ]
    drifted = [
        (c.table_name, c.column_name, c.old_type or c.data_type, c.new_type)
        for c in checks
        if c.status == "conflict"
    ]
    if added:
        lake.write_log(spark, "registry", batch, added, ENTRY_SCHEMA, mode="append")
    if drifted:
        lake.write_log(spark, "drift", batch, drifted, DRIFT_SCHEMA)
    return checks


def _check(table: str, column: str, old: str | None, new: str | None) -> ColumnCheck:
    if new is None or old == new:
        return ColumnCheck(table, column, old, new, "kept" if new is None else "same", old)
    found = type_from_name(new)
    if old is None:
        return ColumnCheck(table, column, old, new, "added", type_text(grown(found, found)))
    # Compared as types: a stored schema file may name the same type otherwise.
    was = type_from_name(old)
    more = widened(was, found)
    if more is None:
        return ColumnCheck(table, column, old, new, "conflict", old)
    if more == was:
        return ColumnCheck(table, column, old, new, "same", old)
    return ColumnCheck(table, column, old, new, "widened", type_text(more))


def known_columns(
    spark: SparkSession, lake: Lake, tables: set[str]
) -> list[tuple[str, str, str]]:
    """Registry rows of some tables."""
    known = lake.registry(spark).where(F.col("table_name").isin(sorted(tables)))
    return [tuple(row) for row in known.collect()]


def check_tables(
    spark: SparkSession, lake: Lake, batch: str, tables: Mapping[str, DataFrame]
) -> list[ColumnCheck]:
    """Discover the schemas of stored tables and merge them into the registry. A check done
    again under its key reports what it added the first time as added."""
    found = [
        row
        for name, df in tables.items()
        for row in schema_rows(name, df.schema)
        if row[1] != lake.date_column
    ]
    checks = record_schemas(spark, lake, batch, found)
    earlier = {(r.table_name, r.column_name) for r in lake.registry(spark, before=batch).collect()}
    return [
        replace(c, status="added")
        if c.status == "same" and (c.table_name, c.column_name) not in earlier
        else c
        for c in checks
    ]


def store_schema_files(spark: SparkSession, lake: Lake, folder: str) -> None:
    """Write the registry as one JSON text ``{"column": "type name"}`` per table, each in a
    folder ``table_name=<table>``."""
    texts = registry_to_json(lake.registry(spark)).select("value", "table_name")
    texts.write.mode("overwrite").partitionBy("table_name").text(folder)


def load_schema_files(spark: SparkSession, lake: Lake, batch: str, folder: str) -> list[ColumnCheck]:
    """Merge the schema files of a folder into the registry, as ``store_schema_files`` lays
    them out. Columns the registry has keep their type."""
    files = spark.read.schema("value string, table_name string").option("wholetext", True)
    rows = registry_from_json(files.text(literal_path(folder)), "table_name", "value")
    return record_schemas(spark, lake, batch, [tuple(row) for row in rows.collect()])
