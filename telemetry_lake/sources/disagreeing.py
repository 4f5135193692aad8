"""Reading a Parquet folder whose files disagree on the types of their columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

from telemetry_lake.operators.quality import (
    castable,
    number_from_text,
    quoted,
    repaired,
    type_text,
    whole_from_text,
)
from telemetry_lake.plans.lake import DRIFT_SCHEMA
from telemetry_lake.session import child_folders, literal_path, small_frame

WHOLE = ("tinyint", "smallint", "int", "bigint")
LOST_SCHEMA = "column_name string, data_type string, value string"


@dataclass(frozen=True)
class Agreeing:
    """Files and folders that one scan can read, and their columns."""

    paths: list[str]
    schema: StructType


@dataclass(frozen=True)
class Reconciled:
    """``rows`` have one type a column, and NULL for each value in ``lost``, which lists what a type
    would not have kept: column, type in the file, text. ``drift`` has a row per other type found."""

    rows: DataFrame
    lost: DataFrame
    drift: DataFrame


def agreeing_parts(spark: SparkSession, root: str) -> list[Agreeing]:
    """The parts of a folder, in the order of their paths, as few as its changes of types allow.

    Spark merges the footers of many paths in tasks of its own and refuses types that differ, so a
    folder is halved until each part agrees: k changes of type among n paths take about k log n
    such jobs. A folder is listed only if its own files disagree. Parts of equal types are then
    put together again, however they alternate. Raises where a single file cannot be read.
    """
    groups: list[Agreeing] = []
    for part in _parts(spark, root, [root]):
        for i, group in enumerate(groups):
            types = {f.name: f.dataType for f in group.schema.fields}
            if all(types.get(f.name, f.dataType) == f.dataType for f in part.schema.fields):
                added = [f for f in part.schema.fields if f.name not in types]
                schema = StructType([*group.schema.fields, *added])
                groups[i] = Agreeing([*group.paths, *part.paths], schema)
                break
        else:
            groups.append(part)
    return groups


def _parts(spark: SparkSession, root: str, paths: list[str]) -> list[Agreeing]:
    try:
        reader = spark.read.option("mergeSchema", True).option("basePath", literal_path(root))
        return [Agreeing(paths, reader.parquet(*map(literal_path, paths)).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        if len(paths) == 1:
            children = sorted(child_folders(spark, literal_path(paths[0])))
            paths = [p for p in children if p.rpartition("/")[2][0] not in "._"]
            if not paths:
                raise
            return _parts(spark, root, paths)
    half = len(paths) // 2
    return _parts(spark, root, paths[:half]) + _parts(spark, root, paths[half:])


def read_disagreeing(
    spark: SparkSession, root: str, table: str, wanted: StructType | None = None
) -> Reconciled:
    """A folder's rows with the types of ``wanted``, or with the first type of each column in the
    order of paths; columns that ``wanted`` lacks come after its own.

    Each group of agreeing files is one scan with pruned columns and pushed filters of its own. A
    value that the type would change, cut off or round becomes NULL and is listed as lost.
    """
    groups = agreeing_parts(spark, root)
    fields = {f.name: f for f in (wanted.fields if wanted else [])}
    for group in groups:
        for field in group.schema.fields:
            fields.setdefault(field.name, StructField(field.name, field.dataType, True))

    rows, lost, drift = [], [], set()
    for group in groups:
        reader = spark.read.schema(group.schema).option("basePath", literal_path(root))
        scan = reader.parquet(*map(literal_path, group.paths))
        values, unfit = [], []
        for name, field in fields.items():
            found = [f for f in group.schema.fields if f.name == name]
            if not found:
                values.append(F.lit(None).cast(field.dataType).alias(name))
                continue
            value = F.col(quoted(name))
            if found[0].dataType != field.dataType:
                old, new = type_text(field.dataType), type_text(found[0].dataType)
                drift.add((table, name, old, new))
                raw = value
                value, gone = _fitted(spark, raw, new, old)
                text = F.to_json(F.struct(raw)) if _nested(found[0]) else raw.cast("string")
                entry = F.struct(F.lit(name).alias("column_name"), F.lit(new).alias("data_type"), text.alias("value"))
                unfit.append(F.when(gone, entry))
                value = F.when(~gone, value)
            values.append(value.alias(name))
        rows.append(scan.select(*values))
        if unfit:
            some = scan.select(F.explode(F.array_compact(F.array(*unfit))).alias("l"))
            lost.append(some.select("l.*"))
    nothing = small_frame(spark, [], LOST_SCHEMA)
    return Reconciled(
        reduce(DataFrame.unionByName, rows),
        reduce(DataFrame.unionByName, lost, nothing),
        small_frame(spark, sorted(drift), DRIFT_SCHEMA),
    )


def _nested(field: StructField) -> bool:
    return isinstance(field.dataType, (ArrayType, MapType, StructType))


def _fitted(spark: SparkSession, value: Column, found: str, wanted: str) -> tuple[Column, Column]:
    """A value in the wanted type, and whether that would lose it; never null."""
    if not castable(spark, found, wanted):
        return F.lit(None).cast(wanted), value.isNotNull()
    if found == "string" and wanted in WHOLE:
        result, gone = whole_from_text(value, wanted)
    elif found == "string" and (wanted in ("float", "double") or wanted.startswith("decimal")):
        result, gone = number_from_text(value, wanted)
    else:
        result, gone = repaired(value, found, wanted)
        if found == "timestamp" and wanted == "date":
            gone = gone | (result.cast("timestamp") != value)
    return result, F.coalesce(gone, F.lit(False))
