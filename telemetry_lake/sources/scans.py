"""File scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Delimiter of each delimited text format.
DELIMITERS = {"csv": ",", "psv": "|", "tsv": "\t"}


def scan_json(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """JSON lines with an inferred schema. Several files are passed as several paths,
    so a missing final newline cannot join two records."""
    return spark.read.json(paths if isinstance(paths, str) else list(paths))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, its partition columns included."""
    return spark.read.parquet(path)


def scan_with_schema(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "json"
) -> DataFrame:
    """A scan with a known schema; no inference pass over the data."""
    return spark.read.schema(schema).format(fmt).load(path)


def string_schema(names: str | Sequence[str]) -> StructType:
    """All-string schema from column names, given as a list or as one spaced text."""
    columns = names.split() if isinstance(names, str) else names
    schema = StructType()
    for name in columns:
        schema = schema.add(name, "string")
    return schema


def scan_delimited(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str | None = None,
    header: bool = False,
) -> DataFrame:
    """Delimited text: ``csv``, ``psv`` or ``tsv``. Without a schema all columns are text."""
    reader = spark.read.option("sep", DELIMITERS[fmt]).option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def load(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A path in any format, by format name."""
    if fmt in DELIMITERS:
        return scan_delimited(spark, path, fmt)
    return spark.read.format(fmt).load(path)
