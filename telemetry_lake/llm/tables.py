"""Tables and column helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from telemetry_lake.session import work_dir

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage, and the rows survive the loss of any executor.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    # The table is all that is read later, so the shuffles behind it can go at once.
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started within it pass at most ``rows`` rows at once to Python; for wide rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text column; none where the text is null."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def id_crc(doc_id: str) -> Column:
    """CRC-32 of an id as text. A null id counts as an empty text, which gives 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def text_key(text: str) -> Column:
    """With the id, tells rows apart where ids repeat; rows equal in both are copies."""
    return F.xxhash64(F.col(text))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def orderable(data_type: DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(data_type, ArrayType):
        return orderable(data_type.elementType)
    if isinstance(data_type, StructType):
        return all(orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (MapType, VariantType))
