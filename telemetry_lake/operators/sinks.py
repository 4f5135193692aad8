"""Batch sinks: partitioned Parquet, CSV reports, the run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators.quality import quoted
from telemetry_lake.session import path_missing, small_frame

# Marks NULL in CSV files, so that a NULL group and an empty one stay apart.
NULL_TEXT = "\\N"
HISTORY_SCHEMA = "report_time string, total_reports_count bigint, last_reports_count bigint"


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows grouped by ``columns`` into tasks of an even size, ahead of a write.

    Adaptive execution merges small groups and splits one that is too big for a task,
    so a hot date is written by many tasks and a cold one into a single file.
    """
    return df.hint("rebalance", *[F.col(quoted(c)) for c in columns])


def iso_date(text: Column) -> Column:
    """Date of a ``yyyy-MM-dd`` text; NULL for any other text."""
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def is_bad_date(text: Column) -> Column:
    """True for a text that is neither empty nor a date."""
    return F.coalesce((text != "") & iso_date(text).isNull(), F.lit(False))


def split_bad_dates(df: DataFrame, date_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows ``append_by_date`` accepts, and rows whose date text it would refuse."""
    if dict(df.dtypes).get(date_column) != "string":
        return df, df.limit(0)
    bad = is_bad_date(F.col(quoted(date_column)))
    return df.where(~bad), df.where(bad)


def with_date(df: DataFrame, date_column: str) -> DataFrame:
    """Make sure of a date partition column: a typed NULL where it is missing, the
    parsed ISO date where it is text. Other text fails the job that reads it."""
    if date_column not in df.columns:
        return df.withColumn(date_column, F.lit(None).cast("date"))
    value = F.col(quoted(date_column))
    if dict(df.dtypes)[date_column] != "string":
        return df.withColumn(date_column, value.cast("date"))
    refused = F.raise_error(F.concat(F.lit(f"{date_column} is not a date: "), value)).cast("date")
    return df.withColumn(date_column, F.when(is_bad_date(value), refused).otherwise(iso_date(value)))


def append_by_date(df: DataFrame, path: str, date_column: str) -> None:
    """Append to a date-partitioned table. Undated rows go to its NULL partition, never
    beside the partition folders, where a reader would not find them."""
    dated = with_date(df, date_column)
    balanced(dated, date_column).write.mode("append").partitionBy(date_column).parquet(path)


def append_plain(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "overwrite") -> None:
    balanced(df, *columns).write.mode(mode).partitionBy(*columns).parquet(path)


def _texts_where(df: DataFrame, pattern: str, changed: str) -> DataFrame:
    """Text columns with ``changed`` in place of values that match; ``{c}`` is the column."""
    names = [quoted(f.name) for f in df.schema.fields if f.dataType.simpleString() == "string"]
    picked = {
        n[1:-1].replace("``", "`"): F.when(F.col(n).rlike(pattern), F.expr(changed.format(c=n))).otherwise(F.col(n))
        for n in names
    }
    return df.withColumns(picked)


def _marked(df: DataFrame) -> DataFrame:
    """Texts that would read as the NULL mark get one more backslash."""
    return _texts_where(df, r"^\\+N$", "concat(char(92), {c})")


def _unmarked(df: DataFrame) -> DataFrame:
    return _texts_where(df, r"^\\{2,}N$", "substring({c}, 2)")


def _write_csv(df: DataFrame, path: str, mode: str) -> None:
    """CSV that ``read_csv_report`` reads back as it was: NULL, empty texts, quotes, newlines."""
    (
        _marked(df)
        .write.mode(mode)
        .options(header=True, nullValue=NULL_TEXT, emptyValue='""', escape='"', lineSep="\n")
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def read_csv_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    read = spark.read.schema(schema).options(
        header=True, nullValue=NULL_TEXT, escape='"', lineSep="\n", multiLine=True
    )
    return _unmarked(read.csv(path))


def write_csv_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """A report as a CSV folder with header lines.

    ``single_file`` puts the whole result through one task; ask for it only where the result
    is known to be small.
    """
    _write_csv(df.coalesce(1) if single_file else df, path, "overwrite")


def append_history(
    summary: DataFrame, path: str, report_time: datetime, overwrite: bool = False
) -> None:
    """One line per run: its time, the total count and the recent count."""
    line = summary.select(
        F.lit(report_time.strftime("%Y-%m-%d %H:%M:%S")).alias("report_time"),
        "total_reports_count",
        "last_reports_count",
    )
    line.write.mode("overwrite" if overwrite else "append").option("header", True).csv(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(HISTORY_SCHEMA).option("header", True).csv(path)
    except Exception as error:
        if path_missing(error):
            return small_frame(spark, [], HISTORY_SCHEMA)
        raise


def export_csv(spark: SparkSession, sql: str, path: str) -> None:
    """Store a query's result as CSV, written by all tasks."""
    _write_csv(spark.sql(sql), path, "errorifexists")
