"""Report queries: date bounds, counts, joins and projections."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def start_date(as_of: date | None, days: int) -> Column:
    """``as_of`` minus ``days``; without ``as_of`` the day the query runs."""
    if as_of is None:
        return F.date_sub(F.current_date(), days)
    return F.lit(as_of - timedelta(days=days))


def since(df: DataFrame, date_column: str, as_of: date | None = None, days: int = 1) -> DataFrame:
    """Rows from ``days`` before ``as_of`` on, that first day included.

    The bound is a constant, so it prunes date partitions or reaches the file scan.
    """
    return df.where(F.col(date_column) >= start_date(as_of, days))


def on_date(df: DataFrame, date_column: str, day: date) -> DataFrame:
    return df.where(F.col(date_column) == F.lit(day))


def project(df: DataFrame, *columns: str) -> DataFrame:
    """Plain or dotted (nested) columns."""
    return df.select(*columns)


def shifted(df: DataFrame, path: str, by: float, name: str) -> DataFrame:
    """Add ``name``: the value at a plain or dotted path plus a number."""
    return df.withColumn(name, F.col(path) + F.lit(by))


def above(df: DataFrame, path: str, bound: float) -> DataFrame:
    """Rows whose value at a plain or dotted path exceeds ``bound``."""
    return df.where(F.col(path) > F.lit(bound))


def count_total(df: DataFrame, name: str = "total_reports_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_since(
    df: DataFrame,
    date_column: str,
    as_of: date | None = None,
    days: int = 1,
    name: str = "last_reports_count",
) -> DataFrame:
    return count_total(since(df, date_column, as_of, days), name)


def count_column(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Number of rows with a value in ``column``."""
    return df.agg(F.count(column).alias(name or f"{column}_count"))


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group in a column named ``count``; NULL is a group of its own."""
    return df.groupBy(*columns).count()


def count_by_since(
    df: DataFrame, column: str, date_column: str, as_of: date | None = None, days: int = 1
) -> DataFrame:
    return count_by(since(df, date_column, as_of, days), column)


def report_summary(
    df: DataFrame, date_column: str, as_of: date | None = None, days: int = 1
) -> DataFrame:
    """Total and recent row counts in one row, from one pass over one column."""
    recent = F.col(date_column) >= start_date(as_of, days)
    return df.agg(
        F.count(F.lit(1)).alias("total_reports_count"),
        F.count_if(recent).alias("last_reports_count"),
    )


def summary_of_counts(
    counts: DataFrame, date_column: str, as_of: date | None = None, days: int = 1
) -> DataFrame:
    """``report_summary`` from the rows per date that a lake keeps of a table, without a look
    at the rows themselves."""
    recent = F.col(date_column) >= start_date(as_of, days)
    return counts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_reports_count"),
        F.coalesce(F.sum(F.when(recent, F.col("rows"))), F.lit(0)).alias("last_reports_count"),
    )


def first_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order, kept per task before they are merged."""
    return df.orderBy(*order).limit(n)


def devices_per_configuration(
    reports: DataFrame,
    info: DataFrame,
    key: str = "report_id",
    device: str = "mac",
    configuration: str = "configuration",
) -> DataFrame:
    """Distinct devices per configuration over the inner join on the report key.

    Repeated (key, configuration) pairs cannot change a distinct count, so they are
    removed first: a key that is frequent on both sides then adds its report rows once
    per configuration, not once per info row. Adaptive execution splits a report key
    that is hot, or broadcasts the pairs once it has measured them as small.
    """
    pairs = info.select(key, configuration).distinct()
    return (
        reports.select(key, device)
        .join(pairs, key, "inner")
        .groupBy(configuration)
        .agg(F.count_distinct(device).alias("devices"))
    )


def join_inner(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """All columns of both sides of an inner equi-join; both keys are kept."""
    return left.join(right, left[left_key] == right[right_key], "inner")
