"""The periodic report: counts, two CSV files and a line of run history."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from telemetry_lake.operators.reports import count_by_since, report_summary
from telemetry_lake.operators.sinks import append_history, write_csv_report


def run_report(
    reports: DataFrame,
    hardware: DataFrame,
    out: str,
    report_time: datetime,
    as_of: date | None = None,
    days: int = 1,
    date_column: str = "report_date",
    fw_column: str = "fw_version",
    hw_column: str = "hardware",
    overwrite_history: bool = False,
) -> None:
    """Write ``fw_version.csv`` and ``hardware.csv``, then the history line.

    The history comes last, so a line in it stands for a finished report.
    """
    as_of = as_of or report_time.date()
    write_csv_report(count_by_since(reports, fw_column, date_column, as_of, days), f"{out}/fw_version.csv")
    write_csv_report(count_by_since(hardware, hw_column, date_column, as_of, days), f"{out}/hardware.csv")
    summary = report_summary(reports, date_column, as_of, days)
    append_history(summary, f"{out}/history", report_time, overwrite_history)
