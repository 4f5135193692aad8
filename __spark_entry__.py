"""Registered queries: every operator of the library over the test tables.

The test tables stand in for report tables: ``events`` for device reports (``user_id`` as
the device, ``event_type`` as firmware version and as table name), ``orders`` for hardware
facts, and ``orders`` with ``customer`` for the join. ``oracle_sql`` holds the same
question as SQL on the same tables.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date, datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from telemetry_lake.functions import joblog, routing, text  # noqa: E402
from telemetry_lake.operators import quality, reports, sinks  # noqa: E402
from telemetry_lake.operators.compact import compact_table as compact_lake_table  # noqa: E402
from telemetry_lake.operators.compact import fold_logs  # noqa: E402
from telemetry_lake.operators.device_sets import DeviceSets  # noqa: E402
from telemetry_lake.plans.daily_report import run_report  # noqa: E402
from telemetry_lake.plans import schemas  # noqa: E402
from telemetry_lake.plans.lake import Lake  # noqa: E402
from telemetry_lake.session import small_frame, work_dir  # noqa: E402
from telemetry_lake.sources import scans  # noqa: E402
from telemetry_lake.sources.disagreeing import read_disagreeing  # noqa: E402
from telemetry_lake.sources.workspace import Workspace, Workspaces, folder_tables  # noqa: E402
from telemetry_lake.streaming import ingest, lines  # noqa: E402

try:  # the training-data operators and their pipeline are optional
    import corpus_pipeline
    from telemetry_lake.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "telemetry_lake.llm"):
        raise
    corpus_pipeline = llm_queries = None

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
# Two halves of a table; rows without a value are in the second one.
BELOW_50 = "coalesce(value < 50, false)"
NOT_BELOW_50 = f"not {BELOW_50}"
AS_OF = date(2024, 1, 30)
HARDWARE_AS_OF = date(2001, 8, 1)
HARDWARE_DAYS = 365
FIELD = "report_table"

# A report line, and the same line cut off for every tenth report. Both engines read this.
LINE = (
    """concat('{"report_table":"', event_type, '","event_id":', event_id, ',"user_id":', user_id,"""
    """ ',"value":', value, ',"report_date":"', cast(cast(ts as date) as string), '"}')"""
)
LANDED = f"case when event_id % 10 = 0 then substring({LINE}, 1, 20) else {LINE} end"
UNROUTED = "event_id % 50 = 7"
# Good lines, and lines with another spelling, glued records, a reserved name, a text in place
# of a struct, a date only, and two spellings at once.
MIXED_LINE = """case event_id % 9
    when 0 then concat('{"Event_ID":', event_id, '}')
    when 1 then concat('{"event_id":', event_id, '},{"event_id":1}')
    when 2 then concat('{"event_id":', event_id, ',"_batch_id":1}')
    when 3 then concat('{"event_id":', event_id, ',"s":"oops"}')
    when 4 then concat('{"report_date":"', cast(cast(ts as date) as string), '"}')
    when 5 then concat('{"event_id":', event_id, ',"EVENT_ID":1}')
    else concat('{"event_id":', event_id, ',"s":{"x":', user_id,
        '},"report_date":"', cast(cast(ts as date) as string), '"}') end"""
MIXED_ARRAY = """case when event_id % 5 = 0 then props when event_id % 5 = 1 then '[1,'
    else concat('[', props, ',', event_id, ',"x",null,[', user_id, '],{"k":1.5}]') end"""
DRIFTED = "case when event_id % 7 = 0 then 'n/a' else cast(user_id as string) end"
# Numbers as JSON writes them, and the order in which files of them land.
JSON_NUMBER = "concat('{{\"v\":', {}, '}}')"
NUMBERS = {
    "fraction": "concat(event_id, '.5')",
    "whole": "cast(event_id as string)",
    "big": "cast(9007199254740993 + event_id as string)",
}
LANDED_NUMBERS = {"num_a": ["fraction", "big", "whole"], "num_b": ["whole", "fraction", "big"]}
NAME = (
    "concat(event_type, '_data_', event_id, '_', user_id,"
    " case when event_id % 7 = 0 then concat('_', event_id % 3) else '' end,"
    " case when event_id % 50 = 0 then '.txt' else '.json' end)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as device reports."""
    return table(spark, sf_dir, "events").withColumn("report_date", F.col("ts").cast("date"))


def hardware_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as hardware facts."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("report_id"),
        F.col("o_orderpriority").alias("hardware"),
        F.col("o_orderdate").cast("date").alias("report_date"),
    )


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.expr(LANDED).alias("value"))


def shown_date(column: str = "report_date"):
    return F.col(column).cast("string").alias(column)


def land(lines_by_table: DataFrame, landing: str, number: int = 1) -> None:
    """Write ``(table_name, value)`` lines as landing files ``<table>_<n>_0.json…``.

    Tasks write them under their final names, so nothing is renamed afterwards.
    """
    names = [r.table_name for r in lines_by_table.select("table_name").distinct().collect()]
    for name in sorted(names, key=str):
        base = "nomatch.json" if name is None else f"{name}_{number}_0.json"
        (
            lines_by_table.where(F.col("table_name").eqNullSafe(F.lit(name)))
            .select("value")
            .write.mode("append")
            .option("mapreduce.output.basename", base)
            .text(landing)
        )


def land_and_ingest(
    spark: SparkSession, lines_by_table: DataFrame, lake: Lake, number: int = 1
) -> None:
    landing = lake.path(f"landing-{number}")
    land(lines_by_table, landing, number)
    ingest.start_ingest(
        spark, landing, lake, lake.path(f"checkpoint-{number}"), glob="*.json*"
    ).awaitTermination()


def new_lake(spark: SparkSession, label: str) -> Lake:
    return Lake(work_dir(spark, label))


def lines_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landing lines; every tenth is cut off, every fiftieth has no routable file."""
    return table(spark, sf_dir, "events").select(
        F.expr(f"case when {UNROUTED} then null else concat(event_type, '_data') end").alias(
            "table_name"
        ),
        F.expr(LANDED).alias("value"),
    )


def lake_rows(spark: SparkSession, lake: Lake, *columns: str) -> DataFrame:
    """Rows of all tables of a lake, with the table's name."""
    opened = lake.open(spark)
    result = None
    for name in opened.tables:
        rows = opened.read(name).select(F.lit(name).alias("table_name"), *columns)
        result = rows if result is None else result.unionByName(rows)
    return result


# Sources


def scan_json(spark, sf_dir):
    path = work_dir(spark, "scan-json")
    table(spark, sf_dir, "events").drop("ts").write.json(path)
    return scans.scan_json(spark, path).select(
        "event_id", "user_id", "event_type", "value", "props"
    )


def scan_parquet(spark, sf_dir):
    path = work_dir(spark, "scan-parquet")
    rows = report_rows(spark, sf_dir).drop("ts")
    sinks.append_by_date(rows.where(BELOW_50), path, "report_date")
    sinks.append_by_date(rows.where(NOT_BELOW_50), path, "report_date")
    return scans.scan_parquet(spark, path).select(
        "event_id", "user_id", "event_type", "value", shown_date()
    )


def append_unpartitioned(spark, sf_dir):
    path = work_dir(spark, "append-plain")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    sinks.append_plain(rows.where(BELOW_50), path)
    sinks.append_plain(rows.where(NOT_BELOW_50), path)
    return scans.scan_parquet(spark, path)


def scan_with_schema(spark, sf_dir):
    path = work_dir(spark, "scan-schema")
    report_rows(spark, sf_dir).drop("ts").write.json(path)
    stored = (
        '{"event_id": "LongType", "user_id": "LongType", "event_type": "StringType",'
        ' "report_date": "DateType", "props": "StructType"}'
    )
    files = small_frame(spark, [("events", stored)], "name string, schema string")
    registry = quality.registry_from_json(files, "name", "schema")
    columns = {r.column_name: r.data_type for r in registry.collect()}
    schema = quality.struct_from_registry(columns)
    rows = scans.scan_with_schema(spark, path, schema)
    return rows.select("event_id", "user_id", "event_type", shown_date(), "props")


def scan_delimited(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    result = None
    for fmt, separator in scans.DELIMITERS.items():
        path = work_dir(spark, f"scan-{fmt}")
        rows.write.option("sep", separator).csv(path)
        ddl = "event_id bigint, user_id bigint, event_type string, value double"
        part = scans.scan_delimited(spark, path, fmt, ddl).withColumn("format", F.lit(fmt))
        result = part if result is None else result.unionByName(part)
    return result


def workspace_read(spark, sf_dir):
    scratch = work_dir(spark, "workspaces")
    spaces = Workspaces(
        spark,
        {
            "root": Workspace(sf_dir, "parquet", writable=False),
            "tmp": Workspace(f"{scratch}/tmp", "csv"),
            "csvOut": Workspace(f"{scratch}/csv", "csv"),
        },
    )
    spaces.register({"nations": "root.nation.parquet", "suppliers": "root.supplier.parquet"})
    picked = "select s_suppkey, n_name, s_acctbal from suppliers join nations on s_nationkey = n_nationkey"
    spaces.create_table_as("tmp.supplier_nation", picked)
    spaces.create_table_as("csvOut.supplier_nation.tbl", picked)
    spaces.create_table_as("tmp.supplier_nation.json", picked)
    ddl = "s_suppkey bigint, n_name string, s_acctbal double"
    names = ["tmp.supplier_nation", "csvOut.supplier_nation.tbl", "tmp.supplier_nation.json"]
    result = None
    for name in names:
        part = spaces.read(name, ddl).withColumn("source", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result.select("source", "s_suppkey", "n_name", "s_acctbal")


def _routed(spark, sf_dir, pattern):
    names = table(spark, sf_dir, "events").select(F.expr(NAME).alias("name"))
    return names.select("name", routing.table_of_name(F.col("name"), pattern).alias("table_name"))


def route_by_filename(spark, sf_dir):
    return _routed(spark, sf_dir, routing.NAME_PATTERN)


def route_by_filename_strict(spark, sf_dir):
    return _routed(spark, sf_dir, routing.NAME_PATTERN_NO_DIGITS)


def _third_of_files(spark, landing):
    """Page size that splits a landing folder into three pages, whatever its size."""
    files = ingest.discover_landing(spark, landing, glob="*.json*").count()
    return max(1, -(-files // 3))


def stream_paged_ingest(spark, sf_dir):
    lake = new_lake(spark, "paged")
    rows = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("_data")).alias("table_name"), F.expr(LINE).alias("value")
    )
    landing = lake.path("landing")
    land(rows, landing)
    size = _third_of_files(spark, landing)
    ingest.start_ingest(
        spark, landing, lake, lake.path("checkpoint"), page_files=size, glob="*.json*"
    ).awaitTermination()
    pages = ingest.audit_summary(spark, lake, "_batch_id")
    return pages.agg(
        F.sum("rows_done").alias("rows_done"),
        F.sum("rows_bad").alias("rows_bad"),
        (F.max("found_files") <= size).alias("within_page"),
        (F.count(F.lit(1)) > 1).alias("several_pages"),
    )


def json_array_explode(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]")).alias("text")
    )
    return text.explode_json_array(rows, "text", "struct<k:int>")


def json_array_any(spark, sf_dir):
    """Arrays of objects, numbers, texts, nulls and arrays, and texts that are no array."""
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(MIXED_ARRAY).alias("text"))
    items = text.with_fields(text.explode_any_array(rows, "text"), "element", {"k": "int"})
    return items.select("event_id", "position", F.to_json("element").alias("element"), "k")


# Sinks and pipelines


def ingest_partitioned(spark, sf_dir):
    lake = new_lake(spark, "partitioned")
    rows = table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("_data")).alias("table_name"), F.expr(LINE).alias("value")
    )
    land_and_ingest(spark, rows, lake)
    return lake_rows(spark, lake, "event_id", "user_id", "value", shown_date())


def ingest_missing_date(spark, sf_dir):
    lake = new_lake(spark, "missing-date")
    events = report_rows(spark, sf_dir).select(
        F.lit("events_data").alias("table_name"), "event_id", "value", "report_date"
    )
    dated = F.to_json(F.struct("event_id", "report_date")).alias("value")
    undated = F.to_json(F.struct("event_id")).alias("value")
    land_and_ingest(spark, events.where(BELOW_50).select("table_name", dated), lake, 1)
    land_and_ingest(spark, events.where(NOT_BELOW_50).select("table_name", undated), lake, 2)
    return lake.open(spark).read("events_data").select("event_id", shown_date())


def write_multi_partition(spark, sf_dir):
    path = work_dir(spark, "multi")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    sinks.write_partitioned(orders, path, "year", "month")
    return scans.scan_parquet(spark, path)


def compact_table(spark, sf_dir):
    lake = new_lake(spark, "compact")
    events = table(spark, sf_dir, "events").select(
        F.lit("events_data").alias("table_name"), "value", F.expr(LINE).alias("line")
    )

    def part(where):
        return events.where(where).select("table_name", F.col("line").alias("value"))

    land_and_ingest(spark, part("coalesce(value < 10, false)"), lake, 1)
    land_and_ingest(spark, part("coalesce(value >= 10 and value < 50, false)"), lake, 2)
    compact_lake_table(spark, lake, "events_data")
    land_and_ingest(spark, part(NOT_BELOW_50), lake, 3)
    return lake.open(spark).read("events_data").select("event_id", "user_id", "value", shown_date())


def count_from_metadata(spark, sf_dir):
    """Totals of a table whose older dates are compacted, from published and footer counts."""
    lake = new_lake(spark, "counts")
    rows = table(spark, sf_dir, "events").select(
        "value", F.lit("events_data").alias("table_name"), F.expr(LINE).alias("line")
    )

    def part(where):
        return rows.where(where).select("table_name", F.col("line").alias("value"))

    land_and_ingest(spark, part(BELOW_50), lake, 1)
    compact_lake_table(spark, lake, "events_data")
    land_and_ingest(spark, part(NOT_BELOW_50), lake, 2)
    counts = lake.open(spark).counts_by_date("events_data")
    return reports.summary_of_counts(counts, "report_date", AS_OF, days=5)


def folded_logs(spark, sf_dir):
    """Audit and quarantine of several pages, folded in between and after."""
    lake = new_lake(spark, "folds")
    rows = lines_with_faults(spark, sf_dir)
    late = F.col("table_name").isNull()
    for number, some in enumerate([rows.where(~late), rows.where(late)], 1):
        landing = lake.path("landing")
        land(some, landing, number)
        size = _third_of_files(spark, landing)
        ingest.start_ingest(
            spark, landing, lake, lake.path("checkpoint"), page_files=size, glob="*.json*"
        ).awaitTermination()
        fold_logs(spark, lake)
    audit = ingest.audit_summary(spark, lake, "table_name").select("table_name", "rows_done", "rows_bad")
    aside = lake.quarantine(spark).groupBy("table_name").agg(F.count(F.lit(1)).alias("aside"))
    return audit.join(aside, audit.table_name.eqNullSafe(aside.table_name), "left").select(
        audit.table_name, "rows_done", "rows_bad", F.coalesce("aside", F.lit(0)).alias("aside")
    )


def report_csv_roundtrip(spark, sf_dir):
    out = work_dir(spark, "report")
    version = "case event_type when 'view' then null when 'click' then '' else event_type end"
    run_report(
        report_rows(spark, sf_dir).withColumn("fw_version", F.expr(version)),
        hardware_rows(spark, sf_dir).withColumn(
            # The two stand-ins are years apart; one as-of date has to fit both.
            "report_date", F.date_add("report_date", (AS_OF - HARDWARE_AS_OF).days)
        ),
        out,
        datetime(2024, 1, 30, 12, 0, 0),
        as_of=AS_OF,
    )
    by_version = sinks.read_csv_report(spark, f"{out}/fw_version.csv", "name string, count bigint")
    by_hardware = sinks.read_csv_report(spark, f"{out}/hardware.csv", "name string, count bigint")
    return by_version.withColumn("report", F.lit("fw_version")).unionByName(
        by_hardware.withColumn("report", F.lit("hardware"))
    )


def report_history(spark, sf_dir):
    path = work_dir(spark, "history")
    rows = report_rows(spark, sf_dir)
    for day in (28, 29, 30):
        summary = reports.report_summary(rows, "report_date", date(2024, 1, day))
        sinks.append_history(summary, path, datetime(2024, 1, day, 12, 0, 0), overwrite=day == 28)
    return sinks.read_history(spark, path)


def export_csv(spark, sf_dir):
    path = work_dir(spark, "export")
    report_rows(spark, sf_dir).createOrReplaceTempView("export_source")
    sinks.export_csv(spark, "select * from export_source", path)
    ddl = (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
        " props string, report_date date"
    )
    rows = sinks.read_csv_report(spark, path, ddl)
    return rows.select("event_id", "user_id", "event_type", "value", "props", shown_date())


def export_csv_documents(spark, sf_dir):
    """Whole texts, with their line ends and quotes, out to CSV and back."""
    path = work_dir(spark, "export-documents")
    table(spark, sf_dir, "documents").createOrReplaceTempView("export_documents")
    sinks.export_csv(spark, "select * from export_documents", path)
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return sinks.read_csv_report(spark, path, ddl)


def to_json_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return text.to_json_rows(rows)


def ingest_quarantine(spark, sf_dir):
    lake = new_lake(spark, "quarantine")
    land_and_ingest(spark, lines_with_faults(spark, sf_dir), lake)
    return lake.quarantine(spark).select("table_name", "reason", "record")


def stream_fanout(spark, sf_dir):
    lake = new_lake(spark, "fanout")
    land_and_ingest(spark, lines_with_faults(spark, sf_dir), lake)
    return lake_rows(spark, lake, "report_table", "event_id", "user_id", "value", shown_date())


def stream_archive(spark, sf_dir):
    """Which pages are archived by the end varies; every landed line must still be in
    one of the two folders."""
    lake = new_lake(spark, "archive")
    landing, archive = lake.path("landing"), lake.path("archive")
    land(lines_with_faults(spark, sf_dir), landing)
    ingest.start_ingest(
        spark,
        landing,
        lake,
        lake.path("checkpoint"),
        page_files=_third_of_files(spark, landing),
        glob="*.json*",
        archive=archive,
    ).awaitTermination()
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    return reader.text([landing, archive])


def ingest_audit(spark, sf_dir):
    lake = new_lake(spark, "audit")
    land_and_ingest(spark, lines_with_faults(spark, sf_dir), lake)
    totals = ingest.audit_summary(spark, lake, "table_name")
    return totals.select(
        "table_name",
        "rows_done",
        "rows_bad",
        (F.col("found_files") == F.col("done_files") + F.col("bad_files")).alias("balanced"),
    )


def ingest_cycles(spark, sf_dir):
    """Two runs over a landing folder, the first in several pages."""
    lake = new_lake(spark, "cycles")
    landing, rows = lake.path("landing"), lines_with_faults(spark, sf_dir)
    late = F.col("table_name").isNull()
    for number, some in enumerate([rows.where(~late), rows.where(late)], 1):
        land(some, landing, number)
        size = _third_of_files(spark, landing)
        ingest.start_ingest(
            spark, landing, lake, lake.path("checkpoint"), page_files=size, glob="*.json*"
        ).awaitTermination()
    cycles = ingest.cycle_summary(spark, lake)
    return cycles.select(
        "rows_done",
        "rows_bad",
        (F.col("found_files") == F.col("done_files") + F.col("bad_files")).alias("balanced"),
        (F.col("file_chunks") > 1).alias("several_pages"),
        (F.col("process_seconds") > 0).alias("timed"),
    )


def ingest_exact_numbers(spark, sf_dir):
    """Fractions, whole numbers and whole numbers beyond 2^53 in files one after the other: what is
    stored and what is set aside, with one file a page and with all files in one."""
    events = table(spark, sf_dir, "events").select("event_id")
    kinds = {k: events.select(F.expr(JSON_NUMBER.format(e)).alias("value")) for k, e in NUMBERS.items()}
    result = None
    for pages, size in (("one", 1), ("all", 1000)):
        lake = new_lake(spark, f"numbers-{pages}")
        landing = lake.path("landing")
        for name, order in LANDED_NUMBERS.items():
            for number, kind in enumerate(order, 1):
                land(kinds[kind].coalesce(1).withColumn("table_name", F.lit(name)), landing, number)
        ingest.start_ingest(
            spark, landing, lake, lake.path("checkpoint"), page_files=size, glob="*.json*"
        ).awaitTermination()
        opened = lake.open(spark)
        none = F.lit(None).cast("string")
        aside = lake.quarantine(spark).select("table_name", "reason", "record", none.alias("stored"))
        for name in LANDED_NUMBERS:
            number = F.col("v").cast("decimal(30,1)").cast("string")
            kept = opened.read(name).select(F.lit(name).alias("table_name"), none.alias("reason"), none.alias("record"), number.alias("stored"))
            aside = aside.unionByName(kept)
        part = aside.withColumn("pages", F.lit(pages))
        result = part if result is None else result.unionByName(part)
    return result


def ingest_mixed_lines(spark, sf_dir):
    """Lines of one page with every kind of fault beside good ones: stored rows and set-aside
    lines together."""
    lake = new_lake(spark, "mixed")
    rows = table(spark, sf_dir, "events").select(
        F.lit("mixed_data").alias("table_name"), F.expr(MIXED_LINE).alias("value"), "event_id"
    )
    land_and_ingest(spark, rows.where("event_id % 9 >= 6").drop("event_id"), lake, 1)
    land_and_ingest(spark, rows.where("event_id % 9 < 6").drop("event_id"), lake, 2)
    text_null = F.lit(None).cast("string")
    stored = lake.open(spark).read("mixed_data").select(
        text_null.alias("reason"), "event_id", "s.x", shown_date(), text_null.alias("record")
    )
    aside = lake.quarantine(spark).select("reason", "record")
    return stored.unionByName(aside, allowMissingColumns=True)


# Projections, filters, joins, aggregates


def filter_since(spark, sf_dir):
    rows = reports.since(report_rows(spark, sf_dir), "report_date", AS_OF)
    return rows.select("event_id", "user_id", "event_type", "value", "props", shown_date())


def filter_on_date(spark, sf_dir):
    rows = reports.on_date(report_rows(spark, sf_dir), "report_date", date(2024, 1, 15))
    return reports.project(rows, "event_id", "event_type")


def project_columns(spark, sf_dir):
    return reports.project(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def project_nested(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.struct(F.col("value").alias("v")).alias("s"))
    rows = reports.shifted(reports.above(rows, "s.v", 30), "s.v", 1, "v_plus_1")
    return reports.project(rows, "event_id", "s.v", "v_plus_1")


def filter_lines_by_table(spark, sf_dir):
    return landed_lines(spark, sf_dir).where(routing.is_line_of(F.col("value"), FIELD, "click"))


def table_name_of_line(spark, sf_dir):
    name = routing.table_or_line(F.col("value"), FIELD)
    return landed_lines(spark, sf_dir).select("event_id", name.alias("table_name"))


def key_lines(spark, sf_dir):
    key = routing.table_key(F.col("value"), FIELD)
    return landed_lines(spark, sf_dir).select(key.alias("key"), "value")


def devices_per_configuration(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("report_id"), F.col("o_custkey").alias("mac")
    )
    info = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("report_id"), F.col("c_mktsegment").alias("configuration")
    )
    return reports.devices_per_configuration(orders, info)


def devices_from_sets(spark, sf_dir):
    """Devices per configuration from the sets kept of compacted dates, and newer rows of some."""
    lake = new_lake(spark, "sets")
    # By quarter, as every date has its folders.
    orders = table(spark, sf_dir, "orders").withColumn("day", F.expr("cast(trunc(o_orderdate, 'QUARTER') as string)"))
    sides = {
        "report_data": F.struct(
            F.col("o_orderkey").alias("report_id"), F.col("o_custkey").alias("mac"), F.col("day").alias("report_date")
        ),
        "flat_info_data": F.struct(
            F.col("o_orderkey").alias("report_id"),
            F.col("o_orderpriority").alias("configuration"),
            F.col("day").alias("report_date"),
        ),
    }

    def part(where):
        rows = orders.where(where)
        halves = [rows.select(F.lit(t).alias("table_name"), F.to_json(r).alias("value")) for t, r in sides.items()]
        return halves[0].unionByName(halves[1])

    # Half of the last year's orders come when the rest is compacted.
    late = "coalesce(year(o_orderdate) >= 2001 and o_orderkey % 2 = 0, true)"
    land_and_ingest(spark, part(f"not {late}"), lake, 1)
    for name in sides:
        compact_lake_table(spark, lake, name)
    sets = DeviceSets(lake)
    sets.keep(spark)
    land_and_ingest(spark, part(late), lake, 2)
    return sets.count(spark)


def join_inner_star(spark, sf_dir):
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_source")
    orders = table(spark, sf_dir, "orders")
    joined = reports.join_inner(orders, spark.table("customer_source"), "o_custkey", "c_custkey")
    return joined.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def count_total(spark, sf_dir):
    return reports.count_total(report_rows(spark, sf_dir))


def count_since(spark, sf_dir):
    return reports.count_since(report_rows(spark, sf_dir), "report_date", AS_OF)


def count_by_fw_version(spark, sf_dir):
    rows = report_rows(spark, sf_dir).withColumnRenamed("event_type", "fw_version")
    return reports.count_by_since(rows, "fw_version", "report_date", AS_OF)


def count_by_hardware(spark, sf_dir):
    rows = hardware_rows(spark, sf_dir)
    return reports.count_by_since(rows, "hardware", "report_date", HARDWARE_AS_OF, HARDWARE_DAYS)


def count_column(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("device", F.expr(f"nullif({DRIFTED}, 'n/a')"))
    return reports.count_column(rows, "device")


def word_count(spark, sf_dir):
    return text.word_count(table(spark, sf_dir, "benchmark"), "text")


def report_summary(spark, sf_dir):
    return reports.report_summary(report_rows(spark, sf_dir), "report_date", AS_OF)


# Quality


def table_stats(spark, sf_dir):
    """All tables of a folder, one that is not there and one whose file is no Parquet."""
    broken = work_dir(spark, "broken")
    table(spark, sf_dir, "region").select("r_name").write.text(f"{broken}/bad_footer.parquet")
    paths = {**folder_tables(spark, sf_dir), "no_such_table": f"{sf_dir}/no_such_table.parquet"}
    stats = quality.table_stats(spark, {**paths, **folder_tables(spark, broken)})
    return stats.select("table_name", "count", F.array_join("columns", ",").alias("columns"))


def schema_discover(spark, sf_dir):
    folder = folder_tables(spark, sf_dir)
    return quality.discover(spark, {name: spark.read.parquet(path) for name, path in folder.items()})


def schema_drift(spark, sf_dir):
    before, after = work_dir(spark, "drift-before"), work_dir(spark, "drift-after")
    events = table(spark, sf_dir, "events")
    events.select("event_id", "user_id", "value", "props").write.json(before)
    events.select(
        "event_id",
        F.expr(DRIFTED).alias("user_id"),
        "value",
        (F.col("value") > 30).alias("high"),
    ).write.json(after)
    registry = quality.discover(spark, {"events": scans.scan_json(spark, before)})
    found = quality.discover(spark, {"events": scans.scan_json(spark, after)})
    return quality.merge_schema(registry, found)


def schema_files(spark, sf_dir):
    """The registry of one lake, out to schema files and into the registry of another."""
    folder = work_dir(spark, "schema-files")
    first, second = new_lake(spark, "schemas-out"), new_lake(spark, "schemas-in")
    schemas.check_tables(
        spark, first, "check", {name: table(spark, sf_dir, name) for name in TABLES}
    )
    schemas.store_schema_files(spark, first, folder)
    schemas.load_schema_files(spark, second, "load", folder)
    return second.registry(spark)


def scan_disagreeing(spark, sf_dir):
    """A folder with a column stored as number, text and fraction by turns."""
    root = work_dir(spark, "disagreeing") + "/events"
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    stored = {"bigint": "user_id", "string": DRIFTED, "double": "user_id + (event_id % 2) / 2"}
    for i, (data_type, value) in enumerate(stored.items()):
        rows = events.where(f"event_id % 3 = {i}").select("event_id", F.expr(value).cast(data_type).alias("v"))
        rows.write.parquet(f"{root}/part={i}")
    found = read_disagreeing(spark, root, "events")
    rows = found.rows.select(F.lit("row").alias("kind"), "event_id", "v", F.lit(None).cast("string").alias("lost"))
    lost = found.lost.select(
        F.lit("lost").alias("kind"), F.lit(None).cast("bigint").alias("event_id"),
        F.lit(None).cast("bigint").alias("v"), F.concat_ws(":", "column_name", "data_type", "value").alias("lost"),
    )
    return rows.unionByName(lost)


def repair_types(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.expr(DRIFTED).alias("user_id"))
    return quality.repair_types(rows, {"user_id": "bigint"})


# SQL


def sql_query(spark, sf_dir):
    spaces = Workspaces(spark, {"root": Workspace(sf_dir)})
    return spaces.query(
        ["root.orders.parquet", "root.customer.parquet"],
        """select c_mktsegment as segment, count(*) as orders, count(distinct o_custkey) as customers
           from orders join customer on o_custkey = c_custkey group by c_mktsegment""",
    )


def sql_query_cached(spark, sf_dir):
    spaces = Workspaces(spark, {"root": Workspace(sf_dir)})
    spaces.register(
        {"recent_reports": "root.events.parquet"},
        columns=["event_type", "user_id", "ts"],
        where=F.col("ts").cast("date") >= F.lit(date(2024, 1, 15)),
        cache=True,
    )
    total = spaces.query_registered("select 'total' as name, count(*) as count from recent_reports")
    grouped = spaces.query_registered(
        """select event_type as name, count(*) as count from recent_reports
           where ts >= timestamp_ntz'2024-01-29 00:00:00' group by event_type"""
    )
    return total.unionByName(grouped)


def first_n(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return reports.first_n(rows, 3, "user_id", "event_id")


# Streams and logs


def stream_count_by_table(spark, sf_dir):
    root = work_dir(spark, "line-counts")
    landed_lines(spark, sf_dir).select("value").write.text(f"{root}/landing")
    source = lines.line_stream(spark, f"{root}/landing")
    lines.start_line_counts(source, FIELD, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    per_batch = spark.read.parquet(f"{root}/out")
    return per_batch.groupBy("table_name").agg(F.sum("lines").alias("lines"))


LOG_PREFIX = (
    "concat('[', date_format(ts, 'dd/MM/yy HH:mm:ss'), '][', user_id, ']',"
    " case when event_id % 3 = 0 then '[ERROR]' else '[INFO]' end, '[feed.py:', event_id % 300, ']')"
)
LOG_LINE = f"""case event_id % 4
    when 0 then concat({LOG_PREFIX}, ' END1: found_files_numb=', event_id, ' ,file_chunks=', event_id % 11,
        ' ,done_files_numb=', event_id - event_id % 5, ' ,bad_files_numb=', event_id % 5, ' process_time=', value)
    when 1 then concat({LOG_PREFIX}, ' PAGE_END: found_files_numb=', event_id, ' ,file_chunks=1 ,done_files_numb=',
        event_id % 1000, ' ,bad_files_numb=0')
    when 2 then concat({LOG_PREFIX}, ' page stored for ', event_type)
    else concat('Traceback ', event_type, ' ', event_id) end"""


def parse_job_log(spark, sf_dir):
    logged = table(spark, sf_dir, "events").select("event_id", F.expr(LOG_LINE).alias("value"))
    parsed = joblog.parse_job_log(logged)
    return parsed.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))


QUERIES = [
    scan_json, scan_parquet, append_unpartitioned, scan_with_schema, scan_delimited,
    workspace_read, route_by_filename, route_by_filename_strict, stream_paged_ingest,
    json_array_explode, json_array_any, count_from_metadata, folded_logs, ingest_partitioned, ingest_missing_date, write_multi_partition,
    compact_table, report_csv_roundtrip, report_history, export_csv,
    export_csv_documents, to_json_rows,
    ingest_quarantine, stream_fanout, stream_archive, ingest_audit, ingest_cycles,
    ingest_exact_numbers, ingest_mixed_lines, filter_since,
    filter_on_date, project_columns, project_nested, filter_lines_by_table,
    table_name_of_line, key_lines, devices_per_configuration, devices_from_sets,
    join_inner_star, count_total,
    count_since, count_by_fw_version, count_by_hardware, count_column, word_count,
    report_summary, table_stats, schema_discover, schema_drift, schema_files, scan_disagreeing,
    repair_types, sql_query,
    sql_query_cached, first_n, stream_count_by_table, parse_job_log,
]


def entry(spark: SparkSession) -> DataFrame:
    """Distinct devices per configuration on the smallest tables."""
    return devices_per_configuration(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {query.__name__: query for query in QUERIES}
    if llm_queries is None:
        return own
    return {**own, **llm_queries.QUERIES, "pipeline": corpus_pipeline.run}


# Oracles

DAY = "cast(cast(ts as date) as varchar)"
GOOD_LINE = f"event_id % 10 <> 0 and not ({UNROUTED})"
SQL_TYPES = """case column_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
    when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'BOOLEAN' then 'boolean'
    when 'TIMESTAMP' then 'timestamp_ntz' when 'FLOAT[]' then 'array<float>' end"""
LINE_TABLE = f"case when json_valid({LANDED}) then json_extract_string({LANDED}, '$.report_table') end"
SUPPLIER_NATIONS = "select s_suppkey, n_name, s_acctbal from supplier join nation on s_nationkey = n_nationkey"


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return own_oracle_sql()
    piped = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**own_oracle_sql(), **llm_queries.ORACLE_SQL, **piped}


def exact_numbers_sql() -> str:
    """The first file of a table decides on whole numbers or doubles; what does not fit is set aside."""
    written = {k: e.replace("as string", "as varchar") for k, e in NUMBERS.items()}
    parts = []
    for name, order in LANDED_NUMBERS.items():
        for kind in order:
            text = written[kind]
            lost = {
                ("num_a", "big"): "(9007199254740993 + event_id) % 2 = 1",
                ("num_b", "fraction"): "true",
            }.get((name, kind), "false")
            shown = text if kind == "fraction" else f"concat({text}, '.0')"
            parts.append(
                f"""select '{name}' as table_name, case when {lost} then 'type_conflict:v' end as reason,
                case when {lost} then {JSON_NUMBER.format(text)} end as record,
                case when not ({lost}) then {shown} end as stored from events"""
            )
    rows = " union all ".join(parts)
    return f"select * from ({rows}), (values ('one'), ('all')) as sizes(pages)"


def own_oracle_sql() -> dict[str, str]:
    described = " union all ".join(
        f"select '{t}' as table_name, column_name, {SQL_TYPES} as data_type from (describe {t})"
        for t in TABLES
    )
    stats = " union all ".join(
        f"select '{t}' as table_name, (select count(*) from {t}) as count,"
        f" (select string_agg(column_name, ',') from (describe {t})) as columns"
        for t in TABLES
    )
    seconds = "strftime(ts, '%d/%m/%y %H:%M:%S')"
    from_log = "event_id % 4 <> 3"
    feed = "concat('feed.py:', event_id % 300)"
    return {
        "scan_json": "select event_id, user_id, event_type, value, props from events",
        "scan_parquet": f"select event_id, user_id, event_type, value, {DAY} as report_date from events",
        "append_unpartitioned": "select event_id, user_id, value from events",
        "scan_with_schema": f"select event_id, user_id, event_type, {DAY} as report_date, props from events",
        "scan_delimited": """select event_id, user_id, event_type, value, format from events,
            (values ('csv'), ('psv'), ('tsv')) as formats(format)""",
        "workspace_read": " union all ".join(
            f"select '{name}' as source, * from ({SUPPLIER_NATIONS})"
            for name in [
                "tmp.supplier_nation",
                "csvOut.supplier_nation.tbl",
                "tmp.supplier_nation.json",
            ]
        ),
        # A name with a third number keeps its first one in the table part.
        "route_by_filename": f"""select {NAME} as name, case when event_id % 50 = 0 then null
            when event_id % 7 = 0 then concat(event_type, '_data_', event_id)
            else concat(event_type, '_data') end as table_name from events""",
        "route_by_filename_strict": f"""select {NAME} as name, case when event_id % 50 = 0
            or event_id % 7 = 0 then null else concat(event_type, '_data') end as table_name
            from events""",
        "stream_paged_ingest": """select count(*) as rows_done, cast(0 as bigint) as rows_bad,
            true as within_page, true as several_pages from events""",
        "json_array_explode": """select event_id, cast(json_extract_string(props, '$.k') as integer) as k
            from events, (values (1), (2)) as copies(n)""",
        "json_array_any": """select event_id, cast(position as integer) as position, case position when 0 then replace(props, ' ', '')
            when 1 then cast(event_id as varchar) when 2 then '"x"' when 3 then 'null'
            when 4 then concat('[', user_id, ']') else '{"k":1.5}' end as element,
            case position when 0 then cast(json_extract_string(props, '$.k') as integer) end as k
            from events, generate_series(0, 5) as places(position) where event_id % 5 > 1""",
        "count_from_metadata": """select count(*) as total_reports_count,
            count(*) filter (where cast(ts as date) >= date '2024-01-25') as last_reports_count
            from events""",
        "folded_logs": f"""select case when {UNROUTED} then null
            else concat(event_type, '_data') end as table_name,
            count(*) filter (where {GOOD_LINE}) as rows_done,
            count(*) filter (where not ({GOOD_LINE})) as rows_bad,
            count(*) filter (where not ({GOOD_LINE})) as aside from events group by 1""",
        "ingest_partitioned": f"""select concat(event_type, '_data') as table_name, event_id, user_id,
            value, {DAY} as report_date from events""",
        "ingest_missing_date": f"""select event_id, case when value < 50 then {DAY} end as report_date
            from events""",
        "write_multi_partition": """select o_orderkey, o_custkey,
            cast(year(o_orderdate) as integer) as year,
            cast(month(o_orderdate) as integer) as month from orders""",
        "compact_table": f"select event_id, user_id, value, {DAY} as report_date from events",
        "report_csv_roundtrip": f"""select case event_type when 'view' then null when 'click' then ''
            else event_type end as name, count(*) as count, 'fw_version' as report from events
            where cast(ts as date) >= date '2024-01-29' group by 1
            union all
            select o_orderpriority, count(*), 'hardware' from orders
            where cast(o_orderdate as date) >= date '{HARDWARE_AS_OF}' - 1 group by 1""",
        "report_history": " union all ".join(
            f"""select '2024-01-{d} 12:00:00' as report_time, count(*) as total_reports_count,
            count(*) filter (where cast(ts as date) >= date '2024-01-{d - 1}') as last_reports_count
            from events"""
            for d in (28, 29, 30)
        ),
        "export_csv_documents": "select doc_id, text, lang, source, n_chars from documents",
        "export_csv": f"""select event_id, user_id, event_type, value, props, {DAY} as report_date
            from events""",
        "to_json_rows": """select concat('{"event_id":', event_id, ',"user_id":', user_id,
            ',"event_type":"', event_type, '","value":', value, '}') as value from events""",
        "ingest_quarantine": f"""select case when {UNROUTED} then null
            else concat(event_type, '_data') end as table_name,
            case when {UNROUTED} then 'unroutable_name' else 'malformed_json' end as reason,
            {LANDED} as record from events where not ({GOOD_LINE})""",
        "stream_fanout": f"""select concat(event_type, '_data') as table_name,
            event_type as report_table, event_id, user_id, value, {DAY} as report_date
            from events where {GOOD_LINE}""",
        "stream_archive": f"select {LANDED} as value from events",
        "ingest_cycles": f"""select count(*) filter (where {GOOD_LINE}) as rows_done,
            count(*) filter (where not ({GOOD_LINE})) as rows_bad, true as balanced,
            not ({UNROUTED}) as several_pages, true as timed
            from events group by {UNROUTED}""",
        "ingest_exact_numbers": exact_numbers_sql(),
        "ingest_mixed_lines": f"""select case event_id % 9 when 1 then 'malformed_json'
                when 3 then 'type_conflict:s' when 2 then 'unreadable_schema'
                when 5 then 'unreadable_schema' end as reason,
            case when event_id % 9 in (0, 6, 7, 8) then event_id end as event_id,
            case when event_id % 9 >= 6 then user_id end as x,
            case when event_id % 9 in (4, 6, 7, 8) then {DAY} end as report_date,
            case when event_id % 9 in (1, 2, 3, 5) then {MIXED_LINE} end as record
            from events""",
        "ingest_audit": f"""select case when {UNROUTED} then null
            else concat(event_type, '_data') end as table_name,
            count(*) filter (where {GOOD_LINE}) as rows_done,
            count(*) filter (where not ({GOOD_LINE})) as rows_bad, true as balanced
            from events group by 1""",
        "filter_since": f"""select event_id, user_id, event_type, value, props, {DAY} as report_date
            from events where cast(ts as date) >= date '2024-01-29'""",
        "filter_on_date": """select event_id, event_type from events
            where cast(ts as date) = date '2024-01-15'""",
        "project_columns": "select l_orderkey, l_linenumber from lineitem",
        "project_nested": "select event_id, value as v, value + 1 as v_plus_1 from events where value > 30",
        "filter_lines_by_table": f"""select event_id, {LANDED} as value from events
            where {LINE_TABLE} = 'click'""",
        "table_name_of_line": f"""select event_id, coalesce({LINE_TABLE}, {LANDED}) as table_name
            from events""",
        "key_lines": f"""select coalesce({LINE_TABLE}, 'no_table_name_error') as key, {LANDED} as value
            from events""",
        "devices_per_configuration": """select c_mktsegment as configuration,
            count(distinct o_custkey) as devices from orders join customer on o_custkey = c_custkey
            group by c_mktsegment""",
        "devices_from_sets": """select o_orderpriority as configuration,
            count(distinct o_custkey) as devices from orders group by o_orderpriority""",
        "join_inner_star": """select orders.* exclude (o_orderdate), customer.*,
            strftime(o_orderdate, '%Y-%m-%d') as o_orderdate
            from orders join customer on o_custkey = c_custkey""",
        "count_total": "select count(*) as total_reports_count from events",
        "count_since": """select count(*) as last_reports_count from events
            where cast(ts as date) >= date '2024-01-29'""",
        "count_by_fw_version": """select event_type as fw_version, count(*) as count from events
            where cast(ts as date) >= date '2024-01-29' group by 1""",
        "count_by_hardware": f"""select o_orderpriority as hardware, count(*) as count from orders
            where cast(o_orderdate as date) >= date '{HARDWARE_AS_OF}' - {HARDWARE_DAYS} group by 1""",
        "count_column": "select count(*) as device_count from events where event_id % 7 <> 0",
        "word_count": """select word, count(*) as count
            from (select unnest(string_split(text, ' ')) as word from benchmark) group by word""",
        "report_summary": """select count(*) as total_reports_count,
            count(*) filter (where cast(ts as date) >= date '2024-01-29') as last_reports_count
            from events""",
        "table_stats": f"{stats} union all select name, -1, '' from (values ('no_such_table'), ('bad_footer')) as bad(name)",
        "schema_discover": described,
        "schema_files": described,
        "scan_disagreeing": """select 'row' as kind, event_id, case when event_id % 3 = 1 and event_id % 7 = 0 then null
                when event_id % 3 = 2 and event_id % 2 = 1 then null else user_id end as v, null as lost from events
            union all select 'lost', null, null, 'v:string:n/a' from events where event_id % 3 = 1 and event_id % 7 = 0
            union all select 'lost', null, null, concat('v:double:', user_id, '.5') from events
                where event_id % 3 = 2 and event_id % 2 = 1""",
        "schema_drift": f"""with before as (select column_name, {SQL_TYPES} as old_type
                from (describe select event_id, user_id, value, props from events)),
            after as (select column_name, {SQL_TYPES} as new_type
                from (describe select event_id, {DRIFTED} as user_id, value, value > 30 as high from events))
            select 'events' as table_name, column_name, old_type, new_type,
                case when old_type is null then 'added' when new_type is null then 'kept'
                when old_type <> new_type then 'conflict' else 'same' end as status,
                coalesce(old_type, new_type) as data_type
            from before full join after using (column_name)""",
        "repair_types": """select event_id, case when event_id % 7 <> 0 then user_id end as user_id
            from events""",
        "sql_query": """select c_mktsegment as segment, count(*) as orders,
            count(distinct o_custkey) as customers from orders join customer on o_custkey = c_custkey
            group by 1""",
        "sql_query_cached": """select 'total' as name, count(*) as count from events
            where cast(ts as date) >= date '2024-01-15'
            union all select event_type, count(*) from events
            where cast(ts as date) >= date '2024-01-29' group by 1""",
        "first_n": """select event_id, user_id, event_type, value from events
            order by user_id, event_id limit 3""",
        "stream_count_by_table": f"""select coalesce({LINE_TABLE}, {LANDED}) as table_name,
            count(*) as lines from events group by 1""",
        "parse_job_log": f"""select event_id,
            case event_id % 4 when 0 then 'END1' when 1 then 'PAGE_END' when 2 then 'generic'
                else 'raw' end as kind,
            case when {from_log} then {seconds} end as my_event_time,
            case when {from_log} then cast(user_id as integer) end as thid,
            case when {from_log} then case when event_id % 3 = 0 then 'ERROR' else 'INFO' end end as log_level,
            case when {from_log} then {feed} end as src_file,
            case when event_id % 4 = 1 then cast(event_id % 1000 as integer) end as done_files_numb_p,
            case when event_id % 4 = 0 then cast(event_id as integer) end as found_files_numb_e,
            case when event_id % 4 = 0 then cast(event_id % 11 as integer) end as file_chunks_e,
            case when event_id % 4 = 0 then cast(event_id - event_id % 5 as integer) end as done_files_numb_e,
            case when event_id % 4 = 0 then cast(event_id % 5 as integer) end as bad_files_numb_e,
            case when event_id % 4 = 0 then value end as process_time_e,
            case event_id % 4 when 2 then concat(' page stored for ', event_type)
                when 3 then concat('Traceback ', event_type, ' ', event_id) end as message,
            case when {from_log} then strftime(ts, '%Y-%m-%d %H:%M:%S') end as event_time
            from events""",
    }
