"""Ingest of landing files into lake tables.

A stream over the landing folder yields the paths of new files, page by page; it never
reads their content. Each page is routed by file name, and each table's files of the
page are parsed, checked against the registry and written by Spark jobs of their own.
Everything a page writes is keyed by its batch, so a replay replaces and never adds. A
page claims its files before it writes; files another batch has finished are left out.
"""

from __future__ import annotations

import operator
import time
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType,
    DataType,
    FractionalType,
    IntegralType,
    StringType,
    StructField,
    StructType,
)

from telemetry_lake.functions.routing import (
    NAME_PATTERN,
    decoded_name,
    file_name,
    table_of_name,
)
from telemetry_lake.operators.quality import (
    fields_of_variant,
    grown,
    has_fractions,
    nested_from_text,
    nested_in_text,
    number_from_text,
    quoted,
    repaired,
    type_from_name,
    type_of_variant,
    type_text,
    whole_from_text,
    widened,
)
from telemetry_lake.operators.sinks import balanced, is_bad_date, iso_date
from telemetry_lake.plans.lake import AUDIT_SCHEMA, BATCH, CLAIM_SCHEMA, Lake
from telemetry_lake.plans.schemas import known_columns, record_schemas
from telemetry_lake.session import child_folders, literal_path, move_file, remove_folder, small_frame
from telemetry_lake.streaming.lines import MAX_AGE_MS

# Fixed value: where the JSON reader keeps a line it cannot parse.
CORRUPT = "_corrupt_record"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
MODIFIED = "unix_millis(modificationTime) as modified"

UNROUTABLE = "unroutable_name"
MALFORMED = "malformed_json"
UNREADABLE = "unreadable_schema"
BAD_DATE = "bad_date"
TYPE_CONFLICT = "type_conflict:"

# The type of a field that is read but makes no column: the date, and names the lake keeps for itself.
SPECIAL = "special"
MISSING = "missing"
AGAIN = "again-"

#: Rows and bytes of landed text that one task sorts and writes; a few times as much where dates meet.
TASK_ROWS = 1 << 20
TASK_BYTES = 1 << 27


@dataclass(frozen=True)
class LandingFile:
    """``modified`` is in milliseconds. Path, size and time together are one landing."""

    path: str
    name: str
    size: int
    table: str | None
    modified: int = 0


@dataclass(frozen=True)
class Source:
    """One spelling of a column in a page, and the type its values were seen to have."""

    name: str
    data_type: DataType


@dataclass(frozen=True)
class TableColumn:
    """One column of a table to write and the fields it comes from."""

    name: str
    data_type: str
    sources: list[Source]


def landing_stream(
    spark: SparkSession,
    landing: str,
    page_files: int = 1000,
    glob: str = "*.json",
    archive: str | None = None,
    max_age_ms: int = MAX_AGE_MS,
) -> DataFrame:
    """Path, size and name of new landing files, at most ``page_files`` a batch. Spark
    gives no row for an empty file, takes a path once only, and skips files that are older
    than the newest one by more than ``max_age_ms``: it keeps the paths of that time alone."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", page_files)
        .option("maxFileAge", f"{max_age_ms}ms")
        # A file taken away after it was listed must not block its page for good.
        .option("ignoreMissingFiles", True)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(landing).select(
        "path", "length", F.expr(MODIFIED), file_name(F.col("path")).alias("name")
    )


def discover_landing(
    spark: SparkSession,
    landing: str,
    glob: str = "*.json",
    pattern: str = NAME_PATTERN,
    recursive: bool = False,
) -> DataFrame:
    """Files now in the landing folder, or below it, with the table each one goes to."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(landing)
    )
    name = file_name(F.col("path"))
    return files.select(
        "path",
        "length",
        F.expr(MODIFIED),
        name.alias("name"),
        table_of_name(name, pattern).alias("table_name"),
    )


def landing_file(row: Row) -> LandingFile:
    return LandingFile(row.path, row.name, row.length, row.table_name, row.modified)


def start_ingest(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    pattern: str = NAME_PATTERN,
    page_files: int = 1000,
    glob: str = "*.json",
    interval: str | None = None,
    archive: str | None = None,
    parallel_tables: int = 8,
    max_age_ms: int = MAX_AGE_MS,
    late_every: int = 100,
) -> StreamingQuery:
    """Start the ingest: every ``interval``, or once over all that is there.

    The stream skips files older than ``max_age_ms`` before the newest one it has taken. A stream
    that runs on looks for such late files by the audit before every ``late_every``-th page; after
    a run over what is there, ``ingest_all`` or ``ingest_again`` does.
    """

    def page(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        # A stream that runs on has a cycle a trigger; one over what is there is a cycle as a whole.
        started = session.sparkContext.getLocalProperty("spark.jobGroup.id")
        cycle = started if interval is None else f"{started}-{batch_id:010d}"
        routed = batch.withColumn("table_name", table_of_name(F.col("name"), pattern))
        # At most page_files rows, and only names and sizes.
        files = {r.path: landing_file(r) for r in routed.collect()}
        if interval is not None and files and batch_id % late_every == late_every - 1:
            newest = max(f.modified for f in files.values())
            # The stream skips them from now on, or will find them finished.
            ingest_again(
                session, landing, lake, pattern, page_files, glob, parallel_tables, newest - max_age_ms
            )
        ingest_page(
            session, lake, f"{run}-{batch_id:010d}", list(files.values()), parallel_tables, cycle
        )

    writer = (
        landing_stream(spark, landing, page_files, glob, archive, max_age_ms)
        .writeStream.foreachBatch(page)
        .option("checkpointLocation", checkpoint)
    )
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def keep_ingesting(
    start: Callable[[], StreamingQuery], pause_seconds: float = 10.0, max_failures: int | None = None
) -> None:
    """Run an ingest query and start it again from its checkpoint when a cycle fails."""
    failures = 0
    while True:
        try:
            start().awaitTermination()
            return
        except Exception:
            failures += 1
            if max_failures is not None and failures > max_failures:
                raise
            time.sleep(pause_seconds)


def ingest_again(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    pattern: str = NAME_PATTERN,
    page_files: int = 1000,
    glob: str = "*.json",
    parallel_tables: int = 8,
    before_ms: int | None = None,
) -> int:
    """Ingest what lies in the landing folder and no batch has finished: a file that came
    again under a name the stream has taken before, or too late for the stream. Returns the
    number of pages.

    The audit decides, by path, size and time. Call it while no ingest runs on the folder.
    A page that was cut off is done again first, under its own key. ``before_ms`` leaves out
    files that are not older.
    """
    claims = lake.log(spark, "claims", CLAIM_SCHEMA).where(F.col(BATCH).startswith(AGAIN))
    cut_off = claims.join(lake.audit(spark).select(BATCH).distinct(), BATCH, "left_anti")
    pages, cycle = 0, f"{AGAIN}{time.time_ns():020d}"
    for key in [r[BATCH] for r in cut_off.select(BATCH).distinct().collect()]:
        claimed = cut_off.where(F.col(BATCH) == key).select("path", "bytes", "modified")
        there = discover_landing(spark, landing, glob, pattern).join(
            claimed.withColumnRenamed("bytes", "length"), ["path", "length", "modified"], "left_semi"
        )
        ingest_page(spark, lake, key, [landing_file(r) for r in there.collect()], parallel_tables, cycle)
        pages += 1
    done = lake.audit(spark).select("path", F.col("bytes").alias("length"), "modified")
    while True:
        # An empty file has no row in the audit.
        found = discover_landing(spark, landing, glob, pattern).where("length > 0")
        if before_ms is not None:
            found = found.where(F.col("modified") < before_ms)
        # Page after page until none is left.
        page = found.join(done, ["path", "length", "modified"], "left_anti").limit(page_files)
        files = [landing_file(r) for r in page.collect()]
        if not files:
            return pages
        ingest_page(spark, lake, f"{AGAIN}{time.time_ns():020d}", files, parallel_tables, cycle)
        done = lake.audit(spark).select("path", F.col("bytes").alias("length"), "modified")
        pages += 1


def ingest_all(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    pattern: str = NAME_PATTERN,
    page_files: int = 1000,
    glob: str = "*.json",
    archive: str | None = None,
    parallel_tables: int = 8,
    max_age_ms: int = MAX_AGE_MS,
) -> int:
    """Ingest all that lies in the landing folder: by the stream, then what came too late for it
    or again under a used name, and archive every finished file, the last page's too. Returns the
    number of files archived."""
    start_ingest(
        spark, landing, lake, checkpoint, pattern, page_files, glob,
        archive=archive, parallel_tables=parallel_tables, max_age_ms=max_age_ms,
    ).awaitTermination()
    ingest_again(spark, landing, lake, pattern, page_files, glob, parallel_tables)
    return 0 if archive is None else archive_finished(spark, landing, lake, archive, glob)


def archive_finished(
    spark: SparkSession, landing: str, lake: Lake, archive: str, glob: str = "*.json", at_once: int = 16
) -> int:
    """Move the landing files that a batch has finished below ``archive``, under their full path,
    as the stream does with those of earlier pages. Returns how many were moved.

    Call it when the last run has ended well: a page that a restart does again needs its files.
    """
    done = lake.audit(spark).where(F.col("status") != MISSING)
    done = done.select("path", F.col("bytes").alias("length"), "modified")
    found = discover_landing(spark, landing, glob)
    finished = found.join(done, ["path", "length", "modified"], "left_semi").select("path").distinct()
    with ThreadPoolExecutor(at_once) as pool:
        # A partition of names at a time.
        moved = pool.map(lambda r: move_file(spark, r.path, archive), finished.toLocalIterator())
        return sum(moved)


def claim_page(
    spark: SparkSession, lake: Lake, batch: str, files: list[LandingFile]
) -> tuple[list[LandingFile], list[LandingFile]]:
    """The files a batch has to ingest, and those it claimed earlier that are gone.

    A file that another batch has finished, by path, size and time, is left out. If the batch
    was tried before, what that attempt wrote is removed.
    """
    gone = []
    earlier = child_folders(spark, literal_path(lake.path("claims")), f"{BATCH}={batch}")
    if earlier:
        there = {file.path for file in files}
        claimed = lake.log(spark, "claims", CLAIM_SCHEMA).where(F.col(BATCH) == batch)
        gone = [
            LandingFile(r.path, r.file_name, r.bytes, r.table_name, r.modified)
            for r in claimed.collect()
            if r.path not in there
        ]
        written = [
            *child_folders(spark, literal_path(lake.path("tables")), f"*/*/{BATCH}={batch}"),
            *child_folders(spark, literal_path(lake.path("quarantine")), f"{BATCH}={batch}"),
            *child_folders(spark, literal_path(lake.path("drift")), f"{BATCH}={batch}"),
        ]
        for folder in written:
            remove_folder(spark, folder)
    if files:
        # A page's files at most; the audit is the side that is read.
        page = small_frame(
            spark, [(f.path, f.size, f.modified) for f in files], "path string, bytes bigint, modified bigint"
        )
        # The time bound skips most of a folded audit, which is sorted by it.
        times = [f.modified for f in files]
        same_time = F.col("modified").between(min(times), max(times))
        others = lake.audit(spark).where(same_time & (F.col(BATCH) != batch) & (F.col("status") != MISSING))
        done = others.join(F.broadcast(page), ["path", "bytes", "modified"], "left_semi")
        finished = {r.path for r in done.select("path").distinct().collect()}
        files = [file for file in files if file.path not in finished]
    if files and not earlier:
        rows = [(f.path, f.name, f.size, f.table, f.modified) for f in files]
        lake.write_log(spark, "claims", batch, rows, CLAIM_SCHEMA)
    return files, gone


def ingest_page(
    spark: SparkSession,
    lake: Lake,
    batch: str,
    files: list[LandingFile],
    parallel_tables: int = 8,
    cycle: str | None = None,
) -> None:
    """Ingest one page of files under a batch key; ``cycle`` names the run it is part of."""
    started = time.monotonic()
    files, gone = claim_page(spark, lake, batch, files)
    if not files and not gone:
        return
    by_table: dict[str | None, list[LandingFile]] = defaultdict(list)
    for file in files:
        by_table[file.table].append(file)
    unrouted = by_table.pop(None, [])
    # The biggest table first, so that it is not the one left running alone.
    names = sorted(by_table, key=lambda t: -sum(f.size for f in by_table[t]))

    with ThreadPoolExecutor(max_workers=parallel_tables) as pool:

        def submit(job: Callable, *args) -> Future:
            return pool.submit(inheritable_thread_target(spark)(job), *args)

        def for_each_table(job: Callable) -> dict:
            running = {table: submit(job, table) for table in names}
            return {table: future.result() for table, future in running.items()}

        known = submit(known_columns, spark, lake, set(names))
        aside = submit(quarantine_files, spark, lake, batch, unrouted, UNROUTABLE)
        # Read once, for the schemas and for all tables.
        lines = page_lines(spark, [f for table in names for f in by_table[table]])
        lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = file_schemas(lines)
            schemas = {t: [(f.name, found[f.name]) for f in in_order(by_table[t]) if f.name in found] for t in names}
            columns = merge_page_schemas(lake, batch, spark, schemas, known.result(), lines)

            def write(table: str) -> dict[str, tuple[int, int]]:
                own = lines.where(F.col("table_name") == table).select("file", "line")
                if not schemas[table] and table not in columns:
                    return quarantine_lines(own, lake, batch, table, MALFORMED)
                return write_table(lake, batch, table, own, columns[table], sum(f.size for f in by_table[table]))

            counts = for_each_table(write)
        finally:
            lines.unpersist()
        counts[None] = aside.result()

    seconds = time.monotonic() - started
    audit = []
    for file in files:
        done, bad = counts[file.table].get(file.name, (0, 0))
        status = "bad" if file.table is None or (bad and not done) else "done"
        landed = (file.path, file.modified)
        audit.append((file.table, file.name, status, file.size, done, bad, seconds, *landed, cycle))
    for file in gone:
        landed = (file.path, file.modified)
        audit.append((file.table, file.name, MISSING, file.size, 0, 0, seconds, *landed, cycle))
    lake.write_log(spark, "audit", batch, audit, AUDIT_SCHEMA)


def in_order(files: list[LandingFile]) -> list[LandingFile]:
    """Files as the stream takes them, the oldest first, however many make a page."""
    return sorted(files, key=lambda f: (f.modified, f.path))


def page_lines(spark: SparkSession, files: list[LandingFile]) -> DataFrame:
    """(table_name, file, line) of the files of a page."""
    tables = small_frame(spark, [(f.name, f.table) for f in files], "name string, table_name string")
    # A page's file names at most.
    named = read_lines(spark, files).withColumn("name", decoded_name(F.col("file")))
    return named.join(F.broadcast(tables.distinct()), "name").select("table_name", "file", "line")


def file_schemas(lines: DataFrame) -> dict[str, list[StructField]]:
    """Fields of the JSON objects of each file that has any, every spelling of a name a field of its own."""
    items = F.when(is_array_line(), F.from_json("line", "array<string>")).otherwise(F.array("line"))
    objects = lines.select("file", F.explode(items).alias("text")).where(F.ltrim("text").startswith("{"))
    value = F.try_parse_json("text")
    # Texts that are no JSON count for nothing. A filter on the value would parse every text twice.
    found = objects.groupBy("file").agg(F.schema_of_variant_agg(value).alias("t")).where("t != 'VOID'")
    named = found.select(decoded_name(F.col("file")).alias("file"), "t")
    return {r.file: fields_of_variant(r.t) for r in named.collect()}


def is_array_line() -> Column:
    return F.ltrim("line").startswith("[")


def merge_page_schemas(
    lake: Lake,
    batch: str,
    spark: SparkSession,
    schemas: dict[str, list[tuple[str, list[StructField]]]],
    known: list[tuple[str, str, str]],
    lines: DataFrame,
) -> dict[str, list[TableColumn]]:
    """Merge the fields of a page's files, given in their order, into the registry and plan the columns of
    each table that has any record. Names that differ only in case are one column, spelled as in the registry.

    The type of a new column is that of the first file with a value in it, so it does not depend
    on how many files make a page.
    """
    spelling = {(table, name.lower()): name for table, name, _ in known}
    types = {(table, name): type_from_name(data_type) for table, name, data_type in known}
    # The types of each spelling of a column, with their file.
    seen: dict[tuple[str, str], list[tuple[str, Source]]] = defaultdict(list)
    special: dict[str, dict[str, Source]] = defaultdict(dict)
    for table, files in schemas.items():
        for file, fields in files:
            for field in fields:
                if field.name.lower() in (lake.date_column.lower(), BATCH):
                    special[table][field.name] = Source(field.name, StringType())
                else:
                    name = spelling.setdefault((table, field.name.lower()), field.name)
                    seen[table, name].append((file, Source(field.name, field.dataType)))

    found, mixed = [], {}
    for (table, name), values in seen.items():
        first = values[0][1].data_type
        kept = types.get((table, name), grown(first, first))
        nested = isinstance(kept, (ArrayType, StructType))
        others = [s.data_type for _, s in values if widened(kept, s.data_type) is None]
        if others:
            mixed[table, name] = type_text(others[0])
        fitting = {}
        if nested and others:
            fitting = fitting_types(lines.where(F.col("table_name") == table), values, kept)
        for file, source in values if nested else []:
            more = widened(kept, source.data_type)
            kept = grown(kept, fitting.get((file, source.name), kept)) if more is None else more
        found.append((table, name, type_text(kept)))
    # A table without columns so far is known by its date.
    with_columns = {table for table, _, _ in [*found, *known]}
    found += [(table, lake.date_column, "date") for table, files in schemas.items() if files and table not in with_columns]

    tables = {table for table, files in schemas.items() if files} | {table for table, _, _ in known}
    columns: dict[str, list[TableColumn]] = {table: [] for table in tables}
    for table in tables:
        columns[table] += [TableColumn(s.name, SPECIAL, [s]) for s in special[table].values()]
    for c in record_schemas(spark, lake, batch, found, known, mixed):
        if c.column_name != lake.date_column:
            sources: dict[str, Source] = {}
            for _, s in seen.get((c.table_name, c.column_name), []):
                same = sources.setdefault(s.name, s)
                if same.data_type != s.data_type:
                    sources[s.name] = Source(s.name, StringType())
            columns[c.table_name].append(TableColumn(c.column_name, c.data_type, list(sources.values())))
    return columns


def fitting_types(
    lines: DataFrame, values: list[tuple[str, Source]], old: DataType
) -> dict[tuple[str, str], DataType]:
    """Per file and spelling, the type of a nested column's values in those that fit the old type as far
    as it goes. A pass of its own over the stored lines, made only where other values do not fit."""
    names = sorted({s.name for _, s in values})
    records = parse_lines(lines, StructType([StructField(name, StringType(), True) for name in names]))
    texts = F.array(*[F.struct(F.lit(n).alias("name"), F.col("record").getField(f"f{i}").alias("text")) for i, n in enumerate(names)])
    cells = records.select("file", F.explode(texts).alias("c")).select(decoded_name(F.col("file")).alias("file"), "c.name", "c.text")
    _, fits = nested_in_text(F.col("text"), old)
    found = cells.where(fits).groupBy("file", "name").agg(F.schema_of_variant_agg(F.try_parse_json("text")).alias("t"))
    return {(r.file, r["name"]): type_of_variant(r.t) for r in found.collect()}


def column_value(
    seen: DataType, wanted: DataType
) -> tuple[DataType, Callable[[Column], tuple[Column, Column | None]]]:
    """The type to read a field as, and what makes of it the column's value and a flag for
    the values that do not fit. It is decided value by value: others of the page do not count."""
    text = type_text(wanted)
    if isinstance(wanted, FractionalType):
        return StringType(), lambda value: number_from_text(value, text)
    if isinstance(wanted, StringType) or (widened(wanted, seen) == wanted and not has_fractions(wanted)):
        return wanted, lambda value: (value, None)
    if isinstance(wanted, (ArrayType, StructType)):
        return StringType(), lambda value: nested_from_text(value, wanted)
    if isinstance(wanted, IntegralType):
        return StringType(), lambda value: whole_from_text(value, text)
    return StringType(), lambda value: repaired(value, "string", text)


def parse_lines(lines: DataFrame, schema: StructType) -> DataFrame:
    """Records of JSON lines in a struct ``record``, NULL for a malformed line. Its fields are
    ``f0``, ``f1``, ... in the schema's order, so that spellings of a name stay apart.

    A line is read as the element of an array, so a second object glued to the first, with
    a comma or without, makes it malformed instead of being dropped. A line that is an array
    gives its items.
    """
    line, is_array = F.col("line"), is_array_line()
    text = F.when(is_array, line).otherwise(F.concat(F.lit("["), line, F.lit("]")))
    numbered = [StructField(f"f{i}", f.dataType) for i, f in enumerate(schema.fields)]
    records = F.from_json(text, ArrayType(schema)).cast(ArrayType(StructType(numbered)))
    # What has no variant, as a name given twice, would lose something.
    whole = F.try_parse_json(line).isNotNull()
    # A column of its own, as what is used twice in an expression with conditions is made twice.
    made = "_" * (1 + max(map(len, lines.columns)))
    parsed = lines.where(F.trim(line) != "").withColumn(made, records)
    kept = F.when(whole & (is_array | (F.size(made) <= 1)), F.col(made))
    return parsed.withColumn("record", F.explode_outer(kept)).drop(made)


def checked_rows(lines: DataFrame, columns: list[TableColumn], date_column: str) -> DataFrame:
    """``file``, ``line``, the ``reason`` to set the line aside or NULL, and ``row``: the
    table's columns in a struct, of the registry's types.

    A line is unreadable if it has a value under two spellings of one name, or under a name
    that the lake keeps for itself.
    """
    read = {s.name: s.data_type for column in columns for s in column.sources}
    position = {name: f"f{i}" for i, name in enumerate(read)}
    columns = [c for c in columns if c.data_type != SPECIAL]

    def field(name: str) -> Column:
        return F.col("record").getField(position[name])

    values, conflicts, unreadable = [], [], []
    for column in columns:
        wanted = type_from_name(column.data_type)
        options = []
        for source in column.sources:
            read[source.name], convert = column_value(source.data_type, wanted)
            value, lost = convert(field(source.name))
            if isinstance(wanted, StructType):
                # An empty object is no value, as it is where the column is not known yet.
                filled = [value.getField(f.name).isNotNull() for f in wanted.fields]
                value = F.when(reduce(operator.or_, filled, F.lit(False)), value)
            options.append(value)
            if lost is not None:
                conflicts.append((column.name, lost))
        value = F.coalesce(*options) if options else F.lit(None).cast(wanted)
        values.append(value.alias(column.name))
        unreadable.append([s.name for s in column.sources])

    day = F.lit(None).cast("date")
    days = [name for name in read if name.lower() == date_column.lower()]
    unreadable.append(days)
    bad_day = F.lit(False)
    if days:
        raw_day = F.coalesce(*[field(name).cast("string") for name in days])
        day, bad_day = iso_date(raw_day), is_bad_date(raw_day)

    reason = F.when(F.col("record").isNull(), MALFORMED)
    for name in read:
        if name.lower() == BATCH:
            reason = reason.when(field(name).isNotNull(), UNREADABLE)
    for names in unreadable:
        if len(names) > 1:
            given = sum((field(name).isNotNull().cast("int") for name in names), F.lit(0))
            reason = reason.when(given > 1, UNREADABLE)
    reason = reason.when(bad_day, BAD_DATE)
    for name, lost in conflicts:
        reason = reason.when(lost, TYPE_CONFLICT + name)

    # Parquet needs a column besides the partitions'; a table may have dates only.
    values = values or [F.lit(None).cast("boolean").alias("_no_column")]
    row = F.struct(*values, day.alias(date_column)).alias("row")
    fields = [StructField(name, data_type, True) for name, data_type in read.items()]
    parsed = parse_lines(lines, StructType(fields or [StructField(CORRUPT, StringType())]))
    return parsed.select("file", "line", reason.alias("reason"), row)


def read_lines(spark: SparkSession, files: list[LandingFile]) -> DataFrame:
    """Lines with their file's name, still percent-encoded."""
    return spark.read.text([literal_path(f.path) for f in files]).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file")
    )


def counts_by_file(rows: DataFrame, good: Column, bad: Column) -> dict[str, tuple[int, int]]:
    """(good, bad) rows by plain file name; a page's files at most."""
    counts = rows.groupBy("file").agg(F.count_if(good).alias("good"), F.count_if(bad).alias("bad"))
    named = counts.select(decoded_name(F.col("file")).alias("file"), "good", "bad")
    return {r["file"]: (r["good"], r["bad"]) for r in named.collect()}


def write_table(
    lake: Lake, batch: str, table: str, lines: DataFrame, columns: list[TableColumn], size: int = 0
) -> dict[str, tuple[int, int]]:
    """Write a table's part of a page, of ``size`` bytes of text; (good, bad) row counts by file name.

    The parsed page is kept on the executors for its three uses. If it is lost it is
    parsed again from the landing files.
    """
    rows = checked_rows(lines, columns, lake.date_column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = F.col("reason").isNull(), F.col("reason").isNotNull()
        counts = counts_by_file(rows, good, bad)
        total = sum(n for n, _ in counts.values())
        if total:
            tasks = -(-max(total, size * TASK_ROWS // TASK_BYTES) // TASK_ROWS)
            write_batch(rows.where(good).select("row.*"), lake.table_path(table), batch, lake.date_column, tasks)
        faulty = sum(n for _, n in counts.values())
        if faulty:
            set_aside(rows.where(bad), lake, batch, table, F.col("reason"), -(-faulty // TASK_ROWS))
    finally:
        rows.unpersist()
    return counts


def spread(df: DataFrame, date_column: str, tasks: int) -> DataFrame:
    """Rows grouped by date ahead of a write, a date with many rows over several of ``tasks`` tasks.

    ``balanced`` splits by bytes, and a task's output not at all; a date's short rows would all be
    sorted by one task. Dates are counted first, so that others stay in one file.
    """
    counts = df.groupBy(F.col(quoted(date_column)).alias("day")).agg(F.count("*").alias("n"))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    most = max(rows // tasks, 1)
    # No more than ``tasks`` dates have so many rows; the tasks behind the first ones are theirs.
    day, width = F.col(quoted(date_column)), tasks
    target = F.when(F.lit(False), 0)
    for r in counts.where(F.col("n") > most).collect():
        own = -(-r.n // most)
        turn = F.lit(width) + F.monotonically_increasing_id() % own
        target = target.when(day.eqNullSafe(F.lit(r.day).cast("date")), turn)
        width += own
    part = "_" * (1 + max(map(len, df.columns)))
    dealt = df.withColumn(part, target.otherwise(F.pmod(F.xxhash64(day), F.lit(tasks))).cast("int"))
    return dealt.repartitionById(width, F.col(part)).drop(part)


def write_batch(df: DataFrame, path: str, batch: str, date_column: str, tasks: int = 1) -> None:
    """Write one batch's rows; a replay overwrites just the batch's own partitions."""
    even = balanced(df, date_column) if tasks <= 1 else spread(df, date_column, tasks)
    keyed = even.withColumn(BATCH, F.lit(batch))
    (
        keyed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column, BATCH)
        .parquet(path)
    )


def quarantine_files(
    spark: SparkSession, lake: Lake, batch: str, files: list[LandingFile], reason: str
) -> dict[str, tuple[int, int]]:
    """Set whole files aside, line by line; (0, lines) by file name."""
    return quarantine_lines(read_lines(spark, files), lake, batch, None, reason) if files else {}


def quarantine_lines(
    lines: DataFrame, lake: Lake, batch: str, table: str | None, reason: str
) -> dict[str, tuple[int, int]]:
    lines = lines.where(F.trim("line") != "")
    counts = counts_by_file(lines, F.lit(False), F.lit(True))
    if counts:
        set_aside(lines, lake, batch, table, F.lit(reason), -(-sum(n for _, n in counts.values()) // TASK_ROWS))
    return counts


def set_aside(
    lines: DataFrame, lake: Lake, batch: str, table: str | None, reason: Column, tasks: int = 1
) -> None:
    kept = lines.select(
        decoded_name(F.col("file")).alias("file_name"),
        reason.alias("reason"),
        F.col("line").alias("record"),
        F.lit(table).cast("string").alias("table_name"),
        F.lit(batch).alias(BATCH),
    )
    if tasks > 1:
        dealt = kept.withColumn("_part", (F.monotonically_increasing_id() % tasks).cast("int"))
        even = dealt.repartitionById(tasks, F.col("_part")).drop("_part")
    else:
        even = balanced(kept)
    (
        even.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH, "table_name")
        .parquet(lake.path("quarantine"))
    )


def audit_summary(spark: SparkSession, lake: Lake, *by: str) -> DataFrame:
    """Found, done and bad files, rows and seconds: per page by ``_batch_id``, per table
    by ``table_name`` (unrouted files have none), or over everything."""
    return (
        lake.audit(spark)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("found_files"),
            F.count_if(F.col("status") == "done").alias("done_files"),
            F.count_if(F.col("status") == "bad").alias("bad_files"),
            F.count_if(F.col("status") == MISSING).alias("missing_files"),
            F.coalesce(F.sum("rows_done"), F.lit(0)).alias("rows_done"),
            F.coalesce(F.sum("rows_bad"), F.lit(0)).alias("rows_bad"),
            F.max("process_seconds").alias("longest_page_seconds"),
        )
    )


def cycle_summary(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per ingest cycle: found files, the pages they were taken in, done, bad and missing files,
    rows, and the seconds its pages took together.

    A cycle is one run over what had landed, one trigger of a stream that runs on, or one call of
    ``ingest_again``. A run that found nothing new has no row; a page done again after a failure
    belongs to the run that finished it.
    """
    pages = lake.audit(spark).groupBy("cycle", BATCH).agg(
        F.count(F.lit(1)).alias("found_files"),
        F.count_if(F.col("status") == "done").alias("done_files"),
        F.count_if(F.col("status") == "bad").alias("bad_files"),
        F.count_if(F.col("status") == MISSING).alias("missing_files"),
        F.sum("rows_done").alias("rows_done"),
        F.sum("rows_bad").alias("rows_bad"),
        # The same for all files of a page.
        F.max("process_seconds").alias("process_seconds"),
    )
    numbers = ["found_files", "done_files", "bad_files", "missing_files", "rows_done", "rows_bad", "process_seconds"]
    return pages.groupBy("cycle").agg(
        F.count(F.lit(1)).alias("file_chunks"), *[F.sum(n).alias(n) for n in numbers]
    )
