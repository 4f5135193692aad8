"""Line counts per table over a directory stream of text files."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry_lake.functions.routing import table_or_line
from telemetry_lake.plans.lake import BATCH
from telemetry_lake.session import child_folders, literal_path

# A stream forgets files that are older than the newest one it has seen by more than this, and
# skips what lands with such a time stamp; those files are looked for without the stream.
MAX_AGE_MS = 7 * 24 * 3600 * 1000
# No file counts as too old. The stream then remembers every path it has seen.
ANY_AGE_MS = 36500 * 24 * 3600 * 1000
FILE = (
    "struct(_metadata.file_path as path, _metadata.file_size as bytes,"
    " unix_millis(_metadata.file_modification_time) as modified) as file"
)
FILES_SCHEMA = "path string, bytes bigint, modified bigint"
LATE = "late-"


def line_stream(
    spark: SparkSession,
    landing: str,
    page_files: int | None = None,
    glob: str | None = None,
    max_age_ms: int | None = None,
) -> DataFrame:
    """Lines of new text files of a folder, in a column ``value``.

    With ``max_age_ms`` the stream forgets older files. Each line then has its ``file`` too, from
    which ``start_line_counts`` logs the files it took, and ``count_late_lines`` takes the rest.
    """
    age = ANY_AGE_MS if max_age_ms is None else max_age_ms
    reader = spark.readStream.option("maxFileAge", f"{age}ms")
    if page_files is not None:
        reader = reader.option("maxFilesPerTrigger", page_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(landing)
    return lines if max_age_ms is None else lines.selectExpr("value", FILE)


def count_lines(lines: DataFrame, field: str) -> DataFrame:
    """Lines per table name; a line without one is counted under its own text."""
    return (
        lines.select(table_or_line(F.col("value"), field).alias("table_name"))
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def start_line_counts(
    lines: DataFrame,
    field: str,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    files: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch's counts, not running totals, to a folder of its own.

    ``interval`` such as ``10 seconds`` keeps the query running; without it the query
    ends after the files that are there. ``files`` is a folder for the log of the files taken.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        _store(batch, field, out, files, f"{run}-{batch_id:010d}")

    writer = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def _store(batch: DataFrame, field: str, out: str, files: str | None, key: str) -> None:
    # The files first: a batch cut off in between is done again, and must not be counted as late.
    if files is not None:
        taken = batch.select("file.*").distinct()
        taken.write.mode("overwrite").parquet(f"{files.rstrip('/')}/{BATCH}={key}")
    count_lines(batch, field).write.mode("overwrite").parquet(f"{out.rstrip('/')}/{BATCH}={key}")


def count_late_lines(
    spark: SparkSession,
    landing: str,
    field: str,
    out: str,
    files: str,
    page_files: int = 1000,
    glob: str | None = None,
) -> int:
    """Count the lines of files that no batch has taken, by path, size and time, and return the
    number of pages. Call it between two runs of the stream, from one place at a time.

    Each page is keyed by its first file, so one that was cut off is done again under its key.
    """
    reader = spark.read.format("binaryFile")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    found = reader.load(landing).selectExpr("path as read_path", FILE).select("read_path", "file.*")
    pages = 0
    while True:
        log = _late_log(spark, files, out)
        late = found.where("bytes > 0").join(log, ["path", "bytes", "modified"], "left_anti")
        page = late.orderBy("modified", "path").limit(page_files).collect()
        if not page:
            return pages
        paths = [literal_path(r.read_path) for r in page]
        first = zlib.crc32(f"{page[0].path} {page[0].bytes}".encode())
        lines = spark.read.text(paths).selectExpr("value", FILE)
        _store(lines, field, out, files, f"{LATE}{page[0].modified:020d}-{first:010d}")
        pages += 1


def _late_log(spark: SparkSession, files: str, out: str) -> DataFrame:
    """The files taken, except those of a late page whose counts are missing."""
    log = spark.read.schema(f"{FILES_SCHEMA}, {BATCH} string").parquet(literal_path(files))
    counted = child_folders(spark, literal_path(out), f"{BATCH}={LATE}*/_SUCCESS")
    done = [path.split("/")[-2].partition("=")[2] for path in counted]
    return log.where(~F.col(BATCH).startswith(LATE) | F.col(BATCH).isin(done))
