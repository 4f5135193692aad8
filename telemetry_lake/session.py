"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "array<string>": pa.list_(pa.string()),
}


def build_session(app_name: str = "telemetry-lake", **conf: str) -> SparkSession:
    """A session with the settings the jobs count on; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate tables, under ``spark.checkpoint.dir``.

    Every executor must reach that folder. Only a local session may do without the
    setting; it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="telemetry-lake-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def literal_path(path: str) -> str:
    """A path that matches only itself where a reader expands globs."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def path_missing(error: Exception) -> bool:
    """True for the analysis error of a read from a folder that does not exist."""
    condition = getattr(error, "getCondition", lambda: None)()
    return condition == "PATH_NOT_FOUND"


def small_frame(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few rows of job metadata as a DataFrame, without a Python worker."""
    fields = StructType.fromDDL(ddl).fields
    columns = {
        f.name: pa.array([row[i] for row in rows], ARROW_TYPES[f.dataType.simpleString()])
        for i, f in enumerate(fields)
    }
    return spark.createDataFrame(pa.table(columns), schema=ddl)


def child_folders(spark: SparkSession, folder: str, pattern: str = "*") -> list[str]:
    """Paths below a folder that match a glob, by the cluster's own file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in files.globStatus(path) or []]


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def move_file(spark: SparkSession, source: str, folder: str) -> bool:
    """Move a file below a folder, under its full path; false if there is one already."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = paths.Path(source)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    target = paths.Path(f"{folder.rstrip('/')}{path.toUri().getPath()}")
    files.mkdirs(target.getParent())
    return not files.exists(target) and files.rename(path, target)
