"""Named workspaces over folders, and SQL over the tables in them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from telemetry_lake.session import child_folders
from telemetry_lake.sources.scans import DELIMITERS

# File extension of each format.
EXTENSIONS = {"tbl": "psv", "csv": "csv", "tsv": "tsv", "json": "json", "parquet": "parquet"}


def folder_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table folders of a folder: name up to its first dot, and path."""
    found = {}
    for path in child_folders(spark, folder):
        name = path.rpartition("/")[2]
        if not name.startswith((".", "_")):
            found[name.split(".")[0]] = path
    return dict(sorted(found.items()))


@dataclass(frozen=True)
class Workspace:
    location: str
    default_format: str = "parquet"
    writable: bool = True


class Workspaces:
    """Resolves ``workspace.table`` to a path and a format.

    A known extension of the table name decides the format, else the workspace's
    default does. Delimited files have no header line unless ``header`` is set.
    """

    def __init__(
        self, spark: SparkSession, spaces: Mapping[str, Workspace], header: bool = False
    ):
        self.spark = spark
        self.spaces = dict(spaces)
        self.header = header
        self._cached: list[DataFrame] = []

    def resolve(self, name: str) -> tuple[str, str]:
        space_name, _, table = name.partition(".")
        space = self.spaces[space_name]
        extension = table.rpartition(".")[2] if "." in table else ""
        fmt = EXTENSIONS.get(extension, space.default_format)
        return f"{space.location.rstrip('/')}/{table}", fmt

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        path, fmt = self.resolve(name)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        if fmt in DELIMITERS:
            return reader.option("sep", DELIMITERS[fmt]).option("header", self.header).csv(path)
        return reader.format(fmt).load(path)

    def write(self, df: DataFrame, name: str, mode: str = "errorifexists") -> None:
        space = self.spaces[name.partition(".")[0]]
        if not space.writable:
            raise PermissionError(f"workspace of {name} is read-only")
        path, fmt = self.resolve(name)
        writer = df.write.mode(mode)
        if fmt in DELIMITERS:
            writer.option("sep", DELIMITERS[fmt]).option("header", self.header).csv(path)
        else:
            writer.format(fmt).save(path)

    def register(
        self,
        tables: Mapping[str, str] | Iterable[str],
        columns: Iterable[str] | None = None,
        where: Column | None = None,
        cache: bool = False,
    ) -> dict[str, DataFrame]:
        """Temp views for tables, as ``{view: workspace.table}`` or plain names.

        Projection and filter come before the cache, so a cached view holds only what
        the later queries read and the scan under it still prunes.
        """
        if not isinstance(tables, Mapping):
            tables = {name.partition(".")[2].partition(".")[0]: name for name in tables}
        views = {}
        for view, name in tables.items():
            df = self.read(name)
            if where is not None:
                df = df.where(where)
            if columns is not None:
                df = df.select(*columns)
            if cache:
                df = df.cache()
                self._cached.append(df)
            df.createOrReplaceTempView(view)
            views[view] = df
        return views

    def query(self, tables: Mapping[str, str] | Iterable[str], sql: str) -> DataFrame:
        """Register the tables, then run SQL on them. No row is an empty DataFrame. To cache,
        ``register`` the columns and rows wanted first and use ``query_registered``."""
        self.register(tables)
        return self.spark.sql(sql)

    def query_registered(self, sql: str) -> DataFrame:
        """Further SQL on views that are already registered."""
        return self.spark.sql(sql)

    def create_table_as(self, name: str, sql: str) -> None:
        """Store a query's result as a new table of a workspace, in its format."""
        self.write(self.spark.sql(sql), name)

    def release(self) -> None:
        """Drop the cached views' data."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
