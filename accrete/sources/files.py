"""Path rules and the small files beside a table, through Hadoop's file API."""

from __future__ import annotations

import json
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession

# Suffix a table path may carry; the table is the same with and without it.
TABLE_SUFFIX = ".table"


def split_table_path(path: str, suffix: str = TABLE_SUFFIX) -> tuple[str, str]:
    """Folder and table name of a path, the suffix stripped."""
    folder, name = posixpath.split(path.rstrip("/"))
    return folder or ".", name.removesuffix(suffix)


class Folder:
    """A folder on any Hadoop file system: list, read and publish small text files."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def path(self, *parts: str) -> str:
        """Full name with scheme, as Spark prints it."""
        return self._fs.makeQualified(self._path(*parts)).toString()

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._path(*parts))

    def files(self, *parts: str) -> list[str]:
        """Names in a folder, sorted; none when it is missing. Hidden files are left out."""
        if not self.exists(*parts):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._path(*parts))]
        return sorted(n for n in names if n[0] not in "._")

    def sizes(self, *parts: str) -> dict[str, int]:
        """Bytes of each file in a folder."""
        return {status.getPath().getName(): status.getLen() for status in self._fs.listStatus(self._path(*parts))}

    def read(self, *parts: str) -> str:
        stream = self._fs.open(self._path(*parts))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, content: str | bytes, *parts: str) -> None:
        """Write under a hidden name, then rename, so readers see whole files only."""
        if self.exists(*parts):
            raise FileExistsError(self.path(*parts))
        hidden = (*parts[:-1], f"_{uuid.uuid4().hex}")
        stream = self._fs.create(self._path(*hidden), False)
        try:
            stream.write(content.encode() if isinstance(content, str) else content)
        finally:
            stream.close()
        if not self._fs.rename(self._path(*hidden), self._path(*parts)):
            raise FileExistsError(self.path(*parts))


def read_sidecar(spark: SparkSession, folder: str, name: str = "slice_info.json") -> dict:
    """Optional JSON metadata beside a table; an empty dict when there is none."""
    place = Folder(spark, folder)
    return json.loads(place.read(name)) if place.exists(name) else {}


def sidecar_rows(spark: SparkSession, folder: str, schema: str, name: str = "slice_info.json") -> DataFrame:
    """The same as a DataFrame: its one row, or none when there is no such file."""
    place = Folder(spark, folder)
    if not place.exists(name):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(place.path(name), multiLine=True)


def write_sidecar(spark: SparkSession, folder: str, info: dict, name: str = "slice_info.json") -> None:
    Folder(spark, folder).publish(json.dumps(info, sort_keys=True), name)


def mirror_columns(df: DataFrame, columns: list[str], path: str, group_rows: int = 64) -> DataFrame:
    """Copy a column group to plain uncompressed Parquet in row groups of `group_rows`, and open it."""
    (
        df.select(*columns)
        .write.mode("errorifexists")
        .option("compression", "none")
        .option("parquet.block.row.count.limit", group_rows)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.select(*columns).schema).parquet(path)
