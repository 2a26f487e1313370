"""Commit markers: small Parquet files, each appended whole, that say which folders of a table count.

A writer puts its rows into a folder nobody reads yet and then appends a marker. The append of one file is a
rename, so a reader meets all of a write or nothing of it, and what a marker replaces stays readable until it
is swept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def read_or_none(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """Parquet under ``path``, or None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    found = read_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def append_marker(rows: DataFrame, path: str) -> None:
    """Append ``rows`` in one file, so that they appear at once."""
    rows.coalesce(1).write.mode("append").parquet(path)


def folders(files: DataFrame) -> list[str]:
    """The folders of the rows' files (``file_path``, as ``_metadata`` has it)."""
    folder = F.regexp_extract("file_path", "^(.*)/[^/]+$", 1)
    return [row[0] for row in files.select(folder).distinct().collect()]


def delete_folders(spark: SparkSession, locations: Iterable[str]) -> int:
    """Delete folders, given as URIs such as ``_metadata.file_path`` holds, and return how many were there.

    Through Hadoop's FileSystem: it knows every store Spark writes to, and PySpark has no call of its own.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    for location in locations:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(location))
        deleted += path.getFileSystem(conf).delete(path, True)
    return deleted
