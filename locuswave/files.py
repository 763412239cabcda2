"""Files that tasks open themselves: the few formats Spark has no reader or writer for."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path below it of a local path or a URI."""
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:/", path):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def plain_path(path: Column) -> Column:
    """Local file URIs as bare paths, so that they compare equal to paths in sample sheets."""
    return F.regexp_replace(path, "^file:/+", "/")


def listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, length) of all files that paths, folders and patterns name; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths)).select(
        plain_path(F.col("path")).alias("path"), "length")
