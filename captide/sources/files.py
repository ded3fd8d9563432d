"""Files: their order, and opening them from tasks on any storage Arrow knows."""

from __future__ import annotations

from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import Column
from pyspark.sql import functions as F


# Schemes that Arrow opens under their own name.
SCHEMES = ("s3", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss")


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a location as Spark names it; bare paths are local."""
    scheme, _, rest = uri.partition(":")
    if uri.startswith("/") or not rest or scheme == "file":
        return fs.LocalFileSystem(), uri.removeprefix("file://").removeprefix("file:")
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    elif scheme not in SCHEMES:
        raise ValueError(f"cannot open {uri!r} from a task: no file system for {scheme!r}")
    return fs.FileSystem.from_uri(quote(uri, safe="/:@?&=+,;"))


def block_order(file: Column, block: Column) -> Column:
    """Sort key of input splits: folder, number of a part file, file name, offset.

    Part numbers count as numbers, as there may be more than their digits foresee.
    """
    return F.struct(
        F.regexp_extract(file, r"^(.*/)", 1).alias("folder"),
        F.regexp_extract(file, r"/part-(\d+)[^/]*$", 1).try_cast("bigint").alias("part"),
        file.alias("file"),
        block.alias("block"),
    )
