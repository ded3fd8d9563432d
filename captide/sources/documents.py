"""Raw documents, one file per show: metadata XML and caption HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.functions.identifiers import GZIP_SUFFIX, META_SUFFIX, PAGE_SUFFIX
from captide.session import broadcast_if_small

SUFFIXES = {"meta": META_SUFFIX, "page": PAGE_SUFFIX}


def scan_documents(
    spark: SparkSession, folder: str, kind: str, compressed: bool = False, prefix: str = ""
) -> DataFrame:
    """Documents of one kind and form in a folder: ``(identifier, path, content)``.

    Only files of that form are opened. The driver holds the list of files: a folder
    with more files than it can hold is gathered in rounds, each with another
    ``prefix`` of the file names.
    """
    ending = SUFFIXES[kind] + (GZIP_SUFFIX if compressed else "")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"{prefix}*{ending}")
        .load(folder)
    )
    name = F.element_at(F.split("path", "/"), -1)
    identifier = F.substring(name, F.lit(1), F.length(name) - len(ending))
    return files.select(identifier.alias("identifier"), "path", "content")


def read_documents(spark: SparkSession, folder: str, kind: str, prefix: str = "") -> DataFrame:
    """``(identifier, content)``, one document per show: the plain file wins over the compressed one.

    Shows stored in both forms are found from file names alone. Only compressed
    documents are compared with that list, so plain content never moves, and
    compressed content moves only when the list is too large to broadcast.
    """
    plain = scan_documents(spark, folder, kind, prefix=prefix)
    compressed = scan_documents(spark, folder, kind, compressed=True, prefix=prefix)
    both, _ = broadcast_if_small(
        compressed.select("identifier").join(plain.select("identifier"), "identifier", "left_semi")
    )
    remaining = compressed.join(both, "identifier", "left_anti")
    return plain.unionByName(remaining).select("identifier", "content")
