"""Storing documents as files, one per show, the way the fetch stage leaves them."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.sources.files import locate

_WRITTEN = pa.schema([("file", pa.string()), ("bytes", pa.int64())])


def write_documents(documents: DataFrame, folder: str, file_name: Column, compressed: bool = False) -> int:
    """Write each ``content`` to its own file and return the number of files.

    Repeating a task writes the same files again.
    """

    def store(batches):
        system, base = locate(folder)
        system.create_dir(base, recursive=True)
        for batch in batches:
            written = []
            for row in batch.to_pylist():
                data = gzip.compress(row["content"], mtime=0) if compressed else row["content"]
                with system.open_output_stream(f"{base}/{row['file']}", compression=None) as sink:
                    sink.write(data)
                written.append({"file": row["file"], "bytes": len(data)})
            yield pa.RecordBatch.from_pylist(written, schema=_WRITTEN)

    files = documents.select(file_name.alias("file"), F.col("content"))
    stored = files.mapInArrow(store, "file STRING, bytes BIGINT")
    return stored.agg(F.count("*").alias("n")).first()["n"]
