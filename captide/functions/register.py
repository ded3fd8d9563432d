"""SQL names for the document parsers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from captide.functions.captions import _containers_udf, _snippets_udf, read_containers
from captide.functions.tags import _tag_udf


@F.udtf(returnType="pos INT, href STRING, text STRING")
class CaptionRows:
    """One row per caption container of a page; none for a faulty page."""

    def eval(self, content: bytes):
        page = read_containers(content) if content is not None else {"containers": None}
        for row in page["containers"] or []:
            yield row["pos"], row["href"], row["text"]


def register_functions(spark: SparkSession) -> None:
    """``tv_tag_map``, ``tv_segments``, ``tv_snippets`` and the table function ``tv_segment_rows``."""
    spark.udf.register("tv_tag_map", _tag_udf(compat=False))
    spark.udf.register("tv_segments", _containers_udf)
    spark.udf.register("tv_snippets", _snippets_udf)
    spark.udtf.register("tv_segment_rows", CaptionRows)
