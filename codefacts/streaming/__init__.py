"""File streams.

The analysed tool reads complete files once; it has no streaming operator.
The text extractors here are stateless projections, so they run unchanged on
a streaming DataFrame: ``read_source_stream`` is the source-tree reader (S1/S2)
as a file stream, and any ``codefacts.operators`` extractor that does not
aggregate (for example ``gofacts.functions`` / ``calls`` or
``client.split_sfc`` + ``client.select_options``) can be applied to it and
written with ``writeStream`` to a table or files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_source_stream(spark: SparkSession, root: str, suffix: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """``(path, content)`` for each new file under ``root`` ending with
    ``suffix``, one row per whole file."""
    r = (spark.readStream.format("text").option("wholetext", True)
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*" + suffix))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(root).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))
