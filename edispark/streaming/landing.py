"""IDoc files that land in a folder, as a stream of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edispark.functions.layout import framing_of
from edispark.shipping import ship
from edispark.sources.idoc import SCHEMA, cut_files
from edispark.sources.kinds import Kind
from edispark.sources.stores import streams


def stream_raw(spark: SparkSession, folder: str, framing: str | None = None, lenient: bool = False, pattern: str = "*.{idoc,idoc.gz,idoc.zst}", files_per_batch: int = 1000) -> DataFrame:
    """The raw record columns for every new file; each file is read once, as Spark's checkpoint remembers it.

    Tasks open the files themselves and hold a chunk at a time, where they can; files of other stores come as values.
    """
    ship(spark)
    kind = framing_of(framing)

    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = files.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(folder)
    return files.select("path", *([] if streams(folder) else ["content"])).mapInArrow(cut_files(Kind({}), kind, lenient, False), SCHEMA)
