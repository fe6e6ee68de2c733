"""Transcript files that keep arriving: each micro-batch is read, cleaned and added to a growing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..sources import transcripts

_FILES = "path string, modificationTime timestamp, length long, content binary"


def transcript_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of CSV files that appear in a folder, cleaned, with their instant."""
    found = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.csv").load(folder)
    rows = transcripts.read(found)
    return rows.withColumn("message", text.final_clean(F.col("message"))).filter("message <> ''").withColumn("ts", text.chat_time(F.col("time_text")))


def follow(spark: SparkSession, folder: str, output: str, checkpoint: str) -> StreamingQuery:
    """Appends what is new to Parquet and stops when all files so far are in; run it again to go on where it ended."""
    return transcript_rows(spark, folder).writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
