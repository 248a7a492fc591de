"""The narrow steps on streams: page files are cleaned, and printed dates read, as they arrive.

Only steps that look at one row are safe in append mode; segmentation, duplicate keys, alphabetical
order and comparison need all rows and stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import partial_date
from ..functions.text import extract
from ..sources.files import clean_pages


def page_stream(spark: SparkSession, folder: str, volume: str = "", running_title: str = "") -> DataFrame:
    """New page files of a folder, cleaned, as an append stream of volume, page, text."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "s*.txt").load(folder)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return clean_pages(raw.select(F.lit(volume).alias("volume"), extract(F.col("path"), r"/s+(\d+)\.txt$", 1).cast("int").alias("page"), text.alias("text")), running_title)


def dated(stream: DataFrame, column: str) -> DataFrame:
    """A stream, or table, with the reading of a printed date in ``datum``."""
    return stream.withColumn("datum", partial_date(column))
