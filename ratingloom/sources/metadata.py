"""Ragged JSON-lines metadata; lines that do not parse are skipped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def line_place() -> Column:
    """Orders the lines of a text scan as files list them: by file, then by the
    start of the split, then by position inside the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(place, document) per readable line, ``place`` by ``line_place``."""
    lines = spark.read.text(path).select(
        line_place().alias("place"),
        F.try_parse_json(F.trim("value")).alias("document"),
    )
    return lines.where(F.col("document").isNotNull())
