"""Feedback events: JSON lines of any shape, ingested exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

RECEIVED, QUARANTINED = "received", "quarantined"


def feedback_lines(
    spark: SparkSession, source: str, files_per_batch: int | None = None
) -> DataFrame:
    """Streaming (line, payload, outcome) of the files landing in a folder."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(source).withColumnRenamed("value", "line")
    parsed = lines.withColumn("payload", F.try_parse_json("line"))
    broken = F.col("payload").isNull()
    return parsed.withColumn("outcome", F.when(broken, QUARANTINED).otherwise(RECEIVED))


def ingest_feedback(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append every new line to ``target`` and stop when none is left.

    ``files_per_batch`` cuts a large backlog into several commits.

    One pass feeds both outcomes: received lines and the quarantine are two
    partitions of the same table, so the file sink commits them together.
    """
    return (
        feedback_lines(spark, source, files_per_batch)
        .writeStream.partitionBy("outcome")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )


def read_feedback(spark: SparkSession, target: str) -> DataFrame:
    """Parsed payloads received so far."""
    return spark.read.parquet(target).where(F.col("outcome") == RECEIVED).select("payload")


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """Lines that are not JSON."""
    return spark.read.parquet(target).where(F.col("outcome") == QUARANTINED).select("line")
