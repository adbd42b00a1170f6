"""Review files: delimited text, JSON lines, Parquet; plain or gzipped."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.operators.cleaning import ALIASES, TIME_ALIASES, clean_ratings, timed_ratings
from ratingloom.scratch import materialize
from ratingloom.sources.metadata import line_place

# File endings per format; anything else is comma separated.
ENDINGS: dict[str, tuple[str, ...]] = {
    "tsv": (".tsv", ".txt"),
    "json": (".json", ".jsonl"),
    "parquet": (".parquet",),
}


def detect_format(path: str) -> str:
    """The format by ending; case and a trailing ``.gz`` do not matter."""
    name = path.lower().rstrip("/").removesuffix(".gz")
    for fmt, endings in ENDINGS.items():
        if name.endswith(endings):
            return fmt
    return "csv"


def read_raw(spark: SparkSession, path: str, fmt: str | None = None, timed: bool = False) -> DataFrame:
    """All columns as stored; text formats stay strings, so no inference pass.

    With ``timed``, ``place`` orders the rows as their files list them.
    """
    fmt = fmt or detect_format(path)
    if fmt == "parquet":
        raw = spark.read.parquet(path)
        return raw.withColumn("place", line_place()) if timed else raw
    if fmt == "json":
        names = [name for aliases in ALIASES.values() for name in aliases]
        names += [name for name in TIME_ALIASES if timed]
        raw = spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        raw = raw.json(path)
    elif fmt in ("csv", "tsv"):
        raw = spark.read.csv(path, header=True, sep="\t" if fmt == "tsv" else ",")
    else:
        raise ValueError(f"unknown format {fmt}: use csv, tsv, json or parquet")
    if timed:
        raw = raw.withColumn("place", line_place())
    if path.lower().endswith(".gz"):
        # One gzip file is one task; spread its rows before any work on them.
        width = int(spark.conf.get("spark.sql.shuffle.partitions"))
        raw = raw.repartition(width)
    return raw


def _used_columns(raw: DataFrame) -> DataFrame:
    """Drop alias columns no line of a JSON file fills, to see which are present."""
    filled = raw.agg(*[F.count(name).alias(name) for name in raw.columns]).first()
    return raw.select(*[name for name in raw.columns if filled[name]])


def read_reviews(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    columns: Mapping[str, str] | None = None,
    timed: bool = False,
) -> DataFrame:
    """Clean (user_id string, item_id string, rating double) rows of a file or folder.

    With ``timed`` also ``rated_at`` and ``place``, by which a pair's latest rating is told.

    ``columns`` names the source column per field.  Without it the first
    accepted alias is taken.  Which aliases JSON lines use shows only in the
    lines, so these are parsed once into a scratch table that answers it.
    """
    fmt = fmt or detect_format(path)
    raw = read_raw(spark, path, fmt, timed)
    if fmt == "json" and columns is None:
        raw = _used_columns(materialize(raw, "raw-reviews"))
    return timed_ratings(raw, columns) if timed else clean_ratings(raw, columns)
