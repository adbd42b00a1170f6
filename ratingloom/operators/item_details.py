"""Metadata of a list of items, in the order asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.scratch import materialize


def key_list(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    """(ordinal, key) of a short list: each key once, at its first place."""
    listed = spark.range(1).select(F.array_distinct(F.lit(list(keys)).cast("array<string>")).alias("keys"))
    return listed.select(F.posexplode("keys").alias("ordinal", "key"))


def first_places(listed: DataFrame) -> DataFrame:
    """(ordinal, key) from rows (ordinal, key) of any number: each key at its first place.

    ``ordinal`` may be anything that orders the list, gaps included.
    """
    return listed.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("ordinal").alias("ordinal"))


def _as_list(document: Column, field: str) -> Column:
    """The field as strings; of a nested list, its first inner list."""
    nested = F.try_variant_get(document, f"$.{field}", "array<array<string>>")
    flat = F.try_variant_get(document, f"$.{field}", "array<string>")
    return F.coalesce(F.get(nested, F.lit(0)), flat)


def category_path(document: Column) -> Column:
    """``A > B > C`` from ``category``, or from ``categories`` when that is empty."""
    text = F.to_json(F.try_variant_get(document, "$.category", "variant"))
    empty = F.coalesce(text, F.lit("null")).isin("null", "[]", "{}", '""', "0", "false")
    names = F.when(empty, _as_list(document, "categories")).otherwise(_as_list(document, "category"))
    spelled = F.transform(names, lambda name: F.coalesce(name, F.lit("None")))
    return F.when(names.isNotNull(), F.array_join(spelled, " > "))


def describe(documents: DataFrame) -> DataFrame:
    """(asin, title, category, brand, price) of parsed metadata documents.

    ``price`` is the text as stored, ``price_value`` the number it spells, if any.
    """
    document = F.col("document")

    def field(name: str, kind: str) -> Column:
        return F.try_variant_get(document, f"$.{name}", kind).alias(name)

    return documents.select(
        "place",
        field("asin", "string"),
        field("title", "string"),
        category_path(document).alias("category"),
        field("brand", "string"),
        field("price", "string"),
        F.expr("try_cast(try_variant_get(document, '$.price', 'string') AS double)").alias("price_value"),
    )


def lookup(details: DataFrame, keys: DataFrame, key: str = "asin") -> DataFrame:
    """First row per wanted key, in key order with its ``ordinal``; keys without a row are absent.

    ``details`` carries ``place``, which orders copies of a key.  The join drops
    everything else before the copies meet, and the first copy is picked by a
    partial aggregate, so a key with very many copies is reduced in every task.
    """
    wanted = details.join(keys.withColumnRenamed("key", key), key)  # keys are unique
    fields = [name for name in details.columns if name not in (key, "place")]
    first = F.min_by(F.struct(*fields), F.col("place")).alias("first")
    return (
        wanted.groupBy("ordinal", key)
        .agg(first)
        .orderBy("ordinal")
        .select("ordinal", key, *[f"first.{name}" for name in fields])
    )


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``position`` 1, 2, ... first, in the order of columns without ties.

    Stored in ranges of that order; a position is the sizes of the ranges before plus the
    place in its own, so no task sees more than a range.
    """
    columns = rows.columns
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "positions")
    stored = stored.withColumn("_part", F.shiftright("_at", 33))
    starts, total = [], 0
    for part, size in sorted(tuple(row) for row in stored.groupBy("_part").agg(F.count("*")).collect()):
        starts.append((part, total))
        total += size
    before = rows.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    position = (F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("int").alias("position")
    return stored.join(F.broadcast(before), "_part").select(position, *columns)
