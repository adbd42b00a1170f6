"""Details of a list of items from a metadata file.

    spark-submit --py-files ratingloom.zip ratingloom/plans/lookup_items.py --metadata meta.json.gz --output out/ \
        (ID [ID ...] | --keys-file ids.txt)

With ``--store FOLDER`` the details are parsed once and published there by key; later
lookups need no ``--metadata`` and read only the buckets of the wanted keys.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.item_details import describe, first_places, key_list, lookup
from ratingloom.scratch import scratch_tables
from ratingloom.session import open_session
from ratingloom.sources import snapshots
from ratingloom.sources.keyed import read_keys, write_keyed
from ratingloom.sources.metadata import line_place, read_metadata

# Fixed value: the name within a published store.
DETAILS = "details"


def keys_from_file(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, key) of a text file or folder with one key per line, of any length."""
    lines = spark.read.text(path).select(
        line_place().alias("ordinal"), F.trim("value").alias("key")
    )
    return first_places(lines.where("key <> ''"))


def item_details(
    spark: SparkSession, metadata_path: str, keys: Sequence[str] | DataFrame
) -> DataFrame:
    """(asin, title, category, brand, price, price_value) in the order of ``keys``."""
    wanted = keys if isinstance(keys, DataFrame) else key_list(spark, keys)
    return lookup(describe(read_metadata(spark, metadata_path)), wanted).drop("ordinal")


def store_details(spark: SparkSession, metadata_path: str, store: str) -> None:
    """Publish the first document of every key, for lookups that scan nothing."""
    with scratch_tables(spark):
        details = describe(read_metadata(spark, metadata_path)).where(F.col("asin").isNotNull())
        fields = [name for name in details.columns if name not in ("asin", "place")]
        first = details.groupBy("asin").agg(F.min_by(F.struct(*fields), "place").alias("first"))
        rows = first.select("asin", *[f"first.{name}" for name in fields])
        snapshots.publish(spark, store, {DETAILS: lambda path: write_keyed(rows, path, "asin")})
    snapshots.retire(spark, store)


def stored_details(spark: SparkSession, store: str, keys: Sequence[str] | DataFrame) -> DataFrame:
    """``item_details`` from a store, with ``ordinal`` first; ``keys`` as there."""
    listed = keys if isinstance(keys, DataFrame) else key_list(spark, keys)
    listed = listed.withColumnRenamed("key", "asin")
    wanted = listed if isinstance(keys, DataFrame) else list(dict.fromkeys(keys))
    found = read_keys(spark, snapshots.current(spark, store)[DETAILS], "asin", wanted)
    return listed.join(found, "asin").select("ordinal", *found.columns).orderBy("ordinal")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--metadata")
    parser.add_argument("--store", help="folder of published details; made from --metadata if that is given too")
    parser.add_argument("--output", required=True)
    parser.add_argument("--keys-file", help="text with one id per line")
    parser.add_argument("keys", nargs="*")
    args = parser.parse_args(argv)
    if bool(args.keys) == bool(args.keys_file):
        parser.error("give ids or --keys-file")
    if not (args.metadata or args.store):
        parser.error("give --metadata or --store")
    spark = open_session("ratingloom-lookup")
    keys = keys_from_file(spark, args.keys_file) if args.keys_file else args.keys
    if args.store and args.metadata:
        store_details(spark, args.metadata, args.store)
    found = stored_details(spark, args.store, keys).drop("ordinal") if args.store else item_details(spark, args.metadata, keys)
    found.write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
