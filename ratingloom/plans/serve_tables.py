"""Batch result tables: recommendations per user, similar items per item.

    spark-submit --py-files ratingloom.zip ratingloom/plans/serve_tables.py recommend \
        --tables tables/ --model artifacts/als_model --output recommendations/ [--subjects ids/]

The table is published in buckets of its subjects, so that ``answers`` reads one
subject's rows from one bucket, or the popular list for a subject it lacks.  A model, map or
popularity table that does not exist yet is taken as empty: subjects then get
the popular items, or nothing if there are none.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.operators.popularity import recommend_from_popularity
from ratingloom.operators.recommending import recommend, similar_items
from ratingloom.scratch import scratch_tables
from ratingloom.session import open_session
from ratingloom.sources import snapshots, tables
from ratingloom.sources.keyed import read_keys, write_keyed
from ratingloom.sources.models import load_factors

# Names within a published answer table.
ANSWERS, FALLBACK = "answers", "fallback"


def recommendation_table(
    spark: SparkSession, tables_dir: str, model_path: str, users: DataFrame | None = None, n: int = 10, exclude_seen: bool = False
) -> DataFrame:
    """Recommendations for ``users`` (``user_id``), by default for every mapped user.

    ``exclude_seen`` leaves out what a user has an interaction with.
    """
    user_factors, item_factors = load_factors(spark, model_path)
    user_map, item_map, popular, interactions = tables.read_set(
        spark, tables_dir, tables.USER_MAP, tables.ITEM_MAP, tables.POPULAR_ITEMS, tables.INTERACTIONS
    )
    return recommend(
        user_map if users is None else users,
        user_factors,
        item_factors,
        user_map,
        item_map,
        popular,
        n,
        interactions if exclude_seen else None,
    )


def similarity_table(
    spark: SparkSession, tables_dir: str, model_path: str, items: DataFrame | None = None, n: int = 5
) -> DataFrame:
    """Similar items for ``items`` (``item_id``), by default for every mapped item."""
    item_map, popular = tables.read_set(spark, tables_dir, tables.ITEM_MAP, tables.POPULAR_ITEMS)
    return similar_items(item_map if items is None else items, load_factors(spark, model_path)[1], item_map, popular, n)


def publish_answers(spark: SparkSession, path: str, key: str, answers: DataFrame, popular: DataFrame, item_map: DataFrame, n: int) -> None:
    """Publish ``answers`` (key, rank, ...) for lookups by ``key``, with the popular list for other subjects."""
    listed = recommend_from_popularity(popular, n, item_map).withColumn("source", F.lit("popularity"))
    named = listed.withColumnRenamed("item_id", "similar_item_id") if "similar_item_id" in answers.columns else listed
    snapshots.publish(spark, path, {ANSWERS: lambda place: write_keyed(answers, place, key, "rank"), FALLBACK: named.coalesce(1).write.parquet})


def answers(spark: SparkSession, path: str, key: str, subjects: Sequence[str] | DataFrame) -> DataFrame:
    """What was published for ``subjects``, a list or a frame with the column ``key``; others get the popular list.

    Only the buckets of the subjects are read.
    """
    published = snapshots.current(spark, path)
    found = read_keys(spark, published[ANSWERS], key, subjects)
    if not isinstance(subjects, DataFrame):
        subjects = spark.range(1).select(F.explode(F.lit(list(subjects)).cast("array<string>")).alias(key))
    rest = subjects.select(key).dropna().distinct().join(found.select(key), key, "left_anti")
    listed = spark.read.parquet(published[FALLBACK])
    pick = listed.agg(F.sort_array(F.collect_list(F.struct(*[name for name in found.columns if name != key]))))
    others = rest.select(key, F.explode(pick.scalar()).alias("pick")).select(key, "pick.*")
    return found.unionByName(others.select(*found.columns))


_JOBS = {"recommend": (recommendation_table, 10, "user_id"), "similar": (similarity_table, 5, "item_id")}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=_JOBS)
    parser.add_argument("--tables", required=True)
    parser.add_argument("--model", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--subjects", help="Parquet with the ids wanted; all without it")
    parser.add_argument("-n", type=int)
    parser.add_argument("--exclude-seen", action="store_true", help="recommend nothing a user has rated")
    args = parser.parse_args(argv)
    spark = open_session(f"ratingloom-{args.job}")
    job, default_n, key = _JOBS[args.job]
    subjects = spark.read.parquet(args.subjects) if args.subjects else None
    n = default_n if args.n is None else args.n
    options = {"exclude_seen": True} if args.exclude_seen else {}
    with scratch_tables(spark):
        result = job(spark, args.tables, args.model, subjects, n, **options)
        item_map, popular = tables.read_set(spark, args.tables, tables.ITEM_MAP, tables.POPULAR_ITEMS)
        publish_answers(spark, args.output, key, result, popular, item_map, n)
    snapshots.retire(spark, args.output)


if __name__ == "__main__":
    main()
