"""Raw reviews to the four pipeline tables.

    spark-submit --py-files ratingloom.zip ratingloom/plans/etl.py --input reviews.json.gz --output tables/
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ratingloom.operators.indexing import index_ids
from ratingloom.operators.popularity import compute_popularity
from ratingloom.operators.repeats import HOW, one_per_pair
from ratingloom.operators.thresholds import min_interactions
from ratingloom.scratch import materialize, scratch_tables
from ratingloom.session import open_session
from ratingloom.sources import snapshots, tables
from ratingloom.sources.reviews import detect_format, read_reviews


def preprocess_reviews(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    minimum: int = 5,
    fmt: str | None = None,
    columns: Mapping[str, str] | None = None,
    iterations: int | None = 1,
    dedupe: str | None = None,
) -> dict[str, str]:
    """Clean, threshold, index and write; returns the written paths.

    ``dedupe`` keeps one rating of each user and item: "max", "last" or "avg".

    Several aggregates and joins read the clean rows and the rows that pass the
    thresholds, so the rows are stored as columns once before each; text is
    parsed once.
    """
    fmt = fmt or detect_format(input_path)
    with scratch_tables(spark):
        clean = read_reviews(spark, input_path, fmt, columns, timed=dedupe == "last")
        # JSON whose columns had to be found is in a scratch table already.
        if fmt in ("csv", "tsv") or (fmt == "json" and columns is not None):
            clean = materialize(clean, "clean")
        if dedupe is not None:
            clean = materialize(one_per_pair(clean, dedupe), "one-per-pair")
        kept = materialize(min_interactions(clean, minimum, iterations=iterations), "kept")
        indexed = index_ids(kept)
        paths: dict[str, str] = {}

        def table(rows: Callable[[], DataFrame], name: str) -> Callable[[str], None]:
            def write(path: str) -> None:
                rows().write.parquet(path)
                paths[name] = path

            return write

        def popular() -> DataFrame:
            return compute_popularity(spark.read.parquet(paths[tables.INTERACTIONS]))

        # All four tables or none: readers never see those of two runs.
        sources = {
            tables.INTERACTIONS: lambda: indexed.interactions,
            tables.USER_MAP: lambda: indexed.user_map.orderBy("user_idx"),
            tables.ITEM_MAP: lambda: indexed.item_map.orderBy("item_idx"),
            tables.POPULAR_ITEMS: popular,
        }
        written = snapshots.publish(spark, output_dir, {name: table(rows, name) for name, rows in sources.items()})
    return {name.removesuffix(".parquet"): path for name, path in written.items()}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--min-interactions", type=int, default=5)
    parser.add_argument("--iterations", type=int, default=1, help="threshold passes; 0 repeats them until nothing falls")
    parser.add_argument("--dedupe", choices=HOW, help="one rating of each user and item; all are kept without it")
    parser.add_argument("--format", choices=["csv", "tsv", "json", "parquet"])
    args = parser.parse_args(argv)
    spark = open_session("ratingloom-etl")
    paths = preprocess_reviews(
        spark, args.input, args.output, args.min_interactions, args.format, iterations=args.iterations or None, dedupe=args.dedupe
    )
    for name, path in paths.items():
        print(f"{name}\t{spark.read.parquet(path).count()} rows\t{path}")


if __name__ == "__main__":
    main()
