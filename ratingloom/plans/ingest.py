"""Ingest feedback files that landed since the last run.

    spark-submit --py-files ratingloom.zip ratingloom/plans/ingest.py --source landing/ --target feedback/ --checkpoint state/
"""

from __future__ import annotations

import argparse

from ratingloom.session import open_session
from ratingloom.streaming.feedback import ingest_feedback


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--files-per-batch", type=int)
    args = parser.parse_args(argv)
    spark = open_session("ratingloom-feedback")
    ingest_feedback(
        spark, args.source, args.target, args.checkpoint, args.files_per_batch
    ).awaitTermination()


if __name__ == "__main__":
    main()
