"""Grid search over ALS, then the best model and the run's results.

    spark-submit --py-files ratingloom.zip ratingloom/plans/train.py --tables tables/ --artifacts artifacts/
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ratingloom.operators.factor_models import fit_als, predict_all
from ratingloom.operators.grid import ALS_GRID, best_trial, grid, search, trials_frame
from ratingloom.operators.splitting import hash_sample, hash_split
from ratingloom.scratch import scratch_tables
from ratingloom.session import open_session
from ratingloom.sources import tables
from ratingloom.sources.experiments import DOCUMENT_METRICS, write_results
from ratingloom.sources.models import save_model


@dataclass(frozen=True)
class Training:
    model_path: str
    params: dict[str, Any]
    metrics: dict[str, float]
    results: dict[str, str]


def train_als(
    spark: SparkSession,
    interactions: DataFrame,
    artifacts_dir: str,
    axes: Mapping[str, Sequence] = ALS_GRID,
    alpha: float = 1.0,
    maxIter: int = 10,
    seed: int = 42,
    k: int = 10,
    train_share: float = 0.8,
    blocks: int | None = None,
    implicit: bool = False,
) -> Training:
    """Split, search the grid, save the model of highest precision.

    An ``implicit`` model predicts preferences, so its error in ratings says little.
    """
    train, validation = (
        part.persist(StorageLevel.MEMORY_AND_DISK)
        for part in hash_split(interactions, train_share, seed)
    )
    try:
        fit = partial(fit_als, alpha=alpha, maxIter=maxIter, seed=seed, blocks=blocks, implicit=implicit)
        trials, model = search(train, validation, grid(axes), fit, k, score_all=predict_all)
    finally:
        train.unpersist()
        validation.unpersist()
    frame = trials_frame(spark, trials)
    best = best_trial(frame).first().asDict()
    params = {name: best[name] for name in axes}
    metrics = {theirs: best[ours] for ours, theirs in DOCUMENT_METRICS.items()}
    root = artifacts_dir.rstrip("/")
    path = save_model(model, f"{root}/als_model", params, metrics)
    results = write_results(frame, f"{root}/metrics", tuple(axes), k)
    return Training(path, params, metrics, results)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--tables", required=True)
    parser.add_argument("--artifacts", required=True)
    parser.add_argument("--rank", type=int, nargs="+", default=ALS_GRID["rank"])
    parser.add_argument("--reg", type=float, nargs="+", default=ALS_GRID["regParam"])
    parser.add_argument("--alpha", type=float, default=1.0)
    parser.add_argument("--maxiter", type=int, default=10)
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--blocks", type=int, help="part of the model, like the seed; by default it follows from the number of ratings")
    parser.add_argument("--implicit", action="store_true", help="ratings are counts of use; --alpha weighs them")
    parser.add_argument("--train-share", type=float, default=0.8)
    parser.add_argument("--sample-fraction", type=float, default=1.0)
    parser.add_argument("--sample-seed", type=int, default=42)
    args = parser.parse_args(argv)
    spark = open_session("ratingloom-train")
    interactions = tables.read_table(spark, args.tables, tables.INTERACTIONS)
    sample = hash_sample(interactions, args.sample_fraction, args.sample_seed)
    axes = {"rank": tuple(args.rank), "regParam": tuple(args.reg)}
    with scratch_tables(spark):
        done = train_als(
            spark,
            sample,
            args.artifacts,
            axes,
            args.alpha,
            args.maxiter,
            args.seed,
            train_share=args.train_share,
            blocks=args.blocks,
            implicit=args.implicit,
        )
    print(done.model_path, done.params, done.metrics)


if __name__ == "__main__":
    main()
