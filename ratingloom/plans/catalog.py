"""Every operator as a query over a data folder, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratingloom.functions import vectors as vec
from ratingloom.operators import (
    cleaning,
    factor_models,
    fold_in,
    grid,
    indexing,
    item_details,
    popularity,
    profile,
    ranking_metrics,
    recommending,
    repeats,
    sketches,
    splitting,
    thresholds,
)
from ratingloom.operators.nearest import top_n
from ratingloom.plans import bias_model, inputs, lookup_items, serve_tables, train
from ratingloom.plans.bias_model import RatingSums
from ratingloom.plans.etl import preprocess_reviews
from ratingloom.scratch import materialize, scratch_path
from ratingloom.sources import experiments, models, reviews, tables
from ratingloom.sources.metadata import read_metadata
from ratingloom.streaming import feedback

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Light buyers and parts both exist below this count in the given tables.
MINIMUM = 30
K = 10
# A minimum whose core is not empty in the given tables and takes several rounds, and rounds that surely do.
CORE_MINIMUM, CORE_ROUNDS = 22, 16

_RATINGS = """
ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_KEPT = f"""{_RATINGS},
kept AS (
  SELECT * FROM ratings
  WHERE user_id IN (SELECT user_id FROM ratings GROUP BY 1 HAVING count(*) >= {MINIMUM})
    AND item_id IN (SELECT item_id FROM ratings GROUP BY 1 HAVING count(*) >= {MINIMUM}))"""

_MAPS = f"""{_KEPT},
user_map AS (
  SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS user_idx, user_id
  FROM kept GROUP BY user_id),
item_map AS (
  SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, item_id) - 1 AS INTEGER) AS item_idx, item_id
  FROM kept GROUP BY item_id),
indexed AS (
  SELECT user_idx, item_idx, rating FROM kept JOIN user_map USING (user_id) JOIN item_map USING (item_id))"""

_POPULAR = """SELECT item_idx, count(*) AS count_ratings, round(avg(rating), 6) AS avg_rating
  FROM indexed GROUP BY item_idx"""

_PAIRS = """
pairs AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_idx, CAST(l_partkey AS INTEGER) AS item_idx,
         CAST(max(ceil(l_quantity / 10)) AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

# md5 hex digests below this text are four fifths of all digests.
_SPLIT = f"""{_PAIRS},
split AS (
  SELECT *, md5(concat(user_idx, '|', item_idx, '|split|42')) < 'cccccccc' AS in_train FROM pairs),
train AS (SELECT user_idx, item_idx, rating FROM split WHERE in_train),
validation AS (SELECT user_idx, item_idx, rating FROM split WHERE NOT in_train)"""


def _scored(candidates: str) -> str:
    """Bias-model predictions and ranking metrics per candidate, as CTEs."""
    return f"""{_SPLIT},
candidates AS (SELECT * FROM (VALUES {candidates}) AS c(ordinal, item_damping, user_damping)),
overall AS (SELECT avg(rating) AS mean FROM train),
item_bias AS (
  SELECT ordinal, item_idx, sum(rating - mean) / (count(*) + item_damping) AS item_bias
  FROM train, overall, candidates GROUP BY ordinal, item_idx, item_damping),
user_bias AS (
  SELECT ordinal, user_idx, sum(rating - mean) / (count(*) + user_damping) AS user_bias
  FROM train, overall, candidates GROUP BY ordinal, user_idx, user_damping),
predictions AS (
  SELECT ordinal, user_idx, item_idx, rating, round(mean + item_bias + user_bias, 9) AS prediction,
         CASE WHEN rating >= 4 THEN 1 ELSE 0 END AS rel
  FROM validation JOIN item_bias USING (item_idx) JOIN user_bias USING (ordinal, user_idx), overall),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY ordinal, user_idx ORDER BY prediction DESC, item_idx) AS rk,
    row_number() OVER (PARTITION BY ordinal, user_idx ORDER BY rel DESC, item_idx) AS ideal_rk
  FROM predictions),
per_user AS (
  SELECT ordinal, user_idx,
    avg(rel) FILTER (rk <= {K}) AS "precision",
    CASE WHEN sum(rel) > 0 THEN (sum(rel) FILTER (rk <= {K})) / CAST(sum(rel) AS DOUBLE) END AS recall,
    CASE WHEN sum(rel) > 0 THEN (sum(rel / log2(rk + 1)) FILTER (rk <= {K}))
         / (sum(rel / log2(ideal_rk + 1)) FILTER (ideal_rk <= {K})) ELSE 0 END AS ndcg
  FROM ranked GROUP BY ordinal, user_idx),
errors AS (
  SELECT ordinal, sqrt(avg((rating - prediction) * (rating - prediction))) AS rmse
  FROM predictions GROUP BY ordinal),
trials AS (
  SELECT ordinal, ANY_VALUE(item_damping) AS item_damping, ANY_VALUE(user_damping) AS user_damping,
    round(ANY_VALUE(rmse), 6) AS rmse, round(avg("precision"), 6) AS precision_at_k,
    round(avg(recall), 6) AS recall_at_k, round(avg(ndcg), 6) AS ndcg_at_k,
    row_number() OVER (ORDER BY round(avg("precision"), 9) DESC, round(ANY_VALUE(rmse), 9), ordinal) AS place
  FROM per_user JOIN errors USING (ordinal) JOIN candidates USING (ordinal) GROUP BY ordinal)"""


_ONE = _scored("(0, 10.0::DOUBLE, 10.0::DOUBLE)")
_AXES = {"item_damping": (0.0, 10.0), "user_damping": (0.0, 10.0, 50.0)}
_GRID = _scored(
    ", ".join(
        f"({at}, {c['item_damping']}::DOUBLE, {c['user_damping']}::DOUBLE)"
        for at, c in enumerate(grid.grid(_AXES))
    )
)


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _six(*names: str) -> list:
    return [F.round(name, 6).alias(name) for name in names]


# -- reading and cleaning ------------------------------------------------------


@query("interactions_view", f"WITH {_RATINGS} SELECT * FROM ratings")
def interactions_view(spark, folder):
    return inputs.ratings(spark, folder)


_EVENT_REVIEWS = """
SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id,
       CAST(CASE event_type WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4
                            WHEN 'click' THEN 3 WHEN 'view' THEN 2 END AS DOUBLE) AS rating
FROM events"""


@query("clean_ratings", f"SELECT * FROM ({_EVENT_REVIEWS}) WHERE rating IS NOT NULL")
def clean_ratings(spark, folder):
    return cleaning.clean_ratings(inputs.event_reviews(spark, folder))


@query(
    "rejected_count",
    f"""SELECT count(*) AS num_rows, count(rating) AS num_kept, count(*) - count(rating) AS num_rejected
    FROM ({_EVENT_REVIEWS})""",
)
def rejected_count(spark, folder):
    return cleaning.rejected_count(inputs.event_reviews(spark, folder))


def _file_query(name: str, fmt: str, write: Callable[[DataFrame, str], None]):
    """Write the ratings as a text file set, then read them as reviews."""

    @query(name, f"WITH {_RATINGS} SELECT * FROM ratings")
    def run(spark, folder):
        path = scratch_path(spark, "reviews") + fmt
        write(inputs.ratings(spark, folder), path)
        return reviews.read_reviews(spark, path)


_file_query("reviews_csv", ".csv", lambda df, path: df.write.csv(path, header=True))
_file_query(
    "reviews_tsv",
    ".tsv",
    lambda df, path: df.toDF("user", "item", "stars").write.csv(path, header=True, sep="\t"),
)
_file_query(
    "reviews_json",
    ".json.gz",
    lambda df, path: df.toDF("reviewerID", "asin", "overall").write.json(path, compression="gzip"),
)
_file_query("reviews_parquet", ".parquet", lambda df, path: df.write.parquet(path))


# -- thresholds, indices, popularity -------------------------------------------


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    ratings = materialize(inputs.ratings(spark, folder), "ratings")
    return thresholds.min_interactions(ratings, MINIMUM)


def _indexed(spark: SparkSession, folder: str) -> indexing.Indexed:
    return indexing.index_ids(materialize(_kept(spark, folder), "kept"))


@query("min_interactions", f"WITH {_KEPT} SELECT * FROM kept")
def min_interactions(spark, folder):
    return _kept(spark, folder)


def _peeled(rounds: int) -> str:
    """Rounds of the threshold pass, each on what the one before has left."""
    steps = [f"""
r{n + 1} AS MATERIALIZED (
  SELECT * FROM r{n}
  WHERE user_id IN (SELECT user_id FROM r{n} GROUP BY 1 HAVING count(*) >= {CORE_MINIMUM})
    AND item_id IN (SELECT item_id FROM r{n} GROUP BY 1 HAVING count(*) >= {CORE_MINIMUM}))""" for n in range(rounds)]
    return f"WITH {_RATINGS}, r0 AS MATERIALIZED (SELECT * FROM ratings), {','.join(steps)} SELECT * FROM r{rounds}"


@query("k_core", _peeled(CORE_ROUNDS))
def k_core(spark, folder):
    """Ratings of the users and items that stay when the threshold pass is repeated until nothing falls."""
    ratings = materialize(inputs.ratings(spark, folder), "ratings")
    return thresholds.min_interactions(ratings, CORE_MINIMUM, iterations=None)


@query("min_interactions_twice", _peeled(2))
def min_interactions_twice(spark, folder):
    ratings = materialize(inputs.ratings(spark, folder), "ratings")
    return thresholds.min_interactions(ratings, CORE_MINIMUM, iterations=2)


def _map(spark: SparkSession, folder: str, key: str, index: str) -> DataFrame:
    return indexing.dense_index(_kept(spark, folder), key, index).rows.drop("cnt").orderBy(index)


@query("user_map", f"WITH {_MAPS} SELECT user_idx, user_id FROM user_map")
def user_map(spark, folder):
    return _map(spark, folder, "user_id", "user_idx")


@query("item_map", f"WITH {_MAPS} SELECT item_idx, item_id FROM item_map")
def item_map(spark, folder):
    return _map(spark, folder, "item_id", "item_idx")


@query("interactions_indexed", f"WITH {_MAPS} SELECT * FROM indexed")
def interactions_indexed(spark, folder):
    return _indexed(spark, folder).interactions


@query(
    "etl_job",
    f"""WITH {_MAPS}, popular AS ({_POPULAR})
    SELECT user_idx, user_id, item_idx, item_id, rating, count_ratings, avg_rating
    FROM kept JOIN user_map USING (user_id) JOIN item_map USING (item_id) JOIN popular USING (item_idx)""",
)
def etl_job(spark, folder):
    """The whole job on stored reviews; its four tables are joined back together."""
    source, out = scratch_path(spark, "reviews") + ".parquet", scratch_path(spark, "tables")
    inputs.ratings(spark, folder).write.parquet(source)
    preprocess_reviews(spark, source, out, MINIMUM)
    popular = tables.read_table(spark, out, tables.POPULAR_ITEMS)
    return (
        tables.read_table(spark, out, tables.INTERACTIONS)
        .join(tables.read_table(spark, out, tables.USER_MAP), "user_idx")
        .join(tables.read_table(spark, out, tables.ITEM_MAP), "item_idx")
        .join(popular.select("item_idx", "count_ratings", *_six("avg_rating")), "item_idx")
    )


# Several ratings of one pair at one hour occur, so the order of lines decides.
_TIMED = """
timed AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS item_id, event_id,
         CAST(CASE event_type WHEN 'purchase' THEN 5 WHEN 'signup' THEN 4
                              WHEN 'click' THEN 3 WHEN 'view' THEN 2 END AS DOUBLE) AS rating,
         CASE WHEN event_id % 9 > 0 THEN CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 END AS rated_at
  FROM events)"""


def _timed_reviews(spark: SparkSession, folder: str) -> str:
    """Events as JSON reviews in the order of their numbers, by the hour, some without a time."""
    hour = F.floor(F.unix_timestamp("unixReviewTime") / 3600) * 3600
    path = scratch_path(spark, "reviews") + ".json"
    raw = inputs.event_reviews(spark, folder).withColumn("unixReviewTime", F.when(F.col("event_id") % 9 > 0, hour))
    raw.repartitionByRange(4, "event_id").sortWithinPartitions("event_id").drop("event_id").write.json(path)
    return path


def _dedupe_query(how: str, chosen: str) -> None:
    @query(
        f"dedupe_{how}",
        f"WITH {_TIMED} SELECT user_id, item_id, {chosen} AS rating FROM timed WHERE rating IS NOT NULL GROUP BY user_id, item_id",
    )
    def run(spark, folder):
        rows = reviews.read_reviews(spark, _timed_reviews(spark, folder), timed=True)
        kept = repeats.one_per_pair(rows, how)
        return kept.select("user_id", "item_id", *_six("rating"))


_dedupe_query("last", "arg_max(rating, (coalesce(rated_at, -1), event_id))")
_dedupe_query("max", "max(rating)")
_dedupe_query("avg", "round(avg(rating), 6)")


@query(
    "encode_known_ids",
    f"""WITH {_MAPS}
    SELECT user_idx, item_idx, rating
    FROM ratings JOIN user_map USING (user_id) JOIN item_map USING (item_id)""",
)
def encode_known_ids(spark, folder):
    # Stored once: the counts, the maps and the encoding each read the ratings again.
    ratings = materialize(inputs.ratings(spark, folder), "ratings")
    maps = indexing.index_ids(materialize(thresholds.min_interactions(ratings, MINIMUM), "kept"))
    return indexing.encode(ratings, maps.user_map, maps.item_map)


@query(
    "user_preview",
    f"""WITH {_MAPS}
    SELECT user_idx, user_id, (SELECT count(*) FROM user_map) AS num_users
    FROM user_map ORDER BY user_idx LIMIT 20""",
)
def user_preview(spark, folder):
    users = _map(spark, folder, "user_id", "user_idx")
    return (
        users.orderBy("user_idx")
        .limit(20)
        .withColumn("num_users", users.agg(F.count("*")).scalar())
    )


@query("popular_items", f"WITH {_MAPS} {_POPULAR}")
def popular_items(spark, folder):
    popular = popularity.compute_popularity(_indexed(spark, folder).interactions)
    return popular.select("item_idx", "count_ratings", *_six("avg_rating"))


@query(
    "popular_topn",
    f"""WITH {_MAPS}, popular AS ({_POPULAR}),
    best AS (
      SELECT *, CAST(row_number() OVER (ORDER BY count_ratings DESC, item_idx) AS INTEGER) AS rank
      FROM popular)
    SELECT rank, item_id, CAST(count_ratings AS DOUBLE) AS score
    FROM best JOIN item_map USING (item_idx) WHERE rank <= 10""",
)
def popular_topn(spark, folder):
    indexed = _indexed(spark, folder)
    popular = popularity.compute_popularity(indexed.interactions)
    return popularity.recommend_from_popularity(popular, 10, indexed.item_map)


@query(
    "popularity_by_item_id",
    f"""WITH {_RATINGS}
    SELECT item_id, count(*) AS count_ratings, round(avg(rating), 6) AS avg_rating
    FROM ratings GROUP BY item_id""",
)
def popularity_by_item_id(spark, folder):
    popular = popularity.compute_popularity(inputs.ratings(spark, folder))
    return popular.select("item_id", "count_ratings", *_six("avg_rating"))


# -- descriptive statistics ----------------------------------------------------

_LINES = """
lines AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_idx, CAST(l_partkey AS INTEGER) AS item_idx,
         l_quantity / 10 AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings with fractions, so that half-step bins have work to do."""
    return inputs.order_lines(spark, folder).select(
        F.col("o_custkey").cast("int").alias("user_idx"),
        F.col("l_partkey").cast("int").alias("item_idx"),
        (F.col("l_quantity") / 10).alias("rating"),
    )


_SLICES = """
slices AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
         year(o_orderdate) AS year, CAST(ceil(l_quantity / 10) AS INTEGER) AS stars
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(
    "distinct_sketches",
    f"""WITH {_SLICES}
    SELECT year, stars, count(*) AS num_rows, count(DISTINCT user_id) AS num_users, count(DISTINCT item_id) AS num_items,
           true AS users_within, true AS items_within
    FROM slices GROUP BY GROUPING SETS ((year, stars), (year), (stars), ())""",
)
def distinct_sketches(spark, folder):
    """Stored sketches by year and stars, and their unions, against exact counts: all within three standard errors."""
    lines = inputs.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.year("o_orderdate").cast("long").alias("year"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("stars"),
    )
    stored = materialize(sketches.sketch_slices(rows, ["year", "stars"]), "sketches")
    found = None
    for by in (["year", "stars"], ["year"], ["stars"], []):
        exact = rows.groupBy(*by).agg(F.count_distinct("user_id").alias("num_users"), F.count_distinct("item_id").alias("num_items"))
        guess = sketches.estimates(sketches.merge_slices(stored, by)).withColumnsRenamed({"num_user_id": "users", "num_item_id": "items"})
        same = [guess[name].eqNullSafe(exact[name]) for name in by] or [F.lit(True)]
        both = guess.join(exact, reduce(lambda a, b: a & b, same))
        names = [guess[name] if name in by else F.lit(None).cast(kind).alias(name) for name, kind in (("year", "long"), ("stars", "int"))]
        bound = 3 * sketches.relative_error()
        within = [(F.abs(F.col(k) - F.col(f"num_{k}")) <= bound * F.col(f"num_{k}")).alias(f"{k}_within") for k in ("users", "items")]
        part = both.select(*names, "num_rows", "num_users", "num_items", *within)
        found = part if found is None else found.union(part)
    return found


@query(
    "basic_stats",
    f"""WITH {_LINES}, sizes AS (
      SELECT CAST(count(*) AS DOUBLE) AS num_rows, CAST(count(DISTINCT user_idx) AS DOUBLE) AS num_users,
             CAST(count(DISTINCT item_idx) AS DOUBLE) AS num_items FROM lines)
    SELECT *, round(1 - least(1, num_rows / greatest(1, num_users * num_items)), 6) AS sparsity
    FROM sizes""",
)
def basic_stats(spark, folder):
    sizes = profile.overview(_lines(spark, folder))
    return sizes.select("num_rows", "num_users", "num_items", *_six("sparsity"))


@query(
    "rating_summary",
    f"""WITH {_LINES}
    SELECT count(rating) AS "count", round(avg(rating), 6) AS mean,
           round(quantile_cont(rating, 0.5), 6) AS median, min(rating) AS "min", max(rating) AS "max"
    FROM lines""",
)
def rating_summary(spark, folder):
    summary = profile.rating_profile(_lines(spark, folder))
    return summary.select("count", *_six("mean", "median"), "min", "max")


@query(
    "rating_distribution",
    f"""WITH {_LINES}
    SELECT round(rating * 2) / 2 AS rating_bin, count(rating) AS "count" FROM lines GROUP BY 1""",
)
def rating_distribution(spark, folder):
    return profile.distribution(_lines(spark, folder))


@query(
    "user_activity",
    f"WITH {_LINES} SELECT user_idx, count(item_idx) AS num_ratings FROM lines GROUP BY 1",
)
def user_activity(spark, folder):
    return profile.user_activity(_lines(spark, folder))


@query(
    "item_popularity",
    f"WITH {_LINES} SELECT item_idx, count(user_idx) AS num_ratings FROM lines GROUP BY 1",
)
def item_popularity(spark, folder):
    return profile.item_popularity(_lines(spark, folder))


def _histogram_sql(key: str, limit: str = "") -> str:
    return f"""WITH {_LINES},
    counts AS (
      SELECT {key}, count(*) AS n FROM lines GROUP BY {key} ORDER BY n DESC, {key} {limit}),
    span AS (SELECT CAST(min(n) AS DOUBLE) AS lo, CAST(max(n) AS DOUBLE) AS hi FROM counts),
    placed AS (
      SELECT lo, hi, CAST(least(floor((n - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin
      FROM counts, span)
    SELECT bin, round(lo + bin * ((hi - lo) / 50), 6) AS low,
           round(lo + (bin + 1) * ((hi - lo) / 50), 6) AS high, count(*) AS frequency
    FROM placed GROUP BY bin, lo, hi"""


def _histogram(counts: DataFrame, limit_top: int | None = None) -> DataFrame:
    bins = profile.histogram(counts, 50, limit_top)
    return bins.select("bin", *_six("low", "high"), "frequency")


@query("activity_histogram", _histogram_sql("user_idx"))
def activity_histogram(spark, folder):
    return _histogram(profile.user_activity(_lines(spark, folder)))


@query("popularity_histogram", _histogram_sql("item_idx"))
def popularity_histogram(spark, folder):
    return _histogram(profile.item_popularity(_lines(spark, folder)))


@query("activity_histogram_top", _histogram_sql("user_idx", "LIMIT 100"))
def activity_histogram_top(spark, folder):
    return _histogram(profile.user_activity(_lines(spark, folder)), 100)


# -- splits and samples --------------------------------------------------------


@query("hash_split", f"WITH {_SPLIT} SELECT user_idx, item_idx, rating, in_train FROM split")
def hash_split(spark, folder):
    return splitting.mark_split(inputs.rated_pairs(spark, folder))


@query(
    "sampled_split",
    f"""WITH {_SPLIT} SELECT user_idx, item_idx, rating, in_train FROM split
    WHERE md5(concat(user_idx, '|', item_idx, '|sample|42')) < '80000000'""",
)
def sampled_split(spark, folder):
    """Half of the pairs, then the split, which the sample does not tilt."""
    return splitting.mark_split(splitting.hash_sample(inputs.rated_pairs(spark, folder), 0.5))


@query(
    "hash_sample",
    f"""WITH {_PAIRS} SELECT * FROM pairs
    WHERE md5(concat(user_idx, '|', item_idx, '|sample|42')) < '40000000'""",
)
def hash_sample(spark, folder):
    return splitting.hash_sample(inputs.rated_pairs(spark, folder), 0.25)


def _times_found(every: DataFrame, **parts: DataFrame) -> DataFrame:
    """Every pair with the number of times each part holds it, as one row per pair."""
    keys = ["user_idx", "item_idx", "rating"]
    tagged = every.select(*keys, F.lit("").alias("part"))
    for name, part in parts.items():
        tagged = tagged.unionByName(part.select(*keys, F.lit(name).alias("part")))
    counts = [F.count(F.when(F.col("part") == name, 1)).alias(name) for name in ("", *parts)]
    return tagged.groupBy(*keys).agg(*counts).withColumnRenamed("", "given")


@query(
    "bernoulli_sample",
    f"""WITH {_PAIRS} SELECT user_idx, item_idx, rating, true AS within, true AS share_fits FROM pairs""",
)
def bernoulli_sample(spark, folder):
    """Which rows fall into the sample is Spark's draw; here every pair says that
    the sample holds it at most once, and that the sample's share is near a quarter."""
    pairs = materialize(inputs.rated_pairs(spark, folder), "pairs")
    sample = materialize(splitting.bernoulli_sample(pairs, 0.25), "sample")
    found = _times_found(pairs, sample=sample)
    n, drawn = pairs.count(), sample.count()
    fits = abs(drawn - n / 4) <= 6 * (n * 3 / 16) ** 0.5
    within = (F.col("given") == 1) & (F.col("sample") <= 1)
    return found.select("user_idx", "item_idx", "rating", within.alias("within"), F.lit(fits).alias("share_fits"))


@query(
    "random_split",
    f"""WITH {_PAIRS} SELECT user_idx, item_idx, rating, true AS in_one_part, true AS share_fits FROM pairs""",
)
def random_split(spark, folder):
    """Spark's draw again: every pair is in exactly one part, and the parts' sizes fit."""
    pairs = materialize(inputs.rated_pairs(spark, folder), "pairs")
    train, validation = (materialize(p, "part") for p in splitting.random_split(pairs))
    found = _times_found(pairs, train=train, validation=validation)
    n, drawn = pairs.count(), train.count()
    fits = abs(drawn - 0.8 * n) <= 6 * (n * 0.16) ** 0.5
    once = (F.col("given") == 1) & (F.col("train") + F.col("validation") == 1)
    return found.select("user_idx", "item_idx", "rating", once.alias("in_one_part"), F.lit(fits).alias("share_fits"))


# -- ranking metrics, on predictions of the bias model --------------------------


def _split_pairs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return splitting.hash_split(materialize(inputs.rated_pairs(spark, folder), "pairs"))


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    train, validation = _split_pairs(spark, folder)
    return RatingSums.of(train).fit(train, 10.0, 10.0).transform(validation)


@query(
    "topk_per_user",
    f"""WITH {_ONE}
    SELECT user_idx, item_idx, rating, round(prediction, 6) AS prediction, CAST(rk AS INTEGER) AS rank
    FROM ranked WHERE rk <= {K}""",
)
def topk_per_user(spark, folder):
    top = ranking_metrics.topk_per_user(_predictions(spark, folder), K)
    return top.select("user_idx", "item_idx", "rating", *_six("prediction"), "rank")


@query(
    "user_metrics",
    f"""WITH {_ONE}
    SELECT user_idx, round("precision", 6) AS "precision", round(recall, 6) AS recall,
           round(ndcg, 6) AS ndcg FROM per_user""",
)
def user_metrics(spark, folder):
    per_user = ranking_metrics.user_metrics(_predictions(spark, folder), K)
    return per_user.select("user_idx", *_six("precision", "recall", "ndcg"))


def _metric_query(name: str, metric: str, compute=ranking_metrics.evaluate):
    @query(name, f"WITH {_ONE} SELECT {metric} FROM trials")
    def run(spark, folder):
        return compute(_predictions(spark, folder), K).select(*_six(metric))


_metric_query("precision_at_k", "precision_at_k", ranking_metrics.mean_precision)
_metric_query("recall_at_k", "recall_at_k")
_metric_query("ndcg_at_k", "ndcg_at_k")


@query("rmse_baseline", f"WITH {_ONE} SELECT rmse FROM trials")
def rmse_baseline(spark, folder):
    return ranking_metrics.rmse(_predictions(spark, folder)).select(*_six("rmse"))


# -- grid search ---------------------------------------------------------------

_RUN_NAMES = """
named AS (
  SELECT trials.* EXCLUDE (place), place = 1 AS is_best,
    concat(CASE WHEN place = 1 THEN 'best' ELSE 'candidate' END,
           '_item_damping=', item_damping, '_user_damping=', user_damping) AS run_name
  FROM trials)"""


def _trials(spark: SparkSession, folder: str) -> DataFrame:
    train, validation = _split_pairs(spark, folder)
    trials, _ = grid.search(train, validation, grid.grid(_AXES), RatingSums.of(train).fit, K, score_all=bias_model.predict_all)
    return grid.trials_frame(spark, trials)


@query("grid_search_baseline", f"WITH {_GRID}, {_RUN_NAMES} SELECT * FROM named")
def grid_search_baseline(spark, folder):
    return _trials(spark, folder).select(
        "ordinal", *_AXES, *_six(*grid.METRICS), "is_best", "run_name"
    )


@query(
    "grid_best",
    f"""WITH {_GRID}, {_RUN_NAMES}
    SELECT item_damping, user_damping, rmse, precision_at_k, ndcg_at_k FROM named WHERE is_best""",
)
def grid_best(spark, folder):
    best = grid.best_trial(_trials(spark, folder))
    return best.select(*_AXES, *_six("rmse", "precision_at_k", "ndcg_at_k"))


@query(
    "grid_pivot",
    f"""WITH {_GRID}
    SELECT item_damping, avg(rmse) FILTER (user_damping = 0) AS "0.0",
      avg(rmse) FILTER (user_damping = 10) AS "10.0", avg(rmse) FILTER (user_damping = 50) AS "50.0"
    FROM trials GROUP BY item_damping""",
)
def grid_pivot(spark, folder):
    wide = grid.pivot_metric(_trials(spark, folder), "item_damping", "user_damping", "rmse")
    return wide.select("item_damping", *[F.round(f"`{d}`", 6).alias(f"{d}") for d in _AXES["user_damping"]])


@query(
    "grid_latest_run",
    f"""WITH {_GRID}
    SELECT 'als_grid_20240102T000000Z.json' AS run, item_damping, user_damping, rmse,
           precision_at_k AS precision_at_10, ndcg_at_k AS ndcg_at_10 FROM trials""",
)
def grid_latest_run(spark, folder):
    """Two runs are stored; the later one is read back."""
    trials = _trials(spark, folder)
    root = scratch_path(spark, "metrics")
    for stamp in ("20240102T000000Z", "20240101T235959Z"):
        experiments.write_results(trials, root, tuple(_AXES), K, stamp)
    latest = experiments.read_latest_grid(spark, root, dict.fromkeys(_AXES, "double"))
    return latest.select("run", *_AXES, *_six("rmse", "precision_at_10", "ndcg_at_10"))


# -- vectors, scoring, similarity ----------------------------------------------


@query(
    "unit_vectors",
    """WITH long AS (
      SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS pos
      FROM embeddings)
    SELECT CAST(vec_id AS INTEGER) AS id, CAST(pos AS INTEGER) AS pos,
           round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS x FROM long""",
)
def unit_vectors(spark, folder):
    units = inputs.vectors(spark, folder).select(
        "id", F.posexplode(vec.unit(F.col("features"))).alias("pos", "x")
    )
    return units.select("id", "pos", *_six("x"))


_FACTORS = """
user_factors AS (SELECT CAST(vec_id AS INTEGER) AS user_idx, CAST(embedding AS DOUBLE[]) AS u
                 FROM embeddings WHERE vec_id % 2 = 0),
item_factors AS (SELECT CAST(vec_id AS INTEGER) AS item_idx, CAST(embedding AS DOUBLE[]) AS v
                 FROM embeddings WHERE vec_id % 2 = 1)"""


def _factors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Even vectors stand for users, odd ones for items."""
    every = inputs.vectors(spark, folder)
    return every.where("id % 2 = 0"), every.where("id % 2 = 1")


@query(
    "score_topn",
    f"""WITH {_FACTORS}, scored AS (
      SELECT user_idx, item_idx, list_dot_product(u, v) AS score FROM user_factors, item_factors),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_idx ORDER BY round(score, 9) DESC, item_idx) AS INTEGER) AS rank
      FROM scored)
    SELECT user_idx, item_idx, round(score, 6) AS score, rank FROM ranked WHERE rank <= 10""",
)
def score_topn(spark, folder):
    users, items = _factors(spark, folder)
    best = top_n(
        users.withColumnRenamed("id", "user_idx"),
        items.withColumnRenamed("id", "item_idx"),
        10,
        "user_idx",
        "item_idx",
    )
    return best.select("user_idx", "item_idx", *_six("score"), "rank")


_EVENT_POPULAR = """
popular AS (
  SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_idx, count(*) AS count_ratings
  FROM events GROUP BY 1),
popular_best AS (
  SELECT *, CAST(row_number() OVER (ORDER BY count_ratings DESC, item_idx) AS INTEGER) AS rank
  FROM popular)"""


def _event_popularity(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events").select(
        F.get_json_object("props", "$.k").cast("int").alias("item_idx"),
        F.col("value").alias("rating"),
    )
    return popularity.compute_popularity(events)


@query(
    "recommend_with_fallback",
    f"""WITH {_FACTORS}, {_EVENT_POPULAR},
    subjects AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS user_id FROM customer),
    user_map AS (SELECT DISTINCT CAST(user_id AS INTEGER) AS user_idx, CAST(user_id AS VARCHAR) AS user_id
                 FROM events),
    item_map AS (SELECT CAST(p_partkey AS INTEGER) AS item_idx, 'part-' || p_partkey AS item_id FROM part),
    known AS (SELECT user_id, u FROM subjects JOIN user_map USING (user_id) JOIN user_factors USING (user_idx)),
    scored AS (SELECT user_id, item_idx, list_dot_product(u, v) AS score FROM known, item_factors),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_idx) AS INTEGER) AS rank
      FROM scored)
    SELECT user_id, rank, coalesce(item_id, CAST(item_idx AS VARCHAR)) AS item_id,
           round(score, 6) AS score, 'als' AS source
    FROM ranked LEFT JOIN item_map USING (item_idx) WHERE rank <= 10
    UNION ALL
    SELECT user_id, rank, coalesce(item_id, CAST(item_idx AS VARCHAR)), CAST(count_ratings AS DOUBLE), 'popularity'
    FROM subjects, popular_best LEFT JOIN item_map USING (item_idx)
    WHERE rank <= 10 AND user_id NOT IN (SELECT user_id FROM known)""",
)
def recommend_with_fallback(spark, folder):
    users, items = _factors(spark, folder)
    user_map = (
        inputs.table(spark, folder, "events")
        .select(
            F.col("user_id").cast("int").alias("user_idx"),
            F.col("user_id").cast("string").alias("user_id"),
        )
        .distinct()
    )
    item_map = inputs.table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("item_idx"),
        F.concat(F.lit("part-"), "p_partkey").alias("item_id"),
    )
    subjects = inputs.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id")
    )
    recs = recommending.recommend(
        subjects, users, items, user_map, item_map, _event_popularity(spark, folder), 10
    )
    return recs.select("user_id", "rank", "item_id", *_six("score"), "source")


def _parts_and_events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Subjects, user map and item map of ``recommend_with_fallback``."""
    users = inputs.table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias("user_idx"), F.col("user_id").cast("string").alias("user_id")
    )
    items = inputs.table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("item_idx"), F.concat(F.lit("part-"), "p_partkey").alias("item_id")
    )
    subjects = inputs.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return subjects, users.distinct(), items


@query("served_recommendations", ORACLES["recommend_with_fallback"])
def served_recommendations(spark, folder):
    """Every customer's answer from a published table of the users that the model knows."""
    users, items = _factors(spark, folder)
    subjects, user_map, item_map = _parts_and_events(spark, folder)
    popular = materialize(_event_popularity(spark, folder), "popular")
    known = user_map.join(users, F.col("user_idx") == F.col("id"), "left_semi").select("user_id")
    recs = recommending.recommend(known, users, items, user_map, item_map, popular, 10)
    path = scratch_path(spark, "answers")
    serve_tables.publish_answers(spark, path, "user_id", recs, popular, item_map, 10)
    found = serve_tables.answers(spark, path, "user_id", subjects)
    return found.select("user_id", "rank", "item_id", *_six("score"), "source")


@query(
    "recommend_unseen",
    f"""WITH {_FACTORS}, {_EVENT_POPULAR},
    subjects AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS user_id FROM customer),
    user_map AS (SELECT DISTINCT CAST(user_id AS INTEGER) AS user_idx, CAST(user_id AS VARCHAR) AS user_id
                 FROM events),
    item_map AS (SELECT CAST(p_partkey AS INTEGER) AS item_idx, 'part-' || p_partkey AS item_id FROM part),
    known AS (SELECT user_id, user_idx, u FROM subjects JOIN user_map USING (user_id) JOIN user_factors USING (user_idx)),
    seen AS (
      SELECT DISTINCT CAST(o_custkey AS INTEGER) AS user_idx, CAST(l_partkey AS INTEGER) AS item_idx
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      UNION
      SELECT CAST(o_custkey % 40 * 14 AS INTEGER), CAST(l_partkey AS INTEGER) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      UNION
      SELECT CAST(o_custkey % 40 * 5 AS INTEGER), CAST(l_partkey % 100 AS INTEGER) FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    scored AS (
      SELECT user_id, item_idx, list_dot_product(u, v) AS score FROM known, item_factors
      WHERE (user_idx, item_idx) NOT IN (SELECT (user_idx, item_idx) FROM seen)),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(score, 9) DESC, item_idx) AS INTEGER) AS rank
      FROM scored),
    others AS (
      SELECT user_id, item_idx, count_ratings,
             CAST(row_number() OVER (PARTITION BY user_id ORDER BY count_ratings DESC, item_idx) AS INTEGER) AS rank
      FROM subjects LEFT JOIN user_map USING (user_id), popular
      WHERE user_id NOT IN (SELECT user_id FROM known)
        AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.user_idx = user_map.user_idx AND seen.item_idx = popular.item_idx))
    SELECT user_id, rank, coalesce(item_id, CAST(item_idx AS VARCHAR)) AS item_id,
           round(score, 6) AS score, 'als' AS source
    FROM ranked LEFT JOIN item_map USING (item_idx) WHERE rank <= 10
    UNION ALL
    SELECT user_id, rank, coalesce(item_id, CAST(item_idx AS VARCHAR)), CAST(count_ratings AS DOUBLE), 'popularity'
    FROM others LEFT JOIN item_map USING (item_idx) WHERE rank <= 10""",
)
def recommend_unseen(spark, folder):
    """Without what a customer has bought; some customers also share what others bought."""
    users, items = _factors(spark, folder)
    subjects, user_map, item_map = _parts_and_events(spark, folder)
    popular = materialize(_event_popularity(spark, folder), "popular")
    buyer, part = F.col("o_custkey"), F.col("l_partkey")
    views = F.array(
        F.struct(buyer.cast("int").alias("user_idx"), part.cast("int").alias("item_idx")),
        F.struct((buyer % 40 * 14).cast("int").alias("user_idx"), part.cast("int").alias("item_idx")),
        F.struct((buyer % 40 * 5).cast("int").alias("user_idx"), (part % 100).cast("int").alias("item_idx")),
    )
    seen = inputs.order_lines(spark, folder).select(F.explode(views).alias("view")).select("view.*")
    recs = recommending.recommend(subjects, users, items, user_map, item_map, popular, 10, materialize(seen, "seen"))
    return recs.select("user_id", "rank", "item_id", *_six("score"), "source")


@query(
    "similar_items",
    f"""WITH {_EVENT_POPULAR},
    vecs AS (SELECT CAST(vec_id AS INTEGER) AS item_idx, 'v' || vec_id AS item_id,
                    CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    subjects AS (SELECT 'v' || p_partkey AS item_id FROM part),
    scored AS (
      SELECT a.item_id, b.item_idx, b.item_id AS similar_item_id,
             list_cosine_similarity(a.v, b.v) AS score
      FROM subjects JOIN vecs a USING (item_id) JOIN vecs b ON a.item_idx <> b.item_idx),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, item_idx) AS INTEGER) AS rank
      FROM scored)
    SELECT item_id, rank, similar_item_id, round(score, 6) AS score, 'als' AS source
    FROM ranked WHERE rank <= 5
    UNION ALL
    SELECT subjects.item_id, rank, coalesce(vecs.item_id, CAST(item_idx AS VARCHAR)),
           CAST(count_ratings AS DOUBLE), 'popularity'
    FROM subjects, popular_best LEFT JOIN vecs USING (item_idx)
    WHERE rank <= 5 AND subjects.item_id NOT IN (SELECT item_id FROM vecs)""",
)
def similar_items(spark, folder):
    factors = inputs.vectors(spark, folder)
    item_map = factors.select(F.col("id").alias("item_idx"), F.concat(F.lit("v"), "id").alias("item_id"))
    subjects = inputs.table(spark, folder, "part").select(
        F.concat(F.lit("v"), "p_partkey").alias("item_id")
    )
    found = recommending.similar_items(
        subjects, factors, item_map, _event_popularity(spark, folder), 5
    )
    return found.select("item_id", "rank", "similar_item_id", *_six("score"), "source")


# -- matrix factorisation ------------------------------------------------------

# As the training job fits by default.
_ALS = {"rank": 32, "maxIter": 10}

# The floats of a fit are MLlib's; SQL checks which rows a query has, and the
# query checks on every row what must hold for any factors.


@query(
    "als_predict",
    f"""WITH {_SPLIT}
    SELECT user_idx, item_idx, rating, true AS is_dot_product FROM validation
    WHERE user_idx IN (SELECT user_idx FROM train) AND item_idx IN (SELECT item_idx FROM train)""",
)
def als_predict(spark, folder):
    """Pairs that survive the cold-start drop, their prediction held against MLlib's own."""
    train, validation = _split_pairs(spark, folder)
    model = factor_models.fit_als(train, **_ALS)
    mine = factor_models.predict(model, validation)
    theirs = model.transform(validation).select("user_idx", "item_idx", F.col("prediction").alias("expected"))
    close = F.abs(F.col("prediction") - F.col("expected")) <= 1e-3
    return mine.join(theirs, ["user_idx", "item_idx"]).select("user_idx", "item_idx", "rating", close.alias("is_dot_product"))


def _gradients(pairs: DataFrame, users: DataFrame, items: DataFrame, key: str, rank: int, alpha: float | None = None) -> DataFrame:
    """(key, num_ratings, size): the largest entry of the loss's gradient at each ``key``.

    With ``alpha`` the loss of implicit feedback, whose unseen pairs enter by the Gram matrix.
    """
    own, other = ("p", "q") if key == "user_idx" else ("q", "p")
    factors, opposite = (users, items) if key == "user_idx" else (items, users)
    product = vec.dot(F.col("p"), F.col("q"))
    pull, counted = product - F.col("rating"), F.count("*")
    if alpha is not None:
        liked = F.col("rating") > 0
        confidence = alpha * F.abs("rating")
        pull = confidence * product - F.when(liked, 1 + confidence).otherwise(0.0)
        counted = F.count_if(liked)
    # The key's own side last: its rows then lie as the sums need them.
    joins = [(items, "item_idx"), (users, "user_idx")]
    for side, name in joins if key == "user_idx" else joins[::-1]:
        pairs = pairs.join(side, name)
    rows = pairs.withColumn("pull", pull)
    axes = range(rank)
    sums = rows.groupBy(key).agg(
        F.count("*").alias("num_ratings"),
        counted.alias("counted"),
        *[F.sum(F.col("pull") * F.col(other)[axis]).alias(f"pull{axis}") for axis in axes],
    )
    unseen = [F.lit(0.0)] * rank
    if alpha is not None:
        rates = fold_in.gram(opposite.select(F.col(other).alias("features")))
        unseen = [sum(float(rates[x, y]) * F.col(own)[y] for y in axes) for x in axes]
    # Per rating, so that single-precision factors leave the same trace for all keys.
    parts = [(F.col(f"pull{x}") + unseen[x]) / F.col("num_ratings") + 0.1 * F.col("counted") / F.col("num_ratings") * F.col(own)[x] for x in axes]
    return sums.join(factors, key).select(key, "num_ratings", F.greatest(*map(F.abs, parts)).alias("size"))


def _sides(pairs: DataFrame, users: DataFrame, items: DataFrame, alpha: float | None = None) -> DataFrame:
    """Both sides' equations at the user factors of a fit, which it solved last, and at
    item factors solved once more against them."""
    rank = len(users.first()["features"])
    again = materialize(fold_in.fold_in(pairs, users, "item_idx", "user_idx", 0.1, alpha), "solved-items")
    named = {"p": users.select(F.col("id").alias("user_idx"), F.col("features").alias("p"))}
    sides = []
    for side, key, solved_items in (("user", "user_idx", items), ("item", "item_idx", again)):
        named["q"] = solved_items.select(F.col("id").alias("item_idx"), F.col("features").alias("q"))
        found = _gradients(pairs, named["p"], named["q"], key, rank, alpha)
        sides.append(found.select(F.lit(side).alias("side"), F.col(key).alias("idx"), "num_ratings", (F.col("size") < 1e-4).alias("solved")))
    return sides[0].union(sides[1])


@query(
    "als_normal_equations",
    f"""WITH {_PAIRS}
    SELECT 'user' AS side, user_idx AS idx, count(*) AS num_ratings, true AS solved FROM pairs GROUP BY user_idx
    UNION ALL
    SELECT 'item', item_idx, count(*), true FROM pairs GROUP BY item_idx""",
)
def als_normal_equations(spark, folder):
    """A saved and reloaded fit: the gradient of its loss vanishes on the side solved last,
    the users, and on the items once they are folded in against those."""
    pairs = materialize(inputs.rated_pairs(spark, folder), "pairs")
    fitted = factor_models.fit_als(pairs, regParam=0.1, **_ALS)
    model = models.load_model(models.save_model(fitted, scratch_path(spark, "als-model")))
    return _sides(pairs, model.userFactors, model.itemFactors)


# Implicit feedback: quantities less a mean one, so that some are not positive.
_IMPLICIT = {"rank": 8, "maxIter": 6, "alpha": 2.0}

_QUANTITIES = """
amounts AS (
  SELECT CAST(o_custkey AS INTEGER) AS user_idx, CAST(l_partkey AS INTEGER) AS item_idx, sum(l_quantity) - 20 AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


def _amounts(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.order_lines(spark, folder)
    pairs = lines.groupBy(F.col("o_custkey").cast("int").alias("user_idx"), F.col("l_partkey").cast("int").alias("item_idx"))
    return pairs.agg((F.sum("l_quantity") - 20).cast("double").alias("rating"))


@query(
    "als_implicit_normal_equations",
    f"""WITH {_QUANTITIES}
    SELECT 'user' AS side, user_idx AS idx, count(*) AS num_ratings, true AS solved FROM amounts GROUP BY user_idx
    UNION ALL
    SELECT 'item', item_idx, count(*), true FROM amounts GROUP BY item_idx""",
)
def als_implicit_normal_equations(spark, folder):
    """The weighted equations of implicit feedback, with the Gram term over all factors, on both sides."""
    pairs = materialize(_amounts(spark, folder), "amounts")
    model = factor_models.fit_als(pairs, regParam=0.1, implicit=True, **_IMPLICIT)
    return _sides(pairs, model.userFactors, model.itemFactors, _IMPLICIT["alpha"])


@query(
    "fold_in_users",
    f"""WITH {_QUANTITIES} SELECT user_idx, count(*) AS num_ratings, true AS explicit_as_fitted, true AS implicit_as_fitted
    FROM amounts GROUP BY user_idx""",
)
def fold_in_users(spark, folder):
    """Users folded in against a fit's items have the factors that the fit gave them."""
    pairs = materialize(_amounts(spark, folder), "amounts")
    found = pairs.groupBy("user_idx").agg(F.count("*").alias("num_ratings"))
    for name, alpha in (("explicit_as_fitted", None), ("implicit_as_fitted", _IMPLICIT["alpha"])):
        model = factor_models.fit_als(pairs, regParam=0.1, implicit=alpha is not None, **_IMPLICIT)
        folded = fold_in.fold_in(pairs, model.itemFactors, "user_idx", "item_idx", 0.1, alpha)
        both = model.userFactors.join(folded.withColumnRenamed("features", "mine"), "id")
        apart = F.aggregate(F.zip_with("features", "mine", lambda a, b: F.abs(a - b)), F.lit(0.0).cast("float"), lambda m, x: F.greatest(m, x))
        size = F.aggregate("features", F.lit(0.0).cast("float"), lambda m, x: F.greatest(m, F.abs(x)))
        found = found.join(both.select(F.col("id").alias("user_idx"), (apart <= 1e-3 * (1 + size)).alias(name)), "user_idx", "left")
    return found


def _by_mllib(model, users: DataFrame, n: int) -> DataFrame:
    """(user_idx, rank, theirs, expected): items and scores of MLlib's own recommendations."""
    theirs = model.recommendForUserSubset(users.select("user_idx").distinct(), n)
    return theirs.select("user_idx", F.posexplode("recommendations").alias("pos", "rec")).select(
        "user_idx", (F.col("pos") + 1).alias("rank"), F.col("rec.item_idx").alias("theirs"), F.col("rec.rating").alias("expected")
    )


def _are_best(found: DataFrame, expected: DataFrame, subject: str, items: DataFrame, item: str) -> DataFrame:
    """``found`` with ``is_best``: the score at each rank is MLlib's, the item is one of
    MLlib's for the subject, or ties with the last of them, and no item comes twice.

    ``items`` (item, theirs) numbers the items as MLlib does.
    """
    numbered = found.join(items, item, "left")
    by_rank = expected.select(subject, "rank", "expected")
    picks = expected.groupBy(subject).agg(F.collect_set("theirs").alias("_picks"), F.min("expected").alias("_last"))
    judged = numbered.join(by_rank, [subject, "rank"], "left").join(picks, subject, "left")
    once = F.count("*").over(Window.partitionBy(subject, item)) == 1
    same = F.abs(F.col("score") - F.col("expected")) <= 1e-3
    picked = F.array_contains("_picks", F.col("theirs")) | (F.abs(F.col("score") - F.col("_last")) <= 1e-3)
    return judged.withColumn("is_best", F.coalesce(once & same & picked, F.lit(False))).drop("expected", "_picks", "_last", "theirs")


@query(
    "als_recommend",
    f"""WITH {_PAIRS}, n AS (SELECT least(10, count(DISTINCT item_idx)) AS n FROM pairs)
    SELECT user_idx, CAST(unnest(range(1, n + 1)) AS INTEGER) AS rank, true AS is_best
    FROM (SELECT DISTINCT user_idx FROM pairs), n""",
)
def als_recommend(spark, folder):
    """Every user's ten items, held against MLlib's; each score must be the product of the pair's factors."""
    pairs = materialize(inputs.rated_pairs(spark, folder), "pairs")
    model = factor_models.fit_als(pairs, **_ALS)
    found = materialize(factor_models.recommend_for_users(model, pairs, 10), "recommended")
    numbers = model.itemFactors.select(F.col("id").alias("item_idx"), F.col("id").alias("theirs"))
    judged = _are_best(found, _by_mllib(model, pairs, 10), "user_idx", numbers, "item_idx")
    users = model.userFactors.select(F.col("id").alias("user_idx"), F.col("features").alias("p"))
    items = model.itemFactors.select(F.col("id").alias("item_idx"), F.col("features").alias("q"))
    product = F.abs(F.col("score") - vec.dot(F.col("p"), F.col("q"))) <= 1e-4
    return judged.join(users, "user_idx").join(items, "item_idx").select("user_idx", "rank", (F.col("is_best") & product).alias("is_best"))


_LABELLED_POPULAR = """
popular_best AS (
  SELECT item_id, count(*) AS count_ratings,
         CAST(row_number() OVER (ORDER BY count(*) DESC, item_idx) AS INTEGER) AS rank
  FROM indexed JOIN item_map USING (item_idx) GROUP BY item_idx, item_id)"""


@query(
    "als_recommend_with_fallback",
    f"""WITH {_MAPS}, {_LABELLED_POPULAR}, n AS (SELECT least(10, count(*)) AS n FROM item_map),
    subjects AS (SELECT DISTINCT user_id FROM ratings)
    SELECT user_id, CAST(unnest(range(1, n + 1)) AS INTEGER) AS rank, 'als' AS source,
           CAST(NULL AS VARCHAR) AS popular_item, CAST(NULL AS BIGINT) AS popular_count, true AS is_best
    FROM subjects SEMI JOIN user_map USING (user_id), n
    UNION ALL
    SELECT user_id, rank, 'popularity', item_id, count_ratings, true
    FROM subjects ANTI JOIN user_map USING (user_id), popular_best WHERE rank <= 10""",
)
def als_recommend_with_fallback(spark, folder):
    indexed = _indexed(spark, folder)
    interactions = materialize(indexed.interactions, "interactions")
    model = factor_models.fit_als(interactions, **_ALS)
    found = recommending.recommend(
        inputs.ratings(spark, folder).select("user_id"),
        model.userFactors,
        model.itemFactors,
        indexed.user_map,
        indexed.item_map,
        popularity.compute_popularity(interactions),
        10,
    )
    expected = _by_mllib(model, interactions, 10).join(indexed.user_map, "user_idx").drop("user_idx")
    numbers = indexed.item_map.select("item_id", F.col("item_idx").alias("theirs"))
    popular = F.col("source") == "popularity"
    found = _are_best(materialize(found, "recommended"), expected, "user_id", numbers, "item_id")
    return found.select(
        "user_id",
        "rank",
        "source",
        F.when(popular, F.col("item_id")).alias("popular_item"),
        F.when(popular, F.col("score").cast("long")).alias("popular_count"),
        (popular | F.col("is_best")).alias("is_best"),
    )


def _beating(last: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, beating): how many other items have a greater cosine than the subject's last answer."""
    units = items.where("q IS NOT NULL").select("other", vec.unit(F.col("q")).alias("features"))
    subjects = last.select("item_id", vec.unit(F.col("p")).alias("features"))
    wide = top_n(subjects, units, 12, "item_id", "other").join(last.select("item_id", "last"), "item_id")
    better = wide.where((F.col("other") != F.col("item_id")) & (F.col("score") > F.col("last") + 1e-6))
    return better.groupBy("item_id").agg(F.count("*").alias("beating"))


@query(
    "als_similar_items",
    f"""WITH {_MAPS}, {_LABELLED_POPULAR}, n AS (SELECT least(5, count(*) - 1) AS n FROM item_map),
    subjects AS (SELECT DISTINCT item_id FROM ratings)
    SELECT item_id, CAST(unnest(range(1, n + 1)) AS INTEGER) AS rank, 'als' AS source,
           CAST(NULL AS VARCHAR) AS popular_item, true AS is_cosine, true AS in_order
    FROM subjects SEMI JOIN item_map USING (item_id), n
    UNION ALL
    SELECT s.item_id, p.rank, 'popularity', p.item_id, true, true
    FROM (SELECT item_id FROM subjects ANTI JOIN item_map USING (item_id)) s, popular_best p WHERE p.rank <= 5""",
)
def als_similar_items(spark, folder):
    """Scores are held against the cosine of the stored factors, ranks against scores, and the
    last rank against the cosine of every other item."""
    indexed = _indexed(spark, folder)
    interactions = materialize(indexed.interactions, "interactions")
    model = factor_models.fit_als(interactions, **_ALS)
    found = recommending.similar_items(
        inputs.ratings(spark, folder).select("item_id"),
        model.itemFactors,
        indexed.item_map,
        popularity.compute_popularity(interactions),
        5,
    )
    named = model.itemFactors.join(indexed.item_map, F.col("id") == F.col("item_idx"))
    own = named.select("item_id", F.col("features").alias("p"))
    other = named.select(F.col("item_id").alias("similar_item_id"), F.col("features").alias("q"))
    judged = found.join(own, "item_id", "left").join(other, "similar_item_id", "left")
    popular = F.col("source") == "popularity"
    exact = F.abs(F.col("score") - vec.cosine(F.col("p"), F.col("q"))) <= 1e-6
    ranked = Window.partitionBy("item_id").orderBy("rank")
    descends = F.coalesce(F.col("score") <= F.lag("score").over(ranked) + 1e-9, F.lit(True))
    # Items whose cosine beats a subject's last one must be among its answers: count them.
    last = judged.where(~popular).groupBy("item_id").agg(F.min("score").alias("last"), F.first("p").alias("p"))
    beating = _beating(materialize(last, "last-answers"), named.select(F.col("item_id").alias("other"), F.col("features").alias("q")))
    judged = judged.join(beating, "item_id", "left").withColumn("beating", F.coalesce("beating", F.lit(0)))
    answers = F.count("*").over(Window.partitionBy("item_id"))
    return judged.select(
        "item_id",
        "rank",
        "source",
        F.when(popular, F.col("similar_item_id")).alias("popular_item"),
        (popular | (exact & (F.col("item_id") != F.col("similar_item_id")))).alias("is_cosine"),
        (descends & (F.col("beating") < answers)).alias("in_order"),
    )


@query(
    "als_grid",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"({at}, {c['rank']}, {c['regParam']}::DOUBLE, true, true)" for at, c in enumerate(grid.grid(grid.ALS_GRID))
    )
    + ") AS t(ordinal, rank, regParam, in_range, best_by_rule)",
)
def als_grid(spark, folder):
    """The default grid; the kept trial is held against the rule written as an order."""
    train, validation = (part.persist() for part in _split_pairs(spark, folder))
    try:
        trials, _ = grid.search(
            train,
            validation,
            grid.grid(grid.ALS_GRID),
            lambda t, **p: factor_models.fit_als(t, maxIter=_ALS["maxIter"], **p),
            K,
            score_all=factor_models.predict_all,
        )
    finally:
        train.unpersist(), validation.unpersist()
    frame = grid.trials_frame(spark, trials)
    # One row per candidate of the grid.
    order = Window.orderBy(F.desc(F.round("precision_at_k", 9)), F.round("rmse", 9), "ordinal")
    shares = [F.col(m).between(0, 1) for m in ("precision_at_k", "recall_at_k", "ndcg_at_k")]
    in_range = (F.col("rmse") > 0) & shares[0] & shares[1] & shares[2]
    best_by_rule = F.col("is_best") == (F.row_number().over(order) == 1)
    return frame.select("ordinal", "rank", "regParam", in_range.alias("in_range"), best_by_rule.alias("best_by_rule"))


_JOB_AXES = {"rank": (4, 8), "regParam": (0.1, 0.8)}


@query(
    "train_job",
    f"""WITH {_SPLIT}, scored AS (
      SELECT count(*) AS scored_pairs FROM validation
      WHERE user_idx IN (SELECT user_idx FROM train) AND item_idx IN (SELECT item_idx FROM train))
    SELECT ordinal, rank, regParam, scored_pairs, true AS as_recorded
    FROM scored, (VALUES """
    + ", ".join(f"({at}, {c['rank']}, {c['regParam']}::DOUBLE)" for at, c in enumerate(grid.grid(_JOB_AXES)))
    + ") AS t(ordinal, rank, regParam)",
)
def train_job(spark, folder):
    """The whole job, from interactions to a published model and a results log.

    The model that was published is loaded and scores the validation pairs again: its
    error and precision must be those recorded for the best candidate, in the log and
    in the model's own document, and its parameters that candidate's.
    """
    pairs = materialize(inputs.rated_pairs(spark, folder), "pairs")
    done = train.train_als(spark, pairs, scratch_path(spark, "artifacts"), _JOB_AXES, maxIter=4, k=K)
    model = models.load_model(done.model_path)
    _, validation = splitting.hash_split(pairs, 0.8, 42)
    predictions = materialize(factor_models.predict(model, validation), "predictions")
    again = ranking_metrics.evaluate(predictions, K, stored=True).first()
    document = models.read_metadata_document(spark, done.model_path).first()
    log = spark.read.parquet(done.results["runs"])
    close = (F.abs(F.col("rmse") - F.lit(again["rmse"])) <= 1e-5) & (F.abs(F.col("precision_at_k") - F.lit(again["precision_at_k"])) <= 1e-5)
    noted = (F.col("rank") == document["params"]["rank"]) & (F.col("regParam") == document["params"]["regParam"])
    noted = noted & (F.col("rank") == model.rank) & (F.abs(F.col("rmse") - F.lit(document["metrics"]["rmse"])) <= 1e-9)
    count = predictions.agg(F.count("*")).scalar()
    return log.select("ordinal", "rank", "regParam", count.alias("scored_pairs"), (~F.col("is_best") | (close & noted)).alias("as_recorded"))


# -- item details and feedback -------------------------------------------------


_LOOKED_UP = """WITH wanted AS (
      SELECT CAST(l_partkey AS VARCHAR) AS key, min(l_orderkey * 10 + l_linenumber) AS place
      FROM lineitem GROUP BY 1
      UNION ALL SELECT 'absent', -1)
    SELECT place AS ordinal, key AS asin, p_name AS title,
           p_type || ' > ' || p_brand AS category, p_brand AS brand,
           CASE WHEN p_partkey % 3 = 0 THEN '$' || CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) || '.5' END AS price,
           CASE WHEN p_partkey % 3 <> 0 THEN p_partkey + 0.5::DOUBLE END AS price_value
    FROM wanted JOIN part ON CAST(p_partkey AS VARCHAR) = key"""


def _part_documents(spark: SparkSession, folder: str) -> str:
    """Parts as ragged JSON lines, each twice and between blank and broken lines."""
    part = inputs.table(spark, folder, "part")
    nested = F.when(F.col("p_partkey") % 2 == 0, F.array(F.array("p_type", "p_brand")))
    flat = F.when(F.col("p_partkey") % 2 == 1, F.array("p_type", "p_brand"))
    key = F.col("p_partkey").cast("string")
    price = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('"$'), key, F.lit('"'))).otherwise(F.concat(key, F.lit(".5")))
    fields = [key.alias("asin"), F.col("p_name").alias("title"), flat.alias("category"), nested.alias("categories"), F.col("p_brand").alias("brand")]
    # A price is a number in some lines and text in others, so it is put in as written.
    first = F.concat(F.regexp_replace(F.to_json(F.struct(*fields)), "}$", ""), F.lit(',"price":'), price, F.lit("}"))
    later = F.to_json(F.struct(key.alias("asin"), F.lit("a later copy").alias("title")))
    lines = F.array(first, F.lit(""), F.lit("  "), F.concat(F.lit('{"asin": "'), key), later)
    path = scratch_path(spark, "metadata")
    part.select(F.explode(lines)).write.text(path)
    return path


def _wanted_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The parts in the order in which they were first bought, and one that there is not."""
    bought = inputs.table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"), F.col("l_partkey").cast("string").alias("key")
    )
    absent = spark.range(1).select(F.lit(-1).cast("long").alias("ordinal"), F.lit("absent").alias("key"))
    return item_details.first_places(bought.union(absent))


@query(
    "item_lookup",
    _LOOKED_UP.replace(
        "SELECT place AS ordinal,",
        "SELECT CAST(row_number() OVER (ORDER BY place, key) AS INTEGER) AS position, place AS ordinal,",
    ),
)
def item_lookup(spark, folder):
    """Looked up in the parsed lines, with every answer's position in the list."""
    documents = item_details.describe(read_metadata(spark, _part_documents(spark, folder)))
    return item_details.positions(item_details.lookup(documents, _wanted_parts(spark, folder)), "ordinal", "asin")


@query("item_lookup_stored", _LOOKED_UP)
def item_lookup_stored(spark, folder):
    """Parsed once into the store by key, then looked up there."""
    store = scratch_path(spark, "details-store")
    lookup_items.store_details(spark, _part_documents(spark, folder), store)
    return lookup_items.stored_details(spark, store, _wanted_parts(spark, folder))


def _ingested(spark: SparkSession, folder: str) -> str:
    """Events as feedback files, error events as broken lines, all ingested."""
    events = inputs.table(spark, folder, "events")
    broken = F.concat(F.lit("broken "), F.col("event_id"))
    whole = F.to_json(F.struct("event_id", "user_id", "event_type", "value", "props"))
    source = scratch_path(spark, "landing")
    events.select(
        F.when(F.col("event_type") == "error", broken).otherwise(whole)
    ).write.text(source)
    target = scratch_path(spark, "feedback")
    state = scratch_path(spark, "feedback-state")
    feedback.ingest_feedback(spark, source, target, state).awaitTermination()
    return target


@query(
    "feedback_stream",
    """SELECT event_id, user_id, event_type, value, props FROM events WHERE event_type <> 'error'""",
)
def feedback_stream(spark, folder):
    payloads = feedback.read_feedback(spark, _ingested(spark, folder))
    kinds = {
        "event_id": "bigint",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    }
    return payloads.select(
        *[F.variant_get("payload", f"$.{name}", kind).alias(name) for name, kind in kinds.items()]
    )


@query(
    "feedback_quarantine",
    "SELECT 'broken ' || event_id AS line FROM events WHERE event_type = 'error'",
)
def feedback_quarantine(spark, folder):
    return feedback.read_quarantine(spark, _ingested(spark, folder))
