"""Hand-worked cases and properties of the operators."""

import gzip
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom import scratch
from ratingloom.functions import scalars, vectors
from ratingloom.operators import (
    cleaning,
    indexing,
    item_details,
    lookup,
    popularity,
    profile,
    ranking_metrics,
    recommending,
    splitting,
    thresholds,
)
from ratingloom.operators.nearest import top_n
from ratingloom.plans import inputs
from ratingloom.plans.etl import preprocess_reviews
from ratingloom.plans.lookup_items import item_details as look_up_items
from ratingloom.sources import reviews, tables
from ratingloom.streaming import feedback

RATING_SCHEMA = "user_id string, item_id string, rating double"


@pytest.fixture
def ratings(spark):
    def build(*pairs):
        return spark.createDataFrame([(u, i, 4.0) for u, i in pairs], RATING_SCHEMA)

    return build


@pytest.fixture
def worked_predictions(spark):
    rows = [(0, 1, 5.0, 0.9), (0, 2, 3.0, 0.8), (0, 3, 4.0, 0.1), (1, 1, 4.0, 0.5), (2, 2, 2.0, 0.7)]
    return spark.createDataFrame(
        rows, "user_idx int, item_idx int, rating double, prediction float"
    )


# -- cleaning ------------------------------------------------------------------


def test_bad_ratings_are_dropped_not_fatal(spark):
    raw = spark.createDataFrame(
        [("u", "i", x) for x in ("4", "abc", "", "NaN", None)], "user string, asin string, stars string"
    )
    assert [tuple(r) for r in cleaning.clean_ratings(raw).collect()] == [("u", "i", 4.0)]
    assert tuple(cleaning.rejected_count(raw).first()) == (5, 1, 4)


def test_alias_preference_and_missing_column():
    assert cleaning.resolve_columns(["reviewerID", "user_id", "asin", "score", "overall"]) == {
        "user_id": "user_id",
        "item_id": "asin",
        "rating": "overall",
    }
    with pytest.raises(ValueError, match="item_id"):
        cleaning.resolve_columns(["user", "stars", "ITEM"])


# -- files ---------------------------------------------------------------------


@pytest.mark.parametrize(
    ("path", "fmt"),
    [
        ("a/b.tsv", "tsv"),
        ("b.TXT", "tsv"),
        ("b.tsv.gz", "tsv"),
        ("b.json", "json"),
        ("b.json.gz", "json"),
        ("b.jsonl", "json"),
        ("b.csv", "csv"),
        ("b.dat", "csv"),
        ("b.parquet", "parquet"),
    ],
)
def test_format_by_ending(path, fmt):
    assert reviews.detect_format(path) == fmt


def test_json_lines_take_the_first_alias_in_use(spark, tmp_path):
    path = tmp_path / "r.json.gz"
    lines = [
        {"reviewerID": "u1", "asin": "a", "overall": 5.0, "helpful": [0, 1], "unixReviewTime": 7},
        {"reviewerID": "u2", "asin": "a", "overall": 3, "userId": "other"},
        {"reviewerID": "u3", "overall": 3},
    ]
    with gzip.open(path, "wt") as out:
        out.write("\n".join(json.dumps(line) for line in lines) + "\nnot json\n")
    rows = reviews.read_reviews(spark, str(path)).collect()
    assert sorted(tuple(r) for r in rows) == [("u1", "a", 5.0), ("u2", "a", 3.0)]
    named = reviews.read_reviews(
        spark, str(path), columns={"user_id": "userId", "item_id": "asin", "rating": "overall"}
    )
    assert [tuple(r) for r in named.collect()] == [("other", "a", 3.0)]


def test_delimited_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("user_id,item_id,rating,extra\n007,i1,4.5,x\nu2,i2,bad,y\n")
    (tmp_path / "r.txt").write_text("user\titem\tscore\nu1\ti,1\t2\n")
    csv = reviews.read_reviews(spark, str(tmp_path / "r.csv"))
    assert [tuple(r) for r in csv.collect()] == [("007", "i1", 4.5)]
    tsv = reviews.read_reviews(spark, str(tmp_path / "r.txt"))
    assert [tuple(r) for r in tsv.collect()] == [("u1", "i,1", 2.0)]
    assert csv.dtypes == [("user_id", "string"), ("item_id", "string"), ("rating", "double")]


def test_etl_writes_the_four_tables(spark, tmp_path, small_dir):
    source = str(tmp_path / "raw.json")
    raw = inputs.ratings(spark, small_dir).toDF("reviewerID", "asin", "overall")
    raw.write.json(source)
    out = str(tmp_path / "out")
    paths = preprocess_reviews(spark, source, out, 30)
    assert sorted(paths) == ["interactions", "item_map", "popular_items", "user_map"]
    interactions = tables.read_table(spark, out, tables.INTERACTIONS)
    users = tables.read_table(spark, out, tables.USER_MAP)
    items = tables.read_table(spark, out, tables.ITEM_MAP)
    assert interactions.dtypes == [("user_idx", "int"), ("item_idx", "int"), ("rating", "double")]
    decoded = interactions.join(users, "user_idx").join(items, "item_idx")
    decoded = decoded.select("user_id", "item_id", "rating")
    kept = thresholds.min_interactions(inputs.ratings(spark, small_dir), 30)
    assert decoded.exceptAll(kept).isEmpty() and kept.exceptAll(decoded).isEmpty()
    # Indices follow popularity, so the most rated item is item 0.
    popular = tables.read_table(spark, out, tables.POPULAR_ITEMS).collect()
    ordered = sorted(popular, key=lambda r: (-r.count_ratings, r.item_idx))
    assert [r.item_idx for r in ordered] == list(range(len(ordered)))


# -- thresholds and indices ----------------------------------------------------


def test_minimum_is_one_pass(ratings):
    kept = thresholds.min_interactions(
        ratings(("u1", "i1"), ("u1", "i2"), ("u2", "i1"), ("u3", "i1")), 2
    )
    assert [tuple(r) for r in kept.collect()] == [("u1", "i1", 4.0)]


def test_dense_index_by_frequency_then_name(ratings):
    rows = ratings(*[("c", "x")] * 3, *[("b", "x")] * 2, *[("a", "x")] * 2)
    table = indexing.dense_index(rows, "user_id", "user_idx")
    assert {r.user_id: r.user_idx for r in table.rows.collect()} == {"c": 0, "a": 1, "b": 2}
    assert table.peak == 3


def test_index_matches_string_indexer(spark, small_dir):
    from pyspark.ml.feature import StringIndexer

    rows = inputs.ratings(spark, small_dir)
    labels = StringIndexer(inputCol="item_id", outputCol="x").fit(rows).labels
    mine = indexing.index_ids(rows).item_map.orderBy("item_idx").collect()
    assert [(r.item_idx, r.item_id) for r in mine] == list(enumerate(labels))


@pytest.mark.parametrize("partitions", ["1", "5", "16"])
def test_index_ignores_partitioning(spark, small_dir, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = inputs.ratings(spark, small_dir).repartition(int(partitions) + 2)
        found = indexing.dense_index(rows, "user_id", "user_idx").rows.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found.sort(key=lambda r: (-r.cnt, r.user_id))
    assert [r.user_idx for r in found] == list(range(len(found)))


def hot_ratings(spark):
    """A third of all rows are one user's, and as many are one item's; copies abound."""
    draw = random.Random(7)
    rows = [("hot", f"i{draw.randrange(40)}", float(draw.randrange(1, 6))) for _ in range(1000)]
    rows += [(f"u{draw.randrange(90)}", "hot", 3.0) for _ in range(1000)]
    rows += [(f"u{draw.randrange(90)}", f"i{draw.randrange(40)}", 2.0) for _ in range(1000)]
    return spark.createDataFrame(rows, RATING_SCHEMA).repartition(6), rows


def test_hot_keys_are_sliced_without_changing_results(spark):
    df, rows = hot_ratings(spark)
    users = {u: sum(r[0] == u for r in rows) for u, _, _ in rows}
    items = {i: sum(r[1] == i for r in rows) for _, i, _ in rows}
    expected = sorted(r for r in rows if users[r[0]] >= 25 and items[r[1]] >= 25)
    kept = thresholds.min_interactions(df, 25, slice_rows=100)
    assert sorted(tuple(r) for r in kept.collect()) == expected
    indexed = indexing.index_ids(df, slice_rows=100)
    assert indexed.interactions.count() == len(rows)
    back = indexed.interactions.join(indexed.user_map, "user_idx").join(indexed.item_map, "item_idx")
    back = back.select("user_id", "item_id", "rating")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_slices_spread_a_hot_key(spark):
    df, _ = hot_ratings(spark)
    keys = lookup.store_keys(lookup.key_counts(df, "user_id"), "test-keys")
    assert keys.peak == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup.attach(df, keys, "user_id", slice_rows=50)
        per_task = (
            joined.where("user_id = 'hot'").groupBy(F.spark_partition_id().alias("task")).count()
        )
        sizes = [r["count"] for r in per_task.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 1000 and len(sizes) >= 6 and max(sizes) < 400


def test_encode_skips_unknown_ids(spark, ratings):
    maps = indexing.index_ids(ratings(("a", "x"), ("b", "y")))
    found = indexing.encode(ratings(("a", "x"), ("z", "x"), ("a", "q")), maps.user_map, maps.item_map)
    assert [tuple(r) for r in found.collect()] == [(0, 0, 4.0)]


# -- statistics ----------------------------------------------------------------


def test_half_steps(spark):
    values = spark.createDataFrame([(3.3,), (2.25,), (1.75,), (5.0,)], "x double")
    assert [r[0] for r in values.select(scalars.half_step(F.col("x"))).collect()] == [3.5, 2.5, 2.0, 5.0]


@pytest.mark.parametrize(
    ("cells", "sparsity"),
    [([(0, 0), (0, 1), (1, 2), (1, 2)], 1 - 4 / 6), ([(0, 0), (0, 1), (1, 2), (1, 2)] * 2, 0.0), ([], 1.0)],
)
def test_sparsity(spark, cells, sparsity):
    df = spark.createDataFrame([(u, i, 3.0) for u, i in cells], "user_idx int, item_idx int, rating double")
    assert profile.basic_stats(df)["sparsity"] == pytest.approx(sparsity)


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_median_is_exact(spark, size):
    draw = np.random.default_rng(size)
    values = np.round(draw.normal(size=size), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "rating double").repartition(5)
    found = profile.rating_summary(df)
    assert found["median"] == pytest.approx(float(np.median(values)))
    assert found["mean"] == pytest.approx(float(np.mean(values)))
    assert (found["count"], found["min"], found["max"]) == (size, values.min(), values.max())


def test_histogram_counts_every_row(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 2, 6, 11])], "user_idx int, num_ratings long")
    bins = profile.histogram(counts, 5).collect()
    assert [(r.bin, r.low, r.high, r.frequency) for r in bins] == [
        (0, 1.0, 3.0, 3),
        (2, 5.0, 7.0, 1),
        (4, 9.0, 11.0, 1),
    ]
    top = profile.histogram(counts, 5, limit_top=2).collect()
    assert sum(r.frequency for r in top) == 2 and top[0].low == 6.0
    flat = profile.histogram(counts.where("num_ratings = 1"), 5).collect()
    assert [(r.bin, r.frequency) for r in flat] == [(0, 2)]


# -- popularity ----------------------------------------------------------------


def test_popular_list_labels_and_bounds(spark):
    popular = spark.createDataFrame(
        [(2, 9, 3.0), (1, 9, 4.0), (3, 20, 1.0)], "item_idx int, count_ratings long, avg_rating double"
    )
    names = spark.createDataFrame([(1, "one"), (3, "three")], "item_idx int, item_id string")
    best = popularity.recommend_from_popularity(popular, 3, names).orderBy("rank").collect()
    assert [tuple(r) for r in best] == [(1, "three", 20.0), (2, "one", 9.0), (3, "2", 9.0)]
    assert popularity.recommend_from_popularity(popular.limit(0), 3, names).count() == 0
    for n in (0, -3):
        with pytest.raises(ValueError):
            popularity.recommend_from_popularity(popular, n)


# -- splits --------------------------------------------------------------------


def test_hash_split_is_a_stable_partition(spark, small_dir):
    pairs = inputs.rated_pairs(spark, small_dir)
    train, validation = splitting.hash_split(pairs)
    again, _ = splitting.hash_split(pairs.repartition(13))
    whole = pairs.count()
    assert train.count() + validation.count() == whole
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    assert abs(train.count() / whole - 0.8) < 0.02
    other, _ = splitting.hash_split(pairs, seed=1)
    assert not train.exceptAll(other).isEmpty()


@pytest.mark.parametrize("fraction", [0.0, 1.0, 2.0])
def test_sample_outside_the_open_interval_keeps_all(spark, fraction):
    df = spark.range(50).withColumnRenamed("id", "user_idx").withColumn("item_idx", F.lit(1))
    assert splitting.bernoulli_sample(df, fraction).count() == 50
    assert splitting.hash_sample(df, fraction).count() == 50


# -- ranking metrics -----------------------------------------------------------


def test_worked_metrics(worked_predictions):
    assert ranking_metrics.precision_at_k(worked_predictions, 2) == pytest.approx(0.5)
    assert ranking_metrics.recall_at_k(worked_predictions, 2) == pytest.approx(0.75)
    assert ranking_metrics.ndcg_at_k(worked_predictions, 2) == pytest.approx(0.537716, abs=1e-6)
    rows = worked_predictions.collect()
    error = math.sqrt(sum((r.rating - r.prediction) ** 2 for r in rows) / len(rows))
    assert ranking_metrics.rmse(worked_predictions).first()[0] == pytest.approx(error)
    assert ranking_metrics.evaluate(worked_predictions, 2).first()["rmse"] == pytest.approx(error)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_metrics_equal_brute_force_with_a_hot_user(spark, k):
    draw = random.Random(k)
    users = [0] * 200 + [draw.randrange(1, 40) for _ in range(400)]
    rows = [
        (u, i, float(draw.randrange(1, 6)), draw.choice([0.1, 0.2, 0.3, 0.4]))
        for i, u in enumerate(users)
    ]
    df = spark.createDataFrame(
        rows, "user_idx int, item_idx int, rating double, prediction double"
    ).repartition(5)
    precision, recall, ndcg = [], [], []
    for user in set(users):
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (-r[3], r[1]))
        rel = [int(r[2] >= 4) for r in mine]
        gain = lambda flags: sum(f / math.log2(at + 2) for at, f in enumerate(flags[:k]))
        precision.append(sum(rel[:k]) / len(rel[:k]))
        if sum(rel):
            recall.append(sum(rel[:k]) / sum(rel))
        ideal = gain(sorted(rel, reverse=True))
        ndcg.append(gain(rel) / ideal if ideal else 0.0)
    found = ranking_metrics.evaluate(df, k).first()
    assert found.precision_at_k == pytest.approx(sum(precision) / len(precision))
    assert found.recall_at_k == pytest.approx(sum(recall) / len(recall))
    assert found.ndcg_at_k == pytest.approx(sum(ndcg) / len(ndcg))


def test_metrics_of_nothing(worked_predictions):
    nothing = worked_predictions.limit(0)
    assert ranking_metrics.precision_at_k(nothing, 2) == 0.0
    assert tuple(ranking_metrics.evaluate(nothing, 2).first()) == (None, 0.0, 0.0, 0.0)
    assert ranking_metrics.rmse(nothing).first()[0] is None


def test_top_cut_runs_before_the_shuffle(worked_predictions):
    plan = ranking_metrics.topk_per_user(worked_predictions, 2)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.index("WindowGroupLimit", text.index("Exchange")) > 0
    assert ", Final" in text and ", Partial" in text


# -- vectors, scoring, similarity ----------------------------------------------


def test_vector_functions(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>"
    )
    rows = df.select(
        vectors.unit(F.col("a")), vectors.unit(F.col("b")), vectors.cosine(F.col("a"), F.col("b"))
    ).collect()
    assert rows[0][0] == pytest.approx([0.6, 0.8]) and rows[0][1] == [0.0, 0.0] and rows[0][2] == 0.0
    assert rows[1][2] == pytest.approx(1 / math.sqrt(2))


def random_factors(spark, rows, seed, dim=6, shape="plain"):
    """Random vectors; "copies" repeats one in half the rows, "zeros" has zero vectors."""
    draw = np.random.default_rng(seed)
    matrix = draw.normal(size=(rows, dim))
    if shape == "copies":
        matrix[rows // 2 :] = matrix[0]
    if shape == "zeros":
        matrix[::3] = 0
    matrix = matrix.astype(np.float32)
    data = [(int(i), [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(data, "id int, features array<float>"), matrix.astype(np.float64)


@pytest.mark.parametrize("block_rows", [16_384, 40, 7])
@pytest.mark.parametrize("shape", ["plain", "copies", "zeros"])
@pytest.mark.parametrize("cosine", [False, True])
def test_top_n_equals_brute_force(spark, block_rows, shape, cosine):
    queries, q = random_factors(spark, 60, 1)
    items, m = random_factors(spark, 90, 2, shape=shape)
    found = top_n(
        queries.withColumnRenamed("id", "qid"),
        items.withColumnRenamed("id", "iid"),
        5,
        "qid",
        "iid",
        cosine=cosine,
        block_rows=block_rows,
    )
    rows = found.collect()
    if cosine:
        q = q / np.linalg.norm(q, axis=1, keepdims=True)
        m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-30)
    scores = q @ m.T
    best = np.array([np.lexsort((np.arange(len(s)), -np.round(s, 9)))[:5] for s in scores])
    assert len(rows) == best.size
    assert all(r.iid == best[r.qid, r["rank"] - 1] for r in rows)
    assert all(r.score == pytest.approx(scores[r.qid, r.iid], abs=1e-9) for r in rows)


def test_top_n_cosine_skips_the_query(spark):
    items, m = random_factors(spark, 50, 3)
    queries = items.withColumnRenamed("id", "qid").withColumn("tag", F.lit("kept"))
    found = top_n(
        queries, items.withColumnRenamed("id", "iid"), 60, "qid", "iid", cosine=True, skip_same=True,
        block_rows=16,
    ).collect()
    assert len(found) == 50 * 49 and all(r.qid != r.iid and r.tag == "kept" for r in found)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    assert all(r.score == pytest.approx(unit[r.qid] @ unit[r.iid]) for r in found)
    assert max(r.score for r in found) <= 1 + 1e-9


@pytest.fixture
def four_items(spark):
    factors = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])],
        "id int, features array<float>",
    )
    names = spark.createDataFrame(
        [(0, "a"), (1, "b"), (2, "c"), (3, "z"), (4, "bare")], "item_idx int, item_id string"
    )
    popular = spark.createDataFrame(
        [(2, 9, 3.0), (0, 5, 3.0)], "item_idx int, count_ratings long, avg_rating double"
    )
    return factors, names, popular


def test_similar_items_and_fallback(spark, four_items):
    factors, names, popular = four_items
    wanted = spark.createDataFrame([("a",), ("a",), ("bare",), ("nope",)], "item_id string")
    found = recommending.similar_items(wanted, factors, names, popular, 3).collect()
    rows = {}
    for r in sorted(found, key=lambda r: (r.item_id, r["rank"])):
        rows.setdefault(r.item_id, []).append((r.similar_item_id, r.score, r.source))
    assert rows["a"] == [("b", 1.0, "als"), ("c", 0.0, "als"), ("z", 0.0, "als")]
    assert rows["bare"] == rows["nope"] == [("c", 9.0, "popularity"), ("a", 5.0, "popularity")]


def test_recommend_sources(spark, four_items):
    item_factors, item_names, popular = four_items
    user_factors = spark.createDataFrame([(0, [1.0, 3.0])], "id int, features array<float>")
    user_map = spark.createDataFrame([(0, "known"), (1, "untrained")], "user_idx int, user_id string")
    users = spark.createDataFrame([("known",), ("untrained",), ("stranger",)], "user_id string")

    def run(items, names=item_names):
        found = recommending.recommend(users, user_factors, items, user_map, names, popular, 2)
        rows = {}
        for r in sorted(found.collect(), key=lambda r: (r.user_id, r["rank"])):
            rows.setdefault(r.user_id, []).append((r.item_id, r.score, r.source))
        return rows

    liked = [("c", 9.0, "popularity"), ("a", 5.0, "popularity")]
    assert run(item_factors) == {
        "known": [("c", 3.0, "als"), ("b", 2.0, "als")],
        "untrained": liked,
        "stranger": liked,
    }
    assert run(item_factors.limit(0))["known"] == liked
    assert run(item_factors, item_names.where("item_id <> 'c'"))["known"][0][0] == "2"


# -- item details and feedback -------------------------------------------------


def test_item_lookup(spark, tmp_path):
    lines = [
        json.dumps({"asin": "A1", "title": "one", "categories": [["E", "C"]], "price": 3.5}),
        "",
        "not json",
        json.dumps({"asin": "A2", "category": ["X", "Y"], "brand": "B"}),
        json.dumps({"asin": "A1", "title": "later"}),
        json.dumps({"asin": "A3", "category": "plain", "categories": [["E"]]}),
        json.dumps({"asin": "A4", "category": [], "categories": ["E", 1], "price": "$12.99"}),
        json.dumps({"asin": "A5"}),
        "[1, 2]",
    ]
    with gzip.open(tmp_path / "meta.json.gz", "wt") as out:
        out.write("\n".join(lines))
    wanted = ["A2", "A1", "A2", "A9", "A3", "A4", "A5"]
    found = look_up_items(spark, str(tmp_path / "meta.json.gz"), wanted)
    assert [tuple(r) for r in found.collect()] == [
        ("A2", None, "X > Y", "B", None, None),
        ("A1", "one", "E > C", None, "3.5", 3.5),
        ("A3", None, None, None, None, None),
        ("A4", None, "E > 1", None, "$12.99", None),
        ("A5", None, None, None, None, None),
    ]


def test_first_line_wins_across_files_and_splits(spark, tmp_path):
    for name in ("b.json", "a.json"):
        lines = [json.dumps({"asin": f"K{i % 20}", "title": f"{name} {i}"}) for i in range(200)]
        (tmp_path / name).write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        found = look_up_items(spark, str(tmp_path), [f"K{i}" for i in range(20)]).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.title for r in found] == [f"a.json {i}" for i in range(20)]


def test_key_list_keeps_first_places(spark):
    rows = item_details.key_list(spark, ["b", "a", "b", "c"]).orderBy("ordinal").collect()
    assert [r.key for r in rows] == ["b", "a", "c"]


def test_feedback_is_ingested_once(spark, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.jsonl").write_text('{"user_id":"u1","clicked":true}\nbad\n{"x":[1]}\n')
    for _ in range(2):
        feedback.ingest_feedback(spark, source, target, state).awaitTermination()
    received = feedback.read_feedback(spark, target)
    assert received.count() == 2
    clicked = received.where(F.try_variant_get("payload", "$.clicked", "boolean"))
    assert clicked.select(F.variant_get("payload", "$.user_id", "string")).first()[0] == "u1"
    assert [r.line for r in feedback.read_quarantine(spark, target).collect()] == ["bad"]
    for name in ("2.jsonl", "3.jsonl"):
        (tmp_path / "in" / name).write_text("[5]\n")
    feedback.ingest_feedback(spark, source, target, state, files_per_batch=1).awaitTermination()
    assert feedback.read_feedback(spark, target).count() == 4


# -- scratch -------------------------------------------------------------------


def test_scratch_tables_go_with_their_block(spark, tmp_path):
    with scratch.scratch_tables(spark):
        inner = scratch.materialize(spark.range(5), "inner")
        files = inner.inputFiles()
        assert inner.count() == 5
    from pathlib import Path
    from urllib.parse import urlparse

    assert files and not Path(urlparse(files[0]).path).exists()
