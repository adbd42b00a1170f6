"""What every subject gets, what training needs, and who owns scratch tables."""

import json
import threading
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from ratingloom import scratch
from ratingloom.operators import grid, indexing, lookup, popularity, ranking_metrics, recommending, splitting
from ratingloom.plans import inputs, lookup_items, serve_tables, train
from ratingloom.plans.bias_model import RatingSums
from ratingloom.sources import tables


def files_of(df):
    return [Path(urlparse(name).path) for name in df.inputFiles()]


@pytest.fixture
def serving(spark):
    nan = float("nan")
    users = spark.createDataFrame(
        [(0, [1.0, 3.0]), (1, None), (2, [nan, 1.0]), (3, [0.0, 0.0])], "id int, features array<float>"
    )
    names = spark.createDataFrame([(i, f"u{i}") for i in range(5)], "user_idx int, user_id string")
    items = spark.createDataFrame(
        [(i, [float(i), 1.0]) for i in range(200)] + [(200, None), (201, [nan, nan])], "id int, features array<float>"
    )
    item_names = spark.createDataFrame([(i, f"i{i}") for i in range(203)], "item_idx int, item_id string")
    popular = spark.createDataFrame(
        [(i, 1000 - i, 3.0) for i in range(180)], "item_idx int, count_ratings long, avg_rating double"
    )
    return users, items, names, item_names, popular


def test_every_subject_gets_an_answer(spark, serving):
    users, items, names, item_names, popular = serving
    wanted = names.select("user_id").union(spark.createDataFrame([("stranger",)], "user_id string"))
    found = recommending.recommend(wanted, users, items, names, item_names, popular, 150).collect()
    by_user = {}
    for r in found:
        by_user.setdefault(r.user_id, []).append(r)
    sources = {u: {r.source for r in rows} for u, rows in by_user.items()}
    als, rest = {"als"}, {"popularity"}
    assert sources == {"u0": als, "u1": rest, "u2": rest, "u3": als, "u4": rest, "stranger": rest}
    assert all(sorted(r["rank"] for r in rows) == list(range(1, 151)) for rows in by_user.values())
    assert {r.item_id for r in by_user["u0"]}.isdisjoint({"i200", "i201"})


def test_similar_items_of_unusable_vectors(spark, serving):
    _, items, _, item_names, popular = serving
    wanted = spark.createDataFrame([("i0",), ("i200",), ("i201",), ("i202",), ("none",)], "item_id string")
    found = recommending.similar_items(wanted, items, item_names, popular, 7).collect()
    sources = {(r.item_id, r.source) for r in found}
    assert sources == {("i0", "als")} | {(i, "popularity") for i in ("i200", "i201", "i202", "none")}
    assert len(found) == 5 * 7


def test_results_need_one_at_least():
    for n in (0, -1):
        with pytest.raises(ValueError):
            popularity.check_results(n)
    assert popularity.check_results(1000) == 1000


def test_serving_without_model_or_tables(spark, tmp_path, serving):
    _, _, names, item_names, popular = serving
    root, nowhere = str(tmp_path / "tables"), str(tmp_path / "model")
    wanted = spark.createDataFrame([("u1",)], "user_id string")
    assert serve_tables.recommendation_table(spark, root, nowhere, wanted).count() == 0
    tables.write_table(popular, root, tables.POPULAR_ITEMS)
    found = serve_tables.recommendation_table(spark, root, nowhere, wanted, 3).collect()
    assert [(r.item_id, r.source) for r in sorted(found, key=lambda r: r["rank"])] == [(str(i), "popularity") for i in range(3)]
    tables.write_table(item_names, root, tables.ITEM_MAP)
    similar = serve_tables.similarity_table(spark, root, nowhere, n=2)
    assert similar.count() == 2 * 203 and similar.where("source <> 'popularity'").count() == 0
    with pytest.raises(ValueError):
        serve_tables.main(["recommend", "--tables", root, "--model", nowhere, "--output", str(tmp_path / "o"), "-n", "0"])


def test_sample_and_split_are_independent(spark):
    pairs = inputs.rated_pairs(spark, "/root/testdata/sf0.001").cache()
    for fraction in (0.1, 0.5, 0.9):
        sample = splitting.hash_sample(pairs, fraction)
        training, validation = (part.count() for part in splitting.hash_split(sample))
        assert abs(validation / (training + validation) - 0.2) < 0.06


def test_training_on_a_sample(spark, tmp_path):
    pairs = inputs.rated_pairs(spark, "/root/testdata/sf0.001")
    tables.write_table(pairs, str(tmp_path), tables.INTERACTIONS)
    before = set(Path(scratch.shared_folder(spark)).rglob("*.parquet"))
    train.main(["--tables", str(tmp_path), "--artifacts", str(tmp_path / "a"), "--rank", "4", "--reg", "0.1", "--maxiter", "2", "--sample-fraction", "0.5", "--blocks", "3", "--seed", "7"])
    document = json.loads(next((tmp_path / "a" / "als_model" / "metadata.json").glob("part-*")).read_text())
    assert document["params"]["rank"] == 4 and document["metrics"]["rmse"] > 0
    assert set(Path(scratch.shared_folder(spark)).rglob("*.parquet")) <= before


def test_search_needs_validation_rows(spark):
    pairs = spark.createDataFrame([(1, 1, 3.0)], "user_idx int, item_idx int, rating double")
    with pytest.raises(ValueError, match="validation"):
        grid.search(pairs, pairs.limit(0), [{"item_damping": 1.0, "user_damping": 1.0}], RatingSums.of(pairs).fit)


def test_one_rule_names_and_keeps_the_best(spark):
    """Precisions that round apart in floating and decimal arithmetic."""
    trials = [
        grid.Trial({"rank": i}, {"rmse": 1.0 + i, "precision_at_k": p, "recall_at_k": 0.0, "ndcg_at_k": 0.0})
        for i, p in enumerate((0.1234567885, 0.1234567895, 0.1234567894999))
    ]
    best = grid.best_ordinal(trials)
    assert grid.best_trial(grid.trials_frame(spark, trials)).first()["ordinal"] == best


def test_scores_are_taken_once(spark):
    """One scan of the predictions feeds both branches of the metrics."""
    reads = spark.sparkContext.accumulator(0)

    def touch(frames):
        for frame in frames:
            reads.add(len(frame))
            yield frame

    rows = [(u, i, float(i % 5 + 1), float(i)) for u in range(4) for i in range(10)]
    schema = "user_idx int, item_idx int, rating double, prediction double"
    traced = spark.createDataFrame(rows, schema).mapInPandas(touch, schema)
    assert ranking_metrics.evaluate(traced, 3).first()["rmse"] > 0
    assert reads.value == 40


@pytest.mark.parametrize("k", [3, 1500])
def test_large_k_ranks_alike(spark, k):
    rows = [(u, i, 1.0, float((i * 7919) % 2003)) for u in range(2) for i in range(2000)]
    frame = spark.createDataFrame(rows, "user_idx int, item_idx int, rating double, prediction double")
    found = ranking_metrics.topk_per_user(frame, k).collect()
    want = sorted((-p, i) for _, i, _, p in rows[:2000])[:k]
    for user in (0, 1):
        assert [r.item_idx for r in sorted(found, key=lambda r: r["rank"]) if r.user_idx == user] == [i for _, i in want]


def test_hot_keys_are_sliced_in_every_join(spark, monkeypatch):
    """A key that is rare where the table was counted and hot in the frame joined."""
    seen = []
    attach = lookup.attach

    def traced(rows, table, key, how="inner", slice_rows=5):
        seen.append(table.peak)
        return attach(rows, table, key, how, 5)

    monkeypatch.setattr(lookup, "attach", traced)
    ratings = spark.createDataFrame([("hot", f"i{i % 3}", 3.0) for i in range(60)] + [("cold", "i0", 1.0)], "user_id string, item_id string, rating double")
    users = spark.createDataFrame([(0, "hot"), (1, "cold")], "user_idx int, user_id string")
    items = spark.createDataFrame([(i, f"i{i}") for i in range(3)], "item_idx int, item_id string")
    encoded = indexing.encode(ratings, users, items)
    assert encoded.count() == 61 and max(seen) == 60
    seen.clear()
    model = RatingSums.of(encoded.distinct()).fit(None, 1.0, 1.0)
    assert model.transform(encoded).count() == 61 and max(seen) == 60


def test_scratch_belongs_to_its_block(spark):
    other = {}
    ready, done = threading.Event(), threading.Event()

    def work():
        ready.wait()
        other["table"] = scratch.materialize(spark.range(3), "other")
        done.set()

    thread = threading.Thread(target=work)
    thread.start()
    with scratch.scratch_tables(spark):
        outer = scratch.materialize(spark.range(4), "outer")
        with scratch.scratch_tables(spark):
            first, second = scratch.side_by_side(
                spark, lambda: scratch.materialize(spark.range(5), "a"), lambda: scratch.materialize(spark.range(6), "b")
            )
            inner = files_of(first) + files_of(second)
        ready.set()
        done.wait()
        assert not any(f.exists() for f in inner) and outer.count() == 4
        left = files_of(outer)
    thread.join()
    assert not any(f.exists() for f in left) and other["table"].count() == 3


def test_keys_from_a_file(spark, tmp_path):
    (tmp_path / "meta.json").write_text("\n".join(json.dumps({"asin": f"K{i}", "price": "$1.5" if i else 2}) for i in range(4)))
    (tmp_path / "ids.txt").write_text("K2\n\nK0\n K2 \nK9\nK1\n")
    out = str(tmp_path / "out")
    lookup_items.main(["--metadata", str(tmp_path / "meta.json"), "--output", out, "--keys-file", str(tmp_path / "ids.txt")])
    keys = lookup_items.keys_from_file(spark, str(tmp_path / "ids.txt"))
    found = lookup_items.item_details(spark, str(tmp_path / "meta.json"), keys).collect()
    assert [(r.asin, r.price, r.price_value) for r in found] == [("K2", "$1.5", None), ("K0", "2", 2.0), ("K1", "$1.5", None)]
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(SystemExit):
        lookup_items.main(["--metadata", "m", "--output", "o"])


def test_item_rows_cross_the_shuffle_as_blocks(spark, serving):
    from ratingloom.operators.nearest import top_n

    users, items, *_ = serving
    found = top_n(users.where("id IN (0, 3)").withColumnRenamed("id", "u"), items.where("id < 200").withColumnRenamed("id", "i"), 2, "u", "i", block_rows=64)
    plan = found._jdf.queryExecution().toString()
    assert "vectors" in plan and found.count() == 4
