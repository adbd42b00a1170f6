"""Publishing that fails halfway, lookups that read one bucket, single answers."""

import json

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import factor_models
from ratingloom.plans import etl, lookup_items, serve_tables
from ratingloom.sources import keyed, models, snapshots, tables


def scan_metrics(df):
    """Files and rows that a query's scans read, once it has run."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaves = execution.executedPlan().collectLeaves()
    found = {"numFiles": 0, "numOutputRows": 0}
    for at in range(leaves.size()):
        metrics = leaves.apply(at).metrics()
        for name in found:
            if metrics.contains(name):
                found[name] += metrics.apply(name).value()
    return found


@pytest.mark.parametrize("step", [0, 0.5, 1, 1.5, 2, 2.5])
def test_readers_keep_the_old_set_until_all_of_the_new_one_is_there(spark, tmp_path, step):
    root = str(tmp_path / "set")
    old, new = spark.range(3), spark.range(5)
    names = ["a", "b", "c"]
    snapshots.publish(spark, root, {name: old.write.parquet for name in names})
    failing = {name: (lambda path, at=at: _write(new, path, step, at)) for at, name in enumerate(names)}
    with pytest.raises(RuntimeError):
        snapshots.publish(spark, root, failing)
    assert [tables.read_table(spark, root, name).count() for name in names] == [3, 3, 3]
    snapshots.publish(spark, root, {name: new.write.parquet for name in names})
    assert [tables.read_table(spark, root, name).count() for name in names] == [5, 5, 5]


def _write(frame, path, step, at):
    if at == step:
        raise RuntimeError("before the write")
    frame.write.parquet(path)
    if at + 0.5 == step:
        raise RuntimeError("after the write")


def test_a_torn_switch_changes_nothing(spark, tmp_path, monkeypatch):
    """A crash before or inside the manifest's write leaves the old one the newest."""
    root = str(tmp_path / "set")
    snapshots.publish(spark, root, {"a": spark.range(3).write.parquet})

    def crash(self, name, text):
        folder, last = name.rsplit("/", 1)
        stream = self.system.create(self.path(f"{folder}/.{last}-torn"))
        stream.write(bytearray(text.encode()[:7]))
        stream.close()
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots._Files, "write_new", crash)
        with pytest.raises(RuntimeError):
            snapshots.publish(spark, root, {"a": spark.range(9).write.parquet})
    assert tables.read_table(spark, root, "a").count() == 3
    snapshots.publish(spark, root, {"a": spark.range(4).write.parquet})
    assert tables.read_table(spark, root, "a").count() == 4


def test_two_writers_at_once_both_count(spark, tmp_path):
    root = str(tmp_path / "set")

    def slow(path):
        snapshots.publish(spark, root, {"b": spark.range(2).write.parquet})
        spark.range(1).write.parquet(path)

    snapshots.publish(spark, root, {"a": slow})
    assert {name: spark.read.parquet(path).count() for name, path in snapshots.current(spark, root).items()} == {"a": 1, "b": 2}
    files = snapshots._Files(spark, root)
    taken = f"{root}/{snapshots.MANIFESTS}/{2:012d}.json"
    assert not files.write_new(taken, "{}") and json.loads(files.read(taken)) != {}


def test_old_sets_are_retired(spark, tmp_path):
    root = str(tmp_path / "set")
    for n in range(5):
        snapshots.publish(spark, root, {"a": spark.range(n).write.parquet} | ({"kept": spark.range(7).write.parquet} if n == 0 else {}))
    snapshots.retire(spark, root, keep=2)
    runs = [p.name for p in (tmp_path / "set" / snapshots.RUNS).iterdir()]
    assert len(runs) == 3  # two of "a", and the first, which still holds "kept"
    assert tables.read_table(spark, root, "a").count() == 4 and tables.read_table(spark, root, "kept").count() == 7


def test_a_failing_etl_run_leaves_all_four_tables(spark, tmp_path, monkeypatch):
    (tmp_path / "one.csv").write_text("user,item,rating\na,x,1\nb,x,2\n")
    (tmp_path / "two.csv").write_text("user,item,rating\na,x,1\nb,y,2\nc,y,3\n")
    out = str(tmp_path / "out")
    etl.preprocess_reviews(spark, str(tmp_path / "one.csv"), out, 1)

    def broken(rows):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(etl, "compute_popularity", broken)
        with pytest.raises(RuntimeError):
            etl.preprocess_reviews(spark, str(tmp_path / "two.csv"), out, 1)
    names = (tables.INTERACTIONS, tables.USER_MAP, tables.ITEM_MAP, tables.POPULAR_ITEMS)
    assert [t.count() for t in tables.read_set(spark, out, *names)] == [2, 2, 1, 1]
    etl.preprocess_reviews(spark, str(tmp_path / "two.csv"), out, 1)
    assert [t.count() for t in tables.read_set(spark, out, *names)] == [3, 3, 2, 2]


def test_a_model_and_its_metadata_change_together(spark, tmp_path):
    ratings = spark.createDataFrame([(u, i, float(u + i)) for u in range(4) for i in range(3)], "user_idx int, item_idx int, rating double")
    path = str(tmp_path / "model")
    for rank in (2, 3):
        models.save_model(factor_models.fit_als(ratings, rank=rank, maxIter=1), path, {"rank": rank}, {"rmse": 0.5})
    assert models.load_model(path).rank == 3
    assert models.read_metadata_document(spark, path).first()["params"]["rank"] == 3
    plain = str(tmp_path / "plain")
    factor_models.fit_als(ratings, rank=4, maxIter=1).save(plain)
    assert models.load_model(plain).rank == 4 and models.load_factors(spark, str(tmp_path / "none"))[0].count() == 0


def test_a_lookup_reads_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id") % 5_000).alias("key"), F.col("id").alias("value"))
    keyed.write_keyed(rows, path, "key", "value", bucket_rows=1_000)
    one = keyed.read_keys(spark, path, "key", ["k7"])
    assert sorted(r["value"] for r in one.collect()) == [7, 5007, 10007, 15007]
    read = scan_metrics(one)
    assert read["numFiles"] == 1 and read["numOutputRows"] < 3_000
    wanted = spark.createDataFrame([("k1",), ("k2",), ("k2",), ("none",), (None,)], "key string")
    some = keyed.read_keys(spark, path, "key", wanted)
    assert sorted(r["value"] for r in some.collect()) == sorted(base + n for base in (1, 2) for n in range(0, 20_000, 5_000))
    assert keyed.read_keys(spark, path, "key", []).collect() == [] == keyed.read_keys(spark, path, "key", ["none"]).collect()
    many = keyed.read_keys(spark, path, "key", [f"k{n}" for n in range(2_000)])
    assert many.count() == 8_000


def test_details_are_parsed_once(spark, tmp_path):
    lines = [json.dumps({"asin": f"B{n}", "title": f"t{n}", "price": n}) for n in range(300)] + ["broken", json.dumps({"asin": "B5", "title": "later"}), '{"title": "no key"}']
    (tmp_path / "meta.json").write_text("\n".join(lines))
    store = str(tmp_path / "store")
    lookup_items.store_details(spark, str(tmp_path / "meta.json"), store)
    (tmp_path / "meta.json").unlink()
    got = lookup_items.stored_details(spark, store, ["B9", "none", "B5", "B9"]).collect()
    assert [(r["ordinal"], r["asin"], r["title"]) for r in got] == [(0, "B9", "t9"), (2, "B5", "t5")]
    out = str(tmp_path / "found")
    lookup_items.main(["--store", store, "--output", out, "B1"])
    assert [r["title"] for r in spark.read.parquet(out).collect()] == ["t1"]


def test_one_subject_reads_one_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed.write_keyed, "__kwdefaults__", {"bucket_rows": 50})
    recs = spark.range(400).select(F.concat(F.lit("u"), F.floor(F.col("id") / 4)).alias("user_id"), (F.col("id") % 4 + 1).cast("int").alias("rank"), F.lit("i").alias("item_id"), F.lit(1.0).alias("score"), F.lit("als").alias("source"))
    popular = spark.createDataFrame([(0, 9, 3.0), (1, 8, 3.0), (2, 1, 3.0)], "item_idx int, count_ratings long, avg_rating double")
    names = spark.createDataFrame([(0, "top")], "item_idx int, item_id string")
    path = str(tmp_path / "answers")
    serve_tables.publish_answers(spark, path, "user_id", recs, popular, names, 2)
    found = serve_tables.answers(spark, path, "user_id", ["u17"])
    assert sorted((r["user_id"], r["rank"], r["source"]) for r in found.collect()) == [("u17", n, "als") for n in range(1, 5)]
    one = keyed.read_keys(spark, snapshots.current(spark, path)[serve_tables.ANSWERS], "user_id", ["u17"])
    read = scan_metrics(one)
    assert read["numFiles"] == 1 and read["numOutputRows"] <= 100
    both = serve_tables.answers(spark, path, "user_id", ["u3", "stranger"]).collect()
    assert sorted((r["user_id"], r["rank"], r["item_id"]) for r in both) == [("stranger", 1, "top"), ("stranger", 2, "1"), *[("u3", n, "i") for n in range(1, 5)]]
