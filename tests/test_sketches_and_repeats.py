"""Sketches against exact counts; one rating per pair against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from ratingloom.operators import repeats, sketches
from ratingloom.plans.etl import preprocess_reviews
from ratingloom.sources import reviews, tables


def test_slices_and_unions_are_within_three_standard_errors(spark):
    n = 60_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20).alias("day"),
        (F.xxhash64("id") % 30_000).cast("string").alias("user_id"),
        (F.xxhash64("id", F.lit(1)) % 700).cast("string").alias("item_id"),
    )
    stored = sketches.sketch_slices(rows, ["day"]).cache()
    for by in (["day"], []):
        guess = {tuple(r[b] for b in by): r for r in sketches.estimates(sketches.merge_slices(stored, by)).collect()}
        exact = rows.groupBy(*by).agg(F.count_distinct("user_id").alias("u"), F.count_distinct("item_id").alias("i"), F.count("*").alias("n"))
        for r in exact.collect():
            mine = guess[tuple(r[b] for b in by)]
            assert mine["num_rows"] == r["n"]
            assert abs(mine["num_user_id"] - r["u"]) <= 3 * sketches.relative_error() * r["u"]
            assert abs(mine["num_item_id"] - r["i"]) <= 3 * sketches.relative_error() * r["i"]
    whole = sketches.overview(stored).first()
    assert whole["num_rows"] == n and 0.99 < whole["sparsity"] < 1


def test_a_new_slice_is_merged_without_the_old_rows(spark):
    rows = spark.range(20_000).select((F.col("id") % 4_000).alias("user_id"), (F.col("id") % 90).alias("item_id"), (F.col("id") % 5).alias("day"))
    old, new = (sketches.sketch_slices(part, ["day"]) for part in (rows.where("day < 4"), rows.where("day = 4")))
    merged = sketches.estimates(sketches.merge_slices(old.union(new))).first()
    at_once = sketches.estimates(sketches.merge_slices(sketches.sketch_slices(rows, ["day"]))).first()
    assert merged == at_once


def test_more_registers_are_more_exact_and_empty_slices_count_nothing(spark):
    assert sketches.relative_error(14) == sketches.relative_error(12) / 2
    rows = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, "x", "b")], "day int, user_id string, item_id string")
    got = {r["day"]: (r["num_rows"], r["num_user_id"], r["num_item_id"]) for r in sketches.estimates(sketches.sketch_slices(rows, ["day"])).collect()}
    assert got == {1: (2, 0, 2), 2: (1, 1, 1)}
    none = sketches.sketch_slices(rows.limit(0), ["day"])
    assert tuple(sketches.overview(none).first()) == (0.0, 0.0, 0.0, 1.0)


LINES = [("u", "i", r, t) for r, t in ((3, 50), (5, 70), (1, 70), (4, None), (2, 10))] + [("u", "j", 2, None), ("u", "j", 4, None), ("v", "i", 1, 9)]


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_the_latest_rating_by_time_then_by_line(spark, tmp_path, fmt):
    path = str(tmp_path / f"reviews.{fmt}")
    raw = spark.createDataFrame([(*line[:2], str(line[2]), line[3]) for line in LINES], "user string, item string, stars string, unixReviewTime long").coalesce(1)
    raw.write.csv(path, header=True) if fmt == "csv" else getattr(raw.write, fmt)(path)
    got = {(r["user_id"], r["item_id"]): r["rating"] for r in repeats.one_per_pair(reviews.read_reviews(spark, path, timed=True), "last").collect()}
    assert got == {("u", "i"): 1.0, ("u", "j"): 4.0, ("v", "i"): 1.0}


def test_last_max_and_avg_of_many_files(spark, tmp_path):
    rng = random.Random(6)
    lines = [(f"u{rng.randrange(6)}", f"i{rng.randrange(4)}", float(rng.randrange(1, 6)), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    for part in range(5):
        text = "\n".join(f"{u}\t{i}\t{r}\t{'' if t is None else t}" for u, i, r, t in lines[part * 60 : part * 60 + 60])
        (tmp_path / f"part-{part}.tsv").write_text("user\titem\trating\ttimestamp\n" + text + "\n")
    rows = reviews.read_reviews(spark, str(tmp_path), "tsv", timed=True)
    groups = {}
    for at, (u, i, r, t) in enumerate(lines):
        groups.setdefault((u, i), []).append((-1 if t is None else t, at, r))
    want = {
        "last": {k: max(g)[2] for k, g in groups.items()},
        "max": {k: max(x[2] for x in g) for k, g in groups.items()},
        "avg": {k: sum(x[2] for x in g) / len(g) for k, g in groups.items()},
    }
    for how in repeats.HOW:
        got = {(r["user_id"], r["item_id"]): r["rating"] for r in repeats.one_per_pair(rows, how).collect()}
        assert got == pytest.approx(want[how])
    with pytest.raises(ValueError, match="first"):
        repeats.one_per_pair(rows, "first")


def test_etl_keeps_the_latest_rating(spark, tmp_path):
    path = str(tmp_path / "reviews.csv")
    (tmp_path / "reviews.csv").write_text("user,item,rating,time\na,x,1,5\na,x,2,4\nb,x,3,1\nb,x,4,1\n")
    out = str(tmp_path / "out")
    preprocess_reviews(spark, path, out, 1, dedupe="last")
    rows = tables.read_table(spark, out, tables.INTERACTIONS).join(tables.read_table(spark, out, tables.USER_MAP), "user_idx")
    assert sorted((r["user_id"], r["rating"]) for r in rows.collect()) == [("a", 1.0), ("b", 4.0)]
