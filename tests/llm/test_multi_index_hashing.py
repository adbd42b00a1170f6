"""Probing against all Hamming distances, the search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import multi_index_hashing as mih
from ratingloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, slot string, block int, twin int, score double, octave int"


def brute(ids, vectors, asked, n=20):
    """Nearest ids and scores per asked row, equal scores by id."""
    scores = vectors[asked] @ vectors.T
    found = {}
    for at, row in zip(np.flatnonzero(asked), scores):
        order = [j for j in np.lexsort((ids, -np.round(row, 12))) if ids[j] != ids[at]][:n]
        found[int(ids[at])] = [(int(ids[j]), row[j]) for j in order]
    return found


def lists(result):
    found = {}
    for row in sorted(result.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(found[row["query_id"]])
    return found


def recall(found, truth):
    """Share of the true neighbours found, one as good as another of the same score."""
    hits = total = 0
    for query, wanted in truth.items():
        bar = wanted[-1][1] if wanted else 0.0
        total += len(wanted)
        hits += min(len(wanted), sum(score >= bar - 1e-9 for _, score in found.get(query, [])))
    return hits / max(total, 1)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", 2, 3, 0.5, 4) for i, v in rows], SCHEMA)


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 256, (30, 32), dtype=np.uint8)
    noise = np.packbits(rng.random((600, 256)) < rng.choice([0.0, 0.01, 0.05, 0.2, 0.5], (600, 1)), axis=1)
    words = np.ascontiguousarray(centres[rng.integers(0, 30, 600)] ^ noise).view(np.uint64)
    queries = np.concatenate([words[:20], rng.integers(0, 1 << 63, (20, 4)).astype(np.uint64)])
    apart = np.bitwise_count(queries[:, None] ^ words[None]).sum(axis=2)
    for enough in (1, 7, 60, 600, 5000):
        query, row = mih.Index(words).within(queries, enough)
        radius = np.sort(apart, axis=1)[:, min(enough, 600) - 1]
        wanted = np.nonzero(apart <= radius[:, None])
        assert set(zip(query.tolist(), row.tolist())) == set(zip(wanted[0].tolist(), wanted[1].tolist()))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_query_recall_and_scores(spark, folder):
    rows = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    got = QUERIES["op13_nearest_neighbours"](spark, f"/root/testdata/{folder}")
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    found, truth = lists(got), brute(ids, vectors, ids % 20 == 0)
    assert found.keys() == truth.keys() and all(len(found[q]) == min(20, len(ids) - 1) for q in truth)
    assert recall(found, truth) >= 0.95
    place = {int(i): v for i, v in zip(ids, vectors)}
    for query, pairs in found.items():
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0]))
        assert query not in [i for i, _ in pairs]
        for other, score in pairs:
            assert score == pytest.approx(place[query] @ place[other], abs=1e-12)


def test_many_shards_blocks_and_very_different_norms(spark, monkeypatch):
    monkeypatch.setattr(mih, "SHARD_VALUES", 16 * 300)
    monkeypatch.setattr(mih, "BLOCK_VALUES", 16 * 10)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16)) + 2
    vectors = centres[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    vectors *= np.exp(rng.normal(size=(3000, 1)) * 1.5)
    ids = np.arange(3000)
    found = lists(mih.nearest(table(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)]), F.col("vec_id") % 20 == 0, 20, enough=100))
    assert recall(found, brute(ids, vectors, ids % 20 == 0)) >= 0.95


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(900, 8))
    vectors[::3] = vectors[0]
    ids = np.arange(900)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    found = lists(mih.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 20))
    truth = brute(ids, vectors, ids % 20 == 0)
    assert recall(found, truth) == 1.0
    for query in truth:  # ties go to the smaller ids
        if query % 3 == 0:
            assert [i for i, _ in found[query]] == [i for i in range(0, 900, 3) if i != query][:20]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0]), (1, [3.0, -1.0]), (1, [3.0, -1.0]), (1, [0.0, 5.0]), (40, None), (60, []), (80, [0.0, -0.0])]
    rows += [(100, [nan, 1.0]), (120, [inf, 1.0]), (140, [None, 1.0]), (None, [1.0, 1.0]), (160, [1.0, 2.0, 3.0]), (3, [1.0, 1.0, 1.0]), (180, [1.0])]
    rows += [(200, [1e-300, 1e-300]), (5, [1e150, 0.0])]
    found = lists(mih.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 3))
    assert found[0] == [(5, 1e150), (1, 10.0), (20, 4.0)]
    assert found[20] == [(5, 2e150), (1, 5.0), (1, 5.0)]
    assert found[160] == [(3, 6.0)]
    assert found[200][0][0] == 5 and set(found) == {0, 20, 160, 200}


def test_no_rows_no_queries_and_few_candidates(spark):
    assert lists(mih.nearest(table(spark, []), F.col("vec_id") % 20 == 0, 20)) == {}
    assert lists(mih.nearest(table(spark, [(1, [1.0])]), F.col("vec_id") % 20 == 0, 20)) == {}
    assert lists(mih.nearest(table(spark, [(0, [1.0]), (2, [3.0]), (7, [-2.0])]), F.col("vec_id") % 20 == 0, 20)) == {0: [(2, 3.0), (7, -2.0)]}


def test_other_number_types(spark):
    rows = spark.createDataFrame([(0, [1, 2]), (1, [3, 4]), (2, [5, -9])], "vec_id int, embedding array<int>")
    assert lists(mih.nearest(rows, F.col("vec_id") == 0, 5)) == {0: [(1, 11.0), (2, -13.0)]}
