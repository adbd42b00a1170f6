import random

import numpy as np
import pytest

from conftest import rows
from ratingloom.llm import jaccard
from ratingloom.llm.components import components


def sets_of(text, words=3):
    found = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not found:
        return set()
    if len(found) < words:
        return {tuple(found)}
    return set(zip(*[found[i:] for i in range(words)]))


def brute_force(values, percent=90):
    sets = [(i, sets_of(t)) for i, t in values]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return sorted((i, len(s), root(i)) for i, s in sets)


def near_copies(rng, families, copies, length, edits):
    values = []
    for f in range(families):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(length)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = f"x{rng.randint(0, 10**6)}"
            values.append(" ".join(text))
    rng.shuffle(values)
    return list(enumerate(values))


@pytest.mark.parametrize("seed,length,edits", [(1, 30, 2), (2, 120, 6), (3, 8, 1), (4, 400, 20)])
def test_components_like_brute_force(spark, seed, length, edits):
    values = near_copies(random.Random(seed), 6, 30, length, edits)
    found = jaccard.similar_documents(spark.createDataFrame(values, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == brute_force(values)


def test_every_linked_pair_has_a_common_key():
    rng = np.random.default_rng(3)
    for n in [1, 2, 5, 9, 10, 11, 19, 20, 50, 200, 1000]:
        for _ in range(20):
            a = set(rng.integers(0, 1 << 63, n).tolist())
            b = set(a)
            # As many changes as the similarity allows.
            while True:
                trial = set(b)
                if rng.random() < 0.5 and trial:
                    trial.discard(next(iter(trial)))
                else:
                    trial.add(int(rng.integers(0, 1 << 63)))
                if not trial or 100 * len(a & trial) < 90 * len(a | trial):
                    break
                b = trial
            flat = np.array(sorted(a) + sorted(b), np.uint64)
            keys, counts = jaccard.block_keys(flat, np.array([len(a), len(b)]))
            assert set(keys[: counts[0]].tolist()) & set(keys[counts[0] :].tolist())


def test_overlap_product():
    rng = np.random.default_rng(0)
    left = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(7)]
    right = [np.unique(rng.integers(0, 60, 20)).astype(np.uint64) for _ in range(5)]
    got = jaccard.overlap_counts(np.concatenate(left), np.array([len(x) for x in left]), np.concatenate(right), np.array([len(x) for x in right]))
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]


def test_odd_rows(spark, odd, nothing, wide):
    for table in (odd, wide):
        got = jaccard.similar_documents(table).collect()
        assert len(got) == odd.count()
        by_id = {r["doc_id"]: r for r in got}
        assert by_id[2]["component_id"] == by_id[1]["component_id"] == 1
        assert by_id[3]["n_shingles"] == by_id[5]["n_shingles"] == 0 and by_id[5]["component_id"] == 5
        assert by_id[9]["n_shingles"] == 1
        assert by_id[None]["component_id"] is None
    assert jaccard.similar_documents(nothing).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 199)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(found[i] == 0 for i in range(51)) and all(found[i] == 100 for i in range(100, 140)) and found[200] == found[199] == 199


def test_bit_maps_never_miss_a_link(spark):
    rng = np.random.default_rng(6)
    sets = []
    for n in (1, 2, 30, 33, 60, 64, 70, 500, 700):
        base = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for share in (0.0, 0.03, 0.1, 0.2, 0.5, 1.0):
            other = base.copy()
            other[rng.random(len(base)) < share] = rng.integers(0, 1 << 63)
            sets.append(np.unique(np.append(other, rng.integers(0, 1 << 63, rng.integers(0, 3)).astype(np.uint64))))
    table = spark.createDataFrame([(i, len(x), x.view(np.int64).tolist()) for i, x in enumerate(sets)], "doc_id long, size long, items array<long>")
    rows = sorted(jaccard._marks(table).collect())
    marks, sizes = [bytes(r["marks"]) for r in rows], np.array([r["size"] for r in rows])
    for percent in (80, 90):
        may = jaccard.may_link(marks, sizes, marks, sizes, percent)
        true = np.array([[100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)) for b in sets] for a in sets])
        assert not (true & ~may).any()
        assert may.sum() < 0.4 * may.size
