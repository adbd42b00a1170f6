import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import language_id, ngram_trie
from ratingloom.llm.elias_fano import EliasFano


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1 << 64), (5, 6), (1000, 1 << 64), (50_000, 1 << 40)])
def test_elias_fano(n, universe, tmp_path):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
    built = EliasFano.build(values, universe)
    built.save(str(tmp_path), "x")
    coded = built.mapped(str(tmp_path), "x")
    assert (coded.values(np.arange(len(values))) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe - 1, 2000, dtype=np.uint64, endpoint=True)])
    where = {int(v): i for i, v in enumerate(values)}
    assert coded.find(asked).tolist() == [where.get(int(v), -1) for v in asked]


def test_elias_fano_finds_the_first_of_equal_values():
    values = np.array([0, 0, 3, 3, 3, 9], np.uint64)
    assert EliasFano.build(values, 10).find(np.array([0, 3, 9, 4], np.uint64)).tolist() == [0, 2, 5, -1]


def test_successors_are_searched_within_a_range():
    values = np.array([2, 5, 9, 2 + 16, 9 + 16, 5 + 32], np.uint64)
    coded = EliasFano.build(values, 48)
    asked = np.array([5, 5, 25, 25, 37], np.uint64)
    first, last = np.array([0, 2, 3, 0, 5]), np.array([3, 3, 5, 4, 6])
    assert coded.find(asked, first, last).tolist() == [1, -1, 4, -1, 5]


def test_every_level_of_the_trie_is_read(tmp_path):
    """Words, pointers and pairs: a pair is found between its word's pointers, and nowhere else."""
    words, known = np.array([10, 20, 30], np.uint64), np.array([3, 1, 2])
    word, previous, times = np.array([0, 0, 1, 2]), np.array([7, 9, 7, 1], np.uint32), np.array([2, 1, 1, 2])
    trie = ngram_trie.Trie(str(tmp_path), words, known, word, previous, times, 6, 3, 1.0)
    asked_word, asked = np.array([0, 0, 1, 1, 2]), np.array([7, 8, 7, 9, 1], np.uint32)
    p = (known + 1) / 10
    want = [2 + p[0], p[0], 1 + p[1], p[1], 2 + p[2]]
    assert np.allclose(10 ** trie.numerators(asked_word, asked), want, rtol=0.003)
    moved = EliasFano.build(np.array([0, 0, 0, 4], np.uint64), 5)  # all pairs under the last word
    trie.ranges = moved
    assert np.allclose(10 ** trie.numerators(asked_word, asked)[:4], [p[0], p[0], p[1], p[1]], rtol=0.003)
    assert trie.find_words(np.array([20, 21], np.uint64)).tolist() == [1, -1]


def test_held_rows_are_read_twice_from_memory_or_a_file(tmp_path, monkeypatch):
    monkeypatch.setattr(ngram_trie, "HELD_BYTES", 2_000)
    batches = [pa.RecordBatch.from_arrays([pa.array(np.arange(n))], ["n"]) for n in (3, 200, 0, 500)]
    for some in (batches[:2], batches, []):
        rows = ngram_trie._Rows(str(tmp_path))
        for batch in some:
            rows.add(batch)
        for _ in range(2):
            assert [b.num_rows for b in rows.read()] == [b.num_rows for b in some]
    assert (tmp_path / "rows.arrow").exists()


def test_many_shards(documents, monkeypatch):
    monkeypatch.setattr(ngram_trie, "SHARD_TOKENS", 3_000)
    check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])


def slow_scores(rows, prior):
    def split(text):
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        return [w.decode() for w in text.encode().split()] + ["</s>"]

    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows}
    train = [split(t) for i, t in rows if not held[i]]
    one = Counter(w for t in train for w in t)
    two = Counter((a, b) for t in train for a, b in zip(["<s>", *t], t))
    one_context = one + Counter({"<s>": len(train)})
    total, kinds = sum(one.values()), len(one)
    out = []
    for i, text in rows:
        words = split(text)
        base = sum(math.log10((one[w] + 1) / (total + kinds + 1)) for w in words)
        score = sum(
            math.log10((two[a, b] + prior * (one[b] + 1) / (total + kinds + 1)) / (one_context[a] + prior)) for a, b in zip(["<s>", *words], words)
        )
        out.append((i, held[i], len(words), sum(one[w] > 0 for w in words), total, base, score))
    return out


def check(table, rows):
    got = ngram_trie.score_texts(table, language_id.fold(F.col("doc_id"), 7) == 2).collect()
    want = slow_scores(rows, ngram_trie.PRIOR)

    def key(r):
        return (r[0] is None, r[0] or 0, r[2])

    assert len(got) == len(want)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        # Quantised numerators are off by half a step per token at most.
        assert abs(g[6] - w[6]) <= g[2] * ngram_trie.STEP / 2 + 1e-6


def test_scores_like_brute_force(documents):
    check(documents, [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = ngram_trie.score_texts(docs, language_id.fold(F.col("doc_id"), 7) == 2).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_odd_rows(odd, nothing, wide):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(odd, rows)
    check(wide, rows)
    assert ngram_trie.score_texts(nothing, F.lit(False)).count() == 0
    untrained = ngram_trie.score_texts(odd, F.lit(True)).collect()
    assert len(untrained) == len(rows) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in untrained)
