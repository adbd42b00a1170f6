import math
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import language_id as lid

PIECES = lid.public_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def every_segmentation(word, probability):
    total = 0.0
    for n in range(len(word)):
        for cuts in combinations(range(1, len(word)), n):
            parts = [word[a:b] for a, b in zip((0, *cuts), (*cuts, len(word)))]
            total += math.prod(probability(p) for p in parts)
    return total


def test_forward_sums_every_segmentation():
    vocabulary = ["▁", "▁a", "a", "ab", "b", "▁ab", "abc", "c", "bca"]
    rng = np.random.default_rng(0)
    table = rng.random((len(vocabulary), 2)) / 10
    words = ["a", "abc", "abcab", "abz", "zz"]
    scores = lid.word_scores(lid.PieceTable(vocabulary), table, words)
    for word, row in zip(words, scores):
        for k in (0, 1):
            def probability(piece, k=k):
                if piece in vocabulary:
                    return table[vocabulary.index(piece), k]
                return lid.UNKNOWN if len(piece) == 1 else 0.0

            assert math.isclose(math.exp(row[k]), every_segmentation("▁" + word, probability), rel_tol=1e-9)


def test_expected_counts_are_derivatives():
    """Expected uses equal the derivative of the log likelihood by the log probability."""
    vocabulary = ["▁a", "▁", "a", "ab", "b", "c"]
    p = np.full((len(vocabulary), 1), 0.1)
    words, times = ["ab", "aab", "cab"], np.array([2.0, 1.0, 3.0])
    table = lid.PieceTable(vocabulary)
    uses = lid.expected_counts(table, p, words, times)
    for i in range(len(vocabulary)):
        up, down = p.copy(), p.copy()
        up[i] *= math.exp(1e-5)
        down[i] *= math.exp(-1e-5)
        slope = (times @ (lid.word_scores(table, up, words) - lid.word_scores(table, down, words)))[0] / 2e-5
        assert math.isclose(uses[i], slope, rel_tol=1e-5, abs_tol=1e-7)


def test_held_out_accuracy(documents):
    held = lid.fold(F.col("doc_id"), 3) == 1
    model = lid.fit(documents.where(~held), PIECES)
    got = lid.identify(documents.where(held), model)
    right, n = got.agg(F.count(F.when(F.col("lang") == F.col("lang_pred"), 1)), F.count("*")).first()
    assert right >= 0.95 * n


def test_odd_rows(odd, nothing, wide, documents):
    model = lid.fit(documents, PIECES, rounds=1)
    got = {r["doc_id"]: r for r in lid.identify(odd, model).collect()}
    assert len(lid.identify(odd, model).collect()) == odd.count()
    for i in (3, 4, 5, 6):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[1]["lang_pred"] == "en" and 0 <= got[1]["score"] <= 1
    assert lid.identify(nothing, model).count() == 0
    replaced = lid.identify(wide, model)
    assert replaced.columns.count("score") == 1 and replaced.where("lang_pred = 'en'").count() >= 3
    empty = lid.fit(nothing, PIECES)
    assert {r["lang_pred"] for r in lid.identify(odd, empty).collect()} == {"und"}


def plain_score(word, chance):
    """Log probability of a marked word, boundary by boundary in logarithms."""
    word = "▁" + word
    best = [0.0]
    for t in range(1, len(word) + 1):
        options = []
        for m in range(1, min(t, 20) + 1):
            p = chance.get(word[t - m : t], lid.UNKNOWN if m == 1 else None)
            if p is not None:
                options.append(best[t - m] + math.log(p))
        top = max(options)
        best.append(top + math.log(sum(math.exp(o - top) for o in options)))
    return best[-1]


def letters_of(text):
    import unicodedata

    words, current = [], ""
    for c in text.lower():
        kind = unicodedata.category(c)[0]
        if kind == "L" or (kind == "M" and current):
            current += c
        elif current:
            words, current = [*words, current], ""
    return [*words, current] if current else words


ODD_TEXTS = [
    "½", "²", "①", "\u0301\u0301", "12 ½ ²①!", "", None, "a", "Straße", "naïve cafe\u0301", "İstanbul", "中文没有空格" * 40,
    "the" * 3_400, "x" * 10_000, ("und" * 30 + " ") * 5, "internationalization representations", "\u0301a", "ﬁne ª º ǅ ʰ",
]


def test_predictions_are_the_plain_ones_on_odd_texts(spark, documents):
    model = lid.fit(documents, PIECES, rounds=1)
    assert max(map(len, model.vocabulary)) > 12
    chances = [dict(zip(model.vocabulary, model.probabilities[:, k])) for k in range(len(model.languages))]
    table = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in lid.identify(table, model).collect()}
    for i, text in enumerate(ODD_TEXTS):
        words = letters_of(text or "")
        assert lid.words_of(text) == words
        if not words:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        totals = [sum(plain_score(w, chance) for w in words) + prior for chance, prior in zip(chances, model.priors)]
        top = max(totals)
        assert got[i]["lang_pred"] == model.languages[totals.index(top)]
        assert math.isclose(got[i]["score"], 1 / sum(math.exp(x - top) for x in totals), rel_tol=1e-6)


def test_expected_counts_of_a_long_word_are_derivatives():
    vocabulary = ["▁", "a", "ab", "b", "abab"]
    p = np.full((len(vocabulary), 1), 1e-5)
    table, words, times = lid.PieceTable(vocabulary), ["ab" * 400, "a", "ab" * 17], np.array([1.0, 2.0, 1.0])
    uses = lid.expected_counts(table, p, words, times)
    for i in range(len(vocabulary)):
        up, down = p.copy(), p.copy()
        up[i] *= math.exp(1e-5)
        down[i] *= math.exp(-1e-5)
        slope = (times @ (lid.word_scores(table, up, words) - lid.word_scores(table, down, words)))[0] / 2e-5
        assert math.isclose(uses[i], slope, rel_tol=1e-4, abs_tol=1e-4)


def test_remembered_words_change_nothing(spark, documents, monkeypatch):
    model = lid.fit(documents, PIECES, rounds=1)
    texts = [r["text"] for r in documents.limit(40).collect()]
    want = model.predict(texts)
    monkeypatch.setattr(lid, "REMEMBERED", 300)
    monkeypatch.setattr(lid, "WORD_CHARS", 50)
    fresh = lid.LanguageModel(model.vocabulary, model.languages, model.priors, model.probabilities)
    for text, label, score in zip(texts, *want):
        got = fresh.predict([text])
        assert got[0] == [label] and math.isclose(got[1][0], score, rel_tol=1e-9)
