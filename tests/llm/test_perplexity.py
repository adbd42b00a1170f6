import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import perplexity as pp


def slow_model(texts):
    three = Counter(("\0\0" + t)[i : i + 3] for t in texts for i in range(len(t)))
    two = Counter(g[1:] for g in three)
    one = Counter(g[1:] for g in two)

    def discounts(table):
        n = Counter(table.values())
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        raw = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3])
        return [min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), raw)]

    tables = [one, two, three]
    ds = [discounts(t) for t in tables]

    def left(table, d, context):
        inside = [n for g, n in table.items() if g[:-1] == context]
        return (sum(inside), sum(d[min(n, 3) - 1] for n in inside)) if inside else (0, 0)

    memo = {}

    def probability(gram):
        if gram not in memo:
            if not gram:
                memo[gram] = 1 / (len(one) + 1)
            else:
                k = len(gram) - 1
                total, mass = left(tables[k], ds[k], gram[:-1])
                lower = probability(gram[1:])
                n = tables[k][gram]
                memo[gram] = (n - ds[k][min(n, 3) - 1] if n else 0) / total + mass / total * lower if total else lower
        return memo[gram]

    return probability


def test_perplexity_like_brute_force(spark, documents):
    texts = [(r["doc_id"], (r["text"] or "")[:400]) for r in documents.limit(40).collect()] + [(900, "völlig \U0001f600 anders"), (901, "")]
    trusted = [t for i, t in texts if i < 20]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r["perplexity"] for r in pp.document_perplexity(docs, docs.where("doc_id < 20")).collect()}
    model = slow_model(trusted)
    for i, text in texts:
        if not text:
            assert i not in got
            continue
        logs = [math.log(model(("\0\0" + text)[j : j + 3])) for j in range(len(text))]
        assert got[i] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-5)


def test_model_is_a_distribution():
    texts = ["abcab cabb acab", "bca abcb ab"]
    model = slow_model(texts)
    alphabet = sorted(set("".join(texts)))
    for context in ("ab", "ca", "\0\0"):
        assert sum(model(context + c) for c in alphabet) + model(context + "?") == pytest.approx(1.0)


def test_large_counts_take_several_postings(spark):
    text = "a" * 200_000
    rows = pp.document_counts(spark.createDataFrame([(65_535 * 3 + 7, text), (-9, "aaaa")], "doc_id long, text string")).collect()
    total = Counter()
    for r in rows:
        for p in r["postings"]:
            total[r["base"] * 65536 + ((p & 0xFFFFFFFF) >> 16)] += p & 0xFFFF
    assert total == {65_535 * 3 + 7: 200_000, -9: 4}


def test_thresholds_keep_trusted_and_reject_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = pp.classify(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id")
    kept = {r["quality"]: r["share"] for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.75


def test_odd_rows(spark, odd, nothing, wide):
    ids = spark.createDataFrame([(1,), (2,), (9,), (None,), (12345,)], "doc_id long")
    for table in (odd, wide):
        got = pp.classify(table, ids).collect()
        assert len(got) == odd.count()
        by_id = {r["doc_id"]: r for r in got}
        assert by_id[3]["perplexity"] is None and not by_id[3]["kept"] and not by_id[4]["kept"]
        assert by_id[1]["kept"] and by_id[None]["perplexity"] > 0
    assert pp.classify(nothing, ids).count() == 0
    unjudged = {r["doc_id"]: r["kept"] for r in pp.classify(odd, ids.limit(0)).collect()}
    assert unjudged[1] and not unjudged[4]


def test_quantiles_of_groups(spark):
    rng = np.random.default_rng(4)
    rows = [(rng.choice(["a", "b", None]), float(rng.choice([1.0, 2.0, rng.random() * 9]))) for _ in range(500)] + [("hot", float(i % 97)) for i in range(400)] + [("one", 3.5), ("none", None)]
    rows = [(None if g is None else str(g), v) for g, v in rows]
    table = spark.createDataFrame(rows, "lang string, perplexity double").repartition(7)
    from ratingloom.llm.quantiles import group_quantiles

    for q in (0.0, 0.25, 0.995, 1.0):
        got = {r["lang"]: r["limit"] for r in group_quantiles(table, "lang", "perplexity", q).collect()}
        groups = {}
        for g, v in rows:
            if v is not None:
                groups.setdefault(g, []).append(v)
        assert got == pytest.approx({g: float(np.quantile(v, q)) for g, v in groups.items()})
    assert group_quantiles(table.limit(0), "lang", "perplexity", 0.5).collect() == []


def test_limits_and_verdicts_like_brute_force(spark, documents):
    """The whole verdict, from the slow model, numpy's quantiles and the rule."""
    rows = [(r["doc_id"], r["lang"], (r["text"] or "")[:300]) for r in documents.limit(60).collect()] + [(900, "zz", "völlig 😀 anders"), (901, "en", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    trusted = [i for i, _, _ in rows[:30]]
    model = slow_model([t for i, _, t in rows if i in trusted])
    worth = {}
    for i, _, text in rows:
        if text:
            logs = [math.log(model(("\0\0" + text)[j : j + 3])) for j in range(len(text))]
            worth[i] = math.exp(-sum(logs) / len(logs))
    known = {}
    for i, lang, _ in rows:
        if i in trusted and i in worth:
            known.setdefault(lang, []).append(worth[i])
    every = [v for values in known.values() for v in values]
    for r in pp.classify(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), quantile=0.9).collect():
        limit = 1.1 * float(np.quantile(known.get(r["lang"], every), 0.9))
        assert r["threshold"] == pytest.approx(limit, rel=1e-5)
        if r["doc_id"] not in worth:
            assert r["perplexity"] is None and not r["kept"]
        elif abs(worth[r["doc_id"]] / limit - 1) > 1e-4:
            assert r["kept"] == (worth[r["doc_id"]] <= limit)


def test_every_trusted_document_trains_the_model(spark, monkeypatch):
    """More of them than any number that a sample would have kept."""
    seen = []
    whole = pp.document_perplexity
    monkeypatch.setattr(pp, "document_perplexity", lambda docs, trusted: seen.append(trusted.select("doc_id").distinct().count()) or whole(docs, trusted))
    docs = spark.range(45_000).selectExpr("id AS doc_id", "'en' AS lang", "concat('text ', id) AS text")
    judged = pp.classify(docs, docs.where("doc_id % 3 > 0").select("doc_id"))
    assert judged.count() == 45_000
    assert seen == [30_000]


@pytest.mark.parametrize("copied", [0, 4_096])
def test_documents_are_picked_by_id_however_the_ids_lie(spark, monkeypatch, copied):
    monkeypatch.setattr(pp, "COPIED_BITMAPS", copied)
    held = [*range(-70_000, 70_000, 13), 2**62, -(2**62) + 1, 32_767, 32_768, 32_769]
    docs = spark.range(-70_010, 70_010).selectExpr("id AS doc_id", "'t' AS text").union(spark.createDataFrame([(2**62, "t"), (2**62 + 1, "t"), (-(2**62) + 1, "t")], "doc_id long, text string"))
    ids = spark.createDataFrame([(i,) for i in set(held)], "doc_id long")
    assert sorted(r.doc_id for r in pp._among(docs, ids).select("doc_id").collect()) == sorted(set(held))
