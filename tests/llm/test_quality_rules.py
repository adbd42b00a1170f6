import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ratingloom.llm import quality_rules as q

WORD = re.compile(r"[^ \t-\r]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts(documents, odd):
    for table in (documents, odd):
        texts = [r["text"] for r in table.collect()]
        got = sorted(tuple(r)[:5] for r in q.base_statistics(table).select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
        assert got == sorted(map(base, texts))


def slow_mcd(x):
    """The same estimate with numpy: both starts, bins of distance, concentration."""
    floors = np.array(list(q.STATISTICS.values())) ** 2
    x = np.asarray(x, float) / 1000
    n = len(x)

    def cov(part):
        return np.cov(part.T, bias=True).reshape(5, 5) * q.CONSISTENCY + np.diag(floors)

    def quartile(share):
        ordered = np.sort(x, axis=0)
        return ordered[int(np.ceil(n * share)) - 1]

    spread = (quartile(0.75) - quartile(0.25)) / 1.349
    best = None
    for name, centre, matrix in (("medians", quartile(0.5), np.diag(spread**2 + floors)), ("plain", x.mean(axis=0), cov(x))):
        kept = None
        for _ in range(q.STEPS):
            d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(matrix), x - centre)
            bins = np.floor(np.log1p(d) * 100)
            limit = np.sort(bins)[int(np.ceil(n * q.KEPT_SHARE)) - 1]
            now = bins <= limit
            centre, matrix = x[now].mean(axis=0), cov(x[now])
            if kept is not None and (now == kept).all():
                break
            kept = now
        det = round(np.linalg.slogdet(matrix)[1] / 2, 6)
        if best is None or det < best[0]:
            best = (det, centre, matrix)
    _, centre, matrix = best
    return np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(matrix), x - centre)


def test_distances_like_numpy(documents):
    docs = documents.withColumn("source", F.when(F.col("doc_id") % 4 == 0, "s1"))
    rows = q.base_statistics(docs).where("NOT base_failed").toPandas()
    judged = q.judge(docs).toPandas().set_index("doc_id")
    for _, part in rows.groupby(["lang", "source"], dropna=False):
        want = slow_mcd(part[[f"x_{n}" for n in q.STATISTICS]].to_numpy())
        got = judged.loc[part["doc_id"], "distance"].to_numpy()
        assert np.allclose(got, want, rtol=1e-6, atol=1e-9)
        assert (judged.loc[part["doc_id"], "kept"].to_numpy() == (want <= q.CUTOFF)).all()


def test_outliers_go_and_clean_text_stays(spark):
    rng = np.random.default_rng(0)
    letters = np.array(list("abcdefghijklmnop"))
    clean = [" ".join("".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(80)) for _ in range(120)]
    junk = [text.replace(" ", "### ") for text in clean[:10]] + [text.upper() for text in clean[10:20]]
    values = [(i, t, "en", "s") for i, t in enumerate(clean + junk)]
    got = {r["doc_id"]: r["kept"] for r in q.judge(spark.createDataFrame(values, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(120)) and not any(got[i] for i in range(120, 140))


def test_odd_rows(nothing, wide):
    got = q.judge(wide).collect()
    assert len(got) == wide.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["kept"] and by_id[3]["base_failed"] and not by_id[4]["kept"]
    assert q.judge(nothing).count() == 0


def test_no_python_runs(documents):
    rows = q.base_statistics(documents)
    plan = q._statistics(documents)._jdf.queryExecution().toString() + q.fit_groups(rows.limit(20), steps=1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
