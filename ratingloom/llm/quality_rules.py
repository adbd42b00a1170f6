"""Robust multivariate outliers among text statistics.

Each text has a vector of transformed statistics.  For every language and source
a minimum covariance determinant estimate is fitted: from two starts (medians
with quartile ranges, and plain mean and covariance) concentration steps keep
the three quarters of the vectors that are nearest by Mahalanobis distance and
estimate anew, until nothing changes; the start with the smaller determinant
wins.  Vectors far from their group's centre are rejected.

A step is one pass with one small aggregation: distances fall into fine bins,
each bin carries its count, sums and products, and running sums over a group's
bins give the nearest vectors' mean and covariance.  Statistics are whole
numbers of thousandths, so sums are exact in any order.  Only DataFrame functions
run, and a group may hold any share of the rows.

Nulls and odd input: a null text has no words and fails the base rule.  A null
language or source is a value like others.  A group of one document is its own
centre and is kept.  Rows are judged one by one, so repeated rows get equal
answers.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ratingloom.scratch import materialize

#: Least words of a text, and most hundredths of its words within repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Words in a window.
WINDOW = 5
#: Share of a group's vectors that the estimate rests on.
KEPT_SHARE = 0.75
#: Concentration steps at most; they end earlier when nothing changes.
STEPS = 12
# Fixed values for five statistics and three quarters: the factor that makes the
# covariance of the nearest three quarters of a normal sample consistent, and the
# chi-squared quantile at 1 - 1e-5 beyond which a vector is rejected.
CONSISTENCY, CUTOFF = 1.413, 30.86
#: Per statistic, the least standard deviation that a group is taken to have.
STATISTICS = {"word_length": 0.12, "symbols": 0.4, "capitals": 0.35, "digits": 0.7, "repeats": 0.9}

_UNIT = 1000  # vectors are held in thousandths
_SPACES = " \t\n\x0b\f\r"


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts, base_failed, and the vector's columns.

    The result is a stored table: a filter on it must not sink below the steps
    that compute a column once, where it would repeat them per word.
    """
    return materialize(_statistics(docs), "text-statistics")


def _statistics(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"))
    # A column that later ones use more than once is computed once.
    rows = rows.withColumn("words", F.array_remove(F.split("text", r"[ \x09-\x0D]+"), "")).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda line: F.translate(line, _SPACES, "") != "")
    )
    size = F.length("text")
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", _SPACES, "")).cast("long").alias("word_chars"),
        (size - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("n_capitals"),
        (size - F.length(F.translate("text", "0123456789", ""))).alias("n_digits"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size("words") - WINDOW), lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])),
        ).alias("windows"),
    )
    # Texts without a repeated window skip the sorting.
    pairs = F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    rows = rows.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(pairs)))
    beside = F.zip_with(F.slice("sorted", 2, F.size("sorted")), "sorted", lambda b, a: b.isNotNull() & (b["x"] == a["x"]))
    rows = rows.withColumn("same", beside)  # i: whether entry i + 1 equals entry i
    starts = F.filter(F.transform("sorted", lambda s, i: F.when(F.coalesce(F.get("same", i), F.lit(False)) | F.coalesce(F.get("same", i - 1), F.lit(False)), s["i"])), lambda i: i.isNotNull())
    rows = rows.withColumn("starts", F.sort_array(starts))
    steps = F.zip_with(F.slice("starts", 2, F.size("starts")), "starts", lambda b, a: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda total, step: total + F.coalesce(step, F.lit(WINDOW)))
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))

    def percent(count: str, of: str) -> Column:
        return F.log1p(100.0 * F.col(count) / F.greatest(F.col(of), F.lit(1)))

    vector = {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "symbols": percent("n_symbols", "word_chars"),
        "capitals": percent("n_capitals", "word_chars"),
        "digits": percent("n_digits", "word_chars"),
        "repeats": F.log1p(100.0 * F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)) + 100.0 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
    }
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", "lang", "source", *counts, failed.alias("base_failed"), *[F.round(x * _UNIT).cast("long").alias(f"x_{n}") for n, x in vector.items()])


_X = [f"x_{name}" for name in STATISTICS]
_P = len(_X)
_GROUP = ["lang", "source"]
_CELLS = [(i, j) for i in range(_P) for j in range(i + 1)]


def _by_group(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys in which null equals null."""
    named = table.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(named, same).drop(*[f"_{k}" for k in keys])


def _whitening(estimates: DataFrame) -> DataFrame:
    """From m_i and c_ij: the inverse w_ij of the covariance's Cholesky factor, and log_det."""
    keys = [*_GROUP, "start", *[f"m{i}" for i in range(_P)]]

    def dot(pairs: list[tuple[str, str]]) -> Column:
        return reduce(lambda a, b: a + b, [F.col(x) * F.col(y) for x, y in pairs], F.lit(0.0))

    # Column by column, then diagonal by diagonal: what belongs together is one projection.
    for j in range(_P):
        rest = {i: F.col(f"c{i}{j}") - dot([(f"l{i}{k}", f"l{j}{k}") for k in range(j)]) for i in range(j, _P)}
        estimates = estimates.withColumn(f"l{j}{j}", F.sqrt(rest[j]))
        estimates = estimates.withColumns({f"l{i}{j}": rest[i] / F.col(f"l{j}{j}") for i in range(j + 1, _P)})
    estimates = estimates.withColumns({f"w{i}{i}": 1.0 / F.col(f"l{i}{i}") for i in range(_P)})
    for d in range(1, _P):
        below = {}
        for j in range(_P - d):
            i = j + d
            below[f"w{i}{j}"] = -dot([(f"l{i}{k}", f"w{k}{j}") for k in range(j, i)]) / F.col(f"l{i}{i}")
        estimates = estimates.withColumns(below)
    log_det = reduce(lambda a, b: a + b, [F.log(f"l{i}{i}") for i in range(_P)])
    return estimates.select(*keys, *[f"w{i}{j}" for i, j in _CELLS], F.round(log_det, 6).alias("log_det"))


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined to its whitening."""
    centred = [F.col(x) / _UNIT - F.col(f"m{i}") for i, x in enumerate(_X)]
    parts = [reduce(lambda a, b: a + b, [F.col(f"w{i}{j}") * centred[j] for j in range(i + 1)]) for i in range(_P)]
    return reduce(lambda a, b: a + b, [part * part for part in parts])


def _estimates(sums: DataFrame) -> DataFrame:
    """Mean and covariance, with the consistency factor and the least deviations, from exact sums."""
    mean = [F.col(f"s{i}") / F.col("n") / _UNIT for i in range(_P)]
    floors = list(STATISTICS.values())
    cells = []
    for i, j in _CELLS:
        covariance = F.col(f"s{i}{j}") / F.col("n") / (_UNIT * _UNIT) - mean[i] * mean[j]
        cells.append((covariance * CONSISTENCY + F.lit(floors[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}"))
    return sums.select(*_GROUP, "start", *[m.alias(f"m{i}") for i, m in enumerate(mean)], *cells)


def _sum_columns() -> list[Column]:
    singles = [F.sum(x).alias(f"s{i}") for i, x in enumerate(_X)]
    return [F.count("*").alias("n"), *singles, *[F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"s{i}{j}") for i, j in _CELLS]]


def _median_start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each statistic, as a diagonal estimate."""
    values = rows.select(*_GROUP, F.explode(F.array([F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(_X)])).alias("v"))
    counted = values.groupBy(*_GROUP, "v.i", "v.x").agg(F.count("*").alias("cnt"))
    each = Window.partitionBy(*_GROUP, "i")
    counted = counted.withColumn("upto", F.sum("cnt").over(each.orderBy("x"))).withColumn("all", F.sum("cnt").over(each))
    quarter = [F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("x"))) / _UNIT for q in (0.25, 0.5, 0.75)]
    spread = counted.groupBy(*_GROUP, "i").agg(quarter[1].alias("m"), ((quarter[2] - quarter[0]) / 1.349).alias("d"))
    floors = list(STATISTICS.values())

    def of(i: int, column: str) -> Column:
        return F.max(F.when(F.col("i") == i, F.col(column)))

    wide = spread.groupBy(*_GROUP).agg(*[of(i, "m").alias(f"m{i}") for i in range(_P)], *[of(i, "d").alias(f"d{i}") for i in range(_P)])
    cells = [(F.col(f"d{i}") * F.col(f"d{i}") + floors[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _CELLS]
    return wide.select(*_GROUP, F.lit("medians").alias("start"), *[f"m{i}" for i in range(_P)], *cells)


def fit_groups(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Whitening of each language and source, from rows of statistics."""
    plain = rows.groupBy(*_GROUP).agg(*_sum_columns()).withColumn("start", F.lit("plain"))
    model = materialize(_whitening(_estimates(plain).unionByName(_median_start(rows))), "mcd-start")
    before = None
    bins = Window.partitionBy(*_GROUP, "start")
    nearest = bins.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(steps):
        # About one per cent of distance per bin.
        near = _by_group(rows, model, _GROUP).withColumn("bin", F.floor(F.log1p(_distance()) * 100).cast("int"))
        cells = near.groupBy(*_GROUP, "start", "bin").agg(*_sum_columns())
        sums = [c for c in cells.columns if c not in (*_GROUP, "start", "bin")]
        running = cells.select(*_GROUP, "start", "bin", *[F.sum(c).over(nearest).alias(c) for c in sums], F.sum("n").over(bins).alias("all"))
        enough = running.where(F.col("n") >= F.ceil(F.col("all") * KEPT_SHARE))
        first = enough.withColumn("rank", F.row_number().over(bins.orderBy("bin"))).where("rank = 1")
        seen = Observation()
        kept = first.observe(seen, F.sum(F.xxhash64(*_GROUP, "start", *sums).cast("decimal(38,0)")).alias("digest"))
        model = materialize(_whitening(_estimates(kept)), "mcd-step")
        if seen.get.get("digest") == before:
            break
        before = seen.get.get("digest")
    best = Window.partitionBy(*_GROUP).orderBy("log_det", "start")
    return model.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank", "start", "log_det")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and, where the base rule was passed, distance (squared)."""
    rows = base_statistics(docs)
    passed = rows.where("NOT base_failed")
    model = materialize(fit_groups(passed), "mcd-model")
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _by_group(passed, model, _GROUP).withColumn("distance", _distance())
    judged = judged.select(*shown, (F.col("distance") <= CUTOFF).alias("kept"), "distance")
    failed = rows.where("base_failed").select(*shown, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return judged.union(failed)
