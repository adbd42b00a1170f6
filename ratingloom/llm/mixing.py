"""Mixing sources to target weights by temperature.

Each source's token share is raised to an exponent between 0 (all equal) and 1
(as they are) and normalised.  Bisection finds the exponent that meets a target:
an entropy of the weights, or a limit on how often a source is repeated.  The
weights are then realised with a token budget: every source is dealt in the
order of a random permutation, whole epochs first, then as much of one more as
its share of the budget leaves; and the copies are cut into blocks of a token
budget, each of which holds every source in proportion and is permuted itself.

Only DataFrame functions run.  A source may hold any share of the rows: running
sums go over hash ranges of a source, never over a whole source at once.  One
row per source is looked at in one task; nothing else is.

Tokens are words and one end mark per document, so every document has some.

Nulls and odd input: a null source is a source of its own, a null or empty text
has its end mark only.  Rows equal in doc_id, source and length are dealt
together, as often as each other.  A null doc_id is an id like any other.  An
empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.scratch import materialize

#: Hash ranges within a source, and the numbers a permutation draws from (its leading part is the range).
RANGES, DRAWS = 1024, 1 << 40
#: Halvings of the exponent's interval.
HALVINGS = 50
#: Tokens in a block of the mixture.
BLOCK_TOKENS = 1_000_000

_KEY = ["doc_id", "source", "n_tokens"]


def token_count(text: Column) -> Column:
    """Words of a text (runs of anything but space and \\x09-\\x0D) and the end mark."""
    return (F.coalesce(F.regexp_count(text, F.lit(r"[^ \x09-\x0D]+")), F.lit(0)) + 1).cast("long")


def units(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens and how many equal rows there are of each."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), token_count(F.col("text")).alias("n_tokens"))
    return rows.groupBy(_KEY).agg(F.count("*").alias("twins"))


def solve_exponent(sources: DataFrame, entropy: float | None = None, repetition: float | None = None) -> float:
    """Exponent for ``sources`` (tokens), one row per source.

    ``entropy``: target of the weights in nats; ``repetition``: most epochs of
    any source while every source is used at least once.  Give one of them.  The
    largest exponent that meets it is taken; if none does, 0, the flattest.
    """
    if (entropy is None) == (repetition is None):
        raise ValueError("give either entropy or repetition")
    sizes = sources.agg(F.sort_array(F.collect_list("tokens")).alias("sizes"), F.sum("tokens").cast("double").alias("total"))
    shares = sizes.where(F.size("sizes") > 0).select(F.transform("sizes", lambda n: n / F.col("total")).alias("shares"))

    def too_high(exponent: Column) -> Column:
        if repetition is not None:
            # Epochs go with share ** (exponent - 1), so more exponent means less repetition.
            return F.pow(F.element_at("shares", -1) / F.element_at("shares", 1), 1 - exponent) < repetition
        powers = F.transform("shares", lambda s: F.pow(s, exponent))
        total = F.aggregate(powers, F.lit(0.0), lambda a, p: a + p)
        return F.aggregate(powers, F.lit(0.0), lambda a, p: a - p / total * F.log(p / total)) < entropy

    def halve(ends: Column) -> Column:
        middle = (ends["low"] + ends["high"]) / 2
        upper = too_high(middle)
        return F.struct(F.when(upper, ends["low"]).otherwise(middle).alias("low"), F.when(upper, middle).otherwise(ends["high"]).alias("high"))

    start = F.struct(F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    ends = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, lambda ends, _: halve(ends))
    # Entropy falls as the exponent rises; for repetition the smallest that keeps the limit is wanted.
    answer = F.when(too_high(F.lit(0.0)), F.lit(0.0)).when(~too_high(F.lit(1.0)), F.lit(1.0))
    found = shares.select(answer.otherwise(ends["high"] if repetition is not None else ends["low"]).alias("exponent")).first()
    return found["exponent"] if found else 1.0


def deal(light: DataFrame, entropy: float | None, repetition: float | None, budget: int | None, block_tokens: int) -> DataFrame:
    """Each unit with its source's plan (source_tokens, dealt, blocks), ``at`` (tokens of
    its source before it) and ``copies``, which may be 0."""
    drawn = light.withColumn("draw", F.pmod(F.xxhash64(F.lit("mix"), *_KEY), F.lit(DRAWS)))
    drawn = materialize(drawn.withColumn("range", F.floor(F.col("draw") / (DRAWS // RANGES)).cast("int")), "mix-rows")
    tokens = F.col("n_tokens") * F.col("twins")
    ranges = drawn.groupBy("source", "range").agg(F.sum(tokens).alias("tokens"))
    running = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialize(ranges.withColumn("before", F.coalesce(F.sum("tokens").over(running), F.lit(0))), "mix-ranges")

    sources = ranges.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    exponent = solve_exponent(sources, entropy, repetition)
    power = F.pow(F.col("tokens").cast("double"), F.lit(exponent - 1.0))  # a source's epochs, up to one factor
    least, spread = sources.agg(F.min(power), F.sum(power * F.col("tokens"))).first()
    factor = (1.0 / least if budget is None else budget / spread) if least else 0.0
    whole_budget = factor * (spread or 0.0)
    blocks = max(1, -(-int(whole_budget) // block_tokens))
    plan = sources.withColumn("dealt", F.round(power * F.col("tokens") * factor).cast("long"))
    plan = plan.withColumn("epochs", F.floor(F.col("dealt") / F.col("tokens")).cast("int")).withColumn("blocks", F.lit(blocks))
    plan = materialize(plan.withColumnRenamed("tokens", "source_tokens").withColumnRenamed("source", "_source"), "mix-plan")

    starts = ranges.select(F.col("source").alias("_from"), F.col("range").alias("_range"), "before")
    placed = drawn.join(starts, F.col("source").eqNullSafe(F.col("_from")) & (F.col("range") == F.col("_range")))
    inside = Window.partitionBy("source", "range").orderBy("draw", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("at", F.col("before") + F.coalesce(F.sum(tokens).over(inside), F.lit(0)))
    placed = placed.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    rest = F.col("dealt") - F.col("epochs") * F.col("source_tokens")
    placed = placed.withColumn("copies", F.col("epochs") + F.when(F.col("at") < rest, 1).otherwise(0))
    return placed.select(*_KEY, "twins", "copies", "at", "source_tokens", "dealt", "blocks")


def mixture(docs: DataFrame, entropy: float | None = None, repetition: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mixture: doc_id, source, n_tokens, epoch, block, slot.

    Without ``budget`` it is the least in which every source is used whole once.
    A document appears once per epoch in which it is dealt (from 0).  Slots run
    from 0 in each block without gaps; reading blocks and slots in order gives
    the weights at every stretch of a block or more.
    """
    dealt = deal(units(docs), entropy, repetition, budget, block_tokens).where("copies > 0")
    dealt = dealt.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    dealt = dealt.withColumn("twin", F.explode(F.sequence(F.lit(1).cast("long"), F.col("twins"))))
    # A copy's place within its source's share of the mixture decides the block.
    place = (F.col("epoch") * F.col("source_tokens") + F.col("at")) / F.col("dealt")
    dealt = dealt.withColumn("block", F.least(F.floor(place * F.col("blocks")), F.col("blocks") - 1).cast("long"))
    # A document is at least one token, so a block's rows are bounded by its tokens.
    turn = F.xxhash64(F.lit("turn"), *_KEY, "epoch", "twin")
    order = Window.partitionBy("block").orderBy(turn, *_KEY, "epoch", "twin")
    return dealt.select(*_KEY, "epoch", "block", (F.row_number().over(order) - 1).alias("slot"))


def repeated(docs: DataFrame, entropy: float | None = None, repetition: float | None = None, budget: int | None = None) -> DataFrame:
    """``docs`` with each row as often as the mixture holds it (not at all, if it does not)."""
    planned = deal(units(docs), entropy, repetition, budget, BLOCK_TOKENS).where("copies > 0")
    planned = planned.select(*[F.col(c).alias(f"_{c}") for c in _KEY], "copies")
    # The row travels whole, so that no column of it can meet one of the plan.
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.col("source").cast("string").alias("source"), token_count(F.col("text")).alias("n_tokens"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _KEY])
    copied = keyed.join(planned, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copied.select("row.*")
