"""Perplexity under an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted text.  Its counts are tables with one row per
n-gram: lower orders count the distinct predecessors of the order above, each
order has three discounts from its counts of counts, and contexts carry the mass
left to the order below.  Distinct n-grams of the corpus are joined to those
tables once, each join sharded by an n-gram or context; their probabilities are
then joined to the documents' own counts, packed per n-gram, and summed.  That
last join copies the table of probabilities while it is small, and is a shuffle
of the packed counts beyond that; the sums are the same.

A document is rejected if its perplexity is above a quantile of the trusted
documents of its language, times a margin; a language without trusted text takes
the quantile over all of them.

Nulls and odd input: null and empty texts have no perplexity and are not kept.
A null language is a language of its own.  Rows that share a doc_id are judged
by all their texts together, and so are all rows without one (as -2**62, which is
therefore no id to use).  Where the trusted text has no n-grams of some order that
occur one, two, three or four times, that order's discounts are 0.5, 0.75 and 0.9.  Without any trusted text nothing can be judged and
every text is kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.batches import list_column, pieces
from ratingloom.llm.quantiles import group_quantiles
from ratingloom.scratch import materialize

#: Share of the trusted documents that a threshold lets pass, and what it is multiplied by.
QUANTILE, MARGIN = 0.995, 1.1

#: Most n-grams whose probabilities (two numbers each) are copied to every executor
#: instead of meeting the documents' counts in a shuffle.
COPIED_GRAMS = 1_000_000

#: Most bitmaps (of 32,768 neighbouring ids, 4 KB each) that are copied to every executor to pick the trusted documents.
COPIED_BITMAPS = 4_096

# An n-gram of three characters is one number of 63 bits; 0 stands before a text.
_BITS = 21
_MASK = (1 << _BITS) - 1


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character n-grams of each text, packed, and how many each has: one per character."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    one = np.concatenate([[0], codes[:-1]]) if len(codes) else codes
    one[starts] = 0
    two = np.concatenate([[0], one[:-1]]) if len(codes) else codes
    two[starts] = 0
    return (two << 2 * _BITS) | (one << _BITS) | codes, sizes


def ngram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all texts; each piece of a partition sends its sums."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            grams, _ = trigrams([t or "" for t in batch.column("text").to_pylist()])
            codes, distinct = pd.factorize(grams)
            yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(np.bincount(codes, minlength=len(distinct)))], ["gram", "n"])

    return texts.select("text").mapInArrow(compute, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def document_counts(docs: DataFrame) -> DataFrame:
    """(gram, base, postings): every document's count of every n-gram.

    Documents whose ids differ in the last 16 bits only share a row per n-gram;
    a posting holds those bits and a count of at most 65535, larger counts take
    several postings.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            grams, sizes = trigrams([t or "" for t in batch.column("text").to_pylist()])
            codes, distinct = pd.factorize(grams)
            row = np.repeat(np.arange(len(ids)), sizes)
            cells, counts = np.unique(codes * len(ids) + row, return_counts=True)
            gram, row = cells // max(1, len(ids)), cells % max(1, len(ids))
            parts = -(-counts // 0xFFFF)
            if len(parts) and parts.max() > 1:
                gram, row = np.repeat(gram, parts), np.repeat(row, parts)
                counts = np.where(np.append(gram[1:] * len(ids) + row[1:] != gram[:-1] * len(ids) + row[:-1], True), np.repeat(counts - (parts - 1) * 0xFFFF, parts), 0xFFFF)
            base, low = ids[row] >> 16, ids[row] & 0xFFFF
            order = np.lexsort((low, base, gram))
            gram, base = gram[order], base[order]
            packed = ((low[order] << 16) | counts[order]).astype(np.uint32).view(np.int32)
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (base[1:] != base[:-1])
            begins = np.flatnonzero(new)
            lengths = np.diff(np.append(begins, len(gram)))
            yield pa.RecordBatch.from_arrays([pa.array(distinct[gram[begins]]), pa.array(base[begins]), list_column(packed, lengths)], ["gram", "base", "postings"])

    return docs.select("doc_id", "text").mapInArrow(compute, "gram long, base long, postings array<int>")


def _discounts(table: DataFrame) -> list[float]:
    """Discounts for counts of one, two and more, from how many n-grams have which count."""
    n1, n2, n3, n4 = table.agg(*[F.count(F.when(F.col("n") == k, 1)) for k in (1, 2, 3, 4)]).first()
    if not (n1 and n2 and n3 and n4):
        return [0.5, 0.75, 0.9]  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    return [min(max(x, 0.05), k - 0.05) for k, x in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


def _discounted(discounts: list[float]) -> Column:
    return F.col("n") - F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])


def _contexts(table: DataFrame, context: Column, discounts: list[float]) -> DataFrame:
    """(context, total, left): a context's count, and the mass its discounts free."""
    freed = reduce_sum([d * F.count(F.when(which, 1)) for d, which in zip(discounts, (F.col("n") == 1, F.col("n") == 2, F.col("n") > 2))])
    return table.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), freed.alias("freed")).select("context", "total", (F.col("freed") / F.col("total")).alias("left"))


def reduce_sum(columns: list[Column]) -> Column:
    total = columns[0]
    for column in columns[1:]:
        total = total + column
    return total


def log_probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, logp) for distinct ``grams``, by the model whose (gram, n) are ``counts``."""
    two, one = F.lit((1 << 2 * _BITS) - 1), F.lit(_MASK)
    trained = materialize(counts, "kn-3")
    bigrams = materialize(trained.groupBy(F.col("gram").bitwiseAND(two).alias("gram")).agg(F.count("*").alias("n")), "kn-2")
    unigrams = materialize(bigrams.groupBy(F.col("gram").bitwiseAND(one).alias("gram")).agg(F.count("*").alias("n")), "kn-1")
    d3, d2, d1 = (_discounts(t) for t in (trained, bigrams, unigrams))

    total, kinds = unigrams.agg(F.sum("n"), F.count("*")).first()
    total, kinds = total or 1, kinds or 0
    freed = unigrams.agg(*[F.count(F.when(c, 1)) for c in (F.col("n") == 1, F.col("n") == 2, F.col("n") > 2)]).first()
    # The rest of the lowest order is spread evenly over the known characters and one unknown.
    rest = (sum(d * k for d, k in zip(d1, freed)) / total if kinds else 1.0) / (kinds + 1)

    def seen(table: DataFrame, discounts: list[float], name: str) -> DataFrame:
        return table.select(F.col("gram").alias(f"gram{name}"), _discounted(discounts).alias(f"seen{name}"))

    def context(table: DataFrame, discounts: list[float], name: str) -> DataFrame:
        found = _contexts(table, F.shiftright("gram", _BITS), discounts)
        return found.select(F.col("context").alias(f"context{name}"), F.col("total").alias(f"total{name}"), F.col("left").alias(f"left{name}"))

    keyed = grams.select(
        F.col("gram").alias("gram3"), F.col("gram").bitwiseAND(two).alias("gram2"), F.col("gram").bitwiseAND(one).alias("gram1"), F.shiftright("gram", _BITS).alias("context3"), F.shiftright(F.col("gram").bitwiseAND(two), _BITS).alias("context2")
    )
    joined = keyed.join(seen(trained, d3, "3"), "gram3", "left").join(context(trained, d3, "3"), "context3", "left")
    joined = joined.join(seen(bigrams, d2, "2"), "gram2", "left").join(context(bigrams, d2, "2"), "context2", "left").join(seen(unigrams, d1, "1"), "gram1", "left")
    p = F.coalesce(F.col("seen1") / total, F.lit(0.0)) + rest
    for k in ("2", "3"):
        p = F.when(F.col(f"total{k}").isNull(), p).otherwise(F.coalesce(F.col(f"seen{k}") / F.col(f"total{k}"), F.lit(0.0)) + F.col(f"left{k}") * p)
    return joined.select(F.col("gram3").alias("gram"), F.log(p).alias("logp"))


def document_perplexity(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, perplexity) of every id with text, by a model of ``trusted`` (text)."""
    distinct = ngram_counts(docs).select("gram")
    logs = materialize(log_probabilities(distinct, ngram_counts(trusted)), "gram-probabilities")
    logs = F.broadcast(logs) if logs.count() <= COPIED_GRAMS else logs.hint("merge")
    rows = document_counts(docs).join(logs, "gram").select("base", "logp", F.explode("postings").alias("posting"))
    doc_id = F.col("base") * 65536 + F.shiftrightunsigned("posting", 16)
    count = F.col("posting").bitwiseAND(F.lit(0xFFFF))
    sums = rows.groupBy(doc_id.alias("doc_id")).agg(F.sum(count * F.col("logp")).alias("logp"), F.sum(count).alias("n"))
    return sums.select("doc_id", F.round(F.exp(-F.col("logp") / F.col("n")), 6).alias("perplexity"))


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is among ``ids`` (distinct doc_id).

    The ids are copied as bitmaps, so that no text is moved: a bit for every id between
    where ids are close.  Ids so scattered that too many bitmaps would be nearly empty are joined.
    """
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("doc_id")).alias("_bits")
    maps = materialize(ids.groupBy(F.bitmap_bucket_number("doc_id").alias("_bucket")).agg(bits), "trusted-bits")
    if maps.count() > COPIED_BITMAPS:
        return docs.join(ids, "doc_id", "left_semi")
    at = F.bitmap_bit_position("doc_id")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = docs.withColumn("_bucket", F.bitmap_bucket_number("doc_id")).join(F.broadcast(maps), "_bucket")
    return held.where(byte.bitwiseAND(F.power(F.lit(2), at % 8).cast("int")) != 0).select(*docs.columns)


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept for every row of ``docs``.

    ``trusted_ids`` (doc_id) names the trusted documents; all of them train the
    model and set the thresholds.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))).alias("doc_id"), "lang", "text", F.col("doc_id").isNull().alias("no_id"))
    trusted = materialize(trusted_ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "trusted")
    fit = _among(docs, trusted)
    scored = materialize(document_perplexity(docs, fit), "perplexities")

    judged = materialize(docs.select("doc_id", "lang", "no_id").join(scored, "doc_id", "left"), "judged")
    known = judged.join(trusted, "doc_id", "left_semi").where("perplexity IS NOT NULL")
    limits = group_quantiles(known, "lang", "perplexity", quantile)
    whole = group_quantiles(known.withColumn("every", F.lit(0)), "every", "perplexity", quantile).first()
    overall = None if whole is None else whole["limit"]
    limits = limits.select(F.col("lang").alias("_lang"), "limit")
    out = judged.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    threshold = F.coalesce("limit", F.lit(overall).cast("double")) * margin
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return out.select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "lang", "perplexity", threshold.alias("threshold"), kept.alias("kept"))
