"""Largest inner products by multi-index hashing.

1. Codes.  Subtracting a fixed mean from all candidates changes a query's products
   by one constant, and adding a component that gives all candidates of a shard the
   same length turns the order of products into that of angles.  Such a vector's
   code is the signs of learned rotations: principal directions of a bounded
   sample, turned until the signs lose least (iterative quantisation), several
   times from different starts.  A query's added component is zero.
2. Index.  Candidates of one length and one octave of norms are dealt by hash into
   shards of bounded size.  A shard cuts its codes into substrings and has, for
   each, the rows of every value.
3. Probing.  By the pigeonhole principle a code within a radius of ``m (k + 1) - 1``
   equals the query's in some of the ``m`` substrings but for ``k`` bits.  ``k`` grows,
   and the values at that distance are looked up, until the radius holds enough
   codes: by enumerating the masks while they are few, then by going through the
   values that occur.  Every code within the radius is found, whatever its number.
4. Reranking.  What was found is compared in double precision, the best of a shard
   leave it, and one ranking merges the shards.

Queries are packed in blocks, and only packed blocks and shards are copied to the
cells where they meet; no pair but a cell's best becomes a row.

Nulls and odd input: a vector that is null, empty, zero or holds a null, NaN or
infinite component takes no part, nor does a row without an id, which no result
could name.  Vectors meet only those with as many components.  Rows that are equal
in id and vector count once; rows of one id with different vectors are queries and
candidates of their own, but never find their own id.  Equal scores go by id.
Other columns play no part.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm.batches import ranges
from ratingloom.scratch import materialize

#: Rows that the rotations are learned from, rounds of learning, seed of the starts.
FIT_ROWS, FIT_ROUNDS, SEED = 8_192, 25, 13
#: Bits of a code and of a substring.
BITS, SUBSTRING = 256, 16
#: A radius must hold this many codes of a shard, or all of them, before reranking.
ENOUGH = 500
#: Bits up to which masks are enumerated; beyond, the values that occur are fewer.
ENUMERATED = 2
#: Numbers in a shard's vectors and in a query block's, and pairs held at once.
SHARD_VALUES, BLOCK_VALUES, PAIRS = 1 << 21, 1 << 19, 1 << 20

_PARTS = BITS // SUBSTRING
_ONES = np.bitwise_count(np.arange(1 << SUBSTRING, dtype=np.uint32)).astype(np.uint8)
_MASKS = [np.flatnonzero(_ONES == k).astype(np.uint16) for k in range(ENUMERATED + 1)]


def _same_length(centred: np.ndarray) -> np.ndarray:
    """Rows with the component that makes them as long as the longest, over that length."""
    squares = (centred * centred).sum(axis=1)
    top = squares.max(initial=0.0)
    added = np.sqrt(np.maximum(top - squares, 0.0))
    return np.column_stack([centred, added]) / np.sqrt(top if top > 0 else 1.0)


def learned(sample: np.ndarray, octaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotations (components + 1 by ``BITS``) from sample rows and their octaves."""
    mean = sample.mean(axis=0)
    rows = np.empty((len(sample), sample.shape[1] + 1))
    for octave in np.unique(octaves):
        rows[octaves == octave] = _same_length(sample[octaves == octave] - mean)
    _, directions = np.linalg.eigh(rows.T @ rows)
    directions = directions[:, ::-1][:, :BITS]
    projected = rows @ directions
    width = projected.shape[1]
    rng = np.random.default_rng(SEED)
    rotations = []
    for _ in range(-(-BITS // width)):
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(FIT_ROUNDS):
            signs = np.where(projected @ turn > 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ signs)
            turn = left @ right
        rotations.append(directions @ turn)
    return mean, np.concatenate(rotations, axis=1)[:, :BITS]


def unlearned(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Random rotations, for lengths that the sample lacks."""
    rng = np.random.default_rng(SEED + size)
    turns = [np.linalg.qr(rng.normal(size=(size + 1, size + 1)))[0] for _ in range(-(-BITS // (size + 1)))]
    return np.zeros(size), np.concatenate(turns, axis=1)[:, :BITS]


def codes(rows: np.ndarray, rotations: np.ndarray) -> np.ndarray:
    """Signs of the rotated rows, as 64-bit words."""
    return np.packbits(rows @ rotations > 0, axis=1).view(np.uint64)


class Index:
    """The rows of a shard by every substring of their codes."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        parts = words.view(np.uint16)
        self.postings = [np.argsort(parts[:, j], kind="stable") for j in range(_PARTS)]
        self.starts = [np.searchsorted(parts[order, j], np.arange((1 << SUBSTRING) + 1)) for j, order in enumerate(self.postings)]
        self.values = [np.unique(parts[:, j], return_inverse=True) for j in range(_PARTS)]

    def within(self, queries: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of every code within each query's least radius that holds ``enough`` codes."""
        n, enough = len(self.words), min(enough, len(self.words))
        far = np.iinfo(np.uint16).max
        apart = np.full((len(queries), n), far, np.uint16)
        parts = queries.view(np.uint16)

        def verify(query: np.ndarray, row: np.ndarray) -> None:
            apart[query, row] = np.bitwise_count(queries[query] ^ self.words[row]).sum(axis=1, dtype=np.uint16)

        open_ = np.arange(len(queries))

        def still_open(radius: int) -> np.ndarray:
            return open_[(apart[open_] <= radius).sum(axis=1) < enough]

        for bits in range(ENUMERATED + 1):
            for j in range(_PARTS):
                probes = parts[open_, j][:, None] ^ _MASKS[bits]
                begins = self.starts[j][probes]
                lengths = self.starts[j][probes.astype(np.int64) + 1] - begins
                row = self.postings[j][ranges(begins.ravel(), lengths.ravel())]
                query = np.repeat(np.repeat(open_, len(_MASKS[bits])), lengths.ravel())
                new = apart[query, row] == far
                verify(query[new], row[new])
            open_ = still_open(_PARTS * (bits + 1) - 1)
            if not len(open_):
                break
        if len(open_):
            least = np.full((len(open_), n), SUBSTRING, np.uint8)
            for j, (values, place) in enumerate(self.values):
                np.minimum(least, _ONES[parts[open_, j][:, None] ^ values][:, place], out=least)
            rows_of = open_
            for bits in range(ENUMERATED + 1, SUBSTRING + 1):
                waiting = np.isin(rows_of, open_)
                query, row = np.nonzero((least == bits) & waiting[:, None])
                verify(rows_of[query], row)
                open_ = still_open(_PARTS * (bits + 1) - 1)
                if not len(open_):
                    break
        radius = np.partition(apart, enough - 1, axis=1)[:, enough - 1]
        return np.nonzero(apart <= radius[:, None])


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Where each query's n largest scores are, ties by id."""
    order = np.lexsort((ids, -scores, query))
    return order[np.arange(len(order)) - np.searchsorted(query[order], query[order]) < n]


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _buffer(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


_PACKED = "ids binary, vectors binary, words binary, wide boolean"


def _packer(model: dict[int, tuple[np.ndarray, np.ndarray]], names: list[str], index: bool):
    """One row per shard or query block: ids, vectors, codes."""

    def pack(rows: pa.Table) -> pa.Table:
        vectors = _vectors(rows["vector"])
        mean, rotations = model.get(vectors.shape[1]) or unlearned(vectors.shape[1])
        exact = vectors.astype(np.float64)
        if index:
            words = codes(_same_length(exact - mean), rotations)
        else:
            words = codes(exact / np.abs(exact).max(axis=1, keepdims=True), rotations[:-1])
        ids = np.stack([rows["id"].to_numpy(), rows["twin"].to_numpy()])
        columns = [rows[name][:1].combine_chunks() for name in names]
        return pa.table([*columns, _buffer(ids), _buffer(vectors), _buffer(words), pa.array([vectors.dtype == np.float64])], names=[*names, "ids", "vectors", "words", "wide"])

    return pack


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, twins = np.frombuffer(table["ids"][0].as_buffer(), np.int64).reshape(2, -1)
    kind = np.float64 if table["wide"][0].as_py() else np.float32
    vectors = np.frombuffer(table["vectors"][0].as_buffer(), kind).reshape(len(ids), -1)
    return ids, twins, vectors, np.frombuffer(table["words"][0].as_buffer(), np.uint64).reshape(len(ids), -1)


def _searcher(n: int, enough: int):
    def search(queries: pa.Table, shard: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], []]
        if queries.num_rows and shard.num_rows:
            query_ids, twins, asked, query_words = _unpacked(queries)
            ids, _, vectors, words = _unpacked(shard)
            index = Index(words)
            strip = max(1, PAIRS // len(ids))
            for start in range(0, len(query_ids), strip):
                query, row = index.within(query_words[start : start + strip], enough)
                query = query + start
                other = ids[row] != query_ids[query]
                query, row = query[other], row[other]
                scores = np.empty(len(row))
                held = max(1, PAIRS // vectors.shape[1])
                for at in range(0, len(row), held):
                    piece = slice(at, at + held)
                    scores[piece] = (asked[query[piece]].astype(np.float64) * vectors[row[piece]]).sum(axis=1)
                kept = _best(query, ids[row], scores, n)
                for column, values in zip(found, (query_ids[query[kept]], twins[query[kept]], ids[row[kept]], scores[kept])):
                    column.append(values)
        kinds = (np.int64, np.int64, np.int64, np.float64)
        return pa.table([pa.array(np.concatenate([np.empty(0, k), *c])) for c, k in zip(found, kinds)], names=["query_id", "twin", "vec_id", "score"])

    return search


def _usable(rows: DataFrame, key: str, vector: str, queries: Column) -> DataFrame:
    """(id, vector, asked, twin, size, octave) of the rows that take part, equal ones once."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    whole = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite & some)
    kept = whole.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), queries.alias("asked")).distinct()
    # Scaled first, so that squares neither overflow nor vanish.
    top = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    kept = kept.withColumn("top", top)
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x.cast("double") / F.col("top")) * (x.cast("double") / F.col("top")))
    octave = F.floor(F.log2("top") + F.log2(squares) / 2).cast("int")
    return kept.withColumns({"twin": F.xxhash64("vector"), "size": F.size("vector"), "octave": octave}).drop("top")


def nearest(rows: DataFrame, queries: Column, n: int, key: str = "vec_id", vector: str = "embedding", enough: int = ENOUGH) -> DataFrame:
    """(query_id, rank, vec_id, score): the n largest inner products found for each row where ``queries`` holds."""
    kind = rows.schema[vector].dataType.simpleString()
    if kind not in ("array<float>", "array<double>"):
        rows = rows.withColumn(vector, F.col(vector).cast("array<double>"))
    vectors = materialize(_usable(rows, key, vector, queries), "mih-vectors")

    drawn = vectors.orderBy(F.xxhash64(F.lit("fit"), "id", "twin"), "id", "twin").limit(FIT_ROWS).select("vector", "size", "octave").toArrow()
    model = {}
    for size in pc.unique(drawn["size"]).to_pylist():
        mine = drawn.filter(pc.equal(drawn["size"], size))
        model[size] = learned(_vectors(mine["vector"]).astype(np.float64), mine["octave"].to_numpy())

    # How many shards each octave of a length is cut into, and how many blocks the queries of a length.
    asked = F.sum(F.col("asked").cast("long"))
    sizes = vectors.groupBy("size", "octave").agg(F.count("*").alias("rows"), asked.alias("queries"))
    sizes = materialize(sizes.withColumn("slots", F.ceil(F.col("rows") * F.col("size") / SHARD_VALUES).cast("int")), "mih-sizes")
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    blocks = sizes.groupBy("size").agg(F.sum("queries").alias("queries"), F.sum("slots").alias("slots"))
    needed = F.ceil(F.col("queries") * F.col("size") / BLOCK_VALUES)
    wanted = F.least(F.ceil(F.col("queries") / 64), F.ceil(F.lit(2 * parallel) / F.col("slots")))
    blocks = materialize(blocks.where("queries > 0").select("size", F.greatest(needed, wanted).cast("int").alias("blocks"), "slots"), "mih-blocks")

    turn = F.xxhash64(F.lit("slot"), "id", "twin")
    shards = vectors.join(sizes.select("size", "octave", "slots"), ["size", "octave"])
    shards = shards.withColumn("slot", F.pmod(turn, F.col("slots")).cast("int")).select("size", "octave", "slot", "id", "twin", "vector")
    cells = ["size", "octave", "slot"]
    shards = shards.groupBy(*cells).applyInArrow(_packer(model, cells, True), f"size int, octave int, slot int, {_PACKED}")
    shards = materialize(shards, "mih-shards")
    asking = vectors.where("asked").join(blocks.select("size", "blocks"), "size")
    asking = asking.withColumn("block", F.pmod(turn, F.col("blocks")).cast("int")).select("size", "block", "id", "twin", "vector")
    asking = asking.groupBy("size", "block").applyInArrow(_packer(model, ["size", "block"], False), f"size int, block int, {_PACKED}")
    asking = materialize(asking, "mih-queries")

    left = asking.join(sizes.select("size", "octave", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")), "size")
    right = shards.join(blocks.select("size", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")), "size")
    meeting = [*cells, "block"]
    count = blocks.agg(F.sum(F.col("blocks") * F.col("slots"))).first()[0] or 1
    tasks = max(min(count, 4 * parallel), -(-count // 8))
    pairs = left.repartition(tasks, *meeting).groupBy(*meeting).cogroup(right.repartition(tasks, *meeting).groupBy(*meeting))
    found = pairs.applyInArrow(_searcher(n, enough), "query_id long, twin long, vec_id long, score double")
    best = Window.partitionBy("query_id", "twin").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return ranked.select("query_id", "rank", "vec_id", "score")
