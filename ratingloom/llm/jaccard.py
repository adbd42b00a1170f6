"""Jaccard join of documents by word n-grams, as a blocked sparse matrix product.

The document by n-gram incidence matrix is never multiplied whole.  Sizes bound
how many n-grams two linked documents may differ in; cutting the n-gram space
into more column blocks than that leaves at least one block in which the two
are equal, so only documents with an equal column block can link.  Those are
the row blocks: all documents that share a column block with the same smallest
document.  Within a row block the product of the incidence matrices adds up
overlaps, tile by tile, and pairs whose size or overlap misses the bound are
discarded.  Bit maps of the sets, a twentieth of their size, go first: they bound
every overlap from above, and only documents that may link in a block send their
sets there.  It runs in two passes: the smallest document of each block against
its members, then, once those links have made components, only the pairs that
are still apart.  Pairs never become rows of a table.

Nulls and odd input: a text that is null or without words has an empty set and
links with nothing.  Rows that share a doc_id count as one document that has the
links of all its texts.  Rows whose doc_id is null are kept, with component null.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.batches import grouped_tables, list_column, pieces, ranges, released
from ratingloom.llm.components import components
from ratingloom.llm.words import mix, shingles, sorted_sets, word_hashes
from ratingloom.scratch import materialize

#: Words in a shingle, and the least similarity in hundredths.
WORDS, PERCENT = 3, 90
#: Column blocks beyond the most that may differ; so many blocks may be empty without mattering.
SPARE = 2
#: Documents and shingles that one side of a block product holds (more only for one long document).
BLOCK_DOCUMENTS, BLOCK_SHINGLES = 256, 400_000
#: Increments of the product that are held at once.
TILE = 4_000_000


@lru_cache
def _classes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Size classes, and column blocks for each pair of neighbouring classes.

    Class i holds sizes from low[i] to 100 * low[i] // percent.  A partner of a
    size in it that is no smaller lies in class i or i + 1.  blocks[i] suits the
    pairs of the two: one more than they may differ in, and the spare ones.
    """
    low, blocks = [0, 1], []
    while low[-1] <= largest:
        low.append(100 * low[-1] // percent + 1)
    for i in range(len(low) - 1):
        high = low[i + 1] - 1
        differ = (high + 100 * high // percent) * (100 - percent) // (100 + percent)
        blocks.append(differ + 1 + SPARE)
    return np.array(low), np.array(blocks)


def block_keys(sets: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """A key for each column block of each document, and how many each document has.

    Two documents that may link have a key in common, whatever their texts.
    ``sets`` holds each document's n-grams in ascending order.
    """
    low, blocks = _classes(percent, 1 << int(max(1, sizes.max(initial=1))).bit_length())
    own = np.searchsorted(low, sizes, side="right") - 1
    keys, owners = [], []
    salted = mix(sets)
    high = sets >> np.uint64(32)
    for tag in (own - 1, own):
        used = np.where((sizes > 0) & (tag > 0), blocks[np.maximum(tag, 0)], 0)
        first = np.cumsum(used) - used
        per_item = np.repeat(used, sizes)
        live = per_item > 0
        block = ((high[live] * per_item[live].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        slot = np.repeat(first, sizes)[live] + block
        total = int(used.sum())
        filled = np.bincount(slot, minlength=total)
        value = np.zeros(total, np.uint64)
        if len(slot):
            begins = np.flatnonzero(np.diff(slot, prepend=-1))
            value[slot[begins]] = np.add.reduceat(salted[live], begins)
        owner = np.repeat(np.arange(len(sizes)), used)
        name = np.repeat(tag, used) * 1_000_003 + np.arange(total) - np.repeat(first, used)
        key = mix(value ^ mix(name.astype(np.uint64) + np.uint64(1)))
        empty = np.bincount(owner[filled == 0], minlength=len(sizes))
        wanted = (filled > 0) | (empty[owner] > SPARE)
        keys.append(key[wanted])
        owners.append(owner[wanted])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(keys)[order], np.bincount(owner, minlength=len(sizes))


def overlap_counts(left: np.ndarray, left_sizes: np.ndarray, right: np.ndarray, right_sizes: np.ndarray) -> np.ndarray:
    """Product of two blocks of the incidence matrix: common n-grams of each pair."""
    shape = (len(left_sizes), len(right_sizes))
    by_item = np.argsort(right, kind="stable")
    items = right[by_item]
    columns = np.repeat(np.arange(shape[1]), right_sizes)[by_item]
    rows = np.repeat(np.arange(shape[0]), left_sizes)
    begin, end = np.searchsorted(items, left), np.searchsorted(items, left, side="right")
    live = np.flatnonzero(end > begin)
    length = (end - begin)[live]
    counts = np.zeros(shape[0] * shape[1], np.int64)
    tiles = np.searchsorted(np.cumsum(length), np.arange(TILE, int(length.sum()) + TILE, TILE))
    at = 0
    for stop in (int(t) + 1 for t in tiles):
        part, times = live[at:stop], length[at:stop]
        where = np.repeat(rows[part] * shape[1], times) + columns[ranges(begin[part], times)]
        counts += np.bincount(where, minlength=len(counts))
        at = stop
    return counts.reshape(shape)


def linked(left, left_sizes, right, right_sizes, percent: int) -> np.ndarray:
    """Which pairs reach the similarity, by whole numbers."""
    common = overlap_counts(left, left_sizes, right, right_sizes)
    union = left_sizes[:, None] + right_sizes[None, :] - common
    return (100 * common >= percent * union) & (common > 0)


def _row_sets(batch: pa.RecordBatch, words: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = word_hashes(batch.column("text"))
    return sorted_sets(*shingles(hashes, counts, words))


def fingerprints(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, a 128-bit print of the set, and block keys."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets, sizes = _row_sets(batch, words)
            keys, per_row = block_keys(sets, sizes, percent)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            prints = []
            for salt in (11, 23):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets + np.uint64(salt)))])
                prints.append(pa.array((sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes.astype(np.int64)), *prints, list_column(keys.view(np.int64), per_row)],
                ["doc_id", "n_shingles", "print1", "print2", "keys"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(compute), "doc_id long, n_shingles long, print1 long, print2 long, keys array<long>"
    )


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its distinct shingles as one array."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets, sizes = _row_sets(batch, words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes.astype(np.int64)), list_column(sets.view(np.int64), sizes)], ["doc_id", "size", "items"])

    return docs.select("doc_id", "text").mapInArrow(released(compute), "doc_id long, size long, items array<long>")


def _marks(sets: DataFrame) -> DataFrame:
    """(doc_id, size, marks): a bit map of each set, of the first power of two from twice its size on."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("items")
            sizes = np.diff(items.offsets.to_numpy()).astype(np.int64)
            bits = np.maximum(64, 2 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
            begin = np.cumsum(bits) - bits
            place = mix(items.flatten().to_numpy().view(np.uint64)).astype(np.int64) & np.repeat(bits - 1, sizes)
            held = np.zeros(int(bits.sum()), np.uint8)
            held[np.repeat(begin, sizes) + place] = 1
            data = np.packbits(held, bitorder="little").tobytes()
            ends = (np.append(begin, bits.sum()) // 8).tolist()
            marks = pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), marks], ["doc_id", "size", "marks"])

    return sets.select("doc_id", "items").mapInArrow(released(compute), "doc_id long, size long, marks binary")


def _folded(rows: np.ndarray, words: int) -> np.ndarray:
    """Bit maps at a smaller size: places count modulo it."""
    while rows.shape[1] > words:
        half = rows.shape[1] // 2
        rows = rows[:, :half] | rows[:, half:]
    return rows


def may_link(left: list[bytes], left_sizes: np.ndarray, right: list[bytes], right_sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets may reach the similarity, by their bit maps; never wrong about one that does.

    Equal items share a bit, so an overlap is at most the common bits and what either
    set has beyond one item for each of its bits.
    """

    def by_length(marks: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lengths = np.array([len(m) for m in marks])
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield at, np.frombuffer(b"".join(marks[i] for i in at), np.uint64).reshape(len(at), -1)

    found = np.zeros((len(left), len(right)), bool)
    others = list(by_length(right))
    for at_left, rows in by_length(left):
        for at_right, columns in others:
            words = min(rows.shape[1], columns.shape[1])
            a, b = _folded(rows, words), _folded(columns, words)
            more_a = left_sizes[at_left] - np.bitwise_count(a).sum(axis=1, dtype=np.int64)
            more_b = right_sizes[at_right] - np.bitwise_count(b).sum(axis=1, dtype=np.int64)
            for i, row in enumerate(a):
                most = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64) + np.minimum(more_a[i], more_b)
                found[at_left[i], at_right] = 100 * most >= percent * (left_sizes[at_left[i]] + right_sizes[at_right] - most)
    return found


def _each_product(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``work`` on the rows of each (block, i, j) of sorted batches."""
    for table in grouped_tables(batches, ["block", "i", "j"]):
        yield work(table.combine_chunks())


def _alive(tasks: DataFrame, percent: int) -> DataFrame:
    """(block, i, j, side, doc_id, label) of documents that may link with the other side of a product."""

    def work(whole: pa.Table) -> pa.RecordBatch:
        side, label, sizes = (whole.column(c).to_numpy() for c in ("side", "label", "size"))
        marks = whole.column("marks").to_pylist()
        cut = int(np.searchsorted(side, 1))
        hit = may_link(marks[:cut], sizes[:cut], marks[cut:], sizes[cut:], percent) & (label[:cut, None] != label[None, cut:])
        kept = whole.select(names).filter(pa.array(np.append(hit.any(axis=1), hit.any(axis=0))))
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in kept.columns], names)

    names = ["block", "i", "j", "side", "doc_id", "label"]
    parted = tasks.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "side", "doc_id")
    found = parted.select(*names, "size", "marks").mapInArrow(released(lambda batches: _each_product(batches, work)), "block long, i int, j int, side int, doc_id long, label long")
    return found.distinct()


def _products(tasks: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) within each product of a block's left and right side.

    ``tasks`` has one row per document and side: block, i, j (the product),
    side (0 left, 1 right), doc_id, label, items.  Pairs of one label are known
    to be connected.  Of a product's links only a spanning forest leaves it.
    """
    parted = tasks.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "side", "doc_id")
    names = ["block", "i", "j", "side", "doc_id", "label", "items"]

    def multiply(whole: pa.Table) -> pa.RecordBatch:
        side, ids, label = (whole.column(c).to_numpy() for c in ("side", "doc_id", "label"))
        items = whole.column("items").combine_chunks()
        sizes = np.diff(items.offsets.to_numpy()).astype(np.int64)
        values = items.flatten().to_numpy().view(np.uint64)
        cut = int(np.searchsorted(side, 1))
        middle = int(sizes[:cut].sum())
        hit = linked(values[:middle], sizes[:cut], values[middle:], sizes[cut:], percent)
        hit &= label[:cut, None] != label[None, cut:]
        a, b = np.nonzero(hit)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        u, v = [], []
        for x, y in zip(ids[:cut][a].tolist(), ids[cut:][b].tolist()):
            p, q = root(x), root(y)
            if p != q:
                parent[max(p, q)] = min(p, q)
                u.append(x)
                v.append(y)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return parted.select(names).mapInArrow(released(lambda batches: _each_product(batches, multiply)), "u long, v long")


def similar_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id
    reachable by links, its own included)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = materialize(fingerprints(docs, words, percent), "shingle-prints")
    named = prints.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))

    # Equal sets: every copy hangs on its smallest document.
    same = ["n_shingles", "print1", "print2"]
    groups = named.groupBy(same).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # Stored before the join, whose other side can then be split where a key is hot.
    groups = materialize(groups, "set-groups")
    copies = materialize(named.select("doc_id", *same).join(groups, same).where("doc_id > first").select("doc_id", "first").distinct(), "equal-sets")

    keys = named.select("doc_id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("block"), F.max("doc_id").alias("last")).where("block < last").drop("last")
    shared = materialize(shared, "shared-keys")
    # Both sides grow with the documents, so the joins of keys and texts are the same at every size.
    members = keys.join(shared.hint("merge"), "key").select("block", "doc_id").distinct()
    # A copy's first document stands for it, as a member and as a block's name.
    for column in ("doc_id", "block"):
        firsts = copies.select(F.col("doc_id").alias(column), F.col("first").alias("_first"))
        members = members.join(firsts, column, "left").withColumn(column, F.coalesce("_first", column)).drop("_first")
    members = members.distinct()
    members = materialize(members.where("doc_id <> block"), "row-blocks")

    needed = members.select("doc_id").union(members.select(F.col("block").alias("doc_id"))).distinct()
    sets = materialize(_sets(docs.join(needed.hint("merge"), "doc_id", "left_semi"), words), "row-sets")
    marks = materialize(_marks(sets), "row-marks")
    sizes = marks.groupBy("doc_id").agg(F.max("size").alias("size"))

    def multiplied(rows: DataFrame, name: str) -> DataFrame:
        """Links of products, sets being sent for documents that may have one."""
        alive = materialize(_alive(rows.join(marks, "doc_id"), percent), f"{name}-alive")
        return _products(alive.join(sets.select("doc_id", "items").hint("merge"), "doc_id"), percent)

    # The smallest document of each block times its members.
    spans = F.greatest(F.ceil(F.col("n") / BLOCK_DOCUMENTS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")

    def parted(rows: DataFrame, name: str) -> DataFrame:
        """Block members with a part number; parts are of bounded size."""
        per_block = rows.join(sizes, "doc_id").groupBy("block").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
        counted = rows.join(per_block.select("block", spans.alias("parts")), "block")
        return counted.withColumn(name, F.pmod(F.xxhash64("doc_id", "block"), F.col("parts")).cast("int"))

    in_parts = materialize(parted(members, "j"), "star-parts")
    stars = in_parts.select("block", F.lit(0).alias("i"), "j").distinct()
    left = stars.select("block", "i", "j", F.lit(0).alias("side"), F.col("block").alias("doc_id"))
    right = in_parts.select("block", F.lit(0).alias("i"), "j", F.lit(1).alias("side"), "doc_id")
    stars = left.union(right).withColumn("label", F.col("side").cast("long"))
    star_links = materialize(multiplied(stars, "star"), "star-links")
    copy_links = copies.select(F.col("doc_id").alias("u"), F.col("first").alias("v"))

    # What the stars have not connected, against its whole block.
    found = materialize(components(star_links.union(copy_links)), "star-components")
    labels = found.select(F.col("id").alias("doc_id"), F.col("component").alias("label"))
    block_labels = found.select(F.col("id").alias("block"), F.col("component").alias("block_label"))
    state = members.join(labels, "doc_id", "left").join(block_labels, "block", "left")
    state = state.select("block", "doc_id", F.coalesce("label", "doc_id").alias("label"), F.coalesce("block_label", "block").alias("block_label"))
    state = materialize(state, "block-states")
    apart = state.where("label <> block_label").select("block", "doc_id", "label")
    # A block needs a second pass only if it has two members with one of them apart.
    open_blocks = state.groupBy("block").agg(F.count("*").alias("n"), F.max(F.col("label") != F.col("block_label")).alias("open")).where("n > 1 AND open").select("block")
    apart = materialize(parted(apart.join(open_blocks, "block", "left_semi"), "i").drop("parts"), "apart-parts")
    whole = materialize(parted(state.select("block", "doc_id", "label").join(open_blocks, "block", "left_semi"), "j").drop("parts"), "whole-parts")
    left_parts, right_parts = apart.select("block", "i").distinct(), whole.select("block", "j").distinct()
    left = apart.join(right_parts, "block").select("block", "i", "j", F.lit(0).alias("side"), "doc_id", "label")
    right = whole.join(left_parts, "block").select("block", "i", "j", F.lit(1).alias("side"), "doc_id", "label")
    rest_links = multiplied(left.union(right), "rest")

    links = star_links.union(rest_links).union(copy_links)
    found = components(links).select(F.col("id").alias("doc_id"), F.col("component").alias("component_id"))
    answer = prints.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    return answer.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
