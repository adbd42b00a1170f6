"""Bigram language model in sharded Elias-Fano tries.

Tokens are words (A-Z lowered) and one end per text.  The model is a bigram with
a Dirichlet prior: log of (c(previous, word) + m * P(word)) / (c(previous) + m),
with P the add-one unigram.  The numerator belongs to the word, the denominator
to the previous token alone, so all that a word's occurrences need meets in the
word's own shard, and a text's score is a sum over shards.

A shard's trie has two levels: its words, ascending, and under each word its
previous words, ascending and offset by the word's place so that the whole level
is one monotone sequence; level one points to where each word's range begins.
All three are Elias-Fano coded, with quantised log probabilities beside them, in
memory-mapped files of the task.  A bigram is found by successor search between
the two pointers of its word.

The number of shards follows from the number of tokens, and a task works on one
shard at a time, in two passes over its packed rows: counting pairs, then scoring.

Words that make up a thousandth of all tokens or more (so a thousand at most)
are spread over shards by their previous word, with their counts known
beforehand; no shard grows with one word's share.

Nulls and odd input: a null text counts as empty and scores its end mark.  A
null doc_id hashes as empty text when the held-out rows are chosen.  Equal rows
get equal scores.  Without any training text every count is 0.
"""

from __future__ import annotations

import math
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.batches import grouped_tables, list_column, pieces, released
from ratingloom.llm.elias_fano import EliasFano
from ratingloom.llm.words import mix, word_hashes
from ratingloom.scratch import materialize

#: The prior's weight, in tokens.
PRIOR = 200.0
#: A word with one in so many tokens is spread over shards.
HOT = 1000
#: Tokens that a shard aims at, and bytes of its packed rows beyond which they are held in a file.
SHARD_TOKENS, HELD_BYTES = 500_000, 32_000_000
#: Tokens whose pairs are sorted at once, unless one piece of documents has more in a shard.
SORTED_TOKENS = 200_000
#: Documents whose sums a task holds before it sends them on.
SUM_ROWS = 300_000
#: Words that a counting task holds before it sends their sums on.
VOCABULARY_ROWS = 750_000
#: Step of the quantised base-10 logarithms, and the lowest one held.
STEP, LOWEST = 1 / 1024, -40.0

_END, _BEGIN = np.uint64(1), np.uint64(2)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of each text, its end included, and how many each has."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    return np.insert(hashes, ends, _END), counts + 1


def _quantise(logs: np.ndarray) -> np.ndarray:
    return np.round((np.maximum(logs, LOWEST) - LOWEST) / STEP).astype(np.uint16)


def _value(codes: np.ndarray) -> np.ndarray:
    return codes * STEP + LOWEST


class Trie:
    """One shard: words, ranges, previous words, and quantised probabilities."""

    def __init__(self, folder: str, words: np.ndarray, known: np.ndarray, pair_word: np.ndarray, previous: np.ndarray, pair_counts: np.ndarray, total: int, vocabulary: int, prior: float):
        """``words`` ascending with their training counts ``known``; pairs by the
        word's index, then by 32-bit previous word, with their counts."""
        probability = (known + 1.0) / (total + vocabulary + 1.0)
        begins = np.searchsorted(pair_word, np.arange(len(words) + 1))
        level = (pair_word.astype(np.uint64) << np.uint64(32)) | previous.astype(np.uint64)
        parts = {
            "words": EliasFano.build(words, 1 << 64),
            "ranges": EliasFano.build(begins.astype(np.uint64), len(level) + 1),
            "pairs": EliasFano.build(level, max(1, len(words)) << 32),
        }
        for name, part in parts.items():
            part.save(folder, name)
            setattr(self, name, part.mapped(folder, name))
        unseen = np.log10(prior * probability)
        seen = np.log10(pair_counts + prior * probability[pair_word])
        for name, array in (("unseen", _quantise(unseen)), ("seen", _quantise(seen)), ("known", known)):
            np.save(os.path.join(folder, f"{name}.npy"), array)
            setattr(self, name, np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r"))

    def find_words(self, words: np.ndarray) -> np.ndarray:
        return self.words.find(words)

    def numerators(self, word: np.ndarray, previous: np.ndarray) -> np.ndarray:
        """log10 of c(previous, word) + m * P(word), for words by their index."""
        begin, end = (self.ranges.values(at).astype(np.int64) for at in (word, word + 1))
        at = self.pairs.find((word.astype(np.uint64) << np.uint64(32)) | previous.astype(np.uint64), begin, end)
        codes = np.where(at >= 0, self.seen[np.maximum(at, 0)] if len(self.seen) else 0, self.unseen[word])
        return _value(codes)


def _vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): training counts of every token; each task sends its sums."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, counts = (np.concatenate(x) for x in zip(*held))
            distinct, place = np.unique(words, return_inverse=True)
            return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

        for batch in pieces(batches, "text"):
            held.append(np.unique(tokens(batch.column("text"))[0], return_counts=True))
            size += len(held[-1][0])
            if size > 2 * VOCABULARY_ROWS:
                held = [merged()]
                size = len(held[0][0])
                if size > VOCABULARY_ROWS:  # what is held stays bounded
                    words, counts = held[0]
                    yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])
                    held, size = [], 0
        if held:
            words, counts = merged()
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    return docs.select("text").mapInArrow(compute, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


_TOKENS = (
    "shard int, train boolean, piece long, words array<long>, runs array<int>, previous array<int>, docs array<smallint>, "
    "ids array<long>, held array<boolean>, sizes array<int>"
)
_SUMS = "piece long, docs array<smallint>, known array<int>, base array<double>, score array<double>, ids array<long>, held array<boolean>, sizes array<int>"


def _occurrences(rows: DataFrame, hot: np.ndarray, shards: int) -> DataFrame:
    """Every token with the one before it, packed by shard; and a row per piece of documents.

    A document is a number within its piece.  Tokens of a piece and shard are one
    row: distinct words, their run lengths, then per occurrence the previous word
    and the document.  The piece's own row (ids, held, sizes) rides along.
    """
    names = [field.split()[0] for field in _TOKENS.split(", ")]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Recomputed tasks read the same rows, so a piece keeps its number.
        piece = TaskContext.get().partitionId() << 32
        for large in pieces(batches, "text"):
            for begin in range(0, large.num_rows, 30_000):
                batch = large.slice(begin, 30_000)
                word, counts = tokens(batch.column("text"))
                before = np.empty_like(word)
                before[1:] = word[:-1]
                before[np.cumsum(counts) - counts] = _BEGIN
                previous = (mix(before) >> np.uint64(32)).astype(np.uint32)
                row = np.repeat(np.arange(len(counts)), counts)
                held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                spread = np.where(np.isin(word, hot), mix(word ^ previous.astype(np.uint64)), mix(word))
                group = (spread % np.uint64(shards)).astype(np.int64) * 2 + ~held[row]
                order = np.lexsort((word, group))
                group, word = group[order], word[order]
                new_group = np.diff(group, prepend=-1) != 0
                new_run = new_group.copy()
                new_run[1:] |= word[1:] != word[:-1]
                begins, runs = np.flatnonzero(new_group), np.flatnonzero(new_run)
                lengths = np.diff(np.append(begins, len(group)))
                runs_per_row = np.diff(np.append(np.searchsorted(runs, begins), len(runs)))
                n = len(begins)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((group[begins] // 2).astype(np.int32)),
                        pa.array(group[begins] % 2 == 1),
                        pa.array(np.full(n, piece)),
                        list_column(word[runs].view(np.int64), runs_per_row),
                        list_column(np.diff(np.append(runs, len(word))).astype(np.int32), runs_per_row),
                        list_column(previous[order].view(np.int32), lengths),
                        list_column(row[order].astype(np.int16), lengths),
                        pa.nulls(n, pa.list_(pa.int64())),
                        pa.nulls(n, pa.list_(pa.bool_())),
                        pa.nulls(n, pa.list_(pa.int32())),
                    ],
                    names,
                )
                ids = batch.column("doc_id").to_pylist()
                own = [
                    pa.array([piece % shards], pa.int32()),
                    pa.array([True]),
                    pa.array([piece]),
                    *[pa.array([[]], pa.list_(kind)) for kind in (pa.int64(), pa.int32(), pa.int32(), pa.int16())],
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([held.tolist()], pa.list_(pa.bool_())),
                    pa.array([counts.tolist()], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(own, names)
                piece += 1

    return rows.mapInArrow(compute, _TOKENS)


class _Rows:
    """A shard's packed rows, read twice; large shards lie in a compressed file of the task."""

    def __init__(self, folder: str) -> None:
        self.path = os.path.join(folder, "rows.arrow")
        self.batches: list[pa.RecordBatch] = []
        self.size, self.writer = 0, None

    def add(self, batch: pa.RecordBatch) -> None:
        if self.writer is None and self.size + batch.nbytes > HELD_BYTES:
            self.writer = pa.ipc.new_file(self.path, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            for held in self.batches:
                self.writer.write_batch(held)
            self.batches = []
        if self.writer is None:
            self.batches.append(batch)
        else:
            self.writer.write_batch(batch)
        self.size += batch.nbytes

    def read(self) -> Iterator[pa.RecordBatch]:
        if self.writer is None:
            yield from self.batches
            return
        self.writer.close()
        with pa.memory_map(self.path) as source:
            reader = pa.ipc.open_file(source)
            for i in range(reader.num_record_batches):
                yield reader.get_batch(i)

    def slices(self) -> Iterator[pa.RecordBatch]:
        """The same rows, about ``SORTED_TOKENS`` tokens at a time."""
        for batch in self.read():
            ends = batch.column("previous").offsets.to_numpy()[1:]
            ends = ends - batch.column("previous").offsets.to_numpy()[0]
            begin = 0
            while begin < batch.num_rows:
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + SORTED_TOKENS, side="right")))
                yield batch.slice(begin, end - begin)
                begin = end


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every token: its word as a place in the batch's distinct words, and its previous one; and those words."""
    runs = batch.column("runs").flatten().to_numpy()
    words, of_run = np.unique(batch.column("words").flatten().to_numpy().view(np.uint64), return_inverse=True)
    return np.repeat(of_run.astype(np.int32), runs), batch.column("previous").flatten().to_numpy().view(np.uint32), words


def _pairs(place: np.ndarray, previous: np.ndarray) -> np.ndarray:
    return (place.astype(np.uint64) << np.uint64(32)) | previous.astype(np.uint64)


def _shard_trie(rows: _Rows, folder: str, hot_words: np.ndarray, hot_counts: np.ndarray, total: int, vocabulary: int, prior: float) -> Trie:
    """Counts of the shard's training words and pairs, as a trie."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word, previous, times = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((previous, word))
        word, previous, times = word[order], previous[order], times[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (previous[1:] != previous[:-1])
        begins = np.flatnonzero(new)
        return word[begins], previous[begins], np.add.reduceat(times, begins) if len(begins) else times

    size = 0
    for batch in rows.slices():
        batch = batch.filter(batch.column("train"))
        place, previous, words = _unpacked(batch)
        pairs, times = np.unique(_pairs(place, previous), return_counts=True)
        held.append((words[(pairs >> np.uint64(32)).astype(np.int64)], (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32), times))
        size += len(pairs)
        if size > 4 * SHARD_TOKENS:
            held = [merged()]
            size = len(held[0][0])
    word, previous, times = merged() if held else (np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64))
    words, at = np.unique(word, return_inverse=True)
    known = np.bincount(at, times, len(words)).astype(np.int64)
    # A hot word's pairs are spread over shards, so its count is the one known beforehand.
    spread = np.searchsorted(words, hot_words)
    here = np.array([i for i, w in enumerate(spread) if w < len(words) and words[w] == hot_words[i]], np.int64)
    known[spread[here]] = hot_counts[here]
    return Trie(folder, words, known, at.astype(np.int64), previous, times, total, vocabulary, prior)


def _batch_scores(batch: pa.RecordBatch, trie: Trie, hot_words: np.ndarray, hot_counts: np.ndarray, total: int, vocabulary: int, prior: float) -> tuple[np.ndarray, ...]:
    """Documents of a batch's tokens, and their known tokens and sums; every distinct word and pair is looked up once."""
    place, previous, words = _unpacked(batch)
    lengths = np.diff(batch.column("previous").offsets.to_numpy())
    docs = batch.column("docs").flatten().to_numpy().astype(np.int64)
    owner = (np.repeat(batch.column("piece").to_numpy(), lengths) << 15) | docs
    index = trie.find_words(words)
    count = np.where(index >= 0, trie.known[np.maximum(index, 0)] if len(trie.known) else 0, 0)
    if len(hot_words):
        # A hot word's count is known even where no training occurrence fell into this shard.
        slot = np.minimum(np.searchsorted(hot_words, words), len(hot_words) - 1)
        count = np.where(hot_words[slot] == words, hot_counts[slot], count)
    pairs, of_pair = np.unique(_pairs(place, previous), return_inverse=True)
    word, before = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    numerator = _value(_quantise(np.log10(prior * (count + 1.0) / (total + vocabulary + 1.0))))[word]
    live = np.flatnonzero(index[word] >= 0)
    numerator[live] = trie.numerators(index[word[live]], before[live])
    # As the previous token of the next one, a word also brings its denominator.
    numerator -= np.where(words == _END, 0.0, np.log10(count + prior))[word]
    owners, which = np.unique(owner, return_inverse=True)
    known, base = (count > 0).astype(float)[place], np.log10(count + 1.0)[place]
    return owners, *(np.bincount(which, of_token, len(owners)) for of_token in (known, base, numerator[of_pair]))


def _scores(occurrences: DataFrame, hot: dict[int, int], shards: int, total: int, vocabulary: int, prior: float) -> DataFrame:
    """Sums over each shard's tokens, one row per piece of documents and task, or more where a task has very many."""
    hot_words = np.array(sorted(w & 0xFFFFFFFFFFFFFFFF for w in hot), np.uint64)
    hot_counts = np.array([hot[int(np.uint64(w).view(np.int64))] for w in hot_words], np.int64)
    names = [field.split()[0] for field in _SUMS.split(", ")]
    model = (hot_words, hot_counts, total, vocabulary, prior)

    def listed(owners: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
        piece = owners >> 15
        begins = np.flatnonzero(np.diff(piece, prepend=-1))
        lengths = np.diff(np.append(begins, len(owners)))
        values = [(owners & 0x7FFF).astype(np.int16), known.astype(np.int32), base, score]
        rest = [pa.nulls(len(begins), pa.list_(k)) for k in (pa.int64(), pa.bool_(), pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(piece[begins]), *(list_column(v, lengths) for v in values), *rest], names)

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        owner, *sums = (np.concatenate(x) for x in zip(*parts))
        owners, which = np.unique(owner, return_inverse=True)
        return owners, *(np.bincount(which, s, len(owners)) for s in sums)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        size = 0
        for rows, folder in _by_shard(batches):
            for batch in rows.read():
                own = batch.filter(batch.column("ids").is_valid())
                if own.num_rows:
                    empty = [pa.nulls(own.num_rows, pa.list_(k)) for k in (pa.int16(), pa.int32(), pa.float64(), pa.float64())]
                    yield pa.RecordBatch.from_arrays([own.column("piece"), *empty, *(own.column(c) for c in ("ids", "held", "sizes"))], names)
            trie = _shard_trie(rows, folder, *model)
            for batch in rows.slices():
                parts.append(_batch_scores(batch, trie, *model))
                size += len(parts[-1][0])
                if size > 2 * SUM_ROWS:
                    parts = [merged(parts)]
                    size = len(parts[0][0])
                    if size > SUM_ROWS:  # what is held stays bounded
                        yield listed(*parts[0])
                        parts, size = [], 0
        if parts:
            yield listed(*merged(parts))

    parallel = int(occurrences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = occurrences.repartition(max(parallel, shards // 8), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(released(compute), _SUMS)


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Rows, str]]:
    """The rows of one shard after the other, with a folder for its files."""
    current, rows, folder = None, None, None
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        begins = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
        for begin, end in zip(begins, [*begins[1:], len(shard)]):
            if shard[begin] != current:
                if rows is not None:
                    yield rows, folder.name
                    folder.cleanup()
                folder = tempfile.TemporaryDirectory()
                current, rows = shard[begin], _Rows(folder.name)
            # Copied, so that a slice does not keep its whole batch.
            rows.add(batch.slice(begin, end - begin) if end - begin == len(shard) else batch.take(pa.array(np.arange(begin, end))))
    if rows is not None:
        yield rows, folder.name
        folder.cleanup()


def _by_document(sums: DataFrame, schema: str) -> DataFrame:
    """doc_id, held_out, n_tokens, known, base, score of every document of every piece."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped_tables(batches, ["piece"]):
            sizes = table.column("sizes").combine_chunks()
            own = sizes.drop_null().flatten().to_numpy()
            docs = table.column("docs").combine_chunks().flatten().to_numpy()
            known, base, score = (np.bincount(docs, table.column(c).combine_chunks().flatten().to_numpy(), len(own)) for c in ("known", "base", "score"))
            first = [table.column(c).combine_chunks().drop_null().flatten() for c in ("ids", "held")]
            columns = [*first, pa.array(own.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "known", "base", "score"])

    return sums.repartition("piece").sortWithinPartitions("piece").mapInArrow(compute, schema)


def score_texts(docs: DataFrame, held_out: Column, prior: float = PRIOR) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    counted = materialize(_vocabulary(keyed.where("NOT held_out")), "vocabulary")
    total, vocabulary = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # At most HOT words can have one in HOT tokens.
    hot = {r["word"]: r["n"] for r in counted.where(F.col("n") * HOT >= F.lit(max(1, total))).collect()} if total else {}
    # Every training text has one end.
    begins = counted.where(F.col("word") == int(_END)).agg(F.sum("n")).first()[0] or 0

    shards = max(1, math.ceil(total / SHARD_TOKENS))
    hot_words = np.array([w & 0xFFFFFFFFFFFFFFFF for w in hot], np.uint64)
    parts = _scores(_occurrences(keyed, hot_words, shards), hot, shards, total, vocabulary, prior)
    summed = _by_document(parts, "doc_id long, held_out boolean, n_tokens long, known long, base double, score double")
    return summed.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(total + vocabulary + 1.0)).alias("base_score"),
        F.round(F.col("score") - math.log10(begins + prior), 6).alias("score"),
    )
