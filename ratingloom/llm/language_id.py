"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all ways to cut it into pieces, which
the forward algorithm computes in one pass; a text's is the product over its
words.  The piece probabilities are learned by expectation maximisation: the
forward and backward sums give each piece's expected count.

All pieces of the vocabulary and all lengths of words count: sums are rescaled
every few characters, so that runs of any number of letters stay within a double.

Nulls and odd input: a text that is null or holds no letter (Unicode category L;
other numbers and lone marks are none) is ``und`` with score 0.  With no labelled row at all every text is ``und``.  Rows are never
dropped or joined, so repeated rows each get their own, equal answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.batches import pieces, released
from ratingloom.scratch import materialize

#: Labelled documents per language that the fit looks at (about; chosen by a hash of the id).
FIT_DOCUMENTS = 4_000
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Expected count given to every piece beforehand, and the probability of a character no piece covers.
PRIOR_COUNT, UNKNOWN = 0.05, 1e-7
UNDETERMINED = "und"

#: Characters of text, and of distinct words, that are scored together; words whose scores a task remembers.
SCORED_CHARS, WORD_CHARS, REMEMBERED = 1_000_000, 400_000, 100_000
#: Boundaries after which sums are taken relative to the last one; no piece may be longer.
EPOCH = 32

_MARK = "▁"
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def public_pieces(path: str) -> list[str]:
    """The letter pieces of a public sentencepiece vocabulary, in lower case."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = set()
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).lower()
        if piece.removeprefix(_MARK).isalpha():
            found.add(piece)
    return sorted(found)


class Found:
    """Where pieces lie in a list of words, each with its mark before it.

    ``starts`` and ``lengths`` place the words in the joined characters.  ``ends[m]``
    has the pieces of m characters by the boundary t at which they end: for t from 1
    on, slices of the words' places in ``longest_first`` and of the pieces.
    """

    def __init__(self, starts: np.ndarray, lengths: np.ndarray) -> None:
        self.starts, self.lengths = starts, lengths
        self.longest_first = np.argsort(-lengths, kind="stable")
        self.boundary = (starts + np.arange(len(lengths)))[self.longest_first]
        self.last = int(lengths.max())
        self.ends: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def at(self, m: int, t: int) -> tuple[np.ndarray, np.ndarray]:
        words, rows, marks = self.ends[m]
        there = slice(marks[t], marks[t + 1])
        return words[there], rows[there]


class PieceTable:
    """Finds pieces in many words at once, by rolling hash and binary search."""

    def __init__(self, vocabulary: list[str]):
        hashes = np.array([self._hash(piece) for piece in vocabulary], np.uint64)
        sizes = np.array([len(piece) for piece in vocabulary], np.int64)
        self.longest = max(int(sizes.max(initial=1)), 1)
        if self.longest > EPOCH:
            raise ValueError(f"a piece of {self.longest} characters is too long; at most {EPOCH} are possible")
        self._by_size = {}
        for m in range(1, self.longest + 1):
            rows = np.flatnonzero(sizes == m)
            rows = rows[np.argsort(hashes[rows])]
            self._by_size[m] = hashes[rows], rows.astype(np.int32)
        self.size = len(vocabulary)

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for character in piece:
            value = (value * int(_BASE) + ord(character) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def find(self, words: list[str]) -> Found:
        """The pieces of every word, as rows of a table of probabilities with one
        row more, ``size``, for a character that is no piece itself."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        starts = np.cumsum(lengths) - lengths
        found = Found(starts, lengths)
        joined = np.frombuffer((_MARK + _MARK.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = joined.astype(np.uint64) + np.uint64(1)
        place = np.empty(len(words), np.int64)
        place[found.longest_first] = np.arange(len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        before = np.arange(len(codes)) - starts[word]
        hashes = np.zeros(len(codes), np.uint64)
        for m in range(1, min(self.longest, found.last) + 1):
            whole = len(codes) - m + 1
            hashes[:whole] = hashes[:whole] * _BASE + codes[m - 1 :]
            known, rows = self._by_size[m]
            inside = np.flatnonzero(before + m <= lengths[word]) if m > 1 else np.arange(len(codes))
            at = np.full(len(inside), self.size, np.int32)
            if len(known):
                asked = hashes[inside]
                near = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                hit = known[near] == asked
                at[hit] = rows[near[hit]]
            if m > 1:
                inside, at = inside[at != self.size], at[at != self.size]
            end = before[inside] + m
            order = np.argsort(end, kind="stable")
            marks = np.searchsorted(end[order], np.arange(found.last + 2))
            found.ends[m] = place[word[inside[order]]], at[order], marks
        return found


def _forward(found: Found, table: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Sum of all segmentations of each prefix: one row per word and boundary.

    Sums are relative to the exponential of the second array, if there is one: from
    every ``EPOCH``-th boundary of a word on, to the sum at the boundary before it.
    """
    boundary, size = found.boundary, found.lengths[found.longest_first]
    alpha = np.zeros((int(size.sum()) + len(size), table.shape[1]))
    shift = np.zeros_like(alpha) if found.last >= EPOCH else None
    alpha[boundary] = 1.0
    begun, base, factor = 0, np.zeros((len(size), table.shape[1])), None
    for t in range(1, found.last + 1):
        active = int(np.searchsorted(-size, -t, side="right"))
        into = boundary[:active] + t
        if t % EPOCH == 0:
            reference = alpha[into - 1]
            begun, base, factor = t, base[:active] + np.log(reference), 1.0 / reference
        total = np.zeros((active, table.shape[1]))
        for m in range(1, min(t, len(found.ends)) + 1):
            words, rows = found.at(m, t)
            if len(words):
                part = alpha[into[words] - m] * table[rows]
                if t - m < begun:
                    part *= factor[words]
                total[words] += part
        alpha[into] = total
        if shift is not None:
            shift[into] = base[:active]
    return alpha, shift


def _backward(found: Found, table: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """The same of each suffix, epochs being counted from the words' ends."""
    boundary, size = found.boundary, found.lengths[found.longest_first]
    beta = np.zeros((int(size.sum()) + len(size), table.shape[1]))
    shift = np.zeros_like(beta) if found.last >= EPOCH else None
    end = boundary + size
    beta[end] = 1.0
    # Pieces by the number of characters from their first to the word's end.
    starts = {}
    for m, (words, rows, marks) in found.ends.items():
        back = size[words] - np.repeat(np.arange(len(marks) - 1), np.diff(marks)) + m
        order = np.argsort(back, kind="stable")
        starts[m] = words[order], rows[order], np.searchsorted(back[order], np.arange(found.last + 2))
    begun, base, factor = 0, np.zeros((len(size), table.shape[1])), None
    for back in range(1, found.last + 1):
        active = int(np.searchsorted(-size, -back, side="right"))
        into = end[:active] - back
        if back % EPOCH == 0:
            reference = beta[into + 1]
            begun, base, factor = back, base[:active] + np.log(reference), 1.0 / reference
        total = np.zeros((active, table.shape[1]))
        for m in range(1, min(back, len(starts)) + 1):
            words, rows, marks = starts[m]
            there = slice(marks[back], marks[back + 1])
            if marks[back] < marks[back + 1]:
                part = beta[into[words[there]] + m] * table[rows[there]]
                if back - m < begun:
                    part *= factor[words[there]]
                total[words[there]] += part
        beta[into] = total
        if shift is not None:
            shift[into] = base[:active]
    return beta, shift


def _padded(probabilities: np.ndarray) -> np.ndarray:
    """Piece probabilities with the row for an uncovered character."""
    return np.vstack([probabilities, np.full((1, probabilities.shape[1]), UNKNOWN)])


def _chunks(words: list[str]) -> Iterator[slice]:
    """Slices of words with about ``WORD_CHARS`` characters, or one longer word."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = 0
    while begin < len(words):
        end = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + WORD_CHARS, side="right"))
        yield slice(begin, max(end, begin + 1))
        begin = max(end, begin + 1)


def word_scores(table: PieceTable, probabilities: np.ndarray, words: list[str]) -> np.ndarray:
    """Log probability of each word (rows) in each language (columns)."""
    scores = np.zeros((len(words), probabilities.shape[1]))
    padded = _padded(probabilities)
    for part in _chunks(words):
        found = table.find(words[part])
        alpha, shift = _forward(found, padded)
        end = found.starts + np.arange(len(found.starts)) + found.lengths
        scores[part] = np.log(alpha[end]) + (0.0 if shift is None else shift[end])
    return scores


def expected_counts(table: PieceTable, probabilities: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in one language's words."""
    uses = np.zeros(table.size + 1)
    padded = _padded(probabilities)
    for part in _chunks(words):
        found = table.find(words[part])
        # Sums and shares as logarithms, since those of long words leave the range of a double.
        (alpha, up), (beta, down) = _forward(found, padded), _backward(found, padded)
        prefix = np.log(alpha[:, 0]) + (0.0 if up is None else up[:, 0])
        suffix = np.log(beta[:, 0]) + (0.0 if down is None else down[:, 0])
        whole = prefix[found.boundary + found.lengths[found.longest_first]]
        times = counts[part][found.longest_first]
        chances = np.log(padded[:, 0])
        for m, (at, rows, marks) in found.ends.items():
            end = found.boundary[at] + np.repeat(np.arange(len(marks) - 1), np.diff(marks))
            share = np.exp(prefix[end - m] + chances[rows] + suffix[end] - whole[at]) * times[at]
            uses += np.bincount(rows, share, table.size + 1)
    return uses[: table.size]


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall(text.lower()) if text else []


class LanguageModel:
    """Piece probabilities per language; ``languages`` may be empty.

    Its size is the vocabulary's times the number of languages, whatever the
    corpus, so it travels with the tasks."""

    def __init__(self, vocabulary: list[str], languages: list[str], priors: np.ndarray, probabilities: np.ndarray):
        self.vocabulary, self.languages = vocabulary, languages
        self.priors, self.probabilities = priors, probabilities
        self._table: PieceTable | None = None
        self._known: dict[str, int] = {}
        self._scores = np.zeros((0, len(languages)))

    def _rows(self, words: list[str]) -> np.ndarray:
        """Where each word's scores are in ``_scores``; only words not met before are scored."""
        new = list(dict.fromkeys(word for word in words if word not in self._known))
        if len(self._known) + len(new) > REMEMBERED:
            new, self._known, self._scores = list(dict.fromkeys(words)), {}, self._scores[:0]
        if new:
            if self._table is None:
                self._table = PieceTable(self.vocabulary)
            self._known |= {word: at for at, word in enumerate(new, len(self._known))}
            self._scores = np.concatenate([self._scores, word_scores(self._table, self.probabilities, new)])
        return np.fromiter((self._known[word] for word in words), np.int64, len(words))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        found = [words_of(text) for text in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        written = np.flatnonzero(sizes)
        if not len(written) or not self.languages:
            return labels, scores
        rows = self._rows([word for words in found for word in words])
        starts = (np.cumsum(sizes) - sizes)[written]
        total = np.add.reduceat(self._scores[rows], starts, axis=0) + self.priors
        best = total.argmax(axis=1)
        posterior = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        scores[written] = posterior
        for row, language in zip(written.tolist(), best.tolist()):
            labels[row] = self.languages[language]
        return labels, scores

    def forget(self) -> None:
        """Drop the remembered words; a worker that is used again starts small."""
        self._known, self._scores = {}, self._scores[:0].copy()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def fit(labelled: DataFrame, vocabulary: list[str], fit_documents: int = FIT_DOCUMENTS, rounds: int = ROUNDS) -> LanguageModel:
    """Learn from (doc_id, text, lang) rows.

    At most about ``fit_documents`` documents of each language, those with the
    lowest id hashes, are counted into a stored table of (lang, word, times);
    every round is one pass over it.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    shares = {row["lang"]: row["cnt"] for row in labelled.groupBy("lang").agg(F.count("*").alias("cnt")).collect()}
    languages = sorted(shares)
    if not languages:
        return LanguageModel(vocabulary, [], np.zeros(0), np.zeros((len(vocabulary), 0)))
    draw = (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 40) - 1))) / float(1 << 40)
    limit = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, fit_documents / shares[lang]))])
    chosen = labelled.where(draw <= limit[F.col("lang")]).select("lang", "text")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            langs = batch.column("lang").to_pylist()
            counts: dict[tuple[str, str], int] = {}
            for lang, text in zip(langs, batch.column("text").to_pylist()):
                for word in words_of(text):
                    counts[lang, word] = counts.get((lang, word), 0) + 1
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in counts]), pa.array([k[1] for k in counts]), pa.array(list(counts.values()), pa.int64())],
                    ["lang", "word", "times"],
                )

    table = chosen.mapInArrow(split, "lang string, word string, times long")
    table = materialize(table.groupBy("lang", "word").agg(F.sum("times").alias("times")), "language-words")

    column = {lang: i for i, lang in enumerate(languages)}
    probabilities = np.full((len(vocabulary), len(languages)), 1.0 / max(1, len(vocabulary)))
    for _ in range(rounds):
        current = probabilities

        def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            pieces_of = PieceTable(vocabulary)
            uses = np.zeros(current.shape)
            for frame in frames:
                for lang, part in frame.groupby("lang"):
                    i = column[lang]
                    uses[:, i] += expected_counts(pieces_of, current[:, [i]], part["word"].tolist(), part["times"].to_numpy(float))
            piece, i = np.nonzero(uses)
            yield pd.DataFrame({"piece": piece, "i": i, "uses": uses[piece, i]})

        found = table.mapInPandas(count, "piece int, i int, uses double").groupBy("piece", "i").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full(probabilities.shape, PRIOR_COUNT)
        # Rounded, so that the order in which partial sums meet does not show.
        uses[found["piece"], found["i"]] += np.round(found["uses"].to_numpy(float), 6)
        probabilities = uses / uses.sum(axis=0)
    total = sum(shares.values())
    return LanguageModel(vocabulary, languages, np.log([shares[x] / total for x in languages]), probabilities)


def identify(docs: DataFrame, model: LanguageModel, label: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the language of its text and the posterior; columns of these names are replaced."""
    kept = docs.drop(label, score)
    carrier = docs.sparkSession.sparkContext.broadcast(model)
    names = [*kept.columns, label, score]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SCORED_CHARS):
            labels, scores = carrier.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(scores)], names)
        carrier.value.forget()

    schema = kept.limit(0).withColumns({label: F.lit("").cast("string"), score: F.lit(0.0)}).schema
    return kept.mapInArrow(released(predict), schema)
