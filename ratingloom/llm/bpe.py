"""Byte-level BPE encoding and decoding with a pair occurrence index.

All distinct word pieces of a stretch of a partition are encoded together: their
symbols lie in one list with links to the next and previous symbol, and an index
maps each mergeable pair to all its positions.  The ranks present are taken in
ascending order; each is applied at all its positions, and the lists of the
pairs that arise or vanish at its borders are updated.  A merge only makes pairs
of higher rank, because their rule names the merged symbol, so ascending order
over the whole stretch gives each piece its own order.

Nulls and odd input: a null text counts as empty and has no ids.  Any Unicode
text round-trips.  Special tokens written in a text become their own ids, as
with the public library's default.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.batches import list_column, pieces

# Fixed value: the pattern that cuts text into word pieces for this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Distinct word pieces that are encoded together, and remembered encodings.
STRETCH, REMEMBERED = 200_000, 1_000_000

_WORD_PIECES = regex.compile(PATTERN)
# Where the only white space is spaces and line feeds, word pieces never reach
# over the start of a white-space run, so each such part can be cut by itself.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_PARTS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return [names[b] for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes of a public tokenizer file; a fixed size."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        names = byte_characters()
        ids = described["model"]["vocab"]
        added = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.of_byte = np.array([ids[name] for name in names], np.int64)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(described["model"]["merges"]):
            self.merges.setdefault(ids[a] << 32 | ids[b], (rank, ids[a + b]))
        byte_of = {name: bytes([b]) for b, name in enumerate(names)}
        self.token_bytes = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for token, i in ids.items():
            if token not in added:
                self.token_bytes[i] = b"".join(byte_of[c] for c in token)
        for token, i in added.items():
            self.token_bytes[i] = token.encode()
        self.special = added


def encode_together(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    if not total:
        return np.empty(0, np.uint32), sizes
    first = vocabulary.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    symbols = first.tolist()
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    following = np.full(total, -1, np.int64)
    following[inner] = inner + 1
    before = np.full(total, -1, np.int64)
    before[inner + 1] = inner
    following, before = following.tolist(), before.tolist()

    # The index: positions of each pair, for pairs that some rule merges.
    merges = vocabulary.merges
    places: dict[int, list[int]] = {}
    pairs = first[inner] << 32 | first[inner + 1]
    order = np.argsort(pairs, kind="stable")
    sorted_pairs, at = pairs[order], inner[order]
    begins = np.flatnonzero(np.diff(sorted_pairs, prepend=-1))
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(at)]):
        pair = int(sorted_pairs[begin])
        if pair in merges:
            places[pair] = at[begin:end].tolist()
    active = [(merges[pair][0], pair) for pair in places]
    heapq.heapify(active)

    while active:
        _, pair = heapq.heappop(active)
        left, right = pair >> 32, pair & 0xFFFFFFFF
        merged = merges[pair][1]
        ahead = merged << 32
        found = places.pop(pair)
        if left == right:
            found.sort()  # of overlapping occurrences the first one merges
        for i in found:
            j = following[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # an earlier merge took one of the two
            after, previous = following[j], before[i]
            symbols[i], symbols[j] = merged, -1
            following[i] = after
            if after >= 0:
                before[after] = i
                made = ahead | symbols[after]
                known = places.get(made)
                if known is not None:
                    known.append(i)
                elif made in merges:
                    places[made] = [i]
                    heapq.heappush(active, (merges[made][0], made))
            if previous >= 0:
                made = symbols[previous] << 32 | merged
                known = places.get(made)
                if known is not None:
                    known.append(previous)
                elif made in merges:
                    places[made] = [previous]
                    heapq.heappush(active, (merges[made][0], made))
    final = np.array(symbols, np.int64)
    live = final >= 0
    return final[live].astype(np.uint32), np.bincount(owner[live], minlength=len(words))


class Encoder:
    """Encodes texts; remembers parts of text that were met before, within a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._ids: dict[str, bytes] = {}  # part of a text to its ids, little-endian
        special = sorted(vocabulary.special, key=len, reverse=True)
        self._special = re.compile("|".join(map(re.escape, special))) if special else None

    def _learn(self, parts: list[str]) -> None:
        """Encodings of parts not met before, in stretches."""
        for begin in range(0, len(parts), STRETCH):
            stretch = parts[begin : begin + STRETCH]
            # Letters after at most one space are one word piece, which needs no pattern.
            cut = [[part] if part.isascii() and part.lstrip(" ").isalpha() and not part.startswith("  ") else _WORD_PIECES.findall(part) for part in stretch]
            distinct = list(dict.fromkeys(chain.from_iterable(cut)))
            ids, sizes = encode_together(self.vocabulary, [word.encode("utf-8", "surrogatepass") for word in distinct])
            data, ends = ids.astype("<u4").tobytes(), (np.cumsum(sizes) * 4).tolist()
            encoded = {word: data[a:b] for word, a, b in zip(distinct, [0, *ends], ends)}
            for part, words in zip(stretch, cut):
                self._ids[part] = encoded[words[0]] if len(words) == 1 else b"".join([encoded[word] for word in words])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cuts: list[list[str | bytes]] = []
        for text in texts:
            text = text or ""
            runs = [(text, None)]
            if self._special and self._special.search(text):
                runs, at = [], 0
                for m in self._special.finditer(text):
                    runs.append((text[at : m.start()], m.group()))
                    at = m.end()
                runs.append((text[at:], None))
            parts: list[str | bytes] = []
            for run, special in runs:
                parts += _PARTS.findall(run) if not _OTHER_SPACE.search(run) else ([run] if run else [])
                if special is not None:
                    parts.append(self.vocabulary.special[special].to_bytes(4, "little"))
            cuts.append(parts)
        known = self._ids
        if len(known) > REMEMBERED:
            known.clear()
        new = {part for parts in cuts for part in parts if part not in known and isinstance(part, str)}
        self._learn(sorted(new))
        return [b"".join([known[part] if isinstance(part, str) else part for part in parts]) for parts in cuts]


def decode(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of the ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
    table = vocabulary.token_bytes
    return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, text: str = "text", output: str = "ids") -> DataFrame:
    """``docs`` with the ids of its text as array<int> (a column of that name is replaced)."""
    kept = docs.drop(output)
    names = [*kept.columns, output]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(path))
        for batch in pieces(batches, text):
            encoded = encoder.encode(batch.column(text).to_pylist())
            ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
            yield pa.RecordBatch.from_arrays([*batch.columns, list_column(ids, sizes)], names)

    schema = kept.limit(0).withColumn(output, F.array().cast("array<int>")).schema
    return kept.mapInArrow(compute, schema)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and the digests of the ids and of the text they decode to."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        encoder = Encoder(vocabulary)
        for batch in pieces(batches, "text"):
            encoded = encoder.encode(batch.column("text").to_pylist())
            decoded = [decode(vocabulary, np.frombuffer(ids, "<u4")) for ids in encoded]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded]),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(compute, schema)
