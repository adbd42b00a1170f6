import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ratingloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_like_the_library(documents):
    rng = random.Random(5)
    letters = list("ab  \n\n\t\r\x1c\x85\x0b'std19½é中\U0001f600<|>-_") + ["<|endoftext|>", "'ll", " ", "　"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [r["text"] or "" for r in documents.select("text").collect()]
    vocabulary = bpe.Vocabulary(PATH)
    got = bpe.Encoder(vocabulary).encode(texts)
    tokenizer = Tokenizer.from_file(PATH)
    for text, ids, want in zip(texts, got, library(texts)):
        numbers = np.frombuffer(ids, "<u4")
        assert numbers.tolist() == want, text
        assert bpe.decode(vocabulary, numbers) == text == tokenizer.decode(want, skip_special_tokens=False)


def test_merges_interact_across_words():
    vocabulary = bpe.Vocabulary(PATH)
    words = [b"aaaaaaa", b"banana", b"", b"a", b"abababab", b" the", b"\xf0\x9f\x98\x80"]
    ids, sizes = bpe.encode_together(vocabulary, words)
    assert sizes[2] == 0 and len(ids) == sizes.sum()
    at = 0
    for word, size in zip(words, sizes):
        assert ids[at : at + size].tolist() == library([word.decode()])[0]
        at += size


def test_odd_rows(odd, nothing, wide):
    import hashlib

    rows = bpe.round_trips(odd, PATH).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert len(rows) == odd.count()
    assert by_id[3]["n_tokens"] == 0 and by_id[3]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    for text in odd.where("doc_id = -5").collect():
        assert by_id[-5]["decoded_sha256"] == hashlib.sha256(text["text"].encode()).hexdigest()
    assert bpe.round_trips(nothing, PATH).count() == 0
    encoded = bpe.encode(wide, PATH)
    assert encoded.columns.count("ids") == 1
    assert {r["doc_id"]: list(r["ids"]) for r in encoded.collect()}[9] == library(["zwei Worte"])[0]
